"""Quality rules: hashed n-gram log-likelihood ratio of trusted target to raw corpus (operator 3).

Texts are cut into runs of letters and digits and runs of punctuation; their
unigrams and bigrams are hashed into BUCKETS counters.  One pass over all
documents counts them for the raw corpus and for the trusted target (documents
labelled good); a second pass scores every document by the mean over its n-grams
of ``log(p_target / p_raw)``.  Both multinomials get additive smoothing, the target's
scaled by its share of all n-grams, so that an n-gram seen once or never tells
little in a corpus of any size.  A document below THRESHOLD is rejected.  Counts cover all documents, and each document is judged by the same
fixed threshold.  The only table sent to all tasks has BUCKETS numbers.

Base rules come first: too few words, or too many words in repeated 3-word windows.

Defined results: null and empty texts have no words, score 0 and fail the base
rules; repeated rows are counted and judged each; without any trusted document the
ratio is 0 for all and the base rules decide; an empty table gives no rows; extra
columns are not read (the pipeline keeps them by joining on the row's own columns).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import scan
from tillsight.llm.staging import join_small, prepare, read

BUCKETS = 1 << 17
SMOOTHING = 5.0
#: Mean log ratio below which a document is junk; text like the trusted target lies near 0.
THRESHOLD = -0.4
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
_SYMBOL = scan.table(SYMBOLS)


def ngrams(chunk: scan.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Text index and bucket of each unigram and bigram; needs ``chunk.ranges()``."""
    kind = np.where(scan.SPACE[chunk.data], 0, np.where(scan.ALNUM[chunk.data], 1, 2)).astype(np.uint8)
    start, end = chunk.runs(kind)
    h, doc = chunk.hash(start, end), chunk.doc(start)
    pair = scan.mix(h[:-1] * np.uint64(3) + h[1:])[doc[:-1] == doc[1:]]
    pair_doc = doc[:-1][doc[:-1] == doc[1:]]
    both = np.concatenate([h, pair])
    return np.concatenate([doc, pair_doc]), (both & np.uint64(BUCKETS - 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        trusted = batch.column("trusted").fill_null(False).to_numpy(zero_copy_only=False)
        for c in scan.chunks(batch.column("text")):
            c.ranges()
            doc, bucket = ngrams(c)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[trusted[c.lo:c.hi][doc]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])],
                                     names=["bucket", "raw", "target"])


def log_ratios(docs: DataFrame) -> np.ndarray:
    """``log(p_target / p_raw)`` of each bucket, from all of ``docs(text, trusted)``."""
    sums = (docs.select("text", "trusted").mapInArrow(_count, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    bucket = sums["bucket"].to_numpy()
    raw[bucket], target[bucket] = sums["raw"].to_numpy(), sums["target"].to_numpy()
    if not target.sum():
        return np.zeros(BUCKETS)
    share = target.sum() / raw.sum()
    return np.log((target + SMOOTHING * share) / (share * (raw + SMOOTHING)))


def measure(c: scan.Chunk, ratios: np.ndarray) -> dict[str, np.ndarray]:
    """Counts and mean log ratio of each text of a chunk."""
    c.ranges()
    start, end = c.words()
    doc, h = c.doc(start), c.hash(start, end)
    in_word = ~scan.SPACE[c.data]
    firsts = (c.data & 0xC0) != 0x80
    out = {"n_words": np.bincount(doc, minlength=c.n), "word_chars": c.total(in_word & firsts),
           "n_symbols": c.total(_SYMBOL[c.data])}
    line_doc, a, b = c.lines()
    has_word = np.searchsorted(start, b) > np.searchsorted(start, a)
    line_doc, a, b = line_doc[has_word], a[has_word], b[has_word]
    salt = scan.mix(np.arange(1, c.n + 1, dtype=np.uint64))
    _, later = scan.repeated(scan.mix(c.hash(a, b) ^ salt[line_doc]))
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=c.n)
    covered = np.zeros(len(h), bool)
    if len(h) > 2:
        at = np.flatnonzero(doc[:-2] == doc[2:])
        window = scan.mix(scan.mix(scan.mix(h[at]) + h[at + 1]) + h[at + 2]) ^ salt[doc[at]]
        at = at[scan.repeated(scan.mix(window))[0]]
        for k in range(3):
            covered[at + k] = True
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=c.n)
    gram_doc, bucket = ngrams(c)
    n = np.bincount(gram_doc, minlength=c.n)
    out["llr"] = np.bincount(gram_doc, weights=ratios[bucket], minlength=c.n) / np.maximum(n, 1)
    return out


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` plus counts, llr, base_failed and kept.

    ``trusted`` has the doc_id of the trusted documents.
    """
    flag = F.lit(True).alias("trusted")
    marked = join_small(docs.select("doc_id", "text"), trusted.select("doc_id").distinct().select("doc_id", flag),
                        "doc_id", "left")
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(marked))
    names = docs.columns
    clash = [n for n in names if n in (*_COUNTS, "llr", "base_failed", "kept")]
    kept_names = [n for n in names if n not in clash]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratios.value
        for batch in batches:
            parts = [measure(c, table) for c in scan.chunks(batch.column("text"))]
            found = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in _COUNTS]
            llr = np.concatenate([p["llr"] for p in parts]) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept_names), *(pa.array(f.astype(np.int64)) for f in found), pa.array(llr)],
                names=[*kept_names, *_COUNTS, "llr"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept_names),
                        *(f"{n} long" for n in _COUNTS), "llr double"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (docs.select(*kept_names).mapInArrow(score, schema).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good."""
    return read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, trusted_ids(spark, sf_dir)).drop("text")
