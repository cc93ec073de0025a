"""Near-duplicate documents by consistent weighted sampling (operator 5).

A document is the weighted set of its five-word shingles, with weight term
frequency times inverse document frequency.  Improved consistent weighted sampling
draws BANDS x ROWS samples of each set such that two documents get the same sample
with a probability equal to their weighted Jaccard similarity; ROWS samples make a
band, and documents that share a band are candidates.  Candidates are verified by
their exact weighted Jaccard similarity (0.8 or more links them), and connected
documents are one group, named by its smallest doc_id.

Inverse document frequency is ``1 + IDF_SPAN * min(1, ln(N / df) / ln(RARE))``, from 1
for a shingle in every document to 1 + IDF_SPAN for one in a thousandth or less, whatever
the size of the corpus.  The span is small: the words that an editor changes are rare
by nature and those that many copies keep are not, so a wide span would part the
members of large groups.  df is counted over all documents in DF_BUCKETS hashed counters: shingles
that clash add up, to about the same share of all shingles at any size, below
what counts as rare; only the counters (a fixed number) reach the driver.

Texts that are equal are one class from the start, so copies cost one row each.
A group of candidates is never spread into all its pairs.  First every member is
compared with its group's first member.  Groups that are not connected by that are
cut into blocks of texts; pairs of blocks, but for those whose texts are connected
already, are compared inside a task, which gives a spanning set of links for each
pair of blocks.  So every candidate link between unconnected texts is found, and
rows grow with blocks, not with the square of a group.

Defined results: texts without words (null and empty too) are alone; texts of one to
four words are one shingle; rows without doc_id are alone; equal rows get equal results;
an empty table gives no rows; other columns are kept, those named like an output
column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillsight.llm import scan
from tillsight.llm.components import components
from tillsight.llm.staging import join_small, prepare, read, stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 8, 3
DF_BUCKETS = 1 << 20
RARE = 1000.0
IDF_SPAN = 0.2
#: Most texts of a block of a group, and most weight (about one for each word).
BLOCK_ROWS, BLOCK_WEIGHT = 256, 150_000


def shingles(c: scan.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and term frequency of the distinct shingles of a chunk's texts, by text."""
    c.ranges()
    start, end = c.words()
    doc, h = c.doc(start), c.hash(start, end)
    n = np.bincount(doc, minlength=c.n)
    at = np.flatnonzero(doc[:len(doc) - SHINGLE + 1] == doc[SHINGLE - 1:]) if len(doc) >= SHINGLE else np.zeros(0, int)
    key = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        key = scan.mix(key + h[at + k])
    few = np.flatnonzero((n > 0) & (n < SHINGLE))
    first = np.searchsorted(doc, few)
    short = np.zeros(len(few), np.uint64)
    for k in range(SHINGLE - 1):
        more = n[few] > k
        short[more] = scan.mix(short[more] + h[first[more] + k])
    key, owner = np.r_[key, short], np.r_[doc[at], few]
    salt = scan.mix(np.arange(1, c.n + 1, dtype=np.uint64))
    _, where, tf = np.unique(key ^ salt[owner], return_index=True, return_counts=True)
    order = np.lexsort((key[where], owner[where]))
    where, tf = where[order], tf[order]
    return owner[where], key[where], tf


def bucket(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(20)).astype(np.int64) & (DF_BUCKETS - 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, docs = np.zeros(DF_BUCKETS, np.int64), 0
    for batch in batches:
        docs += batch.num_rows
        for c in scan.chunks(batch.column("text")):
            _, key, _ = shingles(c)
            df += np.bincount(bucket(key), minlength=DF_BUCKETS)
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[some, -1]), pa.array(np.r_[df[some], docs])], names=["bucket", "n"])


def inverse_frequency(docs: DataFrame) -> np.ndarray:
    """Weight of each bucket from the document frequencies of all of ``docs(text)``."""
    got = (docs.select("text").mapInArrow(_count, "bucket long, n long").groupBy("bucket")
           .agg(F.sum("n").alias("n")).toArrow())
    df = np.ones(DF_BUCKETS + 1)
    df[got["bucket"].to_numpy()] = got["n"].to_numpy()  # bucket -1, the last, has the number of documents
    total = max(df[-1], 1.0)
    return (1 + IDF_SPAN * np.clip(np.log(total / df[:-1]) / math.log(RARE), 0, 1)).astype(np.float32)


def samples(key: np.ndarray, weight: np.ndarray, first: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """Sample k of each set (its shingles are ``first .. first + size``): hash of shingle and level."""
    z = scan.mix(key + np.uint64((0x632BE59BD9B4E019 * (k + 1)) & ((1 << 64) - 1)))

    def uniform(bits: np.ndarray, shift: int, width: int) -> np.ndarray:
        part = (bits >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        return (part.astype(np.float32) + np.float32(0.5)) / np.float32(1 << width)

    r = -np.log(uniform(z, 0, 21) * uniform(z, 21, 21))
    beta = uniform(z, 42, 22)
    z = scan.mix(z + np.uint64(0x9E3779B97F4A7C15))
    log_c = np.log(-np.log(uniform(z, 0, 24) * uniform(z, 24, 24)))
    t = np.floor(np.log(weight) / r + beta)
    a = log_c - r * (t + 1 - beta)
    low = np.repeat(np.minimum.reduceat(a, first), size)
    at = np.flatnonzero(a == low)
    at = at[np.searchsorted(at, first)]
    return scan.mix(key[at] + scan.mix((t[at].astype(np.int64) + (1 << 32)).astype(np.uint64)))


def signatures(docs: DataFrame, idf) -> DataFrame:
    """doc_id, same (digest of the text), total weight and bands of documents with words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for batch in batches:
            for c in scan.chunks(batch.column("text"), scan.CHUNK_BYTES // 2):
                doc, key, tf = shingles(c)
                if not len(doc):
                    continue
                weight = tf.astype(np.float32) * table[bucket(key)]
                first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                size = np.diff(np.r_[first, len(doc)])
                bands = np.empty((len(first), BANDS), np.int64)
                for b in range(BANDS):
                    band = np.full(len(first), b + 1, np.uint64)
                    for k in range(ROWS):
                        band = scan.mix(band + samples(key, weight, first, size, b * ROWS + k))
                    bands[:, b] = band.view(np.int64)
                rows = pa.array(doc[first] + c.lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("same").take(rows),
                     pa.array(np.add.reduceat(weight.astype(np.float64), first)),
                     pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(pa.list_(pa.int64()))],
                    names=["doc_id", "same", "total", "bands"])

    return docs.select("doc_id", "same", "text").mapInArrow(run, "doc_id long, same string, total double, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """The pairs (u, v) whose weighted Jaccard similarity is high enough."""
    def sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        for c in scan.chunks(column, scan.CHUNK_BYTES // 2):
            doc, key, tf = shingles(c)
            yield c.lo, c.hi, doc + c.lo, key, tf * idf.value[bucket(key)].astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salt = scan.mix(np.arange(1, batch.num_rows + 1, dtype=np.uint64))
            sides = [[np.concatenate(x) for x in list(zip(*sets(batch.column(name))))[2:]] for name in ("u_text", "v_text")]
            total = sum(np.bincount(doc, weights=w, minlength=batch.num_rows) for doc, _, w in sides)
            key = np.concatenate([k ^ salt[doc] for doc, k, _ in sides])
            doc, weight = np.concatenate([s[0] for s in sides]), np.concatenate([s[2] for s in sides])
            order = np.argsort(key, kind="stable")
            same = np.flatnonzero(key[order][1:] == key[order][:-1])
            both = np.minimum(weight[order[same]], weight[order[same + 1]])
            common = np.bincount(doc[order[same]], weights=both, minlength=batch.num_rows)
            ok = common >= (similarity - 1e-9) * (total - common)
            yield batch.select(["u", "v"]).filter(pa.array(ok))

    sides = [texts.select(F.col("doc_id").alias(p), F.col("text").alias(f"{p}_text")) for p in "uv"]
    return pairs.join(sides[0], "u").join(sides[1], "v").select(
        "u", "v", "u_text", "v_text").mapInArrow(run, "u long, v long")


def _spanning(a: dict, b: dict, similarity: float) -> list[tuple[int, int]]:
    """Links that join texts of two blocks whose labels are not joined yet.

    A block has, by text, ``id``, ``label`` and ``total`` weight, and the shingles of
    all its texts by key: ``key``, ``weight`` and ``doc`` (the text).
    """
    joined: dict[int, int] = {}

    def root(x: int) -> int:
        while x in joined:
            x = joined[x]
        return x

    found = []
    order = np.argsort(a["doc"], kind="stable")
    first = np.searchsorted(a["doc"][order], np.arange(len(a["id"]) + 1))
    for k in range(len(a["id"])):
        mine = order[first[k]:first[k + 1]]
        low, high = np.searchsorted(b["key"], a["key"][mine], "left"), np.searchsorted(b["key"], a["key"][mine], "right")
        n = high - low
        at = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        common = np.bincount(b["doc"][at], np.minimum(np.repeat(a["weight"][mine], n), b["weight"][at]), len(b["id"]))
        ok = (common >= (similarity - 1e-9) * (a["total"][k] + b["total"] - common)) & (b["label"] != a["label"][k])
        for j in np.flatnonzero(ok).tolist():
            x, y = root(int(a["label"][k])), root(int(b["label"][j]))
            if x != y:
                joined[max(x, y)] = min(x, y)
                found.append((int(a["id"][k]), int(b["id"][j])))
    return found


def block_links(members: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """Links (u, v) that connect the texts of each group of ``members(g, doc_id, total, label)``."""
    in_order = Window.partitionBy("g").orderBy("label", "doc_id")
    number = F.sum("total").over(in_order) / BLOCK_WEIGHT + F.row_number().over(in_order) / BLOCK_ROWS
    rows = members.withColumn("block", F.floor(number)).join(texts, "doc_id")
    blocks = stage(rows.groupBy("g", "block").agg(
        F.collect_list(F.struct("doc_id", "label", "text")).alias("docs"), F.min("label").alias("low"),
        F.max("label").alias("high")), "near-blocks")
    sides = [blocks.select("g", *(F.col(c).alias(f"{p}_{c}") for c in ("block", "docs", "low", "high"))) for p in "ab"]
    apart = (F.col("a_low") != F.col("a_high")) | (F.col("b_low") != F.col("b_high")) | (F.col("a_low") != F.col("b_low"))
    pairs = sides[0].join(sides[1], "g").filter((F.col("a_block") <= F.col("b_block")) & apart)

    def load(docs: list[dict]) -> dict:
        parts = [(doc + c.lo, key, tf) for c in scan.chunks(pa.array([d["text"] for d in docs]), scan.CHUNK_BYTES // 2)
                 for doc, key, tf in [shingles(c)]]
        doc, key, tf = (np.concatenate(x) for x in zip(*parts))
        weight = tf * idf.value[bucket(key)].astype(np.float64)
        order = np.argsort(key, kind="stable")
        return {"id": np.array([d["doc_id"] for d in docs]), "label": np.array([d["label"] for d in docs]),
                "total": np.bincount(doc, weight, len(docs)), "key": key[order], "weight": weight[order], "doc": doc[order]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = (load(batch.column(f"{p}_docs")[k].as_py()) for p in "ab")
                found = _spanning(a, b, similarity)
                yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.int64()),
                                                  pa.array([v for _, v in found], pa.int64())], names=["u", "v"])

    return pairs.select("a_docs", "b_docs").mapInArrow(run, "u long, v long")


def group_links(members: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """Links (u, v) that connect the documents of ``members(g, doc_id, total)`` as far as similarity does.

    ``label`` names the documents that are known to be connected so far.
    """
    firsts = members.groupBy("g").agg(F.min(F.struct("doc_id", "total")).alias("f")).select(
        "g", F.col("f.doc_id").alias("u"), F.col("f.total").alias("u_total"))
    alike = F.least("total", "u_total") >= similarity * F.greatest("total", "u_total") * (1 - 1e-9)
    led = stage(members.join(stage(firsts, "near-firsts"), "g").filter(F.col("doc_id") != F.col("u")), "near-members")
    pairs = stage(led.filter(alike).select("u", F.col("doc_id").alias("v")).distinct(), "near-pairs")
    links = stage(verified(pairs, texts, idf, similarity), "near-links")
    labels = stage(components(links), "near-labels")
    rest = led.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "g", "doc_id", "total", F.coalesce("label", "doc_id").alias("label"))
    # All pairs with the first are compared; a group is open if the others are not connected.
    open_ = rest.groupBy("g").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    rest = stage(rest.join(stage(open_.select("g"), "near-open"), "g", "left_semi"), "near-members")
    return links.union(stage(block_links(rest, texts, idf, similarity), "near-links"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """All columns of ``docs`` with class_id and kept (the smallest doc_id of the class)."""
    spark = docs.sparkSession
    names = [n for n in docs.columns if n not in ("class_id", "kept")]
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.md5(F.col("text")).alias("same"))
    some = base.filter("doc_id is not null and text is not null")
    idf = spark.sparkContext.broadcast(inverse_frequency(base))
    signed = stage(signatures(some, idf), "near-signatures")
    classes = stage(signed.groupBy("same").agg(F.min(F.struct("doc_id", "total", "bands")).alias("x"))
                    .select("same", "x.doc_id", "x.total", "x.bands"), "near-classes")
    bands = classes.select("doc_id", "total", F.posexplode("bands").alias("band", "h")).select(
        F.struct("band", "h").alias("g"), "doc_id", "total")
    shared = stage(bands.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1").select("g"), "near-groups")
    members = stage(bands.join(shared, "g", "left_semi"), "near-candidates")
    texts = stage(join_small(some.select("doc_id", "text"), members.select("doc_id").distinct(), "doc_id", "left_semi")
                  .dropDuplicates(["doc_id"]), "near-texts")
    links = group_links(members, texts, idf, similarity)
    labels = stage(components(links), "near-labels")
    of_class = stage(classes.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "same", F.coalesce("label", "doc_id").alias("class_id")), "near-class-ids")
    result = (docs.select(*names, F.when(F.col("doc_id").isNotNull(), F.md5(F.col("text"))).alias("same"))
              .join(of_class, "same", "left"))
    class_id = F.coalesce("class_id", F.col("doc_id").cast("long"))
    return result.select(*names, class_id.alias("class_id"), F.col("doc_id").cast("long").eqNullSafe(class_id).alias("kept"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    prepare(spark)
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
