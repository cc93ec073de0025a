"""Corpus pipeline: quality rules, near-duplicates, repeated passages, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
All but the last return the columns of ``documents``:

1. ``quality_rules`` drops the documents that the rules reject;
2. ``near_duplicates`` keeps one document of each group, that with the smallest doc_id
   (rows without doc_id come last; texts without a word are alone);
3. ``repeated_passages`` removes repeated 100-byte strings from the texts; bytes of a
   character that was cut through go too, and n_chars is counted anew;
4. ``source_mix`` repeats or drops documents so that sources meet their target weights;
5. ``tokens`` gives doc_id, lang, source, n_tokens, ids (32-bit little-endian) and decoded.

No stage fails on null texts, empty tables or extra columns; what they give there is
stated by the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import bpe, minhash, mixing, staging, suffix_dedup
from tillsight.llm import quality_rules as rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    staging.prepare(spark)
    return rules.judge(docs.select(COLUMNS), rules.trusted_ids(spark, sf_dir)).filter("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates.

    Texts are compared, not ids: each distinct text has a number of its own (a 64-bit
    hash) whatever doc_ids it stands under, and of each class one row stays, that with the
    smallest doc_id (none last), then the smallest digest of the row (its text by digest).
    """
    staging.prepare(spark)
    docs = docs.select(COLUMNS)
    # the text's own digest stands for it, so that no copy of a long text is made
    short = F.struct(*[F.md5("text").alias(c) if c == "text" else F.col(c) for c in COLUMNS])
    row = [F.xxhash64("text").alias("__text"), F.md5(F.to_json(short)).alias("__digest")]
    worded = F.coalesce(F.regexp_like("text", F.lit(mixing.WORD)), F.lit(False))
    judged = minhash.near_duplicates(docs.filter(worded).select("doc_id", "text", *row).withColumnsRenamed(
        {"doc_id": "__id", "__text": "doc_id"})).select(F.col("doc_id").alias("__text"), "class_id", "__id", "__digest")
    judged = staging.stage(judged, "pipeline-judged")
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__digest").alias("digest")))
    groups = staging.stage(judged.groupBy("class_id").agg(F.count("*").alias("n"), first.alias("__first")).filter("n > 1")
                           .select("class_id", "__first"), "pipeline-groups")
    texts = judged.select("__text", "class_id").distinct().join(groups, "class_id").withColumn("__worded", F.lit(True))
    marked = staging.join_small(docs.select("*", *row, worded.alias("__worded")), texts, ["__text", "__worded"], "left")
    alone = marked.filter("class_id is null").select(COLUMNS)
    best = marked.filter((F.col("__digest") == F.col("__first.digest")) & F.col("doc_id").eqNullSafe(F.col("__first.id")))
    return alone.unionByName(best.dropDuplicates(["class_id"]).select(COLUMNS))  # those left of a class are equal rows


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what stood earlier."""
    staging.prepare(spark)
    done = suffix_dedup.remove_repeats(docs.select(COLUMNS), as_text=True)
    done = done.withColumn("text", F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept")))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    staging.prepare(spark)
    return mixing.take(docs.select(COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document of the mix."""
    staging.prepare(spark)
    return bpe.encode(docs.select(COLUMNS), bpe.word_bpe_spec(), columns=["doc_id", "lang", "source"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

#: Suffix arrays, sampling and BPE are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet before the next."""
    docs = staging.read(spark, sf_dir, "documents").select(COLUMNS)
    for name, step in STAGES[:-1]:
        docs = staging.stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
