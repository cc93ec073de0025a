"""The chain against enumeration, and held-out accuracy."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillsight.llm import line_crf as crf

SF = "/root/testdata/sf0.01"


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(3)
    doc = np.array([0, 0, 0, 1, 2, 2, 2, 2, 3, 3])
    pull, pair = rng.normal(size=len(doc)) * 2, rng.normal(size=(2, 2))
    good, pairs, log_z = crf.forward_backward(doc, pull, pair)
    want_good, want_pairs, want_z = np.zeros(len(doc)), np.zeros((2, 2)), 0.0
    for d in range(4):
        at = np.flatnonzero(doc == d)
        paths = list(itertools.product((0, 1), repeat=len(at)))
        weight = [math.exp(sum(pull[i] * s for i, s in zip(at, p)) + sum(pair[x, y] for x, y in zip(p, p[1:]))) for p in paths]
        z = sum(weight)
        want_z += math.log(z)
        for p, w in zip(paths, weight):
            for i, s in zip(at, p):
                want_good[i] += s * w / z
            for x, y in zip(p, p[1:]):
                want_pairs[x, y] += w / z
    assert good == pytest.approx(want_good)
    assert pairs == pytest.approx(want_pairs)
    assert log_z == pytest.approx(want_z)


def test_held_out_accuracy(spark):
    rows = crf.op7_line_crf(spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert rows.count() == n
    assert rows.filter("score < 0 or score > 1 or score is null").count() == 0
    fold = rows.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 4 == 2)).count()
    assert fold == 0
    known = rows.filter("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    right = known.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.97


def test_held_out_labels_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    flipped = labels.withColumn("quality", F.when(crf.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = crf.train(docs, labels, 200), crf.train(docs, flipped, 200)
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a b\n\nc", 1), (1, "a b\n\nc", 1), (2, None, 2), (3, "", 3), (None, "x" * 100_000, 4)],
                                 "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert crf.train(docs, none) is None
    assert {r["score"] for r in crf.score(docs, None).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 4)], "doc_id long, quality int")
    model = crf.train(docs, labels)
    got = crf.score(docs, model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 1}) == 1
    assert len({r["score"] for r in got if r["doc_id"] in (2, 3)}) == 1
    assert crf.score(docs.filter(F.lit(False)), model).count() == 0


def test_piece_size_does_not_matter():
    texts = pa.array(["one line.\nTWO!! LINES!!\n\n| a | b |", None, "", "x\n" * 50, "é" * 10])
    doc = np.array([0, 0, 1])
    x = crf.with_neighbours(doc, np.random.default_rng(0).normal(size=(3, 16)))
    model = crf.fit(doc, x, np.array([0, 0, 1]))
    whole = crf.score_texts(texts, model)
    alone = np.concatenate([crf.score_texts(texts.slice(i, 1), model) for i in range(len(texts))])
    assert whole == pytest.approx(alone)


def test_scores_do_not_depend_on_partitions(spark):
    """Equal bit for bit in 1, 7 and 200 partitions; a shared doc_id gives the same model each time."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.limit(50).select("doc_id", F.concat("text", F.lit(" more"))))
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = []
    for parts in (1, 7, 200):
        rows = crf.score(docs.repartition(parts), crf.train(docs.repartition(parts), labels)).collect()
        got.append(sorted((r["doc_id"], r["score"].hex(), r["predicted"]) for r in rows))
    assert got[0] == got[1] == got[2]
