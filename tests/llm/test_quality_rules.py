"""Quality rules against plain Python counts and a brute-force likelihood ratio."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillsight.llm import quality_rules as q
from tillsight.llm import scan

SF = "/root/testdata/sf0.001"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_match_plain_python():
    texts = ["", None, "a", "a b c a b c a", "x\nx\n x\n\n\nx", "é　ß #|<", "a\x0bb\x0cc\rd a b c d", " \n ", "日本 語\n日本 語\n",
             "a b c\n" * 40, "abcab cab", "\n\n", "w " * 500]
    ratios = np.zeros(q.BUCKETS)
    parts = [q.measure(c, ratios) for c in scan.chunks(pa.array(texts, pa.string()), 64)]
    got = list(zip(*(np.concatenate([p[k] for p in parts]).tolist() for k in q._COUNTS)))
    assert got == [counts(t) for t in texts]


def grams(text):
    runs = re.findall(r"[0-9A-Za-z_\x80-\U0010ffff]+|[^0-9A-Za-z_\x80-\U0010ffff\x20\x09-\x0D]+", text or "")
    spaced = [m.span() for m in re.finditer(r"[0-9A-Za-z_\x80-\U0010ffff]+|[^0-9A-Za-z_\x80-\U0010ffff\x20\x09-\x0D]+", text or "")]
    assert len(runs) == len(spaced)
    return runs + list(zip(runs, runs[1:]))


def log_ratio(raw, target, gram):
    """Log of the two smoothed shares of an n-gram."""
    n_raw, n_target = raw.total(), target.total()
    a_raw, a_target = q.SMOOTHING, q.SMOOTHING * n_target / n_raw
    p_target = (target[gram] + a_target) / (n_target + a_target * q.BUCKETS)
    return math.log(p_target / ((raw[gram] + a_raw) / (n_raw + a_raw * q.BUCKETS)))


def test_ratio_matches_brute_force(spark):
    """With few distinct n-grams buckets do not clash, so exact counting must agree."""
    texts = [(1, "the cat sat on the mat"), (2, "the cat sat"), (3, "### $$$ buy buy buy"), (4, None), (5, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["llr"] for r in q.judge(docs, spark.createDataFrame([(1,), (2,)], "doc_id long")).collect()}
    raw, target = Counter(), Counter()
    for i, t in texts:
        raw.update(grams(t))
        target.update(grams(t) if i in (1, 2) else [])
    for i, t in texts:
        g = grams(t)
        want = sum(log_ratio(raw, target, x) for x in g) / max(len(g), 1)
        assert got[i] == pytest.approx(want, abs=1e-9)


def test_whole_table(spark):
    rows = q.op3_quality_rules(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = counts(texts[r["doc_id"]])
        assert tuple(r[k] for k in q._COUNTS) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_labelled_good_documents_stay(spark, sf):
    rows = q.op3_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = rows.filter(~F.col("base_failed")).groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r["quality"]: r["kept"] for r in rows.collect()}
    assert kept[1] == 1 and kept[0] < 0.1


def test_edges(spark):
    docs = spark.createDataFrame([(None, "a " * 60, 1), (2, None, 2), (2, None, 2), (3, "b", 3)],
                                 "doc_id long, text string, n_words int")
    none = spark.createDataFrame([], "doc_id long")
    got = q.judge(docs, none)
    assert got.columns.count("n_words") == 1
    assert sorted(r["n_words"] for r in got.collect()) == [0, 0, 1, 60]
    assert q.judge(docs.filter("doc_id = 99"), none).count() == 0
