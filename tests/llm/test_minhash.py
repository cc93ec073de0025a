"""Near-duplicate classes against all pairs by exact weighted Jaccard similarity."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillsight.llm import minhash as m
from tillsight.llm import scan

SF = "/root/testdata/sf0.01"


def sets(texts):
    """Weighted shingles of each text, with exact document frequencies."""
    counts = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        counts.append(Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)] if w else []))
    df = Counter(s for c in counts for s in c)
    idf = {s: 1 + m.IDF_SPAN * min(1.0, max(0.0, math.log(len(texts) / n) / math.log(m.RARE))) for s, n in df.items()}
    return [{s: n * idf[s] for s, n in c.items()} for c in counts]


def similarity(a, b):
    low = sum(min(w, b[s]) for s, w in a.items() if s in b)
    return low / (sum(a.values()) + sum(b.values()) - low) if a and b else 0.0


def classes(rows):
    weighted = sets([t for _, t in rows])
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for k, s in enumerate(weighted):
        for x in s:
            index.setdefault(x, []).append(k)
    tried = set()
    for ks in index.values():
        for k in ks:
            for j in ks:
                if k < j and (k, j) not in tried and find(rows[k][0]) != find(rows[j][0]):
                    tried.add((k, j))
                    if similarity(weighted[k], weighted[j]) >= 0.8:
                        a, b = find(rows[k][0]), find(rows[j][0])
                        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in rows}


def words(rng, n):
    return [f"w{rng.randint(0, 5000)}" for _ in range(n)]


def edited(rng, w, share):
    w = list(w)
    for _ in range(max(1, int(share * len(w)))):
        w[rng.randrange(len(w))] = f"e{rng.randint(0, 9999)}"
    return w


def test_classes_match_all_pairs(spark):
    rng = random.Random(11)
    rows = []
    for g in range(25):
        base = words(rng, rng.randint(3, 300))
        rows += [" ".join(base)] * rng.randint(1, 3)
        rows += ["\n ".join(edited(rng, base, rng.choice([0.004, 0.01, 0.015, 0.1]))) for _ in range(rng.randint(0, 5))]
    hot = words(rng, 200)
    rows += [" ".join(edited(rng, hot, 0.01)) for _ in range(60)]
    shared = words(rng, 60)
    rows += [" ".join(words(rng, 40) + shared + words(rng, 40)) for _ in range(40)]
    chain = words(rng, 400)
    rows += [" ".join(chain[k:k + 300]) for k in range(0, 100, 20)]
    rng.shuffle(rows)
    rows = [(k * 7 % 100003, t) for k, t in enumerate(rows)]
    got = m.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = classes(rows)
    wrong = [r["doc_id"] for r in got if want[r["doc_id"]] != r["class_id"]]
    assert len(got) == len(rows) and len(wrong) <= len(rows) // 100
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)


def test_samples_collide_as_often_as_the_sets_are_similar():
    rng = np.random.default_rng(2)
    key = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    a, b = rng.uniform(0.5, 3, 300).astype(np.float32), rng.uniform(0.5, 3, 300).astype(np.float32)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    first, size = np.array([0]), np.array([300])
    hits = [m.samples(key, a, first, size, k)[0] == m.samples(key, b, first, size, k)[0] for k in range(3000)]
    assert np.mean(hits) == pytest.approx(want, abs=0.03)


def test_shingles_do_not_depend_on_pieces():
    texts = pa.array(["a b c d e f a b c d e", "a b", None, "", "a b c d e", "x"])
    whole = [set(zip(d.tolist(), k.tolist(), n.tolist())) for c in scan.chunks(texts) for d, k, n in [m.shingles(c)]][0]
    parts = set()
    for i in range(len(texts)):
        for c in scan.chunks(texts.slice(i, 1)):
            _, k, n = m.shingles(c)
            parts |= set(zip([i] * len(k), k.tolist(), n.tolist()))
    assert whole == parts
    assert {d for d, _, _ in whole} == {0, 1, 4, 5}


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["class_id"] for r in m.op5_minhash(spark, SF).collect()}
    want = classes(rows)
    assert sum(got[i] != want[i] for i, _ in rows) <= 5


def test_edges(spark):
    rows = [(1, None, 1), (2, "", 2), (3, " \n", 3), (4, "one two", 4), (5, "one two", 5), (5, "one two", 5), (6, "one", 6),
            (None, "one two", 7), (8, "long " * 50_000, 8), (9, "long " * 50_000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, class_id int")
    got = m.near_duplicates(df)
    assert got.columns.count("class_id") == 1
    assert sorted(((r["doc_id"], r["class_id"], r["kept"]) for r in got.collect()), key=str) == sorted(
        [(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (5, 4, False), (6, 6, True), (None, None, True),
         (8, 8, True), (9, 8, False)], key=str)
    assert m.near_duplicates(df.filter(F.lit(False))).count() == 0
