"""Removal of repeated strings against a dictionary of all 100-byte strings."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillsight.llm import scan
from tillsight.llm import suffix_dedup as s

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) of distinct documents, in order."""
    seen, out = set(), {}
    key = lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest() if r[1] is not None else "")
    for doc_id, text in sorted(set(rows), key=key):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            w = raw[k:k + 100]
            if w in seen:
                gone[k:k + 100] = b"\x01" * 100
            else:
                seen.add(w)
        stay = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[doc_id, text] = (doc_id, len(raw), sum(gone), spans, hashlib.sha256(stay).hexdigest())
    return [out[r] for r in rows]


def run(spark, rows, shard=s.SHARD, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    done = s.remove_repeats(df, shard)
    return sorted(map(tuple, done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()), key=str)


def text(rng, n, alphabet="abcdefgh ié\n"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def planted(seed):
    rng = random.Random(seed)
    passages = [text(rng, rng.choice([40, 97, 99, 100, 101, 150, 400])) for _ in range(8)]
    rows = []
    for k in range(120):
        t = text(rng, rng.randint(0, 200))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            t += (p if rng.random() < 0.7 else p[rng.randint(0, 40):]) + text(rng, rng.randint(0, 120))
        rows.append((k * 37 % 1009, t))
    rows += [(2000 + k, passages[-1] * 3) for k in range(5)] + [(2010, "ab" * 400), (2011, "ab" * 90), (2012, "x" * 100),
                                                                (2013, "x" * 99), (2014, "x" * 250)]
    rows += [(3000 + k, text(rng, 30) + passages[6] + passages[7]) for k in range(40)]
    return rows


def test_planted_passages(spark):
    rows = planted(1)
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_frequent_anchors_are_split_and_merged(spark):
    rows = planted(2)
    assert run(spark, rows, shard=5, parts=7) == sorted(brute(rows), key=str)


def test_suffix_array_and_prefixes():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 300))) for _ in range(30)] + [b"a" * 300, b"a" * 150]
    doc, lo = np.arange(len(texts)), np.zeros(len(texts), np.int64)
    number, byte, _, _, later = s.shard_repeats(doc, lo, texts)
    got = {(int(t), int(b)): bool(x) for t, b, x in zip(number, byte, later)}
    seen, want = set(), {}
    for t, raw in enumerate(texts):
        for k in range(len(raw) - 99):
            want[t, k] = raw[k:k + 100] in seen
            seen.add(raw[k:k + 100])
    assert got == want


def test_merged_ranges():
    doc, lo, hi = (np.array(x) for x in ([2, 1, 1, 1, 2, 1], [5, 0, 30, 8, 0, 50], [9, 10, 40, 30, 5, 60]))
    assert [x.tolist() for x in s.merged(doc, lo, hi)] == [[1, 1, 2], [0, 50, 0], [40, 60, 9]]


def test_anchors_do_not_depend_on_pieces():
    texts = [t for _, t in planted(3)]
    parts = []
    for limit in (1, 1 << 20):
        found = set()
        for c in scan.chunks(pa.array(texts), limit):
            place, a, lo, hi, around = s.anchors(c)
            doc = c.doc(place)
            found |= set(zip((doc + c.lo).tolist(), (place - c.off[doc]).tolist(), a.tolist(), around.tolist()))
        parts.append(found)
    assert parts[0] == parts[1]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, s.op8_suffix_dedup(spark, SF).collect())) == sorted(brute(rows))


def test_edges(spark):
    long = "0123456789" * 30
    rows = [(1, None), (2, ""), (3, long), (4, long), (4, long), (5, "q" + long), (5, long + "z"), (None, long), (None, "y" * 120),
            (-7, long[:150])]
    assert run(spark, rows) == sorted(brute(rows), key=str)
    df = spark.createDataFrame([(1, long, 5)], "doc_id long, text string, kept int")
    done = s.remove_repeats(df)
    assert done.columns.count("kept") == 1 and done.first()["n_removed"] == 290
    assert s.remove_repeats(df.filter(F.lit(False))).count() == 0


def test_a_third_without_id_and_ids_on_several_texts(spark):
    """Texts that share or lack an id are documents of their own, in the order of their digests, also in split shards."""
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 and k % 2 else d, t) for k, (d, t) in enumerate(planted(11))]
    rows += rows[:9] + [(None, None), (7, None)]
    want = sorted(brute(rows), key=str)
    for shard in (3, s.SHARD):
        assert run(spark, rows, shard) == want
    numbers = s.numbered(spark.createDataFrame(rows, "doc_id long, text string")).select("__doc", "__copy", "text").distinct()
    own = [(r["__doc"], r["__copy"]) for r in numbers.collect()]
    assert len(own) == len(set(own)) == len(set(rows))
