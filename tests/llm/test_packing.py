"""Operator 12: the plan against exact packing and plain best fit, pieces against the library."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillsight.llm import packing, staging

SF = "/root/testdata/sf0.001"


def least_bins(sizes, capacity):
    """Fewest sequences, by trying every placement (small instances)."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for i in sorted({r: i for i, r in enumerate(rooms)}.values()):
            if rooms[i] >= sizes[k]:
                go(k + 1, rooms[:i] + [rooms[i] - sizes[k]] + rooms[i + 1:])
        go(k + 1, [*rooms, capacity - sizes[k]])

    go(0, [])
    return best


def plain_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - s)
        else:
            rooms.append(capacity - s)
    return len(rooms)


def counted(sizes):
    return {s: sizes.count(s) for s in set(sizes)}


def check_plan(sizes, capacity):
    """Every rank has one place, sequences are gapless and not overfull; the number of sequences."""
    runs = packing.plan(counted(sizes), capacity)
    filled = {}
    for s, n in counted(sizes).items():
        sequence, offset = packing.places(runs, np.full(n, s), np.arange(n))
        for q, o in zip(sequence.tolist(), offset.tolist()):
            filled.setdefault(q, []).append((o, s))
    for items in filled.values():
        end = 0
        for o, s in sorted(items):
            assert o == end
            end += s
        assert end <= capacity
    assert len(filled) == int(runs["sequences"])
    return len(filled)


def test_reduction_keeps_the_optimum():
    """Fixed sequences plus an exact packing of the rest need no more than an exact packing of all."""
    rng = random.Random(1)
    fixed_any = 0
    for _ in range(300):
        capacity = rng.choice([10, 15, 24])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        left = packing.Counts(counted(sizes))
        fixed = packing.reduced(left, capacity)
        rest = [s for s, n in left.n.items() for _ in range(n)]
        used = [s for items, n in fixed for _ in range(n) for s in items]
        assert sorted(used + rest) == sorted(sizes)
        assert all(sum(items) <= capacity for items, _ in fixed)
        fixed_any += len(fixed) > 0
        assert sum(n for _, n in fixed) + least_bins(rest, capacity) == least_bins(sizes, capacity), sizes
    assert fixed_any > 200


def test_dominating_set_dominates():
    """By the definition: each other feasible set's pieces go into groups under pieces of the found set."""
    rng = random.Random(2)

    def under(other, found):
        for where in itertools.product(range(len(found)), repeat=len(other)):
            if all(sum(x for x, w in zip(other, where) if w == k) <= f for k, f in enumerate(found)):
                return True
        return False

    tried = 0
    for _ in range(400):
        capacity = rng.choice([12, 20])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 7))]
        j = max(sizes)
        found = packing.dominating(j, packing.Counts(counted(sizes)), capacity)
        if found is None:
            continue
        tried += 1
        others = sorted(sizes, reverse=True)[1:]
        for n in range(len(others) + 1):
            for other in set(itertools.combinations(others, n)):
                if j + sum(other) <= capacity:
                    assert under(other, found[1:] or (0,)), (sizes, found, other)
    assert tried > 200


def test_plan_is_no_worse_than_best_fit():
    rng = random.Random(3)
    for k in range(200):
        capacity = rng.choice([20, 64, 100, 2048])
        most = capacity if k % 2 else max(1, capacity // 3)
        sizes = [rng.randint(1, most) for _ in range(rng.randint(0, 150))] + [rng.randint(1, capacity)] * rng.randint(0, 40)
        n = check_plan(sizes, capacity)
        assert -(-sum(sizes) // capacity) <= n <= plain_best_fit(sizes, capacity) + 1
        left = packing.Counts(counted(sizes))
        assert sum(m for _, m in packing.best_fit(left, capacity)) == plain_best_fit(sizes, capacity)


def test_plan_size_follows_lengths_not_rows():
    rng = random.Random(4)
    counts = {s: rng.randint(1, 10**9) for s in range(1, 2049)}
    runs = packing.plan(counts)
    assert len(runs["length"]) < 30_000
    assert int(runs["sequences"]) <= 1.02 * sum(s * n for s, n in counts.items()) / 2048 + 1


def whole(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4") for t in texts]


def check_packed(rows, docs, capacity):
    """The contract, for collected rows and (doc_id, text) docs."""
    by_doc, filled = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in filled.values():
        end = 0
        for o, n in sorted(items):
            assert o == end
            end += n
        assert end <= capacity
    want = {}
    for (doc, _), ids in zip(docs, whole([t for _, t in docs])):
        ids = np.append(ids, np.uint32(0)).astype("<u4")
        for k, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start:start + capacity]
            want.setdefault(doc, []).append((k, start, len(cut), zlib.crc32(cut.tobytes())))
    assert {d: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rs) for d, rs in by_doc.items()} == {
        d: sorted(p) for d, p in want.items()}
    sizes = [n for items in filled.values() for _, n in items]
    return len(filled), sizes


def test_query(spark):
    docs = [tuple(r) for r in staging.read(spark, SF, "documents").select("doc_id", "text").collect()]
    n, sizes = check_packed(packing.op12_best_fit(spark, SF).collect(), docs, 2048)
    assert n <= plain_best_fit(sizes, 2048)


@pytest.mark.parametrize("parts", [1, 7])
def test_odd_rows(spark, parts):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    docs = [(None, None), (1, ""), (1, None), (2, "word " * 9000), (2, "x" * 70_000), (3, "<|endoftext|> a <|startoftext|>"),
            (4, "  é ́ ΑΣ ΣΑΣ.  \n\t" * 9000), (None, "same text"), (None, "same text"), (5, "It's 12 o'clock")]
    docs += [(None, "copy of a text") for _ in range(40)] + [(k, "w " * rng.randint(0, 30)) for k in range(10, 60)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, ids string, length int").repartition(parts)
    rows = packing.pack(df, packing.word_bpe, capacity=64).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packed(rows, docs, 64)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), packing.word_bpe).collect() == []


def test_words_are_looked_up_once_and_their_parts_shared(monkeypatch):
    """The library is not asked anew for words met lately, nor for the same letters with other signs."""
    path = public_tokenizers.path("word_bpe_49k.json")
    asked = []

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode_batch_fast(self, texts, **options):
            asked.extend(w for t in texts for w in t.replace(packing.MARK, " ").split())
            return self.tokenizer.encode_batch_fast(texts, **options)

    class Library:
        @staticmethod
        def from_file(path):
            return Counted(Tokenizer.from_file(path))

    monkeypatch.setattr("tokenizers.Tokenizer", Library)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 2000)
    monkeypatch.setattr(packing, "_known", {})
    encode = packing.word_encoder(path)
    common = [f"Common{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    texts = [" ".join([*common, *(f"once{k}x{i}" for i in range(300)), *(c + "," for c in common)]) for k in range(20)]
    for lo in range(0, 20, 2):
        got = encode(texts[lo:lo + 2])
        assert [x.tolist() for x in got] == [x.tolist() for x in whole(texts[lo:lo + 2])]
    assert len(asked) == len(set(asked))  # common words stay known while others come and go
    assert sum("common" in w.lower() for w in asked) == len(common)


def test_words_encode_as_whole_texts_do():
    rng = random.Random(12)
    signs = ["a", "A", "ß", "ÿ", "Þ", "ª", "µ", "×", "÷", "<", "|", "~", "`", "_", "@", "[", "\\", "]", "^", "&", "*", ",", ".", "2", "x", "İ", "é",
             "\x01", "\x1c", "\x85", "\xa0", " ", " ", "\n", "\x0b", "\x0c", "\x00", "<|endoftext|>", "Σ", "'s", "'re", "'", "中", "\u0301"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    got = packing.word_bpe()(texts)
    assert [x.tolist() for x in got] == [x.tolist() for x in whole(texts)]
    assert packing.word_bpe()([]) == []
    assert [len(x) for x in packing.word_bpe()(["", " \n"])] == [0, 0]
