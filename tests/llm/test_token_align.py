"""Operator 13 against plain alignment with whole texts and dictionaries, and the perfect hash by itself."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillsight.llm import staging, token_align

SF = "/root/testdata/sf0.001"
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 47, n))
    made = token_align.PerfectHash.unpack(token_align.PerfectHash.build(keys).pack())
    assert made.n == len(keys)
    assert sorted(made.number(keys).tolist()) == list(range(len(keys)))
    if n:
        assert len(made.pack()) < 4 * n + 200  # far below the keys themselves


def test_lookup_verifies_keys():
    keys = np.arange(5, 500, 5)
    made = token_align.PerfectHash.build(keys)
    ordered = np.zeros(len(keys), "<i8")
    ordered[made.number(keys)] = keys
    shards = token_align.Shards([(0, made.pack(), ordered.tobytes(), np.arange(len(keys)).astype("<i8").tobytes())], 1)
    assert sorted(shards.counts_of(keys).tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        shards.counts_of(np.arange(1, 400, 7))


def plain(texts):
    """The contract in plain Python."""
    a_path, b_path = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    a_tok, b_tok = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a_tok.encode_special_tokens = True
    value = {c: b for b, c in enumerate(token_align.byte_symbols())}

    def b_bytes(i):
        piece = b_tok.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_tok.is_byte(i) else piece.replace("▁", " ").encode()

    found, pairs = [], Counter()
    for text in texts:
        groups, links, a_ids, b_ids = [], [], [], []
        if text:
            a_ids, b_ids = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
            a_parts = [bytes(value[c] for c in a_tok.id_to_token(i)) for i in a_ids]
            b_parts = [b_bytes(i) for i in b_ids]
            if not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
                a_ids, b_ids = [], []
            else:
                ends_a, ends_b, n = {}, {}, 0
                for i, p in zip(a_ids, a_parts):
                    n += len(p)
                    ends_a[n] = i
                n = 0
                for i, p in zip(b_ids, b_parts):
                    n += len(p)
                    ends_b[n] = i
                own_a, own_b, rest_b = [], [], list(ends_b.items())
                for end, i in ends_a.items():
                    own_a.append(str(i))
                    if end in ends_b:
                        while rest_b and rest_b[0][0] <= end:
                            own_b.append(str(rest_b.pop(0)[1]))
                        groups.append(",".join(own_a) + "|" + ",".join(own_b))
                        links.append((i, ends_b[end]))
                        own_a, own_b = [], []
        pairs.update(links)
        found.append((len(a_ids), len(b_ids), groups, links))
    best = Counter()
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    return [(a, b, len(groups), len(links), sum(pairs[x] == best[x[1]] for x in links), sum(pairs[x] for x in links),
             ";".join(groups)) for a, b, groups, links in found]


def test_query(spark):
    docs = [tuple(r) for r in staging.read(spark, SF, "documents").select("doc_id", "text").collect()]
    want = {d: (*row[:6], hashlib.sha256(row[6].encode()).hexdigest() if row[0] else "")
            for (d, _), row in zip(docs, plain([t for _, t in docs]))}
    got = token_align.op13_token_align(spark, SF)
    assert got.columns == ["doc_id", *NAMES, "groups_sha256"]
    assert {r["doc_id"]: (*[r[n] for n in NAMES], r["groups_sha256"]) for r in got.collect()} == want


@pytest.fixture(scope="module")
def odd_docs():
    rng = random.Random(4)
    docs = [(None, None), (1, ""), (2, " "), (3, "  two  spaces \n\n"), (4, "under▁line"), (5, "<s></s><|endoftext|> <0x41>"),
            (6, "é中\U0001f600 \t\x00z"), (7, "a" * 300), (8, "It's 1234567 o'clock"), (9, "the the the the"),
            (None, "same words here"), (None, "same words here"), (10, "trailing 　 space "), (11, "ﬁne  x")]
    docs += [(20 + k, " ".join(rng.choice(["the", "cat", "naïve", "x1", "...", "Жук", "a  b"]) for _ in range(40))) for k in range(40)]
    return docs + [(99, "the cat")] * 30


@pytest.mark.parametrize("parts, at_once, shard_pairs", [(1, 1 << 22, 1 << 16), (40, 1 << 22, 16), (7, 32, 16)])
def test_odd_rows(spark, odd_docs, parts, at_once, shard_pairs):
    """Also with many tasks (a tree of sums) and with several blocks of shards."""
    df = spark.createDataFrame([(*d, "x", 1) for d in odd_docs], "doc_id long, text string, groups string, n_a int")
    got = token_align.alignments(df.repartition(parts), token_align.public_pair, at_once, shard_pairs).collect()
    want = [(d, *row) for (d, _), row in zip(odd_docs, plain([t for _, t in odd_docs]))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r["doc_id"], *[r[n] for n in NAMES], r["groups"]) for r in got], key=key) == sorted(want, key=key)


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.alignments(empty, token_align.public_pair).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {r["n_a"] for r in token_align.alignments(blank, token_align.public_pair).collect()} == {0}


def test_chunks_change_nothing():
    """Texts cut into chunks give the tokens and groups of the whole text."""
    rng = random.Random(6)
    words = ["the", "x", "été", "don't", "12", " ", "\n", "\t", "　", "'s", "...", "中文", "  ", "́", "\x1c", "\xa0"]
    texts = ["".join(rng.choice(words) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    texts += [" ".join(rng.choice(["the", "été,", "\n", "a\nb", "中文"]) for _ in range(30)) for _ in range(100)]
    aligner = token_align.Aligner(*token_align.public_pair(), lambda chunks: None)
    got = [aligner.chunks(t) for t in texts * 2]
    want = plain(texts)
    assert sum(map(len, got)) > 10 * len(texts)
    for cs, row in zip(got, want * 2):
        assert (sum(c.n_a for c in cs), sum(c.n_b for c in cs), ";".join(c.groups for c in cs)) == (row[0], row[1], row[6])


def test_chunks_are_aligned_once_while_common(monkeypatch):
    """Common chunks stay known while others come and go, and distinct chunks of many texts are looked up together."""
    monkeypatch.setattr(token_align, "KNOWN_CHUNKS", 2000)
    aligned = []
    aligner = token_align.Aligner(*token_align.public_pair(), aligned.extend)
    common = [f"common{k}" for k in range(200)]
    texts = [" ".join([*common, *(f"once{k}x{i}" for i in range(300)), "a  b", "\nc"]) for k in range(20)] + [None, ""]
    for lo in range(0, len(texts), 2):
        some = texts[lo:lo + 2]
        table, numbers, ends = aligner.many(some)
        assert len(set(map(id, table))) == len(table)
        found = [[table[k] for k in part] for part in np.split(numbers, ends[:-1])]
        for cs, row in zip(found, plain(some), strict=True):
            assert (sum(c.n_a for c in cs), sum(c.n_b for c in cs), ";".join(c.groups for c in cs)) == (row[0], row[1], row[6])
    assert len(aligned) == 200 + 20 * 300 + 1  # the last: a  b \nc
