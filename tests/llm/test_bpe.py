"""BPE against the tokenizers library, and its own round trip."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillsight.llm import bpe

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(bpe.word_bpe_spec())


def ids_of(raw: bytes) -> list[int]:
    return [int.from_bytes(raw[k:k + 4], "little") for k in range(0, len(raw), 4)]


def test_random_texts_match_the_library(library, own):
    rng = random.Random(7)
    pools = ["abcdefghij theTHE's 'll 've'd1234567890", "äöüÄÖÜßéèÉÈçÇñÑ ΣσςΑΒ İıǅ Ǆ", "\t\n\r\x0b\x0c\x1c\x85\xa0 　 ab",
             "日本語한국어العربيةहिन्दी ๐๑", "👍🏽👩‍👩‍👧 éå ﬁ½²Ⅷ", "!!!???###$$$%%%&&&***<>|/\\~^`", "<|startoftext|><|endoftext|><|", "\u0000​﻿�"]
    for _ in range(1500):
        text = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.2:
            text += rng.choice(["<|endoftext|>", "<|startoftext|>x", " <|endoftext|> "])
        ids, decoded = own.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(ids) == want, text
        assert decoded == library.decode(want, skip_special_tokens=False) == own.decode(ids), text


def test_long_word(library, own):
    word = "".join(random.Random(1).choice("abcdeé") for _ in range(5000))
    assert ids_of(own.encode(word)[0]) == library.encode(word, add_special_tokens=False).ids


def test_whole_table_matches_the_library(spark, library):
    rows = {r["doc_id"]: r for r in bpe.op9_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        want = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = rows[d["doc_id"]]
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in want)).hexdigest()
        decoded = library.decode(want, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_nulls_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, "x", 5), (1, None, "x", 5), (2, "", None, 6), (None, "The cat", "y", 7)],
                                 "doc_id long, text string, decoded string, n_tokens int")
    got = sorted(map(tuple, bpe.encode(docs, bpe.word_bpe_spec()).select("doc_id", "n_tokens", "decoded").collect()), key=str)
    assert got == sorted([(1, 0, ""), (1, 0, ""), (2, 0, ""), (None, 2, "the</w> cat</w>")], key=str)
    assert bpe.encode(docs.filter(F.lit(False)), bpe.word_bpe_spec()).count() == 0


def test_decoded_text_comes_from_the_ids():
    own = bpe.Bpe(bpe.word_bpe_spec())
    own.strings[own.vocab["the</w>"]] = "changed"
    assert own.encode("the cat")[1] == "changed cat</w>"
