"""The pipeline against the plain versions of its stages, on a small folder and on odd rows."""

import functools
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_minhash import classes
from test_mixing import brute_mix
from test_quality_rules import counts, grams, log_ratio
from tokenizers import Tokenizer

import corpus_pipeline as p
from tillsight.llm import quality_rules

SF = "/root/testdata/sf0.001"


def without_repeats(rows):
    """doc_id -> what stays of the text, documents in order of doc_id."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        raw = text.encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            w = raw[k:k + 100]
            if w in seen:
                gone[k:k + 100] = b"\x01" * 100
            seen.add(w)
        out[doc_id] = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
    return out


def plain(docs, trusted):
    raw, target = Counter(), Counter()
    for i, (text, _) in docs.items():
        g = grams(text)
        raw.update(g)
        target.update(g if i in trusted else [])
    ratio = functools.cache(lambda x: log_ratio(raw, target, x))

    def good(text):
        n, _, _, _, repeats = counts(text)
        g = grams(text)
        if n < 50 or 100 * repeats > 50 * n:
            return False
        return sum(map(ratio, g)) / len(g) >= quality_rules.THRESHOLD

    kept = {i: t for i, (t, _) in docs.items() if good(t)}
    name = classes(list(kept.items()))
    rest = without_repeats([(i, t) for i, t in kept.items() if name[i] == i])
    copies, _ = brute_mix([(i, counts(t)[0], docs[i][1]) for i, t in rest.items()])
    return {i: (rest[i], n) for i, n in copies.items() if n}


def test_run_matches_the_plain_versions(spark):
    import public_tokenizers
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    want = plain({r["doc_id"]: (r["text"], r["source"]) for r in rows}, trusted)
    got = p.run(spark, SF).collect()
    assert Counter(r["doc_id"] for r in got) == {i: n for i, (_, n) in want.items()}
    for r in got:
        ids = library.encode(want[r["doc_id"]][0], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert bytes(r["ids"]) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)


def odd_rows(spark):
    words = " ".join(f"word{k}" for k in range(80))
    rows = [(1, words, "en", "a", 1), (2, words, "en", "a", 1), (2, words, "en", "a", 1), (3, None, None, None, None), (4, "", "en", "b", 0),
            (None, "x " + words[::-1], None, None, 7), (5, "é" * 20_000 + " " + words, "fr", "b", 9), (6, "other " + words * 3, "en", None, 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(
        "*", F.lit(1).alias("kept"), F.lit("x").alias("class_id"), F.lit(0).alias("copies"))


@pytest.mark.parametrize("name,step", p.STAGES)
def test_stages_take_odd_rows_and_empty_tables(spark, name, step):
    docs = odd_rows(spark)
    out = step(spark, docs, SF)
    assert out.columns == (p.COLUMNS if name != "tokens" else ["doc_id", "lang", "source", "n_tokens", "ids", "decoded"])
    rows = out.collect()
    if name in ("repeated_passages", "tokens"):
        assert len(rows) == docs.count()
    if name == "near_duplicates":
        assert Counter(r["doc_id"] for r in rows) == {1: 1, 3: 1, 4: 1, None: 1, 6: 1}  # 2 and 5 are like 1
    empty = step(spark, docs.filter(F.lit(False)), SF)
    assert empty.columns == out.columns and empty.count() == 0


def test_near_duplicates_go_by_text_not_by_id(spark):
    """Ids on several texts, equal rows, and a third of the ids null: every class keeps one row, no text is lost."""
    def text(k, n=60):
        return " ".join(f"w{k}x{i}" for i in range(n))

    near = text(1) + " and one more"
    rows = [(1, text(1)), (1, text(1)), (3, text(3)), (3, text(1)), (1, text(9)), (2, near), (2, text(4)),
            (None, text(5)), (None, text(5)), (None, text(1)), (None, text(6)), (7, text(6)), (8, text(8)), (9, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"], r["text"]) for r in p.near_duplicates(spark, docs.repartition(4), SF).collect()), key=repr)
    want = [(1, text(1)), (1, text(9)), (2, text(4)), (3, text(3)), (None, text(5)), (7, text(6)), (8, text(8)), (9, ""), (None, None)]
    assert got == sorted(want, key=repr)


def test_clean_documents_pass_the_filters(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = p.quality_rules(spark, docs, sf).select("doc_id")
    clean = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").join(docs, "doc_id")
    clean = clean.filter(F.regexp_count("text", F.lit(r"\S+")) >= 50)
    assert clean.join(kept, "doc_id", "left_anti").count() <= clean.count() // 100
