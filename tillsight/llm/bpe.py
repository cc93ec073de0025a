"""BPE encoding and decoding with a public vocabulary (operator 9).

Text becomes words as the vocabulary file says (composed form, lower case, white
space dropped, split into letters, digits and other signs).  A word starts as one
symbol for each byte; the pair of neighbours with the lowest merge rank is joined
until no pair has a rank.  Symbols form a doubly linked list; candidate pairs wait
in a priority queue by rank and position, and an entry whose symbols have changed
since is stale and skipped.  Decoding joins the vocabulary strings of the ids by
spaces (the file names no decoder).

Each task keeps the results of words it has met, up to CACHE_WORDS, then starts
that table anew.

Defined results: null is an empty text, which has no ids and decodes to the empty
string; texts of any length are encoded whole; repeated rows are repeated; an empty
table gives no rows; other columns are kept as they are, those named like an output
column are replaced.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm.staging import prepare, read

CACHE_WORDS = 200_000
#: Word pattern of the vocabulary file; a fixed value (white space spelled out).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
_loaded: dict[str, "Bpe"] = {}


def byte_symbols() -> list[str]:
    """One printable character for each byte: itself if printable, else from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Bpe:
    """Vocabulary, merges and the word cache of one task."""

    def __init__(self, spec: str):
        loaded = json.loads(spec)
        model = loaded["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.ranks = {tuple(pair): k for k, pair in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in loaded["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.find = regex.compile(WORDS).findall
        self.strings = {i: s for s, i in (*self.vocab.items(), *self.special.items())}
        self.bytes = byte_symbols()
        self.cache: dict[str, bytes] = {}

    def merge(self, word: str) -> list[str]:
        """Symbols of one word."""
        sym = [self.bytes[b] for b in word.encode()]
        sym[-1] += self.suffix
        n = len(sym)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple[int, int, str, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                rank = self.ranks.get((sym[i], sym[after[i]]))
                if rank is not None:
                    heapq.heappush(queue, (rank, i, sym[i], sym[after[i]]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if sym[i] != left or j < 0 or sym[j] != right:  # stale
                continue
            sym[i] = left + right
            sym[j] = ""
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [s for s in sym if s]

    def word(self, word: str) -> bytes:
        """Ids (little-endian, 32 bits each) of one word."""
        ids = b"".join(self.vocab[s].to_bytes(4, "little") for s in self.merge(word))
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        self.cache[word] = ids
        return ids

    def words(self, text: str) -> list[str]:
        return self.find(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids of a whole text as bytes, and the text that they decode to."""
        ids, get = [], self.cache.get
        for k, part in enumerate(self.split_special.split(text) if "<|" in text else [text]):
            if k % 2:
                ids.append(self.special[part].to_bytes(4, "little"))
                continue
            ids += [get(w) or self.word(w) for w in self.words(part)]
        coded = b"".join(ids)
        return coded, self.decode(coded)

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings of ids, joined by spaces."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, spec: str, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``docs`` with n_tokens, ids (binary, 32-bit little-endian) and decoded.

    ``spec`` is the text of a tokenizer file; it is sent to the tasks once, and its
    size does not depend on the data.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(spec)
    made = {"n_tokens": "long", "ids": "binary", "decoded": "string"}
    names = [n for n in (columns or docs.columns) if n not in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(shared.value)
        for batch in batches:
            texts = batch.column(text)
            for lo in range(0, len(texts), 256):
                part = batch.slice(lo, 256)
                got = [bpe.encode(t or "") for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array([len(i) // 4 for i, _ in got], pa.int64()),
                     pa.array([i for i, _ in got], pa.binary()), pa.array([s for _, s in got], pa.string())],
                    names=[*names, *made])

    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{n}` {fields[n]}" for n in names), *(f"{n} {t}" for n, t in made.items())])
    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(run, schema)


def word_bpe_spec() -> str:
    """The tokenizer file of the registered queries."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of every document."""
    prepare(spark)
    coded = encode(read(spark, sf_dir, "documents"), word_bpe_spec(), columns=["doc_id"])
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
