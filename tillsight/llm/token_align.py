"""Cross-tokenizer alignment (operator 13).

Two tokenizers, A and B, cut the same bytes (a space and the text) into tokens.  Byte
offsets where tokens of both end part a document into groups; the A and B tokens that
end there are linked.  How often a pair of ids is linked in the whole corpus says which
A id a B id usually stands for.

First pass: each task aligns its documents and counts its distinct pairs.  The distinct
pairs of all tasks are split into shards by hash, and each shard gets a minimal perfect
hash: keys that are alone at their place of a bit table are settled, the others go on
to a table of the next level, until none is left; a key's number is the count of settled
places before its own, so n keys get the numbers 0 to n - 1 in a few bits each.  The
counts of a few tasks at a time become a dense vector indexed by that number, and
vectors are summed in a tree, FAN_IN at a time, until each shard has one.

Second pass: every document is aligned anew and its pairs are looked up: hash to number,
number to key (which must be the pair itself) and count.  What is sent to the tasks is
at most PAIRS_AT_ONCE pairs (20 bytes each); if there are more distinct pairs, shards
are handled in blocks of that size, one pass for each, and the sums of a document are
added up.  The best count of each B id is a vector as long as B's vocabulary.

Defined results: texts that are null or empty, and texts that a tokenizer does not give
back byte for byte, have no tokens and no groups; texts of any length are encoded whole,
in chunks cut at single spaces between other characters, where neither tokenizer has a
token across; strings of special tokens are plain text; equal rows count each; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm.bpe import byte_symbols
from tillsight.llm.scan import mix
from tillsight.llm.staging import prepare, read, stage
from tillsight.llm.words import Recent, numbered

#: Texts split together.
DOCS_AT_ONCE = 1000
#: A task remembers at most so many chunks, none longer than LONG_CHUNK characters.
KNOWN_CHUNKS = 500_000
LONG_CHUNK = 64
CHUNKS_AT_ONCE = 2000
SHARD_PAIRS = 1 << 15
PAIRS_AT_ONCE = 1 << 21
FAN_IN = 16
#: A task adds up its counted pairs when it holds so many, and hands them on if half as many are left.
HELD_PAIRS = 1 << 20
#: Places of a level's bit table for each key.
SPREAD = 2.0


# ---------------------------------------------------------------- tokenizers


class Tokens:
    """One tokenizer: ids of a text, and the bytes of each id (None: an id that no text gives)."""

    def __init__(self, encode: Callable[[str], np.ndarray], spelled: list[bytes | None]):
        self.encode = encode
        self.spelled = [x or b"" for x in spelled]
        self.size = np.array([len(x) for x in self.spelled], np.int64)

    def text(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.spelled.__getitem__, ids.tolist()))


def byte_level(path: str) -> Tokens:
    """A tokenizers file of byte-level BPE; texts are encoded after a space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    value = {c: b for b, c in enumerate(byte_symbols())}
    special = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    spelled: list[bytes | None] = [None] * (max(tokenizer.get_vocab(True).values()) + 1)
    for token, i in tokenizer.get_vocab(True).items():
        spelled[i] = token.encode() if i in special else bytes(value[c] for c in token)

    def encode(text: str) -> np.ndarray:
        return np.asarray(tokenizer.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.int64)

    return Tokens(encode, spelled)


def pieces_of(path: str) -> Tokens:
    """A sentencepiece model that puts a space before the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled: list[bytes | None] = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            spelled.append(bytes([int(piece[3:-1], 16)]))
        else:
            spelled.append(piece.replace("▁", " ").encode())

    return Tokens(lambda text: np.asarray(model.encode(text), np.int64), spelled)


class Chunk:
    """A part of a text between single spaces, aligned: numbers of tokens, links and the groups as text.

    ``pairs``: each link as one number; ``best`` and ``total``: filled in by the second pass.
    """

    __slots__ = ("n_a", "n_b", "n", "pairs", "groups", "best", "total")

    def __init__(self, n_a: int, n_b: int, pairs: np.ndarray, groups: str):
        self.n_a, self.n_b, self.n, self.pairs, self.groups = n_a, n_b, len(pairs), pairs, groups
        self.best = self.total = 0


#: Stands for a chunk that a tokenizer does not give back byte for byte.
LOST = Chunk(0, 0, np.zeros(0, np.int64), "")


class Aligner:
    """Aligns texts chunk by chunk.

    Texts are cut at single spaces between other characters.  Both tokenizers put a space
    before what they encode, so the space that is cut away comes back as the first byte
    of the next chunk, and neither has a token in which a space follows another
    character: so both have a token end before it, and a text's alignment is that of its
    chunks, one after the other.  Texts are split many at a time and each of their distinct
    chunks is looked up once; those that are not among the KNOWN_CHUNKS met last are aligned.
    ``finish`` is called with new chunks.  ``counts_only``: chunks get their pairs alone, no
    numbers of tokens and no groups.
    """

    CAREFUL = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, first: Tokens, second: Tokens, finish: Callable[[list[Chunk]], None] = lambda chunks: None,
                 counts_only: bool = False):
        self.first, self.second, self.finish, self.counts_only = first, second, finish, counts_only
        self.known = Recent(KNOWN_CHUNKS)  # by name, see name()
        self.any_lost = False
        # strings of ids with what follows them: , within a side, | after A's, ; after B's, end of the chunk
        n = self.n_ids = max(len(first.spelled), len(second.spelled))
        self.strings = [f"{i}{sep}" for sep in ",|;\n" for i in range(n)]

    def chunks(self, text: str | None) -> list[Chunk]:
        """The chunks of a text; none if it is null, empty or not given back byte for byte."""
        table, numbers, _ = self.many([text])
        return [table[k] for k in numbers.tolist()]

    def many(self, texts: list[str | None]) -> tuple[list[Chunk], np.ndarray, np.ndarray]:
        """The distinct chunks of some texts, the number of each text's chunks among them one text after
        the other, and where each text's end."""
        words, numbers, ends = numbered(pc.split_pattern(pa.array(texts, pa.large_string()), " "))
        names, numbers = words.to_pylist(), numbers.to_numpy()
        found = self.known.find(names)
        if None in found:
            new = [k for k, c in enumerate(found) if c is None]
            odd = [k for k in new if not (p := names[k]) or p[0].isspace() or p[-1].isspace()]
            if odd:
                names, numbers, ends = self.cut_with_care(texts, names, numbers, ends, odd)
                found = self.known.find(names)
            found = self.completed(names, found)
        if self.any_lost and LOST in found:
            lost = np.array([c is LOST for c in found])[numbers]
            sizes = np.diff(ends, prepend=0)
            of_text = np.repeat(np.arange(len(texts)), sizes)
            bad = np.bincount(of_text[lost], minlength=len(texts)) > 0
            numbers, ends = numbers[~bad[of_text]], np.cumsum(np.where(bad, 0, sizes))
        return found, numbers, ends

    def cut_with_care(self, texts: list[str | None], names: list[str], numbers: np.ndarray, ends: np.ndarray,
                      odd: list[int]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """As ``many`` split them, but texts with an ``odd`` word, which a split at each space must not give, by CAREFUL."""
        place = {p: k for k, p in enumerate(names)}
        cut = np.split(numbers, ends[:-1])
        for d in np.unique(np.searchsorted(ends, np.flatnonzero(np.isin(numbers, odd)), side="right")).tolist():
            parts = self.CAREFUL.split(texts[d]) if texts[d] else []
            cut[d] = np.array([place.setdefault(self.name(p), len(place)) for p in parts], np.int64)
        names = list(place)
        used, numbers = np.unique(np.concatenate(cut), return_inverse=True)
        return [names[k] for k in used.astype(np.int64).tolist()], numbers, np.cumsum([len(c) for c in cut], dtype=np.int64)

    @staticmethod
    def name(chunk: str) -> str:
        """The chunk, after a space if white space is at either end: so no word of a split at each space has its name."""
        return " " + chunk if chunk[0].isspace() or chunk[-1].isspace() else chunk

    def completed(self, names: list[str], found: list[Chunk | None]) -> list[Chunk]:
        """``found`` with the chunks that were not known aligned."""
        new = [p for p, c in zip(names, found) if c is None]
        plain, made = [p for p in new if p[0] != " "], {}
        for lo in range(0, len(plain), CHUNKS_AT_ONCE):
            some = plain[lo:lo + CHUNKS_AT_ONCE]
            made.update(zip(some, self.align(some), strict=True))
        for p in new:
            if p[0] == " ":
                made[p], = self.align([p[1:]])
        self.known.add({p: c for p, c in made.items() if len(p) <= LONG_CHUNK})
        return [made[p] if c is None else c for p, c in zip(names, found)]

    def align(self, texts: list[str]) -> list[Chunk]:
        """Align new chunks, all in one go: joined by spaces they are cut as each of them is."""
        joined = " ".join(texts)
        a, b = self.first.encode(joined), self.second.encode(joined)
        whole = (" " + joined).encode()
        if self.first.text(a) != whole or self.second.text(b) != whole:
            if len(texts) == 1:
                self.any_lost = True
                return [LOST]
            return self.align(texts[:len(texts) // 2]) + self.align(texts[len(texts) // 2:])
        at_a, at_b = np.cumsum(self.first.size[a]), np.cumsum(self.second.size[b])
        _, last_a, last_b = np.intersect1d(at_a, at_b, assume_unique=True, return_indices=True)
        ends = np.cumsum([len(t.encode()) + 1 for t in texts])
        end_a, end_b = np.searchsorted(at_a, ends) + 1, np.searchsorted(at_b, ends) + 1
        pairs = (a[last_a] << 32) | b[last_b]
        his = (np.searchsorted(last_a, end_a - 1) + 1).tolist()
        if self.counts_only:
            made = [Chunk(0, 0, pairs[lo:hi], "") for lo, hi in zip([0, *his], his)]
            self.finish(made)
            return made
        after_a, after_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        after_a[last_a], after_b[last_b], after_b[end_b - 1] = 1, 2, 3
        group_a, group_b = np.searchsorted(last_a, np.arange(len(a))), np.searchsorted(last_b, np.arange(len(b)))
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        codes = np.concatenate([after_a * self.n_ids + a, after_b * self.n_ids + b])[order]
        groups = "".join(map(self.strings.__getitem__, codes.tolist())).split("\n")
        made, lo = [], 0
        for n_a, n_b, hi, said in zip(np.diff(end_a, prepend=0).tolist(), np.diff(end_b, prepend=0).tolist(), his, groups):
            made.append(Chunk(n_a, n_b, pairs[lo:hi], said))
            lo = hi
        self.finish(made)
        return made


_kept: dict[str, Aligner] = {}


def kept_aligner(run_id: str, make: Callable[[], Aligner]) -> Aligner:
    """The aligner of one pass; a worker process keeps it for its next tasks of that pass."""
    if run_id not in _kept:
        _kept.clear()
        _kept[run_id] = make()
    return _kept[run_id]


# ---------------------------------------------------------------- minimal perfect hash


def places(keys: np.ndarray, level: int, n: int) -> np.ndarray:
    """Place of each key in a table of n bits."""
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix(keys.astype(np.uint64) ^ salt) % np.uint64(n)).astype(np.int64)


class PerfectHash:
    """Numbers 0 to n - 1 for n different keys, one each."""

    def __init__(self, tables: list[np.ndarray]):
        self.tables = tables
        self.sums = [np.r_[0, np.cumsum(t)].astype(np.int32) for t in tables]
        self.start = np.r_[0, np.cumsum([s[-1] for s in self.sums])].astype(np.int64)
        self.n = int(self.start[-1])

    @staticmethod
    def build(keys: np.ndarray) -> "PerfectHash":
        tables = []
        while len(keys):
            n = max(int(SPREAD * len(keys)), 8)
            at = places(keys, len(tables), n)
            alone = np.bincount(at, minlength=n) == 1
            tables.append(alone)
            keys = keys[~alone[at]]
        return PerfectHash(tables)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The key's number; -1 or another key's number for keys that were not built in."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (table, sums) in enumerate(zip(self.tables, self.sums)):
            at = places(keys[left], level, len(table))
            hit = table[at]
            out[left[hit]] = self.start[level] + sums[at[hit]]
            left = left[~hit]
        return out

    def pack(self) -> bytes:
        head = np.array([len(self.tables), *map(len, self.tables)], "<i8").tobytes()
        return head + b"".join(np.packbits(t).tobytes() for t in self.tables)

    @staticmethod
    def unpack(data: bytes) -> "PerfectHash":
        levels = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", levels, 8)
        tables, at = [], 8 * (levels + 1)
        for n in sizes.tolist():
            tables.append(np.unpackbits(np.frombuffer(data, np.uint8, (n + 7) // 8, at), count=n).astype(bool))
            at += (n + 7) // 8
        return PerfectHash(tables)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) >> np.uint64(33)).astype(np.int64) % shards


class Shards:
    """Counts of a block of shards, looked up by pair."""

    def __init__(self, rows: list[tuple[int, bytes, bytes, bytes]], shards: int):
        self.shards = shards
        self.hashes, self.keys, self.counts = {}, {}, {}
        for shard, packed, keys, counts in rows:
            self.hashes[shard] = PerfectHash.unpack(packed)
            self.keys[shard] = np.frombuffer(keys, "<i8")
            self.counts[shard] = np.frombuffer(counts, "<i8")

    def counts_of(self, keys: np.ndarray) -> np.ndarray:
        """Count of each pair; 0 for pairs of other blocks."""
        out, shard = np.zeros(len(keys), np.int64), shard_of(keys, self.shards)
        order = np.argsort(shard, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0, True]) if len(keys) else [0]
        for lo, hi in zip(edges[:-1], edges[1:]):
            at = order[lo:hi]
            s = int(shard[at[0]])
            if s in self.hashes:
                number = self.hashes[s].number(keys[at])
                if (number < 0).any() or (self.keys[s][number] != keys[at]).any():
                    raise ValueError("a pair of the second pass was not counted in the first")
                out[at] = self.counts[s][number]
        return out


# ---------------------------------------------------------------- passes


def added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys with a count, and the sum of each one's counts."""
    keys, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, counts)
    return keys[total > 0], total[total > 0]


def counted_pairs(docs: DataFrame, load: Callable[[], tuple[Tokens, Tokens]]) -> DataFrame:
    """First pass: (task, pair, n), a task's distinct pairs with their links (a task may list a pair again)."""
    run_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        aligner = kept_aligner(run_id, lambda: Aligner(*load(), counts_only=True))
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(keys), 100_000):
                k, n = keys[lo:lo + 100_000], counts[lo:lo + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), task, np.int32)), pa.array(k), pa.array(n)],
                                                 names=["task", "pair", "n"])

        for batch in batches:
            for lo in range(0, batch.num_rows, DOCS_AT_ONCE):
                table, numbers, _ = aligner.many(batch.column("text").slice(lo, DOCS_AT_ONCE).to_pylist())
                if len(numbers):
                    times = np.bincount(numbers, minlength=len(table))
                    held.append(added_up(np.concatenate([c.pairs for c in table]), np.repeat(times, [c.n for c in table])))
                if sum(len(keys) for keys, _ in held) > HELD_PAIRS:
                    held = [added_up(*map(np.concatenate, zip(*held)))]
                    if len(held[0][0]) > HELD_PAIRS // 2:
                        yield from out(*held.pop())
        if held:
            yield from out(*added_up(*map(np.concatenate, zip(*held))))

    return docs.select("text").mapInArrow(run, "task int, pair long, n long")


def hashed(pairs: DataFrame, shards: int) -> DataFrame:
    """A perfect hash for each shard of the distinct ``pair``: shard, hash, keys (in the order of their numbers)."""

    def build(table: pa.Table) -> pa.Table:
        keys = table.column("pair").to_numpy()
        made = PerfectHash.build(keys)
        ordered = np.zeros(len(keys), "<i8")
        ordered[made.number(keys)] = keys
        return pa.table({"shard": table.column("shard").slice(0, 1), "hash": pa.array([made.pack()], pa.binary()),
                         "keys": pa.array([ordered.tobytes()], pa.binary())})

    return with_shard(pairs.select("pair").distinct(), shards).groupBy("shard").applyInArrow(
        build, "shard long, hash binary, keys binary")


def with_shard(pairs: DataFrame, shards: int) -> DataFrame:
    """``shard`` of each pair, a narrow step of the tasks."""
    names = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard_of(b.column("pair").to_numpy(), shards))],
                                             names=[*names, "shard"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema)
    return pairs.mapInArrow(run, f"{fields}, shard long")


def summed(pairs: DataFrame, hashes: DataFrame, shards: int) -> DataFrame:
    """Dense count vectors indexed by hash number, summed in a tree: shard, counts."""

    def scatter(left: pa.Table, right: pa.Table) -> pa.Table:
        made = PerfectHash.unpack(right.column("hash")[0].as_py())
        total = np.zeros(made.n, "<i8")
        np.add.at(total, made.number(left.column("pair").to_numpy()), left.column("n").to_numpy())
        return pa.table({"shard": right.column("shard"), "node": left.column("node").slice(0, 1),
                         "counts": pa.array([total.tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = 0
        for part in table.column("counts"):
            total = total + np.frombuffer(part.as_buffer(), "<i8")
        return pa.table({"shard": table.column("shard").slice(0, 1), "node": table.column("node").slice(0, 1),
                         "counts": pa.array([total.tobytes()], pa.binary())})

    rows = with_shard(pairs, shards).withColumn("node", (F.col("task") / FAN_IN).cast("long"))
    nodes = stage(rows.select("shard", "node").distinct(), "align-nodes")
    vectors = (rows.groupBy("shard", "node")
               .cogroup(hashes.join(nodes, "shard").select("shard", "node", "hash").groupBy("shard", "node"))
               .applyInArrow(scatter, "shard long, node long, counts binary"))
    most = pairs.agg(F.max("task")).first()[0] // FAN_IN
    while most:
        most //= FAN_IN
        vectors = (stage(vectors, "align-sums").withColumn("node", (F.col("node") / FAN_IN).cast("long"))
                   .groupBy("shard", "node").applyInArrow(add, "shard long, node long, counts binary"))
    return vectors.select("shard", "counts")


def best_counts(table: DataFrame, n_second: int) -> np.ndarray:
    """The highest count of each B id; at most as many rows as B has ids reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.zeros(n_second, np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column("keys"), batch.column("counts")):
                ids = np.frombuffer(keys.as_buffer(), "<i8") & 0xFFFFFFFF
                np.maximum.at(top, ids, np.frombuffer(counts.as_buffer(), "<i8"))
        ids = np.flatnonzero(top)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(top[ids])], names=["id", "top"])

    out = np.zeros(n_second, np.int64)
    got = table.select("keys", "counts").mapInArrow(run, "id long, top long").groupBy("id").agg(F.max("top").alias("top")).toArrow()
    out[got["id"].to_numpy()] = got["top"].to_numpy()
    return out


def alignments(docs: DataFrame, load: Callable[[], tuple[Tokens, Tokens]], at_once: int = PAIRS_AT_ONCE,
               shard_pairs: int = SHARD_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (``a1,a2|b1;...``) of every document."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    pairs = stage(counted_pairs(docs, load), "align-pairs")
    n_pairs = pairs.agg(F.approx_count_distinct("pair", 0.02)).first()[0]
    shards = n_pairs // shard_pairs + 1
    hashes = stage(hashed(pairs, shards), "align-hashes")
    if not n_pairs:
        table, blocks = [], [range(1)]
        best = np.zeros(0, np.int64)
    else:
        joined = stage(hashes.join(summed(pairs, hashes, shards), "shard"), "align-counts")
        best = best_counts(joined, len(load()[1].spelled))
        per_block = max(1, at_once // shard_pairs)
        blocks = [range(lo, min(lo + per_block, shards)) for lo in range(0, shards, per_block)]
    names = ["n_best", "count_sum"]
    frame = docs.withColumns({n: F.lit(0).cast("long") for n in names})
    for k, block in enumerate(blocks):
        rows = []
        if n_pairs:
            table = joined.filter(F.col("shard").between(block[0], block[-1])).select("shard", "hash", "keys", "counts").toArrow()
            rows = [tuple(r[c] for c in ("shard", "hash", "keys", "counts")) for r in table.to_pylist()]
        shared = spark.sparkContext.broadcast((rows, shards, best))
        last = k == len(blocks) - 1
        frame = _looked_up(frame, load, shared, last, kind)
        if not last:
            frame = stage(frame, "align-block")
    return frame


def _looked_up(frame: DataFrame, load, shared, last: bool, kind: str) -> DataFrame:
    """Second pass over one block of shards; the last one gives the results."""
    sums = "n_best long, count_sum long"
    schema = (f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, {sums}, groups string" if last
              else f"doc_id {kind}, text string, {sums}")
    run_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make() -> Aligner:
            rows, shards, best = shared.value
            table = Shards(rows, shards)

            def look_up(chunks: list[Chunk]) -> None:
                keys = np.concatenate([c.pairs for c in chunks])
                counts = table.counts_of(keys)
                is_best = (counts > 0) & (counts == best[keys & 0xFFFFFFFF])
                ends = np.cumsum([c.n for c in chunks])
                totals, bests = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(is_best)]
                for c, hi in zip(chunks, ends.tolist()):
                    lo = hi - c.n
                    c.total, c.best = int(totals[hi] - totals[lo]), int(bests[hi] - bests[lo])

            return Aligner(*load(), look_up)

        aligner = kept_aligner(run_id, make)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                table, numbers, ends = aligner.many(part.column("text").to_pylist())
                bounds = np.r_[0, ends]

                def sums(values: list[int]) -> np.ndarray:
                    return np.diff(np.r_[0, np.cumsum(np.array(values, np.int64)[numbers])][bounds])

                n_best, total = (pa.array(part.column(name).to_numpy() + sums(values)) for name, values in (
                    ("n_best", [c.best for c in table]), ("count_sum", [c.total for c in table])))
                if not last:
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), n_best, total],
                                                     names=["doc_id", "text", "n_best", "count_sum"])
                    continue
                n_a, n_b, links = (pa.array(sums(values)) for values in (
                    [c.n_a for c in table], [c.n_b for c in table], [c.n for c in table]))
                said = pa.array([c.groups for c in table], pa.large_string())
                for lo in range(0, part.num_rows, 64):  # so that few long strings go to the JVM at a time
                    some = bounds[lo:lo + 65]
                    lists = pa.LargeListArray.from_arrays(some - some[0], said.take(pa.array(numbers[some[0]:some[-1]])))
                    groups = pc.binary_join(lists, pa.scalar(";", pa.large_string())).cast(pa.string())
                    rows = [c.slice(lo, 64) for c in (part.column("doc_id"), n_a, n_b, links, links, n_best, total)]
                    yield pa.RecordBatch.from_arrays([*rows, groups], names=["doc_id", "n_a", "n_b", "n_groups", "n_links",
                                                                             "n_best", "count_sum", "groups"])

    return frame.mapInArrow(run, schema)


def public_pair() -> tuple[Tokens, Tokens]:
    """Tokenizers of the registered query."""
    import public_tokenizers

    return (byte_level(public_tokenizers.path("byte_bpe_50k.json")), pieces_of(public_tokenizers.path("piece_bpe_32k.model")))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of every document, with corpus-wide counts of its links."""
    prepare(spark)
    rows = alignments(read(spark, sf_dir, "documents"), public_pair)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"))
