"""Best-fit packing of documents into sequences (operator 12).

Documents become tokens and an end token, and those longer than a sequence are cut into
pieces of its length.  Packing needs only how many pieces there are of each length, at
most CAPACITY numbers however large the corpus is, so the plan is made from that table
in two steps, each working on all pieces of a length at once:

1. Martello-Toth dominance: take the longest length j.  If nothing fits beside it, {j} is
   a sequence.  If the best single partner fills the sequence, or no two others fit
   beside j, {j, partner} dominates every other sequence with j; also if the partner is
   at least as long as any two that fit.  If at most two fit, {j, partner, x} dominates
   when the second partner of every pair that fits is at most x.  Such sequences are
   fixed for good and leave the instance; the test then starts anew on what is left,
   until for no length a dominating set is found.
2. Best fit, longest first, of the rest: each piece goes to the open sequence with the
   least room that takes it.

The plan says which ranks of a length go to which sequences and at which place.  It has
at most a few rows for each length, whatever the size of the corpus, and is sent to
all tasks.  A piece's rank is the number it got in the task that made it plus the
number of pieces of its length in earlier tasks (counted per length and task), so no
rows are sorted and only counts are shuffled.

Defined results: a null or empty text is the end token alone; texts of any length are
encoded whole, word by word, which changes nothing; equal rows are packed
each for itself; an empty table gives no rows; extra columns are not read; a null doc_id
stays null.
"""

from __future__ import annotations

import bisect
import os
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillsight.llm.staging import join_small, prepare, read, stage
from tillsight.llm.words import Recent, numbered

CAPACITY = 2048
END = 0
#: A task remembers the ids of at most so many words, none longer than LONG_WORD characters.
KNOWN_WORDS = 500_000
LONG_WORD = 64
WORDS_AT_ONCE = 500
DOCS_AT_ONCE = 1000
#: A control character, which is a token of its own and part of no other character's tokens.
MARK = "\x01"
#: ASCII and Latin-1 letters (each composed, with one lower-case form), then ASCII signs but ' and <.
LETTERS_SIGNS = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<signs>[!-&(-/:;=-@\[-`{-~]*)\z"
#: By tokenizer file; a worker process keeps it for its next tasks.
_known: dict[str, Recent] = {}


# ---------------------------------------------------------------- the plan


class Counts:
    """How many pieces there are of each length; lengths with pieces in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: int(c) for s, c in counts.items() if c > 0}
        self.order = sorted(self.n)

    def take(self, length: int, n: int) -> None:
        self.n[length] -= n
        if not self.n[length]:
            del self.n[length]
            self.order.pop(bisect.bisect_left(self.order, length))

    def largest(self, most: int, without: tuple[int, ...] = ()) -> int:
        """The longest length of at most ``most`` that has a piece besides those in ``without`` (0: none)."""
        k = bisect.bisect_right(self.order, most) - 1
        while k >= 0 and self.n[self.order[k]] <= without.count(self.order[k]):
            k -= 1
        return self.order[k] if k >= 0 else 0

    def smallest(self, k: int, without: tuple[int, ...]) -> list[int]:
        """The k shortest pieces besides those in ``without``."""
        found: list[int] = []
        for s in self.order:
            found += [s] * min(k - len(found), self.n[s] - without.count(s))
            if len(found) == k:
                break
        return found


def dominating(j: int, counts: Counts, capacity: int) -> tuple[int, ...] | None:
    """Lengths of a sequence with ``j`` that dominates all others with it; None if none is found.

    A sequence dominates another if the other's pieces can be put into groups, each no
    longer in sum than a piece of its own in the first.
    """
    room = capacity - j
    one = counts.largest(room, (j,))
    if not one:
        return (j,)
    if one == room:
        return (j, one)
    least = counts.smallest(3, (j,))
    if len(least) < 2 or sum(least[:2]) > room:
        return (j, one)
    if len(least) == 3 and sum(least) <= room:
        return None
    # at most two fit: the largest sum of two, and the largest second partner
    top = second = 0
    for x in counts.order:
        if x > room:
            break
        if counts.n[x] > (j,).count(x):
            y = counts.largest(min(x, room - x), (j, x))  # the longest that is no longer than x
            if y:
                top, second = max(top, x + y), max(second, y)
    if one >= top:
        return (j, one)
    x = counts.largest(room - one, (j, one))
    return (j, one, x) if x >= second else None


def reduced(counts: Counts, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sequences, with how often each; ``counts`` keeps the rest."""
    fixed = []
    while True:
        before = len(fixed)
        for j in reversed(list(counts.order)):
            while j in counts.n and (found := dominating(j, counts, capacity)):
                need = Counter(found)
                n = min(counts.n[s] // k for s, k in need.items())
                for s, k in need.items():
                    counts.take(s, n * k)
                fixed.append((tuple(sorted(found, reverse=True)), n))
        if len(fixed) == before:
            return fixed


def best_fit(counts: Counts, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Sequences as ([(length, pieces of it), ...], how often), longest pieces first, each to the least room."""
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    rooms: list[int] = []

    def put(room: int, filled: list[tuple[int, int]], n: int) -> None:
        if room not in open_:
            bisect.insort(rooms, room)
        open_.setdefault(room, []).append((filled, n))

    for s in reversed(counts.order):
        left = counts.n[s]
        while left:
            k = bisect.bisect_left(rooms, s)
            if k < len(rooms):
                room = rooms[k]
                filled, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(k)
            else:
                room, filled, n = capacity, [], left
            # the piece after one in this room finds less room here than elsewhere, so each sequence is filled up
            each = room // s
            full = min(n, left // each)
            if full:
                put(room - each * s, [*filled, (s, each)], full)
                left -= full * each
            if left and full < n:
                put(room - left * s, [*filled, (s, left)], 1)
                left, full = 0, full + 1
            if full < n and filled:
                put(room, filled, n - full)
    return [x for room in rooms for x in open_[room]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """For runs of ranks of a length: the first rank, first sequence, place, and pieces in each sequence.

    Sorted by length and first rank; rank r of a run goes to sequence
    ``sequence + (r - first) // each``, at ``offset + length * ((r - first) % each)``.
    """
    left = Counts(counts)
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    fixed = [([*Counter(found).items()], n) for found, n in reduced(left, capacity)]
    for filled, n in [*fixed, *best_fit(left, capacity)]:
        offset = 0
        for length, each in filled:
            rows.append((length, used[length], sequence, offset, each))
            used[length] += n * each
            offset += length * each
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "sequence", "offset", "each"), table.T)) | {"sequences": np.int64(sequence)}


def places(runs: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and place of the pieces of given length and rank."""
    lo = np.searchsorted(runs["length"], length, "left")
    hi = np.searchsorted(runs["length"], length, "right")
    # within a length the last run that starts at or before the rank, by halving
    for _ in range(int(np.max(hi - lo, initial=1)).bit_length()):
        mid = (lo + hi) // 2
        up = (hi - lo > 1) & (runs["first"][np.minimum(mid, len(runs["first"]) - 1)] <= rank)
        lo, hi = np.where(up, mid, lo), np.where(up | (hi - lo <= 1), hi, mid)
    nth = rank - runs["first"][lo]
    return runs["sequence"][lo] + nth // runs["each"][lo], runs["offset"][lo] + length * (nth % runs["each"][lo])


# ---------------------------------------------------------------- the pieces


def parts_of(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """What each word is encoded as, one after the other: its letters in lower case and its signs, or the word as it is."""
    cut = pc.extract_regex(words, LETTERS_SIGNS)
    letters, signs = (pc.struct_field(cut, n) for n in ("letters", "signs"))
    return pc.if_else(pc.is_valid(cut), pc.utf8_lower(letters), words), pc.if_else(pc.is_valid(cut), signs, "")


def word_encoder(path: str) -> Callable[[list[str]], list[np.ndarray]]:
    """Encoder of texts to ids by the tokenizers library, with truncation and padding off.

    For tokenizer files that drop white space: no token, special or not, holds any, and
    neither composing nor lower-casing looks across it.  So a text's ids are those of its
    words (parts between ASCII white space).  The texts of one call are split together and
    each of their distinct words is looked up once; the library sees those that are not
    among the KNOWN_WORDS met last.  New words are encoded together with MARK, which is one
    token by itself, between them.

    The files also lower-case, and part letters from other signs (but for contractions, which
    begin with an apostrophe), so that a word of LETTERS_SIGNS is its letters in lower case,
    then its signs, each looked up like a word.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    known = _known.setdefault(path, Recent(KNOWN_WORDS))

    def ids_of(text: str) -> np.ndarray:
        return np.asarray(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    mark, = ids_of(MARK)

    def encode_new(words: list[str]) -> dict[str, bytes]:
        plain = [w for w in words if MARK not in w]
        found = {w: ids_of(w).tobytes() for w in words if MARK in w}
        for lo in range(0, len(plain), WORDS_AT_ONCE):
            some = plain[lo:lo + WORDS_AT_ONCE]
            ids = ids_of(f" {MARK} ".join(some))
            ends = np.flatnonzero(ids == mark)
            data, lo_hi = ids.tobytes(), zip([0, *(4 * ends + 4).tolist()], [*(4 * ends).tolist(), 4 * len(ids)])
            found.update(zip(some, [data[i:j] for i, j in lo_hi], strict=True))
        return found

    def encode(texts: list[str]) -> list[np.ndarray]:
        words, numbers, ends = numbered(pc.ascii_split_whitespace(pa.array(texts, pa.large_string())))
        if not len(words):
            return [np.zeros(0, "<u4") for _ in texts]
        parts = pa.concat_arrays(parts_of(words)).dictionary_encode()
        names = parts.dictionary.to_pylist()
        ids = known.find(names)
        if None in ids:
            found = encode_new([p for p, x in zip(names, ids) if x is None])
            ids = [found[p] if x is None else x for p, x in zip(names, ids)]
            known.add({p: x for p, x in found.items() if len(p) <= LONG_WORD})
        of_parts = pa.array(ids, pa.large_binary())
        firsts, seconds = (of_parts.take(parts.indices[lo:lo + len(words)]) for lo in (0, len(words)))
        of_words = pc.binary_join_element_wise(firsts, seconds, pa.scalar(b"", pa.large_binary()))
        _, places, data = of_words.take(numbers).buffers()  # the ids of all words in a row
        places = np.frombuffer(places, "<i8", len(numbers) + 1) // 4
        together = np.frombuffer(data, "<u4", int(places[-1]))
        bounds = places[np.r_[0, ends]].tolist()
        return [together[lo:hi] for lo, hi in zip(bounds, bounds[1:])]

    return encode


def pieces(docs: DataFrame, encoder: Callable[[], Callable[[list[str]], list[np.ndarray]]], capacity: int = CAPACITY,
           end: int = END) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): doc_id, piece, start, length, ids, and the number ``nth`` that each
    has among those of its length in its task ``task``.  Stage it before use: numbers hold for one run."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = ["doc_id", "piece", "start", "length", "ids", "task", "nth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:  # bounded by bytes
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                made: list[list] = [[] for _ in range(6)]
                for row, ids in enumerate(encode([t or "" for t in part.column("text").to_pylist()])):
                    ids = np.append(ids, np.uint32(end)).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        cut = ids[start:start + capacity]
                        for column, value in zip(made, (row, k, start, len(cut), cut.tobytes(), int(seen[len(cut)]))):
                            column.append(value)
                        seen[len(cut)] += 1
                row, k, start, length, ids, nth = made
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(k, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array([task] * len(row), pa.int32()),
                     pa.array(nth, pa.int64())], names=fields)

    schema = f"doc_id {kind}, piece int, start long, length long, ids binary, task int, nth long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, encoder: Callable[[], Callable[[list[str]], list[np.ndarray]]], capacity: int = CAPACITY,
         end: int = END) -> DataFrame:
    """Every piece of every document with its tokens, sequence and place: doc_id, piece, start, length, ids,
    sequence_id, offset."""
    cut = stage(pieces(docs, encoder, capacity, end), "pack-pieces")
    per_task = stage(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "pack-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    runs = docs.sparkSession.sparkContext.broadcast(plan(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = join_small(cut, starts, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    names = ["doc_id", "piece", "start", "length", "ids"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                where = places(runs.value, *(batch.column(c).to_numpy() for c in ("length", "rank")))
                yield pa.RecordBatch.from_arrays([*map(batch.column, names), *map(pa.array, where)],
                                                 names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.select(names).schema)
    return ranked.select(*names, "rank").mapInArrow(place, f"{fields}, sequence_id long, offset long")


def word_bpe() -> Callable[[list[str]], list[np.ndarray]]:
    """Encoder of the registered query."""
    import public_tokenizers

    return word_encoder(public_tokenizers.path("word_bpe_49k.json"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and place of every piece of every document."""
    prepare(spark)
    packed = pack(read(spark, sf_dir, "documents"), word_bpe)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
