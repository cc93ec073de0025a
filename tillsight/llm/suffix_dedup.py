"""Removal of repeated 100-byte strings with suffix arrays (operator 8).

Every byte that a LENGTH-byte string covers which also starts earlier (in a smaller
doc_id, or earlier in the same document) is removed.  Results are exact.

1. Screening.  Of the GRAM-byte substrings of each LENGTH-byte string, those with
   the smallest hash are its anchors; equal strings have equal anchors at equal
   places.  Each anchor stands for its surroundings, the bytes of all strings it can
   be the anchor of.  Anchors that occur once rule their strings out; where the same
   surroundings occur earlier, all their strings are repeated.  What is left are
   anchors with differing surroundings: the edges of repeated passages.
2. Shards.  Those surroundings are cut from the texts and dealt into shards by
   anchor, a very frequent anchor into several.  Each shard gets a suffix array by
   Larsson-Sadakane refinement (sort by the first bytes, then refine only the groups
   that are still tied by the ranks of what follows, doubling the depth), and common
   prefixes of neighbours by Kasai's rule along the text.  Runs of neighbours with
   LENGTH common bytes are equal strings; all but the earliest are repeated.
3. Merging.  Of anchors that were dealt into several shards, each shard hands over its
   earliest strings as sorted runs, one for each merging task that they fall to; there
   every string is looked up by binary search among those of all shards.

Occurrences in one piece of text are combined before anything is shuffled.  A text
is shuffled only if it has surroundings to cut or bytes to remove.

Defined results: null is an empty text; texts under LENGTH bytes keep all; rows without
doc_id come after all others; rows with equal doc_id and text are one document, and
texts that share a doc_id are ordered by their digest; an empty table gives no rows; other
columns are kept, those named like an output column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillsight.llm import scan
from tillsight.llm.staging import SMALL_ROWS, join_small, prepare, read, stage

LENGTH = 100
GRAM = 40
SPREAD = LENGTH - GRAM + 1  # substrings in a string
SHARD = 12_000  # surroundings in a shard
MERGE_STRINGS = 100_000  # strings in a merging task
LAST = (1 << 63) - 1  # stands for a null doc_id
#: Places are ``number of the text among those of its doc_id << PLACE_BITS | byte``.
#: (A string of Spark has fewer than 2^31 bytes, so 2^31 texts may share or lack a doc_id.)
PLACE_BITS = 32
#: Texts that share a doc_id are numbered in ranges of so many first digits of their digest.
DIGITS = 3
#: Numbers of texts that are sent to all tasks (about 100 bytes each).
FEW_NUMBERS = SMALL_ROWS // 4
_MOST = np.uint64((1 << 64) - 1)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, from running minima of blocks in both directions."""
    n = len(x)
    padded = np.full(-(-n // w) * w, _MOST, np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def anchors(c: scan.Chunk) -> tuple[np.ndarray, ...]:
    """Place, hash, first and last byte of the surroundings and their hash, of a chunk's anchors."""
    n = len(c.data)
    if n < LENGTH:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int64),) * 3
    c.ranges()
    at = np.arange(n - GRAM + 1)
    h = c.hash(at, at + GRAM) >> np.uint64(1)
    low = sliding_min(h, SPREAD)
    ends = np.repeat(c.off[1:], np.diff(c.off))
    start = np.arange(len(low))
    whole = start + LENGTH <= ends[:len(low)]
    # A substring is an anchor if a whole string that holds it has it as minimum: the
    # largest minimum of those strings (none is larger than the hash itself) equals it.
    inverse = np.full(len(low) + 2 * (SPREAD - 1), _MOST, np.uint64)
    inverse[SPREAD - 1:SPREAD - 1 + len(low)] = np.where(whole, ~low, _MOST)
    place = np.flatnonzero(~sliding_min(inverse, SPREAD)[:len(h)] == h)
    doc = c.doc(place)
    lo = np.maximum(c.off[doc], place - SPREAD + 1)
    hi = np.minimum(c.off[doc + 1], place + LENGTH)
    around = scan.mix(c.hash(lo, hi) + (place - lo).astype(np.uint64) * np.uint64(1 << 32) + (hi - lo).astype(np.uint64))
    return place, h[place].view(np.int64), lo, hi, around.view(np.int64)


def running_max(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Running maximum that starts anew at each place of ``first``."""
    order = np.argsort(values, kind="stable")
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    group = np.zeros(len(values), np.int64)
    group[first[1:]] = len(values)
    group = np.cumsum(group)
    return values[order[np.maximum.accumulate(rank + group) - group]]


def merged(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the byte ranges of each document; ranges that touch are one."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    reach = running_max(hi, np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]))
    at = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (lo[1:] > reach[:-1])])
    return doc[at], lo[at], np.maximum.reduceat(hi, at)


SPAN = "doc long, lo long, hi long"


def spans_batch(doc, lo, hi) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (doc, lo, hi)], names=["doc", "lo", "hi"])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each anchor and surroundings of a piece; a row with the piece's own repeats (packed)."""
    for batch in batches:
        ids = batch.column("doc").to_numpy()
        shift = batch.column("copy").to_numpy().astype(np.int64) << PLACE_BITS
        for c in scan.chunks(batch.column("text")):
            place, a, lo, hi, around = anchors(c)
            if not len(place):
                continue
            row = c.doc(place)
            doc, begin = ids[c.lo:c.hi][row], shift[c.lo:c.hi][row] - c.off[row]
            order = np.lexsort((place + begin, doc, around, a))
            doc, begin, place, a, lo, hi, around = (x[order] for x in (doc, begin, place, a, lo, hi, around))
            lo, hi = lo + begin, hi + begin
            new = np.r_[True, (a[1:] != a[:-1]) | (around[1:] != around[:-1])]
            first = np.flatnonzero(new)
            of = np.repeat(first, np.diff(np.r_[first, len(new)]))
            again = (doc != doc[of]) | (lo != lo[of])
            spans = merged(doc[again], lo[again], hi[again])
            packed = np.column_stack(spans).astype("<i8").tobytes() if len(spans[0]) else None
            none = np.r_[np.zeros(len(first), bool), True]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[a[first], around[0]]), pa.array(np.r_[around[first], 0], mask=none),
                 pa.array(np.r_[doc[first], 0]), pa.array(np.r_[lo[first], 0]),
                 pa.array(np.r_[(hi - lo)[first], 0].astype(np.int32)),
                 pa.array([None] * len(first) + [packed], pa.binary())],
                names=["a", "around", "doc", "lo", "size", "packed"])


ANCHOR = "a long, around long, doc long, lo long, size int, packed binary"


def _known_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte ranges of repeated surroundings, joined within a batch."""
    for batch in batches:
        doc, lo = batch.column("doc").to_numpy(), batch.column("lo").to_numpy()
        hi = lo + batch.column("size").to_numpy()
        packed = batch.column("packed")
        plain = np.asarray(packed.is_null())
        parts = [np.column_stack([doc[plain], lo[plain], hi[plain]])]
        parts += [np.frombuffer(p, "<i8").reshape(-1, 3) for p in packed.drop_null().to_pylist()]
        yield spans_batch(*merged(*np.concatenate(parts).T))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted surroundings of each text."""
    for batch in batches:
        doc, shift = batch.column("doc").to_numpy(), batch.column("copy").to_numpy() << PLACE_BITS
        want = batch.column("want")
        row = np.repeat(np.arange(batch.num_rows), want.value_lengths().to_numpy())
        a, lo, size = (want.flatten().field(f).to_numpy(zero_copy_only=False) for f in ("a", "lo", "size"))
        mine = np.flatnonzero(lo >> PLACE_BITS == shift[row] >> PLACE_BITS)  # the others are of a text with the same doc_id
        row, a, lo, size = row[mine], a[mine], lo[mine], size[mine]
        raw = batch.column("text").cast(pa.binary()).to_pylist()
        cuts = [raw[r][b:b + s] for r, b, s in zip(row.tolist(), (lo - shift[row]).tolist(), size.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(doc[row]), pa.array(lo), pa.array(cuts, pa.binary())],
                                         names=["a", "doc", "lo", "bytes"])


def eight_bytes(text: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes from each place as one number, first byte highest."""
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out |= text[k:k + n].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def suffix_array(key: np.ndarray, n: int, depth: int = LENGTH) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` bytes or more; ``key``: eight bytes from each place."""
    sa = np.argsort(key[:n], kind="stable")
    sorted_ = key[sa]
    head = np.r_[True, sorted_[1:] != sorted_[:-1]]
    rank = np.zeros(n + 1, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0)) + 1
    h = 8
    while h < depth:
        slots = np.flatnonzero(~(head & np.r_[head[1:], True]))
        if not len(slots):
            break
        p = sa[slots]
        pair = (rank[p] << 32) | rank[np.minimum(p + h, n)]
        order = np.argsort(pair, kind="stable")
        sa[slots], pair = p[order], pair[order]
        new = np.r_[True, pair[1:] != pair[:-1]]
        head[slots] = new
        rank[sa[slots]] = np.maximum.accumulate(np.where(new, slots, 0)) + 1
        h *= 2
    return sa


def common_prefixes(key: np.ndarray, before: np.ndarray, start: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Common prefix (LENGTH at most) of each suffix and the one before it in the array.

    Kasai's rule: the suffix one place on shares at least one byte less with its own
    predecessor.  Texts are walked side by side, place by place.  The rule holds
    where the last prefix ended below LENGTH (the array is sorted that deep), else
    counting starts anew.
    """
    out = np.zeros(len(before), np.int16)
    order = np.argsort(-steps, kind="stable")
    start, steps = start[order], steps[order]
    alive = np.searchsorted(-steps, -np.arange(1, (steps[0] if len(steps) else 0) + 1), "right")
    carried = np.zeros(len(start), np.int64)
    for t, n in enumerate(alive):
        p = start[:n] + t
        q = before[p]
        known = np.where(carried[:n] >= LENGTH, 0, np.maximum(carried[:n] - 1, 0))
        known[q < 0] = 0
        going = np.flatnonzero(q >= 0)
        while len(going):
            differ = key[p[going] + known[going]] ^ key[q[going] + known[going]]
            equal = np.zeros(len(going), np.int64)
            for k in range(8):
                equal += differ < np.uint64(1 << (56 - 8 * k))
            known[going] += equal
            going = going[(equal == 8) & (known[going] < LENGTH)]
        known = np.minimum(known, LENGTH)
        out[p] = known
        carried[:n] = known
    return out


def shard_repeats(doc: np.ndarray, lo: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Strings of a shard: (text number, byte in it, document, place, whether an earlier one is in the shard)."""
    size = np.array([len(t) for t in texts], np.int64)
    start = np.r_[0, np.cumsum(size + 1)[:-1]]
    n = int((size + 1).sum())
    raw = np.frombuffer(b"\xff".join(texts) + b"\xff" * (2 * LENGTH + 8), np.uint8)  # 0xff is in no UTF-8 text
    key = eight_bytes(raw, n + LENGTH)
    sa = suffix_array(key, n)
    steps = np.maximum(size - LENGTH + 1, 0)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    prefix = common_prefixes(key, before, start, steps)
    owner = np.repeat(np.arange(len(texts)), size + 1)
    offset = np.arange(n) - start[owner]
    sa = sa[(offset < steps[owner])[sa]]  # only suffixes with LENGTH bytes of their own
    head = prefix[sa] < LENGTH
    if len(sa):
        head[0] = True
    text, byte = owner[sa], offset[sa]
    document, place = doc[text], lo[text] + byte
    order = np.lexsort((place, document, np.cumsum(head)))
    group = np.cumsum(head)[order]
    text, byte, document, place = (x[order] for x in (text, byte, document, place))
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    of = np.repeat(first, np.diff(np.r_[first, len(group)]))
    later = (document != document[of]) | (place != place[of])
    return text, byte, document, place, later


FOUND = f"{SPAN}, part int, strings binary, docs binary, places binary"


def _shard(parts: int):
    """Per shard: repeated byte ranges, and sorted runs of the earliest strings of split anchors.

    A run holds the strings that fall to one of ``parts`` merging tasks, by checksum.
    """
    def run(table: pa.Table) -> pa.Table:
        doc, lo = table.column("doc").to_numpy(), table.column("lo").to_numpy()
        texts, split = table.column("bytes").to_pylist(), table.column("split").to_numpy()
        text, byte, document, place, later = shard_repeats(doc, lo, texts)
        d, b, e = merged(document[later], place[later], place[later] + LENGTH)
        keep = np.flatnonzero(~later & split[text])
        strings = np.array([texts[t][k:k + LENGTH] for t, k in zip(text[keep].tolist(), byte[keep].tolist())], f"S{LENGTH}")
        part = np.array([zlib.crc32(s) % parts for s in strings.tolist()], np.int64)
        runs = []
        for k in np.unique(part).tolist():
            mine = np.flatnonzero(part == k)
            mine = mine[np.argsort(strings[mine], kind="stable")]
            at = keep[mine]
            runs.append((k, strings[mine].tobytes(), document[at].astype("<i8").tobytes(), place[at].astype("<i8").tobytes()))
        none = [None] * len(runs)
        empty = [None] * len(d)
        return pa.table({"doc": pa.array([*d.tolist(), *none], pa.int64()), "lo": pa.array([*b.tolist(), *none], pa.int64()),
                         "hi": pa.array([*e.tolist(), *none], pa.int64()),
                         "part": pa.array([*empty, *(r[0] for r in runs)], pa.int32()),
                         **{name: pa.array([*empty, *(r[i] for r in runs)], pa.binary())
                            for i, name in ((1, "strings"), (2, "docs"), (3, "places"))}})
    return run


def _merge(table: pa.Table) -> pa.Table:
    """Runs of all shards: each string is looked up by binary search among all; only its earliest stays."""
    strings = np.concatenate([np.frombuffer(x, f"S{LENGTH}") for x in table.column("strings").to_pylist()])
    doc, lo = (np.concatenate([np.frombuffer(x, "<i8") for x in table.column(c).to_pylist()]) for c in ("docs", "places"))
    order = np.lexsort((lo, doc, np.unique(strings, return_inverse=True)[1]))
    strings, doc, lo = strings[order], doc[order], lo[order]
    first = np.searchsorted(strings, strings, "left")
    late = (doc != doc[first]) | (lo != lo[first])
    d, b, e = merged(doc[late], lo[late], lo[late] + LENGTH)
    return pa.table({"doc": d, "lo": b, "hi": e})


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with __doc (null ids last) and __copy (number among the texts of one id).

    Texts of one id are numbered by digest: inside ranges of digests, after the texts of the
    ranges before, so that no task holds all texts without id.
    """
    rows = docs.withColumn("__doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))
    same = F.coalesce(F.md5("text"), F.lit(""))
    ids = stage(rows.select("__doc", same.alias("__same")).distinct(), "suffix-ids")
    shared = ids.groupBy("__doc").agg(F.count("*").alias("n")).filter("n > 1").select("__doc")
    texts = ids.join(shared, "__doc", "left_semi").withColumn("range", F.substring("__same", 1, DIGITS))
    sizes = texts.groupBy("__doc", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("__doc").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__doc", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("__doc", "range").orderBy("__same"))
    numbers = stage(texts.join(offsets, ["__doc", "range"]).select(
        "__doc", "__same", (F.col("offset") + inside).cast("long").alias("__copy")), "suffix-numbers")
    n, none = numbers.count(), F.lit(0).cast("long")
    if n == 0:
        return rows.withColumn("__copy", none)
    return (rows.withColumn("__same", same).join(F.broadcast(numbers) if n <= FEW_NUMBERS else numbers, ["__doc", "__same"], "left")
            .withColumn("__copy", F.coalesce("__copy", none)).drop("__same"))


def contested_spans(texts: DataFrame, contested: DataFrame, shard: int) -> DataFrame:
    """Repeated byte ranges among anchors with differing surroundings ``(a, doc, lo, size)``."""
    shards = max(1, -(-contested.count() // shard))
    large = stage(contested.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") > shard), "suffix-large")
    parts = 1 + (large.agg(F.sum("n")).first()[0] or 0) * SPREAD // MERGE_STRINGS
    large = large.select("a", F.ceil(F.col("n") / shard).alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64("doc", "lo"), F.col("parts")), F.lit(0))
    marked = join_small(contested, large, "a", "left").select(
        "a", "doc", "lo", F.col("parts").isNotNull().alias("split"),
        F.pmod(F.xxhash64("a", part), F.lit(shards)).alias("shard"))
    copy = F.shiftright("lo", PLACE_BITS)  # the text that a place is in
    want = stage(contested.groupBy("doc", copy.alias("copy")).agg(F.collect_list(F.struct("a", "lo", "size")).alias("want")), "suffix-want")
    cut = (join_small(texts, want.select("doc", "copy"), ["doc", "copy"], "left_semi").join(want, ["doc", "copy"])
           .select("doc", "copy", "text", "want")
           .mapInArrow(_cut, "a long, doc long, lo long, bytes binary"))
    placed = cut.join(marked, ["a", "doc", "lo"])
    found = stage(placed.groupBy("shard").applyInArrow(_shard(parts), FOUND), "suffix-shards")
    runs = found.filter("part is not null").select("part", "strings", "docs", "places")
    return found.filter("part is null").select("doc", "lo", "hi").union(runs.groupBy("part").applyInArrow(_merge, SPAN))


def repeated_spans(texts: DataFrame, shard: int = SHARD) -> DataFrame:
    """Byte ranges (doc, lo, hi) to remove from ``texts(doc, copy, text)``; they may overlap."""
    found = texts.mapInArrow(_anchor_rows, ANCHOR)
    same = Window.partitionBy("a", "around").orderBy("doc", "lo")
    real = F.col("around").isNotNull()
    ruled = (found.withColumn("k", F.dense_rank().over(same))
             .withColumn("kinds", F.sum(F.when((F.col("k") == 1) & real, 1).otherwise(0)).over(Window.partitionBy("a"))))
    ruled = stage(ruled.filter((F.col("k") > 1) | (F.col("kinds") > 1) | ~real).drop("kinds"), "suffix-ruled")
    contested = stage(ruled.filter((F.col("k") == 1) & real).select("a", "doc", "lo", "size").distinct(), "suffix-contested")
    known = ruled.filter(((F.col("k") > 1) & real) | F.col("packed").isNotNull())
    known = known.select("doc", "lo", "size", "packed").mapInArrow(_known_spans, SPAN)
    return known.union(contested_spans(texts, contested, shard))


def remove_repeats(docs: DataFrame, shard: int = SHARD, columns: list[str] | None = None,
                   as_text: bool = False) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, spans (lo, hi) and kept (the bytes that stay).

    With ``as_text`` kept is a string; the rest of a character that was cut through goes.
    """
    made = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "spans": "array<struct<lo:long,hi:long>>",
            "kept": "string" if as_text else "binary"}
    names = [n for n in (columns or docs.columns) if n not in made]
    rows = numbered(docs.select(*dict.fromkeys([*names, "doc_id", "text"])))
    texts = rows.select(F.col("__doc").alias("doc"), F.col("__copy").alias("copy"), "text")
    own = ["__doc", "__copy"]
    spans = stage(repeated_spans(texts, shard).groupBy(
        F.col("doc").alias("__doc"), F.shiftright("lo", PLACE_BITS).alias("__copy")).agg(
        F.collect_list(F.struct("lo", "hi")).alias("__cut")), "suffix-spans")
    ids = spans.select(*own)
    if ids.count() <= SMALL_ROWS:  # texts that stay whole need no shuffle
        uncut = F.lit(None).cast(spans.schema["__cut"].dataType).alias("__cut")
        joined = (rows.join(F.broadcast(ids), own, "left_semi").join(spans, own)
                  .unionByName(rows.join(F.broadcast(ids), own, "left_anti").select("*", uncut)))
    else:
        joined = rows.join(spans, own, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            copy, cut = batch.column("__copy").to_numpy(), batch.column("__cut")
            size = cut.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(raw)), size)
            lo, hi = (cut.flatten().field(f).to_numpy(zero_copy_only=False) for f in ("lo", "hi"))
            mine = lo >> PLACE_BITS == copy[row]
            base = (copy << PLACE_BITS)[row[mine]]
            row, lo, hi = merged(row[mine], lo[mine] - base, hi[mine] - base)
            first = np.searchsorted(row, np.arange(len(raw) + 1)).tolist()
            lo, hi = lo.tolist(), hi.tolist()
            stay = [b"".join(t[a:b] for a, b in zip([0, *hi[f:g]], [*lo[f:g], len(t)]))
                    for t, f, g in zip(raw, first, first[1:])]
            kept = pa.array([s.decode("utf-8", "ignore") for s in stay] if as_text else stay,
                            pa.string() if as_text else pa.binary())
            spans_ = pa.StructArray.from_arrays([pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], ["lo", "hi"])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array([len(t) for t in raw], pa.int64()),
                 pa.array([len(t) - len(s) for t, s in zip(raw, stay)], pa.int64()),
                 pa.array([g - f for f, g in zip(first, first[1:])], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(first, pa.int32()), spans_), kept],
                names=[*names, *made])

    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{n}` {fields[n]}" for n in names), *(f"{n} {t}" for n, t in made.items())])
    return joined.select(*dict.fromkeys([*names, "text", "__copy", "__cut"])).mapInArrow(run, schema)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of what stays of every document."""
    prepare(spark)
    done = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"])
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
