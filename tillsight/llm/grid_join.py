"""Near-duplicate vectors by an epsilon grid order join (operator 6).

Cosine >= c means that unit vectors lie within ``eps = sqrt(2 - 2 c)``.  Vectors are
projected on their LEAD principal directions (found from the second moments of all
vectors), and sorted by the grid cells, of side eps, of those coordinates: the
epsilon grid order.  The sorted sequence is cut into blocks of BLOCK vectors.
Intervals of blocks are joined recursively from the whole sequence down: a pair of
intervals whose boxes lie farther apart than eps holds no link and is skipped, the
others are joined by parent down to pairs of blocks.  The blocks of a pair are never
shuffled: a task reads two runs of the staged sequence and meets their pairs, so disk
follows the number of vectors and not the number of pairs.  A pair of blocks is cut
into leaves, and leaves whose boxes are distant are skipped too.  What is left is
bounded by a matrix product over the first half of all principal directions (what two
unit vectors share in the others is at most the product of their lengths there); only
pairs that may reach the threshold get their whole product, and products near the
threshold are computed anew in double precision.

Equal vectors are one vertex with a number of copies; rows find their vertex by two
64-bit hashes of the vector.  A task gives one link count for each vector it has, and
a spanning set of links, never all pairs, so results do not grow with the square of a
group.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without vec_id, link with nothing; vectors of unequal length do
not link; a repeated row is a copy and counts as a link; one vec_id on several
vectors counts as one vertex; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillsight.llm.components import components
from tillsight.llm.staging import SMALL_ROWS, join_small, prepare, read, stage

COSINE = 0.9
LEAD = 8
BLOCK = 2048
LEAF = 256
FAN_OUT = 8
#: Products of unit vectors in single precision are this near to the cosine.
SLACK = 1e-4
#: Blocks in a range of the sorted sequence; only the last of a range is not full.
RANGE_BLOCKS = 4
#: A task meets two runs of blocks of about so many bytes; there are TILES runs at least, if there are as many files.
TILE_BYTES = 32 << 20
TILES = 16
#: Numbers of one side that are gathered at once for the products of single pairs.
PIECE = 1 << 20


def usable(v: Column) -> Column:
    """The vector has a direction."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def units(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def directions(vectors: DataFrame, dim: int, lead: int) -> np.ndarray:
    """Leading eigenvectors of the second moments of all unit vectors (dim x dim numbers reach the driver)."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = units(matrix(batch.column("v"), dim))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["k", "s"])

    got = vectors.select("v").mapInArrow(moments, "k long, s double").groupBy("k").agg(F.sum("s").alias("s")).toArrow()
    total = np.zeros(dim * dim)
    total[got["k"].to_numpy()] = got["s"].to_numpy()
    _, vectors_ = np.linalg.eigh(total.reshape(dim, dim))
    return vectors_[:, ::-1][:, :lead]


def blocks(vectors: DataFrame, dim: int, eps: float, axes: np.ndarray, block: int, rows: int | None = None) -> DataFrame:
    """The sorted sequence in blocks: pos, n, ids, copies, raw (bytes), lo*, hi* of the coordinates."""
    k = axes.shape[1]
    coords = [f"x{i}" for i in range(k)]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = units(matrix(batch.column("v"), dim)) @ axes
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x[:, i]) for i in range(k))],
                                             names=[*batch.schema.names, *coords])

    kind = vectors.schema["v"].dataType.simpleString()
    number = "<f4" if kind == "array<float>" else "<f8"
    placed = vectors.select("id", "copies", "v").mapInArrow(
        project, ", ".join(["id long", "copies long", f"v {kind}", *(f"{x} double" for x in coords)]))
    parts = max(1, min((vectors.count() if rows is None else rows) // (block * RANGE_BLOCKS), 4096))
    order = [*(F.floor(F.col(x) / eps) for x in coords), *coords, "id"]
    placed = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        seq, part = 0, TaskContext.get().partitionId()

        def made(rows: pa.Table) -> pa.RecordBatch:
            x = np.column_stack([rows.column(c).to_numpy() for c in coords])
            raw = matrix(rows.column("v").combine_chunks(), dim)
            cols = [part, seq, len(rows), rows.column("id").to_numpy().astype("<i8").tobytes(),
                    rows.column("copies").to_numpy().astype("<i8").tobytes(), raw.astype(number).tobytes(),
                    *x.min(0).tolist(), *x.max(0).tolist()]
            return pa.RecordBatch.from_arrays([pa.array([c]) for c in cols], names=names)

        for batch in batches:
            waiting.append(batch)
            while sum(b.num_rows for b in waiting) >= block:
                rows = pa.Table.from_batches(waiting)
                yield made(rows.slice(0, block))
                seq += 1
                waiting = rows.slice(block).to_batches()
        if sum(b.num_rows for b in waiting):
            yield made(pa.Table.from_batches(waiting))

    los, his = [f"lo{i}" for i in range(k)], [f"hi{i}" for i in range(k)]
    names = ["part", "seq", "n", "ids", "copies", "raw", *los, *his]
    cut_blocks = stage(placed.select("id", "copies", "v", *coords).mapInArrow(cut, ", ".join(
        ["part long", "seq long", "n long", "ids binary", "copies binary", "raw binary",
         *(f"{c} double" for c in (*los, *his))])), "grid-blocks")
    offsets = stage(cut_blocks.groupBy("part").agg(F.count("*").alias("k")).withColumn(
        "first", F.sum("k").over(Window.orderBy("part")) - F.col("k")).drop("k"), "grid-offsets")
    return cut_blocks.join(F.broadcast(offsets), "part").withColumn("pos", F.col("first") + F.col("seq")).drop(
        "part", "seq", "first")


def near_pairs(sequence: DataFrame, eps: float, fan_out: int = FAN_OUT) -> DataFrame:
    """Pairs (a, b), a <= b, of blocks that may hold a link, by recursive interval joins."""
    los = [c for c in sequence.columns if c.startswith("lo")]
    his = [c for c in sequence.columns if c.startswith("hi")]
    levels = [stage(sequence.select("pos", *los, *his), "grid-level")]
    top = levels[0].agg(F.max("pos")).first()[0] or 0
    small = F.broadcast if top < SMALL_ROWS else lambda side: side
    while top > 0:
        levels.append(stage(levels[-1].groupBy(F.floor(F.col("pos") / fan_out).alias("pos")).agg(
            *(F.min(c).alias(c) for c in los), *(F.max(c).alias(c) for c in his)), "grid-level"))
        top //= fan_out
    pairs = levels[-1].select(F.col("pos").alias("a"), F.col("pos").alias("b"))
    for level in reversed(levels[:-1]):
        sides = [small(level.select(F.floor(F.col("pos") / fan_out).alias(p), F.col("pos").alias(f"{p}_child"),
                                    *(F.col(c).alias(f"{p}_{c}") for c in (*los, *his)))) for p in "ab"]
        gaps = [F.greatest(F.lit(0.0), F.col(f"a_{lo}") - F.col(f"b_{hi}"), F.col(f"b_{lo}") - F.col(f"a_{hi}"))
                for lo, hi in zip(los, his)]
        near = sum((g * g for g in gaps), F.lit(0.0)) <= (eps + 1e-6) ** 2
        pairs = stage(pairs.join(sides[0], "a").join(sides[1], "b")
                      .filter((F.col("a_child") <= F.col("b_child")) & near)
                      .select(F.col("a_child").alias("a"), F.col("b_child").alias("b")), "grid-pairs")
    return pairs


class Block:
    """A block as a task compares it, with the link counts and labels found so far."""

    def __init__(self, ids: bytes, copies: bytes, raw: bytes, axes: np.ndarray, lead: int):
        self.ids, self.copies = np.frombuffer(ids, "<i8").copy(), np.frombuffer(copies, "<i8").copy()
        dim = len(axes)
        self.raw = np.frombuffer(raw, "<f4" if len(raw) < 8 * dim * len(self.ids) else "<f8").reshape(-1, dim).copy()
        unit = units(self.raw.astype(np.float64))
        places, half = unit @ axes, max(lead, dim // 2)
        self.single = unit.astype(np.float32)
        self.head = np.c_[places[:, :half], np.sqrt((places[:, half:] ** 2).sum(1))].astype(np.float32)
        leaves = np.arange(0, len(self.ids), LEAF)
        self.lo = np.minimum.reduceat(places[:, :lead], leaves)
        self.hi = np.maximum.reduceat(places[:, :lead], leaves)
        self.links, self.low = np.zeros(len(self.ids), np.int64), self.ids.copy()

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.links)
        return self.ids[at], self.links[at], self.low[at]


def products(a: Block, b: Block, i: np.ndarray, j: np.ndarray, cosine: float) -> np.ndarray:
    """Which of the pairs (i, j) are links."""
    out = np.zeros(len(i), bool)
    step = max(1, PIECE // a.raw.shape[1])
    for lo in range(0, len(i), step):
        p, q = i[lo:lo + step], j[lo:lo + step]
        product = np.einsum("ij,ij->i", a.single[p], b.single[q])
        sure = product >= cosine + SLACK
        at = np.flatnonzero((product >= cosine - SLACK) & ~sure)
        if len(at):
            x, y = a.raw[p[at]].astype(np.float64), b.raw[q[at]].astype(np.float64)
            dot = np.einsum("ij,ij->i", x, y)
            size = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
            sure[at] = dot / size >= cosine
        out[lo:lo + step] = sure
    return out


def linked(a: Block, b: Block, cosine: float, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (i, j) of two blocks, a leaf of the first at a time with all leaves of the second that are near."""
    gap = np.maximum(0, np.maximum(a.lo[:, None] - b.hi, b.lo - a.hi[:, None]))
    near = (gap * gap).sum(2) <= (eps + 1e-6) ** 2
    space = np.empty((LEAF, len(b.ids)), np.float32)
    for leaf in np.flatnonzero(near.any(1)):
        rows, some = slice(leaf * LEAF, min((leaf + 1) * LEAF, len(a.ids))), None
        if not near[leaf].all():
            some = np.flatnonzero(np.repeat(near[leaf], LEAF)[:len(b.ids)])
        head, single = (b.head, b.single) if some is None else (b.head[some], b.single[some])
        bound = np.matmul(a.head[rows], head.T, out=space[:rows.stop - rows.start, :len(head)])
        if bound.max() < cosine - SLACK:
            continue
        at = np.flatnonzero(bound >= cosine - SLACK)
        if len(at) > bound.size // 16:  # too many to gather: all products, then those that may reach the threshold
            product = a.single[rows] @ single.T
            links = product >= cosine + SLACK
            at = np.flatnonzero((product >= cosine - SLACK) & ~links)
            i, j = np.divmod(at, len(head))
            sure = products(a, b, i + rows.start, j if some is None else some[j], cosine)
            links[i[sure], j[sure]] = True
            i, j = np.nonzero(links)
            i, j = i + rows.start, j if some is None else some[j]
        else:
            i, j = np.divmod(at, len(head))
            i, j = i + rows.start, j if some is None else some[j]
            sure = products(a, b, i, j, cosine)
            i, j = i[sure], j[sure]
        if len(i):
            yield i, j


def spanning(a: Block, b: Block, i: np.ndarray, j: np.ndarray) -> list[np.ndarray]:
    """Gives linked vectors the smallest label that links reach; returns what tied the old labels to the new (pairs)."""
    if (a.low[i] == b.low[j]).all():
        return []
    sides = [(block, at, block.low[at]) for block, at in ((a, np.unique(i)), (b, np.unique(j)))]
    while True:
        low = np.minimum(a.low[i], b.low[j])
        if (a.low[i] == low).all() and (b.low[j] == low).all():
            break
        np.minimum.at(a.low, i, low)
        np.minimum.at(b.low, j, low)
    # a label that is the vector's own id needs no tie: the vector's last label ties it
    return [np.unique(np.c_[was, block.low[at]][(was != block.low[at]) & (was != block.ids[at])], axis=0)
            for block, at, was in sides]


def partners(pairs: DataFrame) -> DataFrame:
    """(pos, met): for the first block of pairs, a bit for each second block, 64 in an entry of ``met``.

    The sum of both numbers says which block is first, so that all parts of the
    sequence come first for as many pairs as second.
    """
    odd = (F.col("a") + F.col("b")) % 2 == 1
    dealt = pairs.select(F.when(odd, F.col("a")).otherwise(F.col("b")).alias("pos"),
                         F.when(odd, F.col("b")).otherwise(F.col("a")).alias("other"))
    words = dealt.groupBy("pos", F.expr("other div 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(other % 64 as int)))").alias("bits"))
    return stage(words.groupBy("pos").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("met")),
                 "grid-partners")


def compare(sequence: DataFrame, pairs: DataFrame, axes: np.ndarray, cosine: float, eps: float) -> DataFrame:
    """Rows (id, links, label) from every task: copies linked to id, and a link that connects it.

    The sequence is read in runs of about TILE_BYTES, and each task meets two of
    them; nothing is shuffled, only the bits of ``partners`` are sent to all tasks.
    """
    lead = sum(c.startswith("lo") for c in sequence.columns)
    kept = sequence.select("pos", "ids", "copies", "raw")
    size = kept.agg(F.sum(F.length("raw"))).first()[0] or 0
    runs = kept.coalesce(max(TILES, -(-size // TILE_BYTES)))
    first = runs.join(F.broadcast(partners(pairs)), "pos").select(
        *(F.col(c).alias(f"a_{c}") for c in kept.columns), "met")
    second = runs.select(*(F.col(c).alias(f"b_{c}") for c in kept.columns))
    met = first.join(second.hint("shuffle_replicate_nl"), F.expr(
        "getbit(try_element_at(met, b_pos div 64), cast(b_pos % 64 as int)) = 1"))  # no projection: it would copy both blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def opened(batch: pa.RecordBatch, row: int, side: str) -> Block:
            return Block(*(batch.column(f"{side}_{c}")[row].as_buffer() for c in ("ids", "copies", "raw")), axes, lead)

        def rows(*cols: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["id", "links", "label"])

        def tied() -> pa.RecordBatch:
            both = np.unique(np.concatenate(ties), axis=0)
            ties.clear()
            return rows(both[:, 0], np.zeros(len(both)), both[:, 1])

        a_pos, a, held, size, ties = None, None, {}, 0, []
        for batch in batches:
            for row in range(batch.num_rows):
                pos = [batch.column(f"{p}_pos")[row].as_py() for p in "ab"]
                if pos[0] != a_pos:
                    if a is not None:
                        yield rows(*a.found())
                    a_pos, a = pos[0], opened(batch, row, "a")
                if pos[0] == pos[1]:
                    b = a
                elif pos[1] in held:
                    b = held[pos[1]]
                else:
                    b = opened(batch, row, "b")
                    if size + b.raw.nbytes <= 2 * TILE_BYTES:
                        held[pos[1]], size = b, size + b.raw.nbytes
                for i, j in linked(a, b, cosine, eps):
                    if a is b:
                        i, j = i[i != j], j[i != j]
                    a.links += np.bincount(i, b.copies[j], len(a.ids)).astype(np.int64)
                    if a is not b:
                        b.links += np.bincount(j, a.copies[i], len(b.ids)).astype(np.int64)
                    ties += spanning(a, b, i, j)
                    if sum(map(len, ties)) > PIECE:
                        yield tied()
                if b is not a and pos[1] not in held:
                    yield rows(*b.found())
        for block in (*held.values(), *([a] if a is not None else [])):
            yield rows(*block.found())
        if ties:
            yield tied()

    return met.mapInArrow(run, "id long, links long, label long")


def join_vectors(rows: DataFrame, cosine: float = COSINE, lead: int = LEAD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for ``rows(vec_id, v)``."""
    eps = math.sqrt(2 - 2 * cosine)
    fits = F.col("vec_id").isNotNull() & usable(F.col("v"))
    good, alone = rows.filter(fits), rows.filter(~fits).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"))
    keyed = good.select("vec_id", F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g"), F.size("v").alias("dim"))
    classes = stage(keyed.groupBy("h", "g", "dim").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")),
                    "grid-classes")
    found = None
    for dim, n in classes.groupBy("dim").count().orderBy("dim").collect():
        same = good.filter(F.size("v") == dim)
        axes = directions(same, dim, dim)
        vertices = same.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
        sequence = blocks(vertices, dim, eps, axes[:, :lead], block, n)
        part = compare(sequence, near_pairs(sequence, eps), axes, cosine, eps)
        found = part if found is None else found.union(part)
    if found is None:
        return alone
    found = stage(found, "grid-links")
    labels = components(found.filter("id <> label").select(F.col("id").alias("u"), F.col("label").alias("v")))
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    sums = sums.join(labels.withColumnRenamed("node", "id"), "id", "left")
    # the others have one copy and no link
    known = join_small(classes, sums, "id", "left").filter("copies > 1 or links is not null").select(
        "h", "g", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("label", "id").alias("component_id"))
    component = F.coalesce("component_id", "vec_id")
    return join_small(keyed, known, ["h", "g"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept")).union(alone)


def op6_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    prepare(spark)
    return join_vectors(read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("v")))
