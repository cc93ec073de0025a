"""Mixing sources to target weights by entropy balancing (operator 1).

Among all document rates r >= 0 that meet the token targets of the groups, the
one closest to the corpus in relative entropy (measured in words) is an
exponential tilt, ``r = min(cap, exp(sum of its groups' multipliers))``.  The
multipliers solve a convex dual, which Newton steps solve here: each step is one
Spark aggregation of tilted words per group.  Rates depend on a document only
through its groups, so words are summed once into cells (one row for each
combination of groups) and the steps run over cells.

Rates become whole copies by systematic rounding: the documents of a group are
ranked by size, and document number k gets ``floor(r k + u) - floor(r (k-1) + u)``
copies, so that the words taken differ from the target by at most the size of
the largest document.  The offset u is the one of 16 that comes nearest.

Defined results: a null text has size 0; a null group is a group of its own
(last in code point order); a repeated row is a document of its own, so equal
rows may get different copies; a document of size 0 takes 0 words; an empty table
gives no rows.  Extra columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillsight.llm.staging import join_small, prepare, read, stage

#: A word: code points other than space, tab, newline, \x0B, \x0C, \r.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
OFFSETS = tuple((k + 0.4142) / 16 for k in range(16))
ROWS_PER_BLOCK = 2000
NEWTON_STEPS = 60
TOLERANCE = 1e-13


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def group_key(group: Column) -> Column:
    """A non-null key: null sorts after every value and equals no string."""
    return F.when(group.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), group))


def weighted_targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """Word targets of groups: ``sizes(g, mass)`` gets column ``target``.

    Groups in key order get the weights in turn; all targets together are the mass
    of all groups; a target above ``cap`` times its group's mass stops there and
    the rest is shared again by weight.  With level t, targets are
    ``min(cap * mass, t * weight)``; t follows from the groups sorted by
    ``cap * mass / weight``.  One row for each group meets in one task here.
    """
    order = Window.orderBy("g")
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    by_need = Window.orderBy(F.col("most") / F.col("w"), "g")
    everything = Window.partitionBy()
    rows = (sizes.withColumn("w", weight).withColumn("most", F.lit(cap) * F.col("mass"))
            .withColumn("before", F.sum("most").over(by_need.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("w_rest", F.sum("w").over(by_need.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("total", F.sum("mass").over(everything))
            .withColumn("level", (F.col("total") - F.coalesce("before", F.lit(0.0))) / F.col("w_rest"))
            .withColumn("k", F.row_number().over(by_need)))
    fits = F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct("k", "level"))
    return (rows.withColumn("t", F.min(fits).over(everything)["level"])
            .select("g", "mass", F.least("most", F.coalesce(F.col("t") * F.col("w"), F.col("most"))).alias("target")))


def balance(cells: DataFrame, targets: dict[str, DataFrame], cap: float = CAP,
            steps: int = NEWTON_STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """Newton solution of the dual: ``cells`` plus column ``rate``.

    ``cells`` has one column of group keys for each key of ``targets`` and
    ``mass``; ``targets[dim]`` has ``g`` and ``target``.  With one family of
    groups the Hessian is diagonal; with several, each sweep takes the families
    in turn (block Newton).  A step is at most 1 in the exponent.  Stops when no
    group's words are off by more than ``tolerance`` of its target.
    """
    cells = cells.withColumn("eta", F.lit(0.0))
    for _ in range(steps):
        off = 0.0
        for dim, wanted in targets.items():
            tilted = F.least(F.lit(cap), F.exp("eta")) * F.col("mass")
            free = F.when(F.exp("eta") < cap * (1 + 1e-9), tilted).otherwise(0.0)
            grads = (cells.groupBy(dim).agg(F.sum(tilted).alias("words"), F.sum(free).alias("hess"))
                     .join(wanted.select(F.col("g").alias(dim), "target"), dim)
                     .withColumn("gap", F.col("target") - F.col("words"))
                     .withColumn("step", F.when(F.col("hess") > 0, F.greatest(F.lit(-1.0), F.least(
                         F.lit(1.0), F.col("gap") / F.col("hess")))).otherwise(F.signum("gap"))))
            grads = stage(grads.select(dim, "step", F.when(F.col("target") > 0, F.abs("gap") / F.col("target"))
                                       .otherwise(0.0).alias("off")), "mix-gradient")
            off = max(off, grads.agg(F.max("off")).first()[0] or 0.0)
            cells = cells.join(grads.select(dim, "step"), dim).withColumn(
                "eta", F.col("eta") + F.col("step")).drop("step")
        cells = stage(cells, "mix-cells")
        if off <= tolerance:
            break
    return cells.withColumn("rate", F.least(F.lit(cap), F.exp("eta")))


def copies_of(rate: Column, rank: Column, offset: Column, cap: float = CAP) -> Column:
    """Whole copies of document number ``rank`` of its group."""
    return F.least(F.lit(int(cap)), F.floor(rate * rank + offset) - F.floor(rate * (rank - 1) + offset))


def block_of(doc_id: Column, blocks: Column) -> Column:
    """A number below ``blocks`` that spreads regular ids."""
    m = F.lit(2147483647)
    return F.pmod(F.pmod(F.pmod(F.coalesce(doc_id, F.lit(0)), m) * 48271, m), blocks)


def ranked(docs: DataFrame) -> DataFrame:
    """Rank the rows ``(doc_id, g, size)`` within g by size, largest first.

    A rank is the sum of three counts: rows of larger sizes, rows of earlier
    blocks of the same size, and rows before in the same block.  Only blocks of
    about ROWS_PER_BLOCK rows are ever sorted in one task, however hot a group
    or a size is.
    """
    by_size = Window.partitionBy("g").orderBy(F.desc("size"))
    levels = (docs.groupBy("g", "size").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(by_size) - F.col("n"))
              .withColumn("blocks", F.ceil(F.col("n") / ROWS_PER_BLOCK)))
    rows = (docs.join(levels.select("g", "size", "before", "blocks"), ["g", "size"])
            .withColumn("block", block_of(F.col("doc_id"), F.col("blocks"))))
    rows = stage(rows, "mix-blocks")
    in_level = Window.partitionBy("g", "size").orderBy("block")
    starts = (rows.groupBy("g", "size", "block").agg(F.count("*").alias("n"))
              .withColumn("start", F.sum("n").over(in_level) - F.col("n")).drop("n"))
    in_block = Window.partitionBy("g", "size", "block").orderBy(F.asc_nulls_first("doc_id"))
    return (rows.withColumn("at", F.row_number().over(in_block))
            .join(starts, ["g", "size", "block"])
            .select("doc_id", "g", "size", (F.col("before") + F.col("start") + F.col("at")).alias("rank")))


def mix(docs: DataFrame, group: str = "source", weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken, rate, copies."""
    return planned(docs, group, weights, cap).drop("g")


def planned(docs: DataFrame, group: str, weights, cap: float) -> DataFrame:
    """``mix`` with the group key g."""
    sized = stage(docs.select("doc_id", group_key(F.col(group).cast("string")).alias("g"),
                              n_words(F.col("text")).alias("size")), "mix-sizes")
    sizes = stage(sized.groupBy("g").agg(F.sum("size").cast("double").alias("mass")), "mix-groups")
    wanted = stage(weighted_targets(sizes, weights, cap), "mix-targets")
    rates = balance(wanted.select("g", "mass"), {"g": wanted.select("g", "target")}, cap)
    plan = stage(wanted.join(rates.select("g", "rate"), "g"), "mix-rates")
    rows = stage(ranked(sized).join(plan, "g"), "mix-ranks")
    tried = [F.sum(F.col("size") * copies_of(F.col("rate"), F.col("rank"), F.lit(u), cap)).alias(f"t{k}")
             for k, u in enumerate(OFFSETS)]
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(k).alias("k"),
                                          F.lit(u).alias("u")) for k, u in enumerate(OFFSETS)]))
    offsets = (rows.groupBy("g").agg(F.first("target").alias("target"), *tried)
               .select("g", best["u"].alias("u")))
    return (rows.join(stage(offsets, "mix-offsets"), "g")
            .withColumn("copies", copies_of(F.col("rate"), F.col("rank"), F.col("u"), cap).cast("int"))
            .select("doc_id", "g", "size", F.col("mass").cast("long").alias("source_size"), "target",
                    (F.col("size") * F.col("copies")).cast("long").alias("taken"), "rate", "copies"))


def take(docs: DataFrame, group: str = "source", weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as its number of copies.

    Only numbers of copies are joined to the texts.  Rows that share a doc_id get those
    planned for their group and size, most copies first in the order of the rows' digests,
    so that only equal rows are interchangeable.  Digests are counted and sorted by their
    first digits, so that no task sorts all rows without doc_id.
    """
    plan = stage(planned(docs, group, weights, cap).select(
        F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__null"), F.col("g").alias("__g"),
        F.col("size").alias("__size"), "copies"), "mix-plan")
    key = ["__id", "__null"]
    rows = docs.withColumn("__id", F.coalesce("doc_id", F.lit(0))).withColumn("__null", F.col("doc_id").isNull())
    shared = stage(plan.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key), "mix-shared")
    single = plan.join(shared, key, "left_anti").filter("copies > 0").select(*key, "copies")
    chosen = join_small(rows, single, key)
    if not shared.isEmpty():
        same = [*key, "__g", "__size"]
        levels = range(1, int(cap) + 1)
        counts = (plan.join(shared, key, "left_semi").groupBy(*same)
                  .agg(*[F.count_if(F.col("copies") >= c).alias(f"__n{c}") for c in levels]).filter("__n1 > 0"))
        twins = (join_small(rows, shared, key, "left_semi")
                 .withColumn("__g", group_key(F.col(group).cast("string"))).withColumn("__size", n_words(F.col("text")))
                 .withColumn("__digest", F.md5(F.to_json(F.struct(*docs.columns))))
                 .withColumn("__part", F.substring("__digest", 1, 3)))
        starts = (twins.groupBy(*same, "__part").agg(F.count("*").alias("n"))
                  .withColumn("__start", F.sum("n").over(Window.partitionBy(*same).orderBy("__part")) - F.col("n")).drop("n"))
        rank = F.col("__start") + F.row_number().over(Window.partitionBy(*same, "__part").orderBy("__digest"))
        twins = join_small(join_small(twins, starts, [*same, "__part"]).withColumn("__k", rank), counts, same)
        copies = sum((F.when(F.col("__k") <= F.col(f"__n{c}"), 1).otherwise(0) for c in levels), F.lit(0))
        chosen = chosen.unionByName(twins.withColumn("copies", copies).filter("copies > 0").select(*chosen.columns))
    return chosen.withColumn("__copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*docs.columns)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents by source with weights 5, 2, 1 and a cap of three copies."""
    prepare(spark)
    return mix(read(spark, sf_dir, "documents")).drop("rate")


_SQL_COPIES = "least(3, floor(rate * rank + {u}) - floor(rate * (rank - 1) + {u}))"
_TRIES = ", ".join(f"sum(size * {_SQL_COPIES.format(u=u)}) AS t{k}" for k, u in enumerate(OFFSETS))
_OFFS = ", ".join(f"{{'off': abs(t{k} - target), 'k': {k}, 'u': {u}}}" for k, u in enumerate(OFFSETS))

ORACLE_OP1 = rf"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS g,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
groups AS (
  SELECT g, CAST(sum(size) AS DOUBLE) AS mass, sum(sum(size)) OVER () AS total,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY g) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM sized GROUP BY g),
-- Raising the level from cap to cap: of all sets of capped groups the right one is
-- the one whose level lies above the needs of the capped and not above the others'.
levels AS (
  SELECT a.g, (max(a.total) - coalesce(sum(3 * b.mass) FILTER (3 * b.mass / b.w < 3 * a.mass / a.w), 0))
              / sum(b.w) FILTER (3 * b.mass / b.w >= 3 * a.mass / a.w) AS level,
         any_value(3 * a.mass / a.w) AS need
  FROM groups a, groups b GROUP BY a.g),
targets AS (
  SELECT g, mass, least(3 * mass, w * (SELECT arg_min(level, need) FROM levels WHERE level <= need * (1 + 1e-15))) AS target
  FROM groups),
blocked AS (
  SELECT doc_id, g, size, (coalesce(doc_id, 0) % 2147483647 * 48271 % 2147483647)
           % CAST(ceil(count(*) OVER (PARTITION BY g, size) / 2000.0) AS BIGINT) AS block
  FROM sized),
ranks AS (
  SELECT doc_id, g, size, row_number() OVER (PARTITION BY g ORDER BY size DESC, block, doc_id NULLS FIRST) AS rank
  FROM blocked),
rated AS (
  SELECT doc_id, g, size, rank, mass, target,
         CASE WHEN mass = 0 THEN 1.0 ELSE least(3.0, target / mass) END AS rate
  FROM ranks JOIN targets USING (g)),
tried AS (SELECT g, any_value(target) AS target, {_TRIES} FROM rated GROUP BY g),
chosen AS (SELECT g, list_min([{_OFFS}]).u AS u FROM tried)
SELECT doc_id, size, CAST(mass AS BIGINT) AS source_size, target,
       CAST(size * {_SQL_COPIES.format(u='u')} AS BIGINT) AS taken,
       CAST({_SQL_COPIES.format(u='u')} AS INT) AS copies
FROM rated JOIN chosen USING (g)
"""
