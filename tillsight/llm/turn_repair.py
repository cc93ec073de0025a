"""Repair of conversation structure by survivor-coalescence Viterbi (operator 11).

A conversation should read ``(s?(ua)+)?``: perhaps a system turn, then turns of user
and assistant in alternation, by the first letters of the roles.  The rows of a
conversation are edited into such a sequence at the least cost: Keep 0, Rerole (to user
or assistant) 2, Delete 3, Insert (an empty user or assistant turn) 2, and 1 for a row
that stays though its text is truncated.  Blank rows and duplicates have to go.  Among
edits of equal cost the ASCII-least string of their letters D, I, K, R wins.

The rows stream through a Viterbi search over the four states of that grammar.  Paths
are leaves of a tree of backpointers: a node is the edits around one row and counts its
children and the survivors that end at it; a node that falls to zero is freed, and its
parent with it if that was its last child.  Once all survivors share an ancestor, its
edits can no longer change: they are emitted, with their rows, and the tree starts
there.  Two paths into one state that tie in cost are compared by their complete
unresolved letters, up to the ancestor they share.  (Neither can be a prefix of the
other: it would have fewer inserts and so a lower cost.)  A survivor that is more than
WORST_DETOUR dearer than the best is dropped, since from any state every end can be
reached for at most that much more.

Which rows are duplicates is found before, by counting: the first turn of each role and
text of a conversation is a grouped minimum (combined before the shuffle), joined to the
rows.  Each conversation is then sorted and streamed through one task, as a digest over
the whole repaired conversation demands; that task holds only the tree, the rows not
yet resolved (without the texts of rows that have to go) and no more.  Rows resolve
within a few turns unless a long stretch leaves the survivors level (roles other than
system, user and assistant throughout), which keeps that stretch in memory.

Defined results: a null conv_id is a conversation of its own; null turns come first;
rows of one turn are taken by role, then rows that have to go, then by text; a null text
is blank, a null role is no role of the grammar; equal rows of one turn are duplicates of
the first of them; texts of any length are read whole; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm.staging import join_small, prepare, read

#: A character that is not white space, and a text whose last such character ends a sentence.
SOLID = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after s, after u, after a; what may follow each, and where it leads.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Inserts that bring a state to an accepting one.
CLOSE = ("", "ua", "a", "")
WORST_DETOUR = 5
ROLES = {"u": "user", "a": "assistant"}
ROWS_PER_BATCH = 2000


def _moves() -> dict[str, list[tuple[int, int, str, str, int]]]:
    """For each first letter of a role: (state, next state, edits, letters they give, cost).

    A row is deleted, or kept or reroled after at most one insert.  An insert before a
    deleted row is never best: after it, it costs the same and D sorts before I.  Two
    inserts lead to a state that allows nothing more than the state before them.
    """
    table: dict[str, list[tuple[int, int, str, str, int]]] = {}
    for first in ("s", "u", "a", ""):
        moves = [(q, q, "D", "", DELETE) for q in range(4)]
        for q in range(4):
            starts = [(q, "", "", 0)] + [(NEXT[q][x], "I", x, INSERT) for x in "ua" if x in NEXT[q]]
            for at, edits, given, cost in starts:
                if first in NEXT[at]:
                    moves.append((q, NEXT[at][first], edits + "K", given + first, cost))
                moves += [(q, NEXT[at][x], edits + "R", given + x, cost + REROLE) for x in "ua" if x in NEXT[at]]
        table[first] = moves
    return table


MOVES = _moves()
FORCED = [m for m in MOVES[""] if m[2] == "D"]


class Node:
    """The edits around one row; ``refs`` counts children and survivors that end here."""

    __slots__ = ("parent", "edits", "given", "kids", "ends")

    def __init__(self, parent: "Node | None", edits: str, given: str):
        self.parent, self.edits, self.given = parent, edits, given
        self.kids: list[Node] = []
        self.ends = 0

    @property
    def refs(self) -> int:
        return len(self.kids) + self.ends


def before(a: Node, more_a: str, b: Node, more_b: str) -> bool:
    """Whether the path to ``a`` and ``more_a`` has lesser letters than that to ``b`` and ``more_b``.

    Both nodes stand at the same row, so both paths climb in step to the ancestor they share.
    """
    if a is b:
        return more_a < more_b
    left, right = [more_a], [more_b]
    while a is not b:
        left.append(a.edits)
        right.append(b.edits)
        a, b = a.parent, b.parent
    return "".join(reversed(left)) < "".join(reversed(right))


class Search:
    """Viterbi over the rows of one conversation; ``add`` and ``end`` give resolved rows.

    A resolved item is (edits, letters, row) with the row as it was added.
    """

    def __init__(self):
        self.root = Node(None, "", "")
        self.root.ends = 1
        self.alive: dict[int, tuple[int, Node]] = {0: (0, self.root)}
        self.rows: deque = deque()
        self.most_held = 0

    def add(self, first: str, must_go: bool, truncated: bool, row) -> Iterator[tuple[str, str, object]]:
        self.rows.append(row)
        self.most_held = max(self.most_held, len(self.rows))
        best: dict[int, tuple[int, Node, str, str]] = {}
        for q, to, edits, given, cost in FORCED if must_go else MOVES.get(first, MOVES[""]):
            if q not in self.alive:
                continue
            total, node = self.alive[q]
            total += cost + (TRUNCATED if truncated and edits != "D" else 0)
            old = best.get(to)
            if old is None or total < old[0] or total == old[0] and before(node, edits, old[1], old[2]):
                best[to] = (total, node, edits, given)
        least = min(total for total, *_ in best.values())
        alive = {}
        for to, (total, node, edits, given) in best.items():
            if total <= least + WORST_DETOUR:
                leaf = Node(node, edits, given)
                leaf.ends = 1
                node.kids.append(leaf)
                alive[to] = (total, leaf)
        self.drop(self.alive)
        self.alive = alive
        return self.resolved()

    def drop(self, alive: dict[int, tuple[int, Node]]) -> None:
        """End survivors and free the nodes that nothing refers to any more."""
        for _, node in alive.values():
            node.ends -= 1
            while node is not self.root and not node.refs:
                parent = node.parent
                parent.kids.remove(node)
                node.parent = None
                node = parent

    def resolved(self) -> Iterator[tuple[str, str, object]]:
        """Emit what all survivors share."""
        while not self.root.ends and len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.parent = None
            yield self.root.edits, self.root.given, self.rows.popleft()

    def end(self) -> tuple[int, list[tuple[str, str, object]]]:
        """Cost of the best path, and the rest of its edits (inserts at the end have no row)."""
        done = None
        for q, (total, node) in self.alive.items():
            close = CLOSE[q]
            total, edits = total + INSERT * len(close), "I" * len(close)
            if done is None or total < done[0] or total == done[0] and before(node, edits, done[1], done[2]):
                done = (total, node, edits, close)
        total, node, edits, close = done
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        rest = [(n.edits, n.given, self.rows.popleft()) for n in reversed(path)]
        return total, [*rest, *([(edits, close, None)] if close else [])]


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` damaged by the checksum of their key: dropped, emptied, stripped, repeated or reroled.

    Dropped rows stay as placeholders (``gone``), so that their conversation is not lost.
    """
    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = (F.when(kind == 0, None).when(kind == 1, "")
            .when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                        text.alias("text"), (kind == 0).alias("gone"), F.explode(copies).alias("__copy"))
            .drop("__copy"))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault``: blank, later (role and text stood at an earlier turn) or truncated.

    ``later`` does not cover equal rows of one turn; they are neighbours once sorted.
    """
    blank = F.col("gone") | ~F.coalesce(F.regexp_like("text", F.lit(SOLID)), F.lit(False))
    key = [F.coalesce("conv_id", F.lit(0)).alias("__conv"), F.col("conv_id").isNull().alias("__none"),
           F.sha2(F.to_json(F.struct("role", "text")), 256).alias("__said")]
    rows = rows.withColumn("__blank", blank).select("*", *key)
    names = ["__conv", "__none", "__said"]
    firsts = (rows.filter(~F.col("__blank")).groupBy(*names)
              .agg(F.min("turn").alias("__first"), F.max("turn").alias("__last"),
                   F.max(F.col("turn").isNull()).alias("__null")).filter(
                  F.col("__first").isNotNull() & (F.col("__null") | (F.col("__first") < F.col("__last"))))
              .select(*names, F.when(~F.col("__null"), F.col("__first")).alias("__first")))
    rows = join_small(rows, firsts.withColumn("__again", F.lit(True)), names, "left")
    later = F.col("__again") & F.col("turn").isNotNull() & (F.col("__first").isNull() | (F.col("turn") > F.col("__first")))
    fault = (F.when(F.col("__blank"), "blank").when(later, "duplicate")
             .when(~F.regexp_like("text", F.lit(ENDED)), "truncated"))
    return (rows.withColumn("fault", fault)
            .withColumn("text", F.when(F.col("fault").isNull() | (F.col("fault") == "truncated"), F.col("text")))
            .select("conv_id", "turn", "role", "text", "gone", "fault"))


EDIT_COLUMNS = ("seq long, turn long, role string, new_role string, text string, fault string, edit string, "
                "total long")


def repair(rows: DataFrame) -> DataFrame:
    """The edits of every conversation, one row each, in order within each partition.

    Input: conv_id, turn, role, text, and gone (true for a placeholder of a row that does
    not exist).  Output: conv_id, seq (from 0), turn, role (as it was; null for an insert),
    new_role and text (of the turn as repaired; null if deleted), fault, edit (D, I, K or R),
    total (on a conversation's last row: the cost).  A conversation of placeholders only
    has one row without edit.
    """
    if "gone" not in rows.columns:
        rows = rows.withColumn("gone", F.lit(False))
    conv = rows.schema["conv_id"].dataType.simpleString()
    ready = (faults(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "gone"))
             .repartition("conv_id")
             .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")))
    return ready.mapInArrow(_repair_batches, f"conv_id {conv}, {EDIT_COLUMNS}")


def _repair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[list] = [[] for _ in range(9)]
    schema: list[pa.Schema] = []
    conv, search, seq, last, count = None, None, 0, None, 0

    def put(values) -> None:
        for column, value in zip(out, values):
            column.append(value)

    def edits(items) -> None:
        nonlocal seq
        for letters, given, row in items:
            given = iter(given)
            for letter in letters:
                if letter == "I":
                    put((conv, seq, None, None, ROLES[next(given)], "", None, "I", None))
                else:
                    turn, role, text, fault = row
                    x = next(given) if letter != "D" else ""
                    new = ROLES[x] if letter == "R" else role if letter == "K" else None
                    put((conv, seq, turn, role, new, text if new is not None else None, fault, letter, None))
                seq += 1

    def close() -> None:
        if search is None:
            return
        if count:
            cost, rest = search.end()
            edits(rest)
            out[8][-1] = cost
        else:
            put((conv, 0, None, None, None, None, None, None, 0))

    def flush() -> Iterator[pa.RecordBatch]:
        """All rows but the newest, which may still get its conversation's cost."""
        if len(out[0]) > ROWS_PER_BATCH:
            ready, rest = [c[:-1] for c in out], [c[-1:] for c in out]
            for column, value in zip(out, rest):
                column[:] = value
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(ready, schema[0].types)], schema=schema[0])

    for batch in batches:
        if not schema:
            string, long = pa.string(), pa.int64()
            schema.append(pa.schema(list(zip(
                ["conv_id", "seq", "turn", "role", "new_role", "text", "fault", "edit", "total"],
                [batch.schema.field("conv_id").type, long, long, string, string, string, string, string, long]))))
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for row in zip(*(part.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "fault"))):
                key, turn, role, text, gone, fault = row
                if search is None or key != conv:
                    close()
                    conv, search, seq, last, count = key, Search(), 0, None, 0
                if gone:
                    continue
                count += 1
                if fault in (None, "truncated"):
                    if last == (turn, role, text):  # equal rows of one turn are neighbours
                        fault = "duplicate"
                    last = (turn, role, text)
                must_go = fault in ("blank", "duplicate")
                edits(search.add((role or "")[:1], must_go, fault == "truncated",
                                 (turn, role, None if must_go else text, fault)))
            yield from flush()
    close()
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema[0].types)], schema=schema[0])


def summary(edits: DataFrame) -> DataFrame:
    """One row for each conversation from the ordered edits of ``repair``, read in one pass without a shuffle."""
    conv = edits.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{n} long" for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return edits.mapInArrow(_summary_batches, f"conv_id {conv}, {counts}, audit string, repaired_sha256 string")


def _summary_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    done: list[tuple] = []
    kind = pa.int64()

    def made() -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        columns = [pa.array(c, t) for c, t in zip(zip(*done), types)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for row in zip(*(part.column(n).to_pylist() for n in (
                    "conv_id", "seq", "turn", "role", "new_role", "text", "fault", "edit", "total"))):
                conv, seq, turn, role, new_role, text, fault, edit, total = row
                if seq == 0:
                    seen = {"blank": 0, "duplicate": 0, "truncated": 0}
                    audit, digest, lowest, highest, distinct, illegal, first, said = [], hashlib.sha256(), None, None, 0, 0, None, False
                if edit is not None:
                    audit.append(edit)
                    if edit != "I":
                        if fault:
                            seen[fault] += 1
                        if turn is not None and turn != highest:
                            lowest, highest, distinct = turn if lowest is None else lowest, turn, distinct + 1
                        now = (role or " ")[:1]
                        illegal += first is not None and first + now not in ("su", "ua", "au")
                        first = now
                    if new_role is not None:
                        digest.update(f"{chr(10) if said else ''}{new_role}:{text}".encode())
                        said = True
                if total is not None:
                    gaps = 0 if lowest is None else highest - lowest + 1 - distinct
                    done.append((conv, gaps, seen["blank"], seen["duplicate"], seen["truncated"], illegal, total,
                                 "".join(audit), digest.hexdigest()))
        if len(done) >= ROWS_PER_BATCH:
            yield made()
    if done:
        yield made()


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired text of every (damaged) conversation."""
    prepare(spark)
    return summary(repair(damage(read(spark, sf_dir, "conversations"))))
