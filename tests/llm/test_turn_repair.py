"""Operator 11 against enumeration and a plain search over whole strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tillsight.llm import staging, turn_repair

SF_SMALL = "/root/testdata/sf0.001"
GOOD = re.compile(r"(s?(ua)+)?")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def enumerated(rows):
    """Least (cost, audit) over every edit with at most two inserts in a gap; rows: (first letter, must go, truncated)."""
    gaps = [(n * 2, "I" * n, "".join(x)) for n in range(3) for x in itertools.product("ua", repeat=n)]
    best = None

    def go(k, cost, audit, given):
        nonlocal best
        for c, edits, letters in gaps:
            if k == len(rows):
                if GOOD.fullmatch(given + letters):
                    found = (cost + c, audit + edits)
                    best = found if best is None else min(best, found)
                continue
            first, must_go, truncated = rows[k]
            go(k + 1, cost + c + 3, audit + edits + "D", given + letters)
            if not must_go:
                go(k + 1, cost + c + truncated, audit + edits + "K", given + letters + (first or "?"))
                for x in "ua":
                    go(k + 1, cost + c + 2 + truncated, audit + edits + "R", given + letters + x)

    go(0, 0, "", "")
    return best


def plain(rows):
    """Least (cost, audit) by a table of whole strings, with any run of inserts in each gap."""
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(table):
        for _ in range(2):
            for (q, (c, w)) in list(table.items()):
                for x in "ua":
                    if (q, x) in step:
                        put(table, step[q, x], (c + 2, w + "I"))

    def put(table, q, value):
        table[q] = min(table.get(q, value), value)

    # two prefixes in one state tie only if neither is a prefix of the other, so the lesser stays lesser
    table = {"0": (0, "")}
    for first, must_go, truncated in rows:
        inserted(table)
        new = {}
        for q, (c, w) in table.items():
            put(new, q, (c + 3, w + "D"))
            if not must_go:
                if (q, first) in step:
                    put(new, step[q, first], (c + truncated, w + "K"))
                for x in "ua":
                    if (q, x) in step:
                        put(new, step[q, x], (c + 2 + truncated, w + "R"))
        table = new
    inserted(table)
    return min(v for q, v in table.items() if q in "0a")


def searched(rows):
    search, audit = turn_repair.Search(), ""
    for first, must_go, truncated in rows:
        audit += "".join(e for e, _, _ in search.add(first, must_go, truncated, None))
    cost, rest = search.end()
    return (cost, audit + "".join(e for e, _, _ in rest)), search


def some_rows(rng, n):
    return [(rng.choice("suaua") if rng.random() < 0.9 else "", rng.random() < 0.15, int(rng.random() < 0.2)) for _ in range(n)]


def test_search_is_enumeration():
    kinds = [(f, go, t) for f in ("s", "u", "a", "") for go, t in ((False, 0), (False, 1), (True, 0))]
    for n in (1, 2):
        for rows in itertools.product(kinds, repeat=n):
            assert searched(rows)[0] == enumerated(rows) == plain(rows), rows
    rng = random.Random(5)
    for _ in range(12):
        rows = some_rows(rng, 3)
        assert searched(rows)[0] == enumerated(rows) == plain(rows), rows


def test_search_is_plain_table():
    rng = random.Random(6)
    for _ in range(3000):
        rows = some_rows(rng, rng.randrange(0, 30))
        if rows:
            assert searched(rows)[0] == plain(rows), rows


def test_survivors_coalesce():
    """A long conversation is emitted while it is read, and the tree is freed."""
    rng = random.Random(7)
    rows = [("ua"[k % 2], rng.random() < 0.05, int(rng.random() < 0.1)) for k in range(20_000)]
    (_, audit), search = searched(rows)
    assert search.most_held < 200 and sum(x != "I" for x in audit) == len(rows)
    assert search.root.parent is None


def brute(rows):
    """The whole contract in plain Python, from raw rows."""
    convs = {}
    for conv, turn, role, text in rows:
        out = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else text
        if kind == 2 and text is not None:
            text = re.sub("[.!?]", "", text)
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    result = {}
    for conv, found in convs.items():
        def goes(r, found=found):
            earlier = any(o[1:] == r[1:] and (o[0] is None, -(o[0] or 0)) > (r[0] is None, -(r[0] or 0)) for o in found)
            return earlier or not (r[2] or "").strip(SPACE)
        found = sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", not goes(r), r[2] or ""))
        marks, seen = [], set()
        for _, role, text in found:
            solid = (text or "").strip(SPACE)
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen else
                     "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))
            marks.append(fault)
        turns = [t for t, _, _ in found if t is not None]
        first = [(r or " ")[:1] for _, r, _ in found]
        cost, audit = plain([(f if f in "sua" else "", m in ("blank", "duplicate"), int(m == "truncated"))
                             for f, m in zip(first, marks)]) if found else (0, "")
        texts, at, letters = [], 0, [x for x in audit if x != "D"]
        expected = ("s" if len(letters) % 2 else "") + "ua" * (len(letters) // 2)
        roles = iter(expected)
        for x in audit:
            if x == "I":
                texts.append({"u": "user:", "a": "assistant:"}[next(roles)])
                continue
            _, role, text = found[at]
            at += 1
            if x != "D":
                want = next(roles)
                texts.append(f"{role if x == 'K' else {'u': 'user', 'a': 'assistant'}[want]}:{text}")
        result[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count("blank"),
                        marks.count("duplicate"), marks.count("truncated"),
                        sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
                        hashlib.sha256("\n".join(texts).encode()).hexdigest())
    return result


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def collected(df):
    rows = df.collect()
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_is_brute_force(spark):
    df = turn_repair.op11_turn_repair(spark, SF_SMALL)
    rows = [tuple(r) for r in staging.read(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert collected(df) == brute(rows)


@pytest.fixture(scope="module")
def odd_rows():
    """Null ids, turns, roles and texts, ties, copies, blanks, other roles, one hot conversation with a third of all rows."""
    rng = random.Random(8)
    texts = ["Yes.", "No", "  ", "", None, "ü!\n", "Why? \x0b", "a" * 5000 + ".", "dot. after", " ", "x. "]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant"]
    rows = []
    for conv in [None, *range(40)]:
        for k in range(rng.randrange(1, 12)):
            rows.append((conv, rng.choice([None, k, k, k, k - 1, k + 7]), rng.choice(roles), rng.choice(texts)))
    rows += [(99, k // 2, roles[k % 2] if k % 5 else rng.choice(roles), rng.choice(texts) if k % 3 else f"t{k}.") for k in range(len(rows) // 2)]
    rows += [(98, k, "user", "same.") for k in range(60)] + rows[:25]
    return rows


@pytest.mark.parametrize("parts", [1, 5])
def test_odd_rows(spark, odd_rows, parts):
    df = spark.createDataFrame([(*r, "extra", 1) for r in odd_rows],
                               "conv_id long, turn long, role string, text string, fault string, seq int").repartition(parts)
    assert collected(turn_repair.summary(turn_repair.repair(turn_repair.damage(df)))) == brute(odd_rows)


def test_empty_and_all_dropped(spark):
    schema = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], schema)
    assert turn_repair.summary(turn_repair.repair(turn_repair.damage(empty))).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    got = collected(turn_repair.summary(turn_repair.repair(turn_repair.damage(
        spark.createDataFrame([(gone, 1, "user", "Hi.")], schema)))))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_edits_are_real_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "Hello."), (1, 3, "user", "Bye.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = turn_repair.repair(df).orderBy("seq").collect()
    assert [r["edit"] for r in got] == ["K", "I", "K", "D", "K", "I"]
    assert [(r["new_role"], r["text"]) for r in got if r["edit"] != "D"] == [
        ("system", "Be kind."), ("user", ""), ("assistant", "Hello."), ("user", "Bye."), ("assistant", "")]
    assert got[-1]["total"] == 2 + 3 + 2
