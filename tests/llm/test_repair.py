import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ebbline.llm import repair
from ebbline.llm.queries import QUERIES

from .conftest import SF

GOAL = re.compile(r"(s?(ua)+)?")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
EMPTY = hashlib.sha256().hexdigest()


def damage(rows):
    """``(conv, turn, role, text)`` as the contract damages them."""
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults(rows):
    """Rows in order, each with its first fault."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    seen, out = set(), []
    for _, turn, role, text in rows:
        left = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        fault = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def table_of_states(rows):
    """Cheapest edits by a table over all states, audits kept whole: ``cost, audit, repaired lines``."""
    steps = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(best):
        for _ in range(4):
            for state, (cost, audit, lines) in list(best.items()):
                for i, to in steps[state].items():
                    if i in names:
                        new = cost + 3, audit + "I", [*lines, f"{names[i]}:"]
                        if to not in best or new[:2] < best[to][:2]:
                            best[to] = new
        return best

    best = with_inserts({"": (0, "", [])})
    for _, role, text, fault in rows:
        after = {}

        def put(state, cost, audit, lines, after=after):
            if state not in after or (cost, audit) < after[state][:2]:
                after[state] = cost, audit, lines

        for state, (cost, audit, lines) in best.items():
            put(state, cost + 4, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            for i, to in steps[state].items():
                if role[:1] == i:
                    put(to, cost + more, audit + "K", [*lines, f"{role}:{text}"])
                if i in names:
                    put(to, cost + more + 3, audit + "R", [*lines, f"{names[i]}:{text}"])
        best = with_inserts(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])


def every_edit(rows, most):
    """The same by trying all edits, with up to ``most`` inserts."""
    best = None
    options = [["D"] if f in ("blank", "duplicate") else ["K", "Ru", "Ra", "D"] for *_, f in rows]
    for edits in itertools.product(*options):
        for n in range(most + 1):
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), n):
                for kinds in itertools.product("ua", repeat=n):
                    initials, audit, cost, at = "", "", 3 * n, list(zip(places, kinds, strict=True))
                    for k in range(len(rows) + 1):
                        for place, kind in at:
                            if place == k:
                                initials, audit = initials + kind, audit + "I"
                        if k < len(rows):
                            _, role, _, fault = rows[k]
                            audit += edits[k][0]
                            if edits[k] != "D":
                                initials += role[:1] if edits[k] == "K" else edits[k][1]
                            cost += {"K": 0, "R": 3, "D": 4}[edits[k][0]] + 3 * (edits[k] != "D" and fault == "truncated")
                    if GOAL.fullmatch(initials) and all(r[1] or e != "K" for r, e in zip(rows, edits, strict=True)):
                        best = min(best or (cost, audit), (cost, audit))
    return best


def expected(rows, damaged=True):
    out, after = [], {}
    for conv, *row in damage(rows) if damaged else rows:
        after.setdefault(conv, []).append((conv, *row))
    for conv in {r[0] for r in rows}:
        own = faults(after.get(conv, []))
        turns = {t for t, *_ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [sum(f == kind for *_, f in own) for kind in ("blank", "duplicate", "truncated")]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, lines = table_of_states(own)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def _rows(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def invented(seed, convs, length):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        turns = [i for i in range(rng.randrange(length)) for _ in range(rng.choice([0, 1, 1, 1, 1, 2]))]
        for turn in turns:
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            rows.append((conv, turn, role, rng.choice(["Yes.", "no", "What?", " \t", "é!\n", "Oh.\x85", f"a{turn}.", f"b{turn}!"])))
    return rows


def test_query_equals_the_table_of_states(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op11_repair"](spark, SF)
    assert df.columns == COLUMNS
    assert _rows(df) == expected(rows)


@pytest.mark.parametrize("segment", [1, 3, 64])
def test_long_conversations_over_many_partitions(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = invented(1, 12, 90) + [(99, i // 2, "uaxs"[i % 4] + "ser", f"{i % 37}.") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for shape, is_damaged in ((repair.damaged, True), (repair.undamaged, False)):
            got = repair.digests(shape(df)).withColumnRenamed("conv", "conv_id")
            assert _rows(got) == expected(rows, is_damaged)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_lightest_is_least_of_all_edits():
    rng = random.Random(7)
    for _ in range(60):
        roles = [rng.choice(["user", "assistant", "system", "x", ""]) for _ in range(rng.randrange(5))]
        rows = [(i, r, f"{i}.", rng.choice([None, None, "blank", "truncated"])) for i, r in enumerate(roles)]
        items = [(r[:1], f == "blank", f == "truncated") for _, r, _, f in rows]
        (found,) = repair.lightest(items, {repair.START: (0, "")}, repair.GOALS).values()
        cost, audit = found
        assert (cost, audit.replace("E", "D")) == every_edit(rows, 3) == table_of_states(rows)[:2]


def test_agenda_stops_at_the_goal(monkeypatch):
    """A sound conversation costs one pop a row: nothing dearer than the goal is looked at."""
    pops, pop = [], repair.heapq.heappop
    monkeypatch.setattr(repair.heapq, "heappop", lambda agenda: pops.append(pop(agenda)) or pops[-1])
    items = [("s", False, False)] + [("u", False, False), ("a", False, False)] * 50
    assert repair.lightest(items, {repair.START: (0, "")}, repair.GOALS) == {repair.ASSISTANT: (0, "K" * 101)}
    assert len(pops) == 102


def test_odd_rows(spark):
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, 5, None, "x")]
    rows += [(2, 1, "assistant", None), (3, 2, "user", "a" * 100_000 + "."), (3, 9, "assistant", "😀"), (4, -3, "user", "\n \r\x0b\x0c\t")]
    rows += [(5, t, r, "Same.") for t in (3, 3, 7) for r in ("user", "user", "assistant")]
    rows += [(10 + i, 0, "user", "Only.") for i in range(60)]  # some are dropped
    df = spark.createDataFrame(rows, SCHEMA)
    got = repair.digests(repair.damaged(df)).withColumnRenamed("conv", "conv_id")
    assert _rows(got) == expected(rows)
    assert any(r[-1] == EMPTY and r[6] == 0 and r[7] == "" for r in _rows(got))
    clash = df.selectExpr("*", "1 AS conv", "2 AS copies", "'x' AS digest", "3 AS facts")
    assert _rows(repair.digests(repair.damaged(clash)).withColumnRenamed("conv", "conv_id")) == expected(rows)
    assert repair.digests(repair.damaged(df.limit(0))).count() == 0


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "First."), (1, 1, "user", "Second."), (1, 2, "user", "Second."), (1, 3, "tool", "Third")]
    got = repair.repaired(repair.undamaged(spark.createDataFrame(rows, SCHEMA))).orderBy("conv", "place").collect()
    assert [(r.conv, r.place) for r in got] == [(1, i) for i in range(len(got))]
    assert [f"{r.role}:{r.text}" for r in got] == table_of_states(faults(rows))[2]
    assert GOAL.fullmatch("".join(r.role[0] for r in got)) and {r.edit for r in got} <= set("KRI")
