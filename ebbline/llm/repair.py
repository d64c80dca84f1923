"""Conversation structure repair: Knuth's lightest derivations over an agenda.

A conversation is repaired by edits of its rows, in their order: Keep, Rerole (to user or assistant), Delete, and Insert
of an empty user or assistant turn anywhere.  What is left must read as an optional system turn and then pairs of user
and assistant, or be empty.  ``(i, q)`` is the item that ``i`` rows are used up and the turns written so far leave the
grammar in state ``q``.  Every edit is a deduction from one item to another; its function adds a cost and appends a
letter.  Costs are not negative and a longer audit comes later in the order, so these functions are monotone and superior
in ``(cost, audit)``, and the agenda may pop items in that order: the first derivation popped for an item is its
lightest one.

Equal costs are decided by the audits' ASCII order.  That carries over to longer audits, because of two derivations of
one cost for as many rows none is a part of the other at its beginning: the longer one would have more Inserts, which
are not free.

1. Rows are counted once for each turn, role and text.  The first turn of a role and text marks all later ones as
   duplicates.  Rows then go, without their texts, to range partitions by conversation and turn, so a long conversation
   spreads over many tasks.
2. A task runs the agenda over ``SEGMENT`` rows at a time.  What all lightest derivations begin with is settled and put
   aside.  A conversation that began in an earlier partition is worked out for each state it may be entered in; one that
   may go on in the next partition gives the lightest derivation to each state.
3. A conversation's stretches, one for each partition at most, are chained.
4. Texts go to their conversation's audit and are hashed in order, row by row.  A SHA-256 sum is sequential: only this
   step sees a conversation in one task, as a stream.

Order of rows: turn (nulls first), then role, then the text's SHA-256, for rows of one turn.  Equal rows count as often
as they occur.  Rows with a null ``conv_id`` are one conversation.  A null role or text is one space, as is a null in the
key that damage is drawn from.  An empty role has no initial, and no place in the grammar.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import os.path
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.batches import map_columns
from ebbline.session import settle

SEGMENT = 64  # rows of an agenda
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs

WHITE = r"[\x20\x09-\x0D]"
START, SYSTEM, USER, ASSISTANT = range(4)
#: What may follow, by state: the state after a system, user or assistant turn.
NEXT = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
GOALS = (START, ASSISTANT)
STATES = tuple(NEXT)
LEGAL = ("su", "ua", "au")
NAMES = {"u": "user", "a": "assistant"}
FORCED = "E"  # the letter of a required Delete until the end; it sorts as D does among K, R and I

Weight = tuple[int, str]  # cost and audit


# ---- the agenda --------------------------------------------------------------


def lightest(rows: list[tuple[str, int, bool]], axioms: dict[int, Weight], goals: Iterable[int] | None) -> dict[int, Weight]:
    """The lightest derivations that use up all ``rows``, from weighted start states.

    A row is its role's initial, whether it must be deleted, and whether it is truncated.  With ``goals``, the agenda
    ends with the first of these states that is final; without, it yields every state.
    """
    n, done, out = len(rows), set(), {}
    agenda = [(cost, audit, 0, q) for q, (cost, audit) in axioms.items()]
    heapq.heapify(agenda)
    while agenda:
        cost, audit, i, q = heapq.heappop(agenda)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == n:
            if goals is None or q in goals:
                out[q] = (cost, audit)
                if goals is not None or len(out) == len(STATES):
                    break
        else:
            initial, forced, truncated = rows[i]
            if forced:
                heapq.heappush(agenda, (cost + DELETE, audit + FORCED, i + 1, q))
            else:
                left = cost + TRUNCATED * truncated
                heapq.heappush(agenda, (cost + DELETE, audit + "D", i + 1, q))
                if initial in NEXT[q]:
                    heapq.heappush(agenda, (left, audit + "K", i + 1, NEXT[q][initial]))
                for to in NAMES:
                    if to in NEXT[q]:
                        heapq.heappush(agenda, (left + REROLE, audit + "R", i + 1, NEXT[q][to]))
        for to in NAMES:
            if to in NEXT[q] and (i, NEXT[q][to]) not in done:
                heapq.heappush(agenda, (cost + INSERT, audit + "I", i, NEXT[q][to]))
    return out


class Chain:
    """Lightest derivations from one start state, segment after segment.  ``settled`` is what all of them begin with."""

    def __init__(self, state: int):
        self.settled: list[str] = []
        self.items: dict[int, Weight] = {state: (0, "")}

    def _settle(self) -> None:
        """Put aside the common beginning.  What is left of the audits decides ties as the whole ones would."""
        common = len(os.path.commonprefix([audit for _, audit in self.items.values()]))
        self.settled.append(next(iter(self.items.values()))[1][:common])
        self.items = {q: (cost, audit[common:]) for q, (cost, audit) in self.items.items()}

    def read(self, rows: list[tuple], goals: Iterable[int] | None = None) -> None:
        self.items = lightest(rows, self.items, goals)
        self._settle()

    def follow(self, stretch: dict[int, dict[int, Weight]]) -> None:
        """Go on with a whole stretch: its lightest derivations by the states before and after it."""
        after: dict[int, Weight] = {}
        for p, (cost, audit) in self.items.items():
            for q, (more, letters) in stretch[p].items():
                weight = cost + more, audit + letters
                after[q] = min(after.get(q, weight), weight)
        self.items = after
        self._settle()

    def ends(self) -> dict[int, Weight]:
        head = "".join(self.settled)
        return {q: (cost, head + audit) for q, (cost, audit) in self.items.items()}


# ---- rows --------------------------------------------------------------------


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``conv, turn, role, text, copies`` after a damage that the key decides: rows are dropped (no copies), emptied,
    stripped of their marks, doubled or given to the user."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def undamaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The rows as they are, in the shape of ``damaged``."""
    role, text = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    return rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), role, text, F.lit(1).cast("long").alias("copies"))


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")


def _outlines(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts, in order: ``conv, turn, role, digest, copies, blank, truncated, seen``."""
    last = F.regexp_extract("text", rf"(?s)([^\x20\x09-\x0D]){WHITE}*\z", 1)
    outlines = rows.select(
        "conv", "turn", "role", _digest(), "copies", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated")
    )
    key = ["conv", "turn", "role", "digest", "blank", "truncated"]
    outlines = settle(outlines.groupBy(key).agg(F.sum("copies").alias("copies")))
    # the first turn of a role and text, as a row of that turn: no busy key in the join
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    firsts = outlines.where("copies > 0").groupBy("conv", "role", "digest").agg(first)
    firsts = firsts.select(F.struct("conv", "first.turn", "role", "digest").alias("new"))
    outlines = outlines.withColumn("at", F.struct("conv", "turn", "role", "digest"))
    outlines = outlines.join(firsts, F.col("at").eqNullSafe(F.col("new")), "left").withColumn("seen", F.col("new").isNull())
    order = ["conv", "turn", "role", "digest"]
    return outlines.select(*order, "copies", "blank", "truncated", "seen").repartitionByRange(*order).sortWithinPartitions(*order)


class Stretch:
    """What one partition has of a conversation."""

    def __init__(self, row: tuple, opens: bool):
        self.conv, self.first = row[0], row[1:4]
        self.chains = {q: Chain(q) for q in ((START,) if opens else STATES)}
        self.held: list[tuple] = []
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.initials: list[str | None] = [None, None]  # of the first and the last row
        self.least = self.most = None

    def add(self, turn, role, copies, blank, truncated, seen) -> None:
        initial = role[:1]
        if copies and turn is not None and turn != self.most:
            self.least, self.most = turn if self.least is None else self.least, turn
            self.turns += 1
        for copy in range(copies):
            duplicate = not blank and (seen or copy > 0)
            cut = truncated and not blank and not duplicate
            self.blank += blank
            self.duplicate += duplicate
            self.truncated += cut
            if self.rows:
                self.illegal += self.initials[1] + initial not in LEGAL
            else:
                self.initials[0] = initial
            self.initials[1] = initial
            self.rows += 1
            if len(self.held) == SEGMENT:
                for chain in self.chains.values():
                    chain.read(self.held)
                self.held = []
            self.held.append((initial, blank or duplicate, cut))

    def row(self, closes: bool) -> dict:
        for chain in self.chains.values():
            chain.read(self.held, GOALS if closes else None)
        ends = [
            {"p": p, "q": q, "cost": cost, "audit": audit}
            for p, chain in self.chains.items()
            for q, (cost, audit) in chain.ends().items()
        ]
        counts = {n: getattr(self, n) for n in ("rows", "blank", "duplicate", "truncated", "illegal", "turns", "least", "most")}
        own = {"conv": self.conv, **dict(zip(("turn", "role", "digest"), self.first, strict=True)), "ends": ends}
        return own | counts | dict(zip(("initial", "final"), self.initials, strict=True))


STRETCH = (
    "conv {conv}, turn {turn}, role string, digest binary, ends array<struct<p:int,q:int,cost:long,audit:string>>, "
    "rows long, blank long, duplicate long, truncated long, illegal long, turns long, least {turn}, most {turn}, "
    "initial string, final string"
)


def _stretches(batches) -> Iterator[dict]:
    """A partition's outlines, in order, to stretches.  The first may have begun before, the last may go on."""
    now, opens = None, False
    for batch in batches:
        out: list[dict] = []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or row[0] != now.conv:
                if now is not None:
                    out.append(now.row(closes=True))
                now, opens = Stretch(row, opens), True
            now.add(row[1], row[2], *row[4:])
        if out:
            yield {n: [r[n] for r in out] for n in out[0]}
    if now is not None:
        yield {n: [v] for n, v in now.row(closes=False).items()}


class Whole:
    """A conversation, stretch after stretch."""

    def __init__(self, conv):
        self.conv, self.chain = conv, Chain(START)
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.final = None

    def add(self, s: dict) -> None:
        for n in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, n, getattr(self, n) + s[n])
        if s["rows"]:
            self.illegal += self.final is not None and self.final + s["initial"] not in LEGAL
            self.final = s["final"]
        if s["least"] is not None:
            self.turns += s["turns"] - (s["least"] == self.most)  # a turn may be cut
            self.least, self.most = s["least"] if self.least is None else self.least, s["most"]
        by_state: dict[int, dict[int, Weight]] = {}
        for e in s["ends"]:
            by_state.setdefault(e["p"], {})[e["q"]] = e["cost"], e["audit"]
        self.chain.follow(by_state)

    def row(self) -> dict:
        cost, audit = min(w for q, w in self.chain.ends().items() if q in GOALS)
        out = {n: getattr(self, n) for n in ("conv", "blank", "duplicate", "truncated", "illegal")}
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return out | {"gaps": gaps, "cost": cost, "edits": audit}


def _chained(batches) -> Iterator[dict]:
    now = None
    for batch in batches:
        out: list[dict] = []
        for s in batch.to_pylist():
            if now is None or s["conv"] != now.conv:
                if now is not None:
                    out.append(now.row())
                now = Whole(s["conv"])
            now.add(s)
        if out:
            yield {n: [r[n] for r in out] for n in out[0]}
    if now is not None:
        yield {n: [v] for n, v in now.row().items()}


FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def diagnose(rows: DataFrame) -> DataFrame:
    """``conv``, the counts, ``cost`` and ``edits`` of every conversation of ``damaged`` rows.

    ``edits`` is the audit with a letter of its own for required Deletes.
    """
    types = {c: rows.schema[c].dataType.simpleString() for c in ("conv", "turn")}
    found = map_columns(_outlines(rows), _stretches, STRETCH.format(**types))
    found = found.repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest")
    schema = f"conv {types['conv']}, " + ", ".join(f"{n} long" for n in FACTS) + ", edits string"
    return map_columns(found, _chained, schema)


# ---- repaired conversations --------------------------------------------------


class Writer:
    """Applies a conversation's edits to its rows, in order.  Lines are ``role, text, edit``."""

    def __init__(self, edits: str):
        self.edits, self.at, self.state = edits, 0, START

    def _turned(self) -> str:
        """The role that the grammar wants here, and a step to the state after it."""
        initial = next(i for i in NAMES if i in NEXT[self.state])
        self.state = NEXT[self.state][initial]
        return NAMES[initial]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            yield self._turned(), "", "I"

    def add(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        letter = self.edits[self.at]
        self.at += 1
        if letter == "K":
            self.state = NEXT[self.state][role[:1]]
            yield role, text, letter
        elif letter == "R":
            yield self._turned(), text, letter


def _lines_of(batches) -> Iterator[dict]:
    """A row of facts for every conversation, then its repaired lines."""
    names = ["facts", "conv", "place", "role", "text", "edit"]
    now, conv, place = None, None, 0

    def line(what):
        nonlocal place
        place += 1
        return dict(zip(names, (None, conv, place - 1, *what), strict=True))

    for batch in batches:
        out: list[dict] = []
        for facts, own, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if facts is not None:
                if now is not None:
                    out += map(line, now.inserted())
                now, conv, place = Writer(facts["edits"]), own, 0
                out.append(dict.fromkeys(names) | {"facts": facts, "conv": own})
            for _ in range(copies):
                out += map(line, now.add(role, text))
        if out:
            yield {n: [r[n] for r in out] for n in names}
    if now is not None and (out := [line(what) for what in now.inserted()]):
        yield {n: [r[n] for r in out] for n in names}


def _lines(rows: DataFrame) -> DataFrame:
    found = diagnose(rows).select(
        F.struct(*FACTS, "edits").alias("facts"), "conv", F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"),
        F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit(None).cast("binary").alias("digest"),
    )
    kind = found.schema["facts"].dataType
    nothing = F.lit(None).cast(kind).alias("facts")
    texts = rows.where("copies > 0").select(nothing, "conv", "role", "text", "copies", "turn", _digest())
    order = ["conv", F.col("facts").isNull(), "turn", "role", "digest"]
    both = found.unionByName(texts).repartition("conv").sortWithinPartitions(*order)
    schema = f"facts {kind.simpleString()}, conv {rows.schema['conv'].dataType.simpleString()}, "
    schema += "place long, role string, text string, edit string"
    return map_columns(both.select("facts", "conv", "role", "text", "copies"), _lines_of, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """``conv, place, role, text, edit``: the repaired conversations, turn by turn."""
    return _lines(rows).where("place is not null").drop("facts")


def _digests_of(batches) -> Iterator[dict]:
    now, total, lines = None, hashlib.sha256(), 0

    def row():
        audit = now["edits"].replace(FORCED, "D")
        return {n: now[n] for n in ("conv", *FACTS)} | {"audit": audit, "repaired_sha256": total.hexdigest()}

    for batch in batches:
        out: list[dict] = []
        facts, conv, _, role, text, _ = (c.to_pylist() for c in batch.columns)
        for i, own in enumerate(facts):
            if own is not None:
                if now is not None:
                    out.append(row())
                now, total, lines = {"conv": conv[i], **own}, hashlib.sha256(), 0
            else:
                total.update(f"{chr(10) if lines else ''}{role[i]}:{text[i]}".encode())
                lines += 1
        if out:
            yield {n: [r[n] for r in out] for n in out[0]}
    if now is not None:
        yield {n: [v] for n, v in row().items()}


def digests(rows: DataFrame) -> DataFrame:
    """``conv``, the counts, ``cost``, ``audit`` and the sum of the repaired text of every conversation.

    ``rows`` have the shape of ``damaged``; a conversation of which no copy is left gives zeros and the empty sum.
    """
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in FACTS)
    # the lines of a conversation come one after the other, so they are summed where they are written
    return map_columns(_lines(rows), _digests_of, schema + ", audit string, repaired_sha256 string")
