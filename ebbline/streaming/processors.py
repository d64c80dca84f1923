"""Keyed state for the streaming twins.

Input rows are window totals, i.e. already reduced by Spark: per key and
micro-batch at most one row per window that closed.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from heapq import nsmallest
from math import exp

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# executors get these classes with the query and need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CANDIDATES = "array<struct<media_id:string,score:double,last_update:bigint>>"


class LifetimeTotal(StatefulProcessor):
    """Adds each closed window to the key's total and emits the new total."""

    def __init__(self, keys: list[str], ttl_ms: int | None = None):
        self.keys, self.ttl_ms = keys, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total bigint", self.ttl_ms)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.total.update((initialState["total"],))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.total.get()
        total = stored[0] if stored else 0
        for row in sorted(rows, key=lambda r: r["window_start"]):
            total += row["n"]
            yield Row(
                **dict(zip(self.keys, key)),
                window_start=row["window_start"],
                window_end=row["window_end"],
                n=row["n"],
                total=total,
            )
        self.total.update((total,))

    def close(self) -> None:
        pass


class DecayedValues(StatefulProcessor):
    """Fades and adds each closed window to the key's counters and emits them all.

    The counters of a key share their last update; each interval has its value.
    """

    def __init__(self, keys: list[str], intervals: list[int], ttl_ms: int | None = None):
        self.keys, self.intervals, self.ttl_ms = keys, intervals, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("counters", "last_update bigint, value array<double>", self.ttl_ms)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.state.update((initialState["last_update"], list(initialState["value"])))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, values = self.state.get() or (0, [0.0] * len(self.intervals))
        for row in sorted(rows, key=lambda r: r["window_start"]):
            at, n = row["event_ts"], row["n"]
            now = max(last, at)
            values = [
                v * exp(-(now - last) / d) + n * exp(-(now - at) / d) for v, d in zip(values, self.intervals)
            ]
            last = now
            yield Row(
                **dict(zip(self.keys, key)),
                window_start=row["window_start"],
                window_end=row["window_end"],
                last_update=last,
                value=values,
            )
        self.state.update((last, list(values)))

    def close(self) -> None:
        pass


class Expiry:
    """Event-time expiry: what was written is forgotten ``ttl_s`` seconds after its last window's end.

    The one timer is moved at every write, and fires when the watermark passes it.  Rows are asked too, since a
    batch may bring the window that ends a life together with the watermark that would have ended it.
    """

    def __init__(self, ttl_s: int):
        self.ttl_s = ttl_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.written = handle.getValueState("written", "window_end bigint")

    def last(self) -> int | None:
        stored = self.written.get()
        return stored[0] if stored else None

    def over(self, last: int | None, window_end: int) -> bool:
        return last is not None and window_end - last >= self.ttl_s

    def moved(self, before: int | None, now: int) -> None:
        if before != now:
            if before is not None:
                self.handle.deleteTimer((before + self.ttl_s) * 1000)
            self.handle.registerTimer((now + self.ttl_s) * 1000)
            self.written.update((now,))


def _plain(entries: Iterable) -> list[tuple]:
    """Nested rows come as rows from the state and as dictionaries from the input."""
    return [tuple(e.values() if isinstance(e, dict) else e) for e in entries]


class BucketOfKeys(StatefulProcessor):
    """What is kept of every key of a bucket of keys, read and written at once.

    State in Python costs some calls for each group and batch, however little a group has, so a group is a bucket.
    An entry of the state is the key's columns, its last window's end, and what :meth:`fold` makes of its windows.
    With ``ttl_s`` a key is forgotten that many seconds of event time after its last window's end: the bucket has one
    timer, for the key that ends first.
    """

    kept = ""  # the types of what is kept

    def __init__(self, keys: list[str], types: list[str], amounts: list[str], ttl_s: int | None = None):
        self.keys, self.types, self.ttl_s = keys, types, ttl_s
        self.columns = [*keys, "window_start", "window_end", *amounts]
        self.expiry = None if ttl_s is None else Expiry(ttl_s)

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [f"k{i}:{t}" for i, t in enumerate(self.types)]
        self.state = handle.getValueState("keys", f"entries array<struct<{','.join([*fields, 'at:bigint', self.kept])}>>")
        if self.expiry:
            self.expiry.init(handle)

    def _load(self) -> dict[tuple, tuple]:
        stored, n = self.state.get(), len(self.keys)
        return {e[:n]: e[n:] for e in _plain(stored[0])} if stored else {}

    def _save(self, held: dict[tuple, tuple], before: int | None, timerValues) -> None:
        if self.expiry:
            now = timerValues.getCurrentWatermarkInMs() // 1000
            held = {k: e for k, e in held.items() if e[0] + self.ttl_s > now}
            if held:
                self.expiry.moved(before, min(e[0] for e in held.values()))
            elif before is not None:
                self.expiry.handle.deleteTimer((before + self.ttl_s) * 1000)
                self.expiry.written.clear()
        if held:
            self.state.update(([(*k, *e) for k, e in held.items()],))
        else:
            self.state.clear()

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        """One row for each bucket, with the entries of all its keys."""
        n = len(self.keys)
        held = {e[:n]: e[n:] for e in _plain(initialState["entries"])}
        self.state.update(([(*k, *e) for k, e in held.items()],))
        if self.expiry and held:
            self.expiry.moved(None, min(e[0] for e in held.values()))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held, n = self._load(), len(self.keys)
        before = self.expiry.last() if self.expiry else None
        ordered: list[tuple] = []
        for row in rows:
            if not ordered:
                at = [row.__fields__.index(c) for c in self.columns]
            ordered.append(tuple(row[i] for i in at))
        ordered.sort(key=lambda r: r[n])
        for row in ordered:
            own, end = row[:n], row[n + 1]
            entry = held.get(own)
            if entry and self.expiry and self.expiry.over(entry[0], end):
                entry = None
            kept, shown = self.fold(entry[1:] if entry else None, *row[n + 2 :])
            held[own] = (end, *kept)
            yield self.out(*row[: n + 2], *shown)
        self._save(held, before, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._load()
        self.expiry.written.clear()
        self._save(held, None, timerValues)
        return iter(())

    def close(self) -> None:
        pass


class LifetimeTotals(BucketOfKeys):
    """Adds each closed window to its key's total and emits the new total."""

    kept = "total:bigint"

    def __init__(self, keys: list[str], types: list[str], ttl_s: int | None = None):
        super().__init__(keys, types, ["n"], ttl_s)
        self.out = Row(*keys, "window_start", "window_end", "n", "total")

    def fold(self, kept: tuple | None, n: int) -> tuple[tuple, tuple]:
        total = (kept[0] if kept else 0) + n
        return (total,), (n, total)


class DecayedCounters(BucketOfKeys):
    """Fades and adds each closed window to its key's counters and emits them all, as :class:`DecayedValues`."""

    kept = "last_update:bigint,value:array<double>"

    def __init__(self, keys: list[str], types: list[str], intervals: list[int], ttl_s: int | None = None):
        super().__init__(keys, types, ["event_ts", "n"], ttl_s)
        self.intervals = intervals
        self.out = Row(*keys, "window_start", "window_end", "last_update", "value")

    def fold(self, kept: tuple | None, at: int, n: int) -> tuple[tuple, tuple]:
        last, values = kept or (0, [0.0] * len(self.intervals))
        now = max(last, at)
        values = [v * exp(-(now - last) / d) + n * exp(-(now - at) / d) for v, d in zip(values, self.intervals)]
        return (now, values), (now, values)


class BoundedTop:
    """The ``size`` best candidates; of equal scores the one put longest ago leaves first."""

    def __init__(self, size: int, candidates: Iterable[tuple] = ()):
        self.size, self.puts = size, 0
        self.by_id: dict[str, tuple] = {}
        self.sorted: list[tuple] = []
        for media_id, score, last_update in candidates:
            self.put(media_id, score, last_update)

    def put(self, media_id: str, score: float, last_update: int) -> bool:
        """Set an id's score, up or down.  True if it is in the list and new or risen."""
        old = self.by_id.pop(media_id, None)
        if old is not None:
            del self.sorted[bisect_left(self.sorted, old)]
        self.puts += 1
        entry = (score, self.puts, media_id, last_update)
        self.by_id[media_id] = entry
        insort(self.sorted, entry)
        if len(self.sorted) > self.size:
            del self.by_id[self.sorted.pop(0)[2]]
        return media_id in self.by_id and (old is None or score > old[0])

    def best(self) -> list[tuple]:
        """Best first; equal scores in the order they were put."""
        ordered = sorted(self.sorted, key=lambda e: (-e[0], e[1]))
        return [(media_id, score, at) for score, _, media_id, at in ordered]


def _by_score(candidates: Iterable[tuple]) -> list[tuple]:
    return sorted(candidates, key=lambda c: (-c[1], c[0]))


def _rows(candidates: Iterable[tuple]) -> list[Row]:
    """State takes plain tuples, output takes rows ..."""
    return [Row(media_id=m, score=s, last_update=t) for m, s, t in candidates]


def _tuples(candidates: Iterable[dict]) -> list[tuple]:
    """... and nested input comes as dictionaries."""
    return [(c["media_id"], c["score"], c["last_update"]) for c in candidates]


class BucketTop(StatefulProcessor):
    """Filter in front of the global list: each bucket of ids keeps its own top.

    ``latest`` keeps the latest score of every id, and beside them the ``reserve``
    best and a mark: the highest score among the others.  While enough of the
    reserve is above the mark, the others cannot matter; when scores fell so far
    that they might, reserve and mark are taken anew from all scores.  The
    bucket's top is forwarded whenever it changed.  ``improvements`` keeps only
    ``size`` candidates and forwards those that are new to them or rose, in the
    order they came.
    """

    def __init__(self, size: int, reserve: int, mode: str, ttl_ms: int | None = None):
        self.size, self.mode, self.ttl_ms = size, mode, ttl_ms
        self.kept = size if mode == "improvements" else max(size, reserve)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("top", f"top {CANDIDATES}, mark double", self.ttl_ms)
        if self.mode == "latest":
            self.all = handle.getMapState("all", "media_id string", "score double, last_update bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.state.get()
        before = [tuple(c) for c in stored[0]] if stored else []
        if self.mode == "improvements":
            changed = self._improved(before, rows)
        else:
            changed = self._latest(before, stored[1] if stored else None, rows)
        if changed:
            yield Row(bucket=key[0], candidates=_rows(changed))

    def _improved(self, before: list[tuple], rows: Iterator[Row]) -> list[tuple]:
        # the list is stored best first, a later put counts as newer
        top, improved = BoundedTop(self.kept, before), []
        for row in sorted(rows, key=lambda r: (r["window_start"], r["media_id"])):
            candidate = (row["media_id"], row["score"], row["last_update"])
            if top.put(*candidate):
                improved.append(candidate)
        self.state.update((top.best(), None))
        return improved

    def _latest(self, before: list[tuple], mark: float | None, rows: Iterator[Row]) -> list[tuple]:
        newest: dict[str, tuple] = {}
        for row in rows:
            at = newest.get(row["media_id"])
            if at is None or row["window_start"] >= at[0]:
                newest[row["media_id"]] = (row["window_start"], row["score"], row["last_update"])
        for media_id, (_, score, last_update) in newest.items():
            self.all.updateValue((media_id,), (score, last_update))
        merged = [c for c in before if c[0] not in newest]
        merged = _by_score(merged + [(m, score, at) for m, (_, score, at) in newest.items()])
        for _, score, _ in merged[self.kept :][:1]:
            mark = score if mark is None else max(mark, score)
        top = merged[: self.kept]
        if mark is not None and sum(c[1] > mark for c in top[: self.size]) < self.size:
            every = ((m, score, at) for (m,), (score, at) in self.all.iterator())
            best = nsmallest(self.kept + 1, every, key=lambda c: (-c[1], c[0]))
            top, mark = best[: self.kept], best[self.kept][1] if len(best) > self.kept else None
        self.state.update((top, mark))
        return top[: self.size] if top[: self.size] != before[: self.size] else []

    def close(self) -> None:
        pass


class CountedTop(BucketTop):
    """Counters and filter in one: rows are window totals, faded and added to the id's counter before it is ranked."""

    def __init__(self, size: int, reserve: int, interval: int, ttl_ms: int | None = None):
        super().__init__(size, reserve, "latest", ttl_ms)
        self.interval = interval

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        return super().handleInputRows(key, self._counted(rows), timerValues)

    def _counted(self, rows: Iterator[Row]) -> Iterator[dict]:
        values: dict[str, tuple[float, int]] = {}
        for row in sorted(rows, key=lambda r: r["window_start"]):
            media_id, at = row["media_id"], row["event_ts"]
            if media_id not in values:
                values[media_id] = self.all.getValue((media_id,)) or (0.0, 0)
            value, last = values[media_id]
            now = max(last, at)
            value = value * exp(-(now - last) / self.interval) + row["n"] * exp(-(now - at) / self.interval)
            values[media_id] = value, now
            yield {"media_id": media_id, "score": value, "last_update": now, "window_start": row["window_start"]}


class GlobalTop(StatefulProcessor):
    """One list from all buckets; emits it whenever a bucket reported."""

    def __init__(self, size: int, mode: str, ttl_ms: int | None = None):
        self.size, self.mode, self.ttl_ms = size, mode, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        if self.mode == "improvements":
            self.top = handle.getListState("top", "media_id string, score double, last_update bigint", self.ttl_ms)
        else:
            self.tops = handle.getMapState("tops", "bucket int", f"top {CANDIDATES}", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.mode == "improvements":
            top = BoundedTop(self.size, [tuple(c) for c in self.top.get()] if self.top.exists() else [])
            for row in sorted(rows, key=lambda r: r["bucket"]):
                for c in _tuples(row["candidates"]):
                    top.put(*c)
            best = top.best()
            self.top.put(best)
        else:
            for row in rows:
                self.tops.updateValue((row["bucket"],), (_tuples(row["candidates"]),))
            best = _by_score(tuple(c) for (tops,) in self.tops.values() for c in tops)[: self.size]
        yield Row(name=key[0], updated=max(c[2] for c in best), candidates=_rows(best))

    def close(self) -> None:
        pass


class MissingReaction(StatefulProcessor):
    """Emits first events that no reaction followed in time.

    Rows are counts per second, grouped by buckets of key and time slice.  First events whose deadline the watermark
    has passed are told at once; the others wait for it, and reactions are kept as long as a first event could still
    need them: a key's slice holds at most a slice's seconds of each, whatever the key's traffic.
    """

    def __init__(self, keys: list[str], types: list[str], reaction: str, within: int):
        self.keys, self.types, self.reaction, self.within = keys, types, reaction, within
        self.columns = [*keys, "second", "event_name", "n"]
        self.out = Row(*keys, "second", "n")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = ",".join([*(f"k{i}:{t}" for i, t in enumerate(self.types)), "second:bigint"])
        self.state = handle.getValueState(
            "open", f"waiting array<struct<{fields},n:bigint>>, reactions array<struct<{fields}>>, due bigint"
        )

    def _told(self, rows: Iterable[Row], now: int, fired: bool) -> Iterator[Row]:
        """Add ``rows``, emit what is decided at ``now`` and keep the rest."""
        first, answers, due = self.state.get() or ([], [], None)
        waiting: dict[tuple, dict[int, int]] = {}
        reactions: dict[tuple, set[int]] = {}
        for *own, second, amount in _plain(first):
            waiting.setdefault(tuple(own), {})[second] = amount
        for *own, second in _plain(answers):
            reactions.setdefault(tuple(own), set()).add(second)
        at = None
        for row in rows:
            at = at or [row.__fields__.index(c) for c in self.columns]
            *own, second, name, amount = (row[i] for i in at)
            if name == self.reaction:
                reactions.setdefault(tuple(own), set()).add(second)
            else:
                seconds = waiting.setdefault(tuple(own), {})
                seconds[second] = seconds.get(second, 0) + amount
        first, answers = [], []
        for own in {**waiting, **reactions}:
            seconds, after = waiting.get(own, {}), sorted(reactions.get(own, ()))
            for second in sorted(seconds):
                if second + self.within >= now:
                    first.append((*own, second, seconds[second]))
                    continue
                i = bisect_left(after, second)
                if i == len(after) or after[i] > second + self.within:
                    yield self.out(*own, second, seconds[second])
            oldest = min((s for s in seconds if s + self.within >= now), default=now)
            answers += [(*own, s) for s in after[bisect_left(after, min(oldest, now)) :]]
        self._save(first, answers, None if fired else due)

    def _save(self, first: list[tuple], answers: list[tuple], timer: int | None) -> None:
        due = None
        if first or answers:
            # a reaction at the deadline itself still counts; without first events, wake up to forget
            n = len(self.keys)
            due = min(r[n] for r in first) + self.within + 1 if first else max(r[n] for r in answers) + 1
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer * 1000)
        if due is None:
            self.state.clear()
            return
        if timer != due:
            self.handle.registerTimer(due * 1000)
        self.state.update((first, answers, due))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        return self._told(rows, timerValues.getCurrentWatermarkInMs() // 1000, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) // 1000
        return self._told((), now, True)

    def close(self) -> None:
        pass
