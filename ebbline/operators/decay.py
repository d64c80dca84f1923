"""Decayed counters over static tables: final values, and one row per window close.

``value(T) = sum of v * exp(-(T - t) / d)``.  Epoch seconds would overflow
``exp(t / d)``, so time is cut into slices of at most ``SPAN`` decay intervals
and each slice is summed relative to its own start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.decay import add, counter, fade
from ebbline.operators.prefix import prefix
from ebbline.operators.running import DAY, keyed, sliced, time_slice

# exp(300) leaves a double room for 1e178 events, exp(-300) is far below its precision
SPAN = 300


def _slice_seconds(intervals: list[int]) -> int:
    return max(1, min(SPAN * min(intervals), DAY))


def _grown(amount: Column, elapsed: Column, d: int) -> Column:
    return amount * F.exp(elapsed / F.lit(float(d)))


def _checked(intervals: list[int]) -> list[int]:
    if not intervals or min(intervals) <= 0 or len(set(intervals)) != len(intervals):
        raise ValueError("decay intervals must be distinct positive seconds")
    return list(intervals)


def counter_map(intervals: list[int], last_update: Column, values: dict[int, Column]) -> Column:
    pairs = [x for d in intervals for x in (F.lit(d).cast("bigint"), counter(d, last_update, values[d]))]
    return F.create_map(*pairs)


def explode_counters(counters: DataFrame, counts: str = "counts") -> DataFrame:
    """Long form: one row per counter."""
    kept = [c for c in counters.columns if c != counts]
    return counters.select(*kept, F.explode(F.map_values(counts)).alias("_c")).select(
        *kept, "_c.decay_interval", "_c.last_update", "_c.value"
    )


def slice_sums(
    rows: DataFrame,
    keys: list[str],
    intervals: list[int],
    ts: str = "event_ts",
    amount: str = "n",
    time: str | None = None,
) -> DataFrame:
    """Per key and slice: the last event time and, per interval, the sum grown from the slice's start.

    Sums of parts add up, so this also runs on a stream in update mode; ``time``
    then names its watermarked column, which must be the time stamp of ``ts``.
    """
    intervals = _checked(intervals)
    moment = F.timestamp_seconds(ts) if time is None else F.col(time)
    start = F.unix_seconds("_w.start")
    grown = {d: _grown(F.col(amount), F.col(ts) - start, d) for d in intervals}
    return (
        rows.withColumn("_w", F.window(moment, f"{_slice_seconds(intervals)} seconds"))
        .groupBy("_w", *keys)
        .agg(F.max(ts).alias("last_ts"), *[F.sum(grown[d]).alias(f"sum_{d}") for d in intervals])
        .select(*keys, start.alias("slice"), "last_ts", *[f"sum_{d}" for d in intervals])
    )


def merge_slices(sums: DataFrame, keys: list[str], intervals: list[int]) -> DataFrame:
    """Slice sums to counters, per key, in ``counts`` (a map by interval).

    A counter starts as value 0 at second 0.
    """
    latest = F.greatest(F.max("last_ts").over(Window.partitionBy(*keys)), F.lit(0).cast("bigint"))
    faded = {d: F.col(f"sum_{d}") * fade(F.col("_t") - F.col("slice"), d) for d in intervals}
    merged = (
        sums.withColumn("_t", latest)
        .groupBy(*keys)
        .agg(F.max("_t").alias("_t"), *[F.sum(faded[d]).alias(f"_v{d}") for d in intervals])
    )
    return merged.select(
        *keys, counter_map(intervals, F.col("_t"), {d: F.col(f"_v{d}") for d in intervals}).alias("counts")
    )


def decay_final(
    rows: DataFrame, keys: list[str], intervals: list[int], ts: str = "event_ts", amount: str = "n"
) -> DataFrame:
    """Counters after all rows, per key, in ``counts``.

    Rows are summed per key and slice before they meet, so a hot key reaches its
    task as one row per slice.
    """
    return merge_slices(slice_sums(rows, keys, intervals, ts, amount), keys, intervals)


def decay_as_of(
    rows: DataFrame, keys: list[str], intervals: list[int], as_of: int, ts: str = "event_ts", amount: str = "n"
) -> DataFrame:
    """Counters faded to one common time.  With the time given this is a plain sum: one shuffle."""
    intervals = _checked(intervals)
    age = F.lit(as_of).cast("bigint") - F.col(ts)
    summed = rows.where(F.col(ts) <= as_of).groupBy(*keys).agg(
        *[F.sum(F.col(amount) * fade(age, d)).alias(f"_v{d}") for d in intervals]
    )
    return summed.select(
        *keys, counter_map(intervals, F.lit(as_of), {d: F.col(f"_v{d}") for d in intervals}).alias("counts")
    )


def decay_running(
    windows: DataFrame,
    keys: list[str],
    intervals: list[int],
    order: str = "window_start",
    ts: str = "event_ts",
    amount: str = "n",
    in_order: bool = True,
) -> DataFrame:
    """Counters at every window close, per key, in ``counts``.

    ``order`` is the second in which windows close, one row per key each.  With
    ``in_order=False`` event times may go back along it: a late amount is faded
    to the counter's last update, as on the stream.
    """
    intervals = _checked(intervals)
    size = _slice_seconds(intervals)
    if in_order:
        rows = sliced(windows, order, size, "_arrived").withColumn("_clock", F.col(ts))
    else:
        rows = sliced(prefix(windows, keys, [order], {"_clock": ("max", ts)}), order, size, "_arrived")
    rows = sliced(rows.withColumn("_clock", F.greatest("_clock", F.lit(0).cast("bigint"))), "_clock", size)
    slices = ["_slice", "_arrived"]
    keys, rows = ["_key"], keyed(rows, keys)
    grown = {d: _grown(F.col(amount), F.col(ts) - F.col("_slice"), d) for d in intervals}
    inside = Window.partitionBy(*keys, *slices).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *[F.sum(grown[d]).over(inside).alias(f"_v{d}") for d in intervals])
    carried = _carried(
        rows.groupBy(*keys, *slices).agg(*[F.sum(grown[d]).alias(f"_all{d}") for d in intervals]),
        keys,
        slices,
        intervals,
        size,
    )
    since = F.col("_clock") - F.col("_slice")
    values = {d: (F.col(f"_v{d}") + F.col(f"_pre{d}")) * fade(since, d) for d in intervals}
    kept = [c for c in windows.columns if c not in (ts, amount)]
    return local.join(carried, [*keys, *slices]).select(
        *kept, counter_map(intervals, F.col("_clock"), values).alias("counts")
    )


def _carried(
    totals: DataFrame, keys: list[str], slices: list[str], intervals: list[int], size: int
) -> DataFrame:
    """What earlier slices are still worth at each slice's start.

    Slices are grouped into blocks of up to SPAN intervals; the own block's
    earlier slices and the block before it are summed, anything older has faded
    below the precision of a double.
    """
    start = F.col("_slice")
    columns = []
    for d in intervals:
        length = max(1, SPAN * d // size) * size
        block, own, previous = (F.col(f"_{c}{d}") for c in ("b", "own", "prev"))
        within = Window.partitionBy(*keys, f"_b{d}").orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
        before = Window.partitionBy(*keys).orderBy(f"_b{d}").rangeBetween(-length, -length)
        totals = totals.withColumn(f"_b{d}", time_slice(start, length)).withColumn(
            f"_x{d}", _grown(F.col(f"_all{d}"), start - block, d)
        )
        totals = totals.withColumn(f"_own{d}", F.sum(f"_x{d}").over(within))
        totals = totals.withColumn(f"_prev{d}", F.sum(f"_x{d}").over(before))
        columns.append(
            (
                F.coalesce(own, F.lit(0.0)) * fade(start - block, d)
                + F.coalesce(previous, F.lit(0.0)) * fade(start - block + length, d)
            ).alias(f"_pre{d}")
        )
    return totals.select(*keys, *slices, *columns)


def merge_counters(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Add two long-form counter tables, e.g. a backfill and a live one."""
    packed = [
        keyed(side, keys).select("_key", "decay_interval", F.struct("decay_interval", "last_update", "value").alias(name))
        for side, name in ((left, "_l"), (right, "_r"))
    ]
    merged = packed[0].join(packed[1], ["_key", "decay_interval"], "full")
    return merged.select("_key.*", add(F.col("_l"), F.col("_r")).alias("_c")).select(
        *keys, "_c.decay_interval", "_c.last_update", "_c.value"
    )
