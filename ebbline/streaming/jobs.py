"""Streaming twins: each takes a streaming DataFrame and returns one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ebbline.operators.decay import counter_map, slice_sums
from ebbline.operators.engagement import reached_slices
from ebbline.operators.windows import event_clock, window_counts, word_counts, word_window_counts
from ebbline.streaming.processors import (
    CANDIDATES,
    BucketOfKeys,
    BucketTop,
    CountedTop,
    DecayedCounters,
    DecayedValues,
    GlobalTop,
    LifetimeTotal,
    LifetimeTotals,
    MissingReaction,
)

TTL_DAYS = 7
MODES = ("latest", "improvements")
BUCKETS = 512  # of keys; their number is fixed for the life of a checkpoint


def ttl_millis(days: float | None = TTL_DAYS) -> int | None:
    return None if days is None else int(days * 86_400_000)


def _time_mode(ttl_ms: int | None) -> str:
    """State expiry needs processing time; without it a bounded run can end by itself."""
    return "None" if ttl_ms is None else "ProcessingTime"


def _typed(rows: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)


def _types(rows: DataFrame, columns: list[str]) -> list[str]:
    return [rows.schema[c].dataType.simpleString() for c in columns]


def _bucket(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.hash(*columns), F.lit(buckets)).alias("_bucket")


def _in_buckets(
    windows: DataFrame,
    keys: list[str],
    processor: BucketOfKeys,
    schema: str,
    initial: DataFrame | None,
    kept: list[str],
    buckets: int,
) -> DataFrame:
    """``windows`` through a state of buckets of keys; ``initial`` has the keys and what is ``kept`` of them."""
    clock = [c for c in windows.columns if c == "_w"]
    placed = windows.select(_bucket(keys, buckets), *clock, *processor.columns)
    if initial is not None:
        ends = F.col("window_end").cast("bigint") if processor.ttl_s is not None else F.lit(None).cast("bigint")
        typed = [F.col(k).cast(t).alias(k) for k, t in zip(keys, processor.types)]
        entries = initial.select(*typed, ends.alias("_at"), *kept)
        entries = entries.groupBy(_bucket(keys, buckets)).agg(F.collect_list(F.struct(*keys, "_at", *kept)).alias("entries"))
        initial = entries.groupBy("_bucket")
    mode = "None" if processor.ttl_s is None else "EventTime"
    return placed.groupBy("_bucket").transformWithState(processor, schema, "Append", mode, initialState=initial)


def watermarked(events: DataFrame, delay: str = "0 seconds", event_time: str = "payload") -> DataFrame:
    """Add ``event_time`` and its watermark.  No delay: a row is late once its window has closed."""
    return events.withColumn("event_time", event_clock(event_time)).withWatermark("event_time", delay)


def word_windows(
    lines: DataFrame,
    length: str = "5 seconds",
    delay: str = "0 seconds",
    tokeniser: str = "words",
    clocked: bool = False,
) -> DataFrame:
    """Words per window, emitted when the window closes (append mode)."""
    return word_window_counts(lines.withWatermark("arrival", delay), length, tokeniser=tokeniser, clocked=clocked)


def word_totals(lines: DataFrame, tokeniser: str = "words") -> DataFrame:
    """Totals without windows: for update mode, one row per word that changed."""
    return word_counts(lines, tokeniser)


def lifetime_totals(
    windows: DataFrame,
    keys: list[str],
    ttl_ms: int | None = None,
    initial: DataFrame | None = None,
    event_ttl_s: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Count since the beginning at every window close.

    The state is kept in ``buckets`` of keys, which a batch reads and writes whole; only state that expires in
    processing time (``ttl_ms``) has a group for each key.

    ``initial`` are totals of a backfill (the keys and ``total``, one row each), which a new checkpoint begins with.
    ``event_ttl_s`` forgets a key so many seconds of event time after its last window's end; ``windows`` must then be
    clocked, and ``initial`` must have ``window_end`` too.
    """
    schema = f"{_typed(windows, keys)}, window_start bigint, window_end bigint, n bigint, total bigint"
    if ttl_ms is None or event_ttl_s is not None:
        totals = LifetimeTotals(keys, _types(windows, keys), event_ttl_s)
        return _in_buckets(windows, keys, totals, schema, initial, ["total"], buckets)
    return windows.groupBy(*keys).transformWithState(
        LifetimeTotal(keys, ttl_ms),
        schema,
        "Append",
        _time_mode(ttl_ms),
        initialState=None if initial is None else initial.select(*keys, "total").groupBy(*keys),
    )


def counter_state(counters: DataFrame, keys: list[str], intervals: list[int]) -> DataFrame:
    """Counters of a backfill (``counts``) as the state that a counter stream begins with.

    Its ``window_end``, if there is one, is kept.
    """
    ends = [c for c in ("window_end",) if c in counters.columns]
    c = {d: F.col("counts")[F.lit(d).cast("bigint")] for d in intervals}
    values = F.array(*[F.coalesce(c[d]["value"], F.lit(0.0)) for d in intervals])
    last = F.greatest(*[F.coalesce(c[d]["last_update"], F.lit(0)) for d in (*intervals, intervals[0])])
    return counters.select(*keys, *ends, last.alias("last_update"), values.alias("value"))


def decayed_counters(
    windows: DataFrame,
    keys: list[str],
    intervals: list[int],
    ttl_ms: int | None = None,
    initial: DataFrame | None = None,
    event_ttl_s: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """All counters of a key at every window close, in ``counts``.

    ``initial`` are counters of a backfill with the same intervals (the keys and ``counts``, one row each), such as
    :func:`ebbline.operators.decay.decay_final` gives; a new checkpoint begins with them.  ``event_ttl_s`` and
    ``buckets`` as in :func:`lifetime_totals`.
    """
    schema = f"{_typed(windows, keys)}, window_start bigint, window_end bigint, last_update bigint, value array<double>"
    if initial is not None:
        initial = counter_state(initial, keys, intervals)
    if ttl_ms is None or event_ttl_s is not None:
        counters = DecayedCounters(keys, _types(windows, keys), intervals, event_ttl_s)
        states = _in_buckets(windows, keys, counters, schema, initial, ["last_update", "value"], buckets)
    else:
        states = windows.groupBy(*keys).transformWithState(
            DecayedValues(keys, intervals, ttl_ms),
            schema,
            "Append",
            _time_mode(ttl_ms),
            initialState=None if initial is None else initial.groupBy(*keys),
        )
    values = {d: F.col("value")[i] for i, d in enumerate(intervals)}
    return states.select(
        *keys, "window_start", "window_end", counter_map(intervals, F.col("last_update"), values).alias("counts")
    )


def event_counters(
    events: DataFrame,
    key: str,
    intervals: list[int],
    length: str = "5 seconds",
    delay: str = "0 seconds",
    event_time: str = "payload",
    ttl_ms: int | None = None,
    initial: DataFrame | None = None,
    event_ttl_s: int | None = None,
) -> DataFrame:
    """Events to counters: ``feature_name`` (the event name), ``key``, ``counts``.

    ``initial`` has the same three columns, and ``window_end`` if keys expire in event time.
    """
    keys = ["event_name", key]
    windows = window_counts(watermarked(events, delay, event_time), keys, length, clocked=event_ttl_s is not None)
    if initial is not None:
        initial = initial.withColumnsRenamed({"feature_name": "event_name", "key": key})
    counters = decayed_counters(windows, keys, intervals, ttl_ms, initial, event_ttl_s)
    return counters.withColumnsRenamed({"event_name": "feature_name", key: "key"})


def counter_slices(events: DataFrame, key: str, intervals: list[int], delay: str = "1 day") -> DataFrame:
    """Counters without Python state, for update mode.

    Emits changed slice sums, to be upserted by ``feature_name``, ``key`` and
    ``slice``; :func:`ebbline.operators.decay.merge_slices` turns the stored sums
    into counters.  Every event counts at its own second, in whatever order they
    come; ``delay`` is how long a slice may still change.
    """
    sums = slice_sums(
        watermarked(events, delay), ["event_name", key], intervals, amount="event_count", time="event_time"
    )
    return sums.withColumnsRenamed({"event_name": "feature_name", key: "key"})


def top_lists(
    counters: DataFrame,
    name: str,
    feature: str,
    interval: int,
    k: int,
    buckets: int = 64,
    reserve: int | None = None,
    mode: str = "latest",
    ttl_ms: int | None = None,
) -> DataFrame:
    """The global list of the ``k`` best, emitted whenever it may have changed.

    ``buckets`` tasks each pass on what may matter, so the one global task sees a
    bounded list per bucket.  ``latest`` ranks each id by its latest score;
    ``improvements`` never learns of a score that fell.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    scored = counters.where(F.col("feature_name") == feature)
    c = F.col("counts")[F.lit(interval).cast("bigint")]
    scored = scored.select(
        F.pmod(F.hash("key"), F.lit(buckets)).alias("bucket"),
        F.col("key").alias("media_id"),
        c["value"].alias("score"),
        c["last_update"].alias("last_update"),
        "window_start",
    ).where(F.col("score").isNotNull())
    tops = scored.groupBy("bucket").transformWithState(
        BucketTop(k, 4 * k if reserve is None else reserve, mode, ttl_ms),
        f"bucket int, candidates {CANDIDATES}",
        "Append",
        _time_mode(ttl_ms),
    )
    return (
        tops.withColumn("name", F.lit(name))
        .groupBy("name")
        .transformWithState(
            GlobalTop(k, mode, ttl_ms), f"name string, updated bigint, candidates {CANDIDATES}", "Append", _time_mode(ttl_ms)
        )
    )


def counted_tops(
    windows: DataFrame,
    key: str,
    feature: str,
    interval: int,
    k: int,
    buckets: int = 64,
    reserve: int | None = None,
    ttl_ms: int | None = None,
) -> DataFrame:
    """Window totals to the ``k`` best counters of each bucket of ids, with a single state in Python.

    A bucket's task keeps the counters of its ids beside its top and puts the top out when it changed.  Upserted by
    ``bucket``, the rows are the whole list in parts: :func:`ebbline.operators.topk.merged` gives the list of all.
    """
    placed = windows.where(F.col("event_name") == feature).select(
        F.pmod(F.hash(key), F.lit(buckets)).alias("bucket"), F.col(key).alias("media_id"), "window_start", "event_ts", "n"
    )
    bucket_top = CountedTop(k, 4 * k if reserve is None else reserve, interval, ttl_ms)
    return placed.groupBy("bucket").transformWithState(
        bucket_top, f"bucket int, candidates {CANDIDATES}", "Append", _time_mode(ttl_ms)
    )


def without_reaction(
    events: DataFrame,
    keys: list[str],
    first: str,
    reaction: str,
    within: int,
    delay: str = "0 seconds",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Twin of the batch operator; rows come once the watermark has passed the deadline."""
    per_second = (
        watermarked(events.where(F.col("event_name").isin(first, reaction)), delay)
        .groupBy(F.window("event_time", "1 second").alias("_w"), *keys, "event_name")
        .agg(F.sum("event_count").alias("n"))
        .select("_w", F.unix_seconds("_w.start").alias("second"), *keys, "event_name", "n")
    )
    # a slice of a busy key may lie in a bucket of its own, so a backfill spreads
    slices = reached_slices(F.col("second"), F.col("event_name") == reaction, within)
    placed = per_second.select("*", F.explode(slices).alias("slice"))
    placed = placed.select("_w", _bucket([*keys, "slice"], buckets), "second", *keys, "event_name", "n")
    missing = MissingReaction(keys, _types(placed, keys), reaction, within)
    return placed.groupBy("_bucket").transformWithState(
        missing, f"{_typed(placed, keys)}, second bigint, n bigint", "Append", "EventTime"
    )


def without_reaction_joined(
    events: DataFrame, keys: list[str], first: str, reaction: str, within: int, delay: str = "0 seconds"
) -> DataFrame:
    """The same as :func:`without_reaction` by a stream-stream join, without Python.

    Both sides are counts per second.  Watermarks on both and the interval between them let the join forget a second
    once ``within`` has passed; first events that met nothing come out then.  Slices spread a busy key as above; null
    keys join nothing, so their first events come out too.
    """

    def per_second(name: str, side: str) -> DataFrame:
        # a condition on the clock too, never true, keeps this above the watermark: both sides go by all events' clock
        own = (F.col("event_name") == name) | (F.col("event_time") < F.timestamp_micros(F.lit(-(2**63))))
        counts = watermarked(events, delay).where(own).groupBy(F.window("event_time", "1 second").alias("_w"), *keys).agg(F.sum("event_count").alias("n"))
        counts = counts.select(F.window_time("_w").alias(f"_{side}"), F.unix_seconds("_w.start").alias("second"), *keys, "n")
        slices = reached_slices(F.col("second"), F.lit(side == "reaction"), within)
        return counts.select("*", F.explode(slices).alias("slice"))

    firsts = per_second(first, "first")
    reactions = per_second(reaction, "reaction").select(
        "_reaction", F.col("slice").alias("_slice"), *[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)]
    )
    met = F.col("slice") == F.col("_slice")
    for i, k in enumerate(keys):
        met &= F.col(k) == F.col(f"_r{i}")
    in_time = F.expr(f"_reaction >= _first and _reaction <= _first + interval {int(within)} seconds")
    joined = firsts.join(reactions, met & in_time, "left_outer")
    return joined.where(F.col("_reaction").isNull()).select(*keys, "second", "n")


def start(writer: DataStreamWriter, spark: SparkSession, partitions: int | None = None) -> StreamingQuery:
    """Start a query with ``partitions`` state partitions, by default one per core of the cluster.

    Their number is fixed for the life of a checkpoint, and adaptive execution does not merge them.
    """
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(partitions or spark.sparkContext.defaultParallelism))
    try:
        return writer.start()
    finally:
        spark.conf.set(setting, before)


def run_available(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    partitions: int | None = None,
) -> list[dict]:
    """Process what is there, batch by batch, then stop.  Returns the query's progress records."""
    writer = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
        .trigger(availableNow=True)
    )
    query = start(writer, stream.sparkSession, partitions)
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return list(query.recentProgress)


def append_table(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps every row, once per batch id."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")
