"""Event-time windows: tumbling counts for events and words, sliding counts.

``window_counts`` and ``word_window_counts`` hold for static and streaming input
alike; on a stream call :func:`ebbline.streaming.jobs.watermarked` first.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.text import explode_words

TIMES = ("payload", "arrival")
TS_POLICIES = ("min", "max", "first_arrival")


def event_clock(event_time: str = "payload", arrival: str = "arrival", ts: str = "event_ts") -> Column:
    """The time windows are cut by: the event's own seconds, or the broker's time stamp."""
    if event_time not in TIMES:
        raise ValueError(f"event_time must be one of {TIMES}, not {event_time!r}")
    return F.timestamp_seconds(F.col(ts)) if event_time == "payload" else F.col(arrival)


def window_counts(
    events: DataFrame,
    keys: list[str],
    length: str = "5 seconds",
    time: str = "event_time",
    ts_policy: str = "min",
    arrival_order: str = "arrival",
    clocked: bool = False,
) -> DataFrame:
    """Events per key and tumbling window; ``clocked`` keeps the watermarked window as ``_w``.

    The sum over a window carries one event time.  Where events of a key arrive
    in order, its first arrival is also its earliest; ``min`` needs no arrival
    order and is the default.
    """
    if ts_policy not in TS_POLICIES:
        raise ValueError(f"ts_policy must be one of {TS_POLICIES}, not {ts_policy!r}")
    stamp = {
        "min": F.min("event_ts"),
        "max": F.max("event_ts"),
        "first_arrival": F.min_by("event_ts", F.struct(arrival_order, "event_ts")),  # ties: the earlier event
    }[ts_policy]
    counted = events.groupBy(F.window(time, length).alias("_w"), *keys).agg(
        F.sum("event_count").alias("n"), stamp.alias("event_ts")
    )
    return _flat(counted, [*keys, "_w"] if clocked else keys, ["n", "event_ts"])


def word_window_counts(
    lines: DataFrame,
    length: str = "5 seconds",
    time: str = "arrival",
    tokeniser: str = "words",
    value: str = "value",
    clocked: bool = False,
) -> DataFrame:
    """Words per tumbling window; ``clocked`` keeps the watermarked window as ``_w``."""
    words = explode_words(lines, tokeniser, value, [time])
    counted = words.groupBy(F.window(time, length).alias("_w"), "word").agg(F.count("*").alias("n"))
    return _flat(counted, ["word", "_w"] if clocked else ["word"], ["n"])


def _flat(counted: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    return counted.select(
        *keys,
        F.unix_seconds("_w.start").alias("window_start"),
        F.unix_seconds("_w.end").alias("window_end"),
        *values,
    )


def word_counts(lines: DataFrame, tokeniser: str = "words", value: str = "value") -> DataFrame:
    """Words over the whole table."""
    words = explode_words(lines, tokeniser, value)
    return words.groupBy("word").agg(F.count("*").alias("n"))


def sliding_counts(
    events: DataFrame, keys: list[str], length: int = 3600, slide: int = 300, ts: str = "event_ts"
) -> DataFrame:
    """Events per key and sliding window, times in seconds.

    Events are first counted in panes that every window is a union of; only the
    pane counts are copied to the ``length / slide`` windows around them.
    """
    pane = gcd(length, slide)
    panes = events.groupBy(*keys, (F.floor(F.col(ts) / pane) * pane).alias("_pane")).agg(
        F.sum("event_count").alias("_n")
    )
    newest = F.floor(F.col("_pane") / slide) * slide
    oldest = (F.floor((F.col("_pane") + pane - length - 1) / slide) + 1) * slide
    copies = panes.select(
        *keys, "_n", F.explode(F.sequence(oldest, newest, F.lit(slide).cast("bigint"))).alias("window_start")
    )
    return copies.groupBy(*keys, "window_start").agg(F.sum("_n").alias("n")).select(
        *keys, "window_start", (F.col("window_start") + length).alias("window_end"), "n"
    )
