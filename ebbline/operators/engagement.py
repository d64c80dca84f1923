"""Features computed from raw engagement: periods, ratios, unique users, missing reactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.operators.running import DAY, time_slice


def in_period(events: DataFrame, as_of: int, seconds: int, ts: str = "event_ts") -> DataFrame:
    """Events of the last ``seconds`` before ``as_of``."""
    return events.where((F.col(ts) > as_of - seconds) & (F.col(ts) <= as_of))


def period_counts(events: DataFrame, keys: list[str], as_of: int, periods: dict[str, int]) -> DataFrame:
    """Event totals per key over several periods, in one pass over the longest."""
    recent = in_period(events, as_of, max(periods.values()))
    return recent.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("event_ts") > as_of - s, F.col("event_count"))), F.lit(0)).alias(name)
            for name, s in periods.items()
        ]
    )


def amount_sums(events: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """Sum and count of a measured amount, e.g. time spent."""
    return events.groupBy(*keys).agg(F.sum(amount).alias("total"), F.sum("event_count").alias("n"))


def share(part: str, whole: str) -> Column:
    return F.try_divide(F.sum(_of(part)), F.sum(_of(whole)))


def _of(name: str) -> Column:
    return F.when(F.col("event_name") == name, F.col("event_count")).otherwise(0)


def ratios(events: DataFrame, keys: list[str], part: str, whole: str) -> DataFrame:
    """E.g. likes per view; null where there was no view."""
    return events.where(F.col("event_name").isin(part, whole)).groupBy(*keys).agg(
        F.sum(_of(part)).alias("part"), F.sum(_of(whole)).alias("whole"), share(part, whole).alias("ratio")
    )


def unique_users(events: DataFrame, keys: list[str], approximate: bool = False) -> DataFrame:
    """Distinct users per key.  Streams cannot count distinct exactly: use ``approximate`` there."""
    users = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    return events.groupBy(*keys).agg(users.alias("users"))


def user_bitmaps(
    events: DataFrame, keys: list[str], number: Column, length: str = "1 day", time: str = "event_time"
) -> DataFrame:
    """The users of each key and window as bitmaps, from which the distinct users of any period follow exactly.

    ``number`` is the user's whole number; users without one are left out.  Numbers are cut into buckets of 32,768, a
    row each, so a bitmap has 4 kB whatever the traffic, most of it zeros that compress away.  Bitmaps add up: this also
    runs on a stream in update mode, to be upserted by ``keys``, ``window_start`` and ``bucket``.
    """
    numbered = events.select(time, *keys, number.alias("_user"), "event_ts").where(F.col("_user").isNotNull())
    bucket = F.bitmap_bucket_number("_user").alias("bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("_user")).alias("bits")
    days = numbered.groupBy(F.window(time, length).alias("_w"), *keys, bucket).agg(bits, F.max("event_ts").alias("last_ts"))
    return days.select(*keys, F.unix_seconds("_w.start").alias("window_start"), "bucket", "bits", "last_ts")


def _bits_in_period(bitmaps: DataFrame, keys: list[str], start: int, end: int) -> DataFrame:
    """One bitmap for each key and bucket, over the windows that begin in ``[start, end)``."""
    period = bitmaps.where((F.col("window_start") >= start) & (F.col("window_start") < end))
    return period.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def users_of_bitmaps(bitmaps: DataFrame, keys: list[str], start: int, end: int) -> DataFrame:
    """Distinct users per key over the windows that begin in ``[start, end)``."""
    merged = _bits_in_period(bitmaps, keys, start, end)
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("users"))


def users_of_both(bitmaps: DataFrame, keys: list[str], first: str, second: str, start: int, end: int) -> DataFrame:
    """Distinct users per key who did both, e.g. viewed and liked, each at any time of the period."""
    merged = _bits_in_period(bitmaps.where(F.col("event_name").isin(first, second)), [*keys, "event_name"], start, end)
    both = merged.groupBy(*keys, "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("_n"))
    both = both.withColumn("_users", F.when(F.col("_n") == 2, F.bitmap_count("bits")).otherwise(0))
    return both.groupBy(*keys).agg(F.sum("_users").alias("users"))


def user_sketches(
    events: DataFrame, keys: list[str], length: str = "1 day", time: str = "event_time", precision: int = 12
) -> DataFrame:
    """The same with sketches of fixed size, for users of any type; merged with an error of about 1.04 / 2^(precision / 2)."""
    sketch = F.hll_sketch_agg("user_id", precision).alias("sketch")
    days = events.groupBy(F.window(time, length).alias("_w"), *keys).agg(sketch, F.max("event_ts").alias("last_ts"))
    return days.select(*keys, F.unix_seconds("_w.start").alias("window_start"), "sketch", "last_ts")


def users_of_sketches(sketches: DataFrame, keys: list[str], start: int, end: int) -> DataFrame:
    """Estimated users per key over the windows that begin in ``[start, end)``."""
    period = sketches.where((F.col("window_start") >= start) & (F.col("window_start") < end))
    return period.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"))


def reached_slices(second: Column, is_reaction: Column, within: int) -> Column:
    """The slices of a day or more that a row belongs to.

    A reaction early in a slice may also answer events late in the one before.
    """
    size = max(within, DAY)
    own = time_slice(second, size)
    return F.when(is_reaction & (second - own < within), F.array(own, own - size)).otherwise(F.array(own))


def without_reaction(
    events: DataFrame, keys: list[str], first: str, reaction: str, within: int, ts: str = "event_ts"
) -> DataFrame:
    """``first`` events (say views) with no ``reaction`` by the same key in the next ``within`` seconds.

    Rows: key, second, number of such events.  Events are summed per second and
    time is cut into slices; see :func:`reached_slices`.  A group then has at most
    two rows per second of a slice and of ``within``, whatever the key's traffic,
    and no pairs are formed.
    """
    per_second = (
        events.where(F.col("event_name").isin(first, reaction))
        .groupBy(*keys, F.col(ts).alias("second"), (F.col("event_name") == reaction).alias("_reaction"))
        .agg(F.sum("event_count").alias("n"))
    )
    slices = reached_slices(F.col("second"), F.col("_reaction"), within)
    placed = per_second.select("*", F.explode(slices).alias("_slice"))
    # on a tie the reaction comes first here, i.e. a reaction in the same second counts
    ahead = Window.partitionBy(*keys, "_slice").orderBy(F.col("second").desc(), F.col("_reaction").desc())
    next_reaction = F.min(F.when(F.col("_reaction"), F.col("second"))).over(
        ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.withColumn("_next", next_reaction)
        .where(~F.col("_reaction"))
        .where(F.col("_next").isNull() | (F.col("_next") - F.col("second") > within))
        .select(*keys, "second", "n")
    )
