"""Arithmetic of one exponentially decayed counter.

A counter is ``struct<decay_interval, last_update, value>`` with times in whole
seconds.  Adding two counters keeps the later time and fades the earlier value
forward to it, so the sum does not depend on the order of its terms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbline.schemas import COUNTER


def fade(elapsed: Column, interval: int | Column) -> Column:
    """Share of a value that is left after ``elapsed`` seconds."""
    return F.exp(-elapsed.cast("double") / interval)


def counter(interval: int | Column, last_update: Column, value: Column) -> Column:
    return F.struct(
        F.lit(interval).cast("bigint").alias("decay_interval"),
        last_update.cast("bigint").alias("last_update"),
        value.cast("double").alias("value"),
    )


def add(left: Column, right: Column) -> Column:
    """Sum of two counters; a missing one counts as nothing.

    Counters of different intervals cannot be added: the job stops.
    """
    latest = F.greatest(left["last_update"], right["last_update"])
    d = left["decay_interval"]
    faded = [c["value"] * fade(latest - c["last_update"], d) for c in (left, right)]
    mixed = F.raise_error(F.lit("cannot add counters with different decay intervals"))
    return (
        F.when(left.isNull(), right)
        .when(right.isNull(), left)
        .when(left["decay_interval"] == right["decay_interval"], counter(d, latest, faded[0] + faded[1]))
        .otherwise(mixed.cast(COUNTER))
    )


def value_at(c: Column, at: Column | int) -> Column:
    """The counter's value faded to a later time."""
    return c["value"] * fade(F.lit(at) - c["last_update"], c["decay_interval"])
