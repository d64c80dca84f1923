"""Running totals that hold when one key owns a third of the table.

A plain ``OVER (PARTITION BY key ORDER BY t)`` puts all rows of a key into one
task.  Here each key's time line is cut into slices: rows are totalled inside
their slice, the slices' totals are summed along the key (one row per slice, so
bounded by time span / slice length), and the two are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.operators.prefix import prefix

DAY = 86_400
_KINDS = {"sum": (F.sum, lambda a, b: a + b), "max": (F.max, F.greatest)}


def time_slice(at: Column | str, seconds: int) -> Column:
    """Start of the slice a second falls into."""
    at = F.col(at) if isinstance(at, str) else at
    return (F.floor(at / seconds) * seconds).cast("bigint")


def sliced(rows: DataFrame, at: str, seconds: int, name: str = "_slice") -> DataFrame:
    """Add the slice of a time that is never null, such as a window's start."""
    return rows.withColumn(name, F.coalesce(time_slice(at, seconds), F.lit(0).cast("bigint")))


def keyed(rows: DataFrame, keys: list[str], name: str = "_key") -> DataFrame:
    """Add the keys as one struct.

    A struct is never null and equal to one with nulls in the same places, so a null key is a key like others in joins
    too; and both sides of a self-join still read the same shuffle.
    """
    return rows.withColumn(name, F.struct(*keys))


def running(
    rows: DataFrame,
    keys: list[str],
    slices: list[str],
    order: list[str],
    totals: dict[str, tuple[str, str]],
    before: bool = False,
) -> DataFrame:
    """Add running totals ``{name: (sum | max, column)}`` per key along ``order``.

    ``slices`` must sort the rows of a key the way ``order`` does, only coarser.
    Slices must not be null.  ``before`` leaves the current row out; a key's
    first row then gets null.
    """
    columns, keys, rows = rows.columns, ["_key"], keyed(rows, keys)
    end = -1 if before else Window.currentRow
    inside = Window.partitionBy(*keys, *slices).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    earlier = Window.partitionBy(*keys).orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select("*", *[_KINDS[k][0](c).over(inside).alias(f"_in_{n}") for n, (k, c) in totals.items()])
    carried = (
        rows.groupBy(*keys, *slices)
        .agg(*[_KINDS[k][0](c).alias(f"_all_{n}") for n, (k, c) in totals.items()])
        .select(
            *keys,
            *slices,
            *[_KINDS[k][0](f"_all_{n}").over(earlier).alias(f"_pre_{n}") for n, (k, _) in totals.items()],
        )
    )

    def both(name: str, kind: str) -> Column:
        inner, pre = F.col(f"_in_{name}"), F.col(f"_pre_{name}")
        return F.coalesce(_KINDS[kind][1](inner, pre), inner, pre).alias(name)

    return local.join(carried, [*keys, *slices]).select(
        *columns, *[both(n, k) for n, (k, _) in totals.items()]
    )


def lifetime_counts(
    windows: DataFrame, keys: list[str], slice_seconds: int = DAY, name: str = "total"
) -> DataFrame:
    """Count since the beginning, one row per key and closed window."""
    rows = sliced(windows.select(*keys, "window_start", "window_end", "n"), "window_start", slice_seconds)
    return running(rows, keys, ["_slice"], ["window_start"], {name: ("sum", "n")}).drop("_slice")


def record_totals(records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One updated total per input record (no window), along ``order``.

    Single records are dealt in ranges of equal size, however many fall into one second.  ``records`` should hold no
    more columns than are wanted.
    """
    counted = records.withColumn("_one", F.lit(1).cast("bigint"))
    return prefix(counted, keys, order, {"total": ("sum", "_one")}).drop("_one")


def lives(
    windows: DataFrame, keys: list[str], ttl: int, written: str = "window_end", slice_seconds: int = DAY
) -> DataFrame:
    """Number the lives of each key's state: it is forgotten ``ttl`` seconds after its last write.

    Use ``life`` as one more key in the running and decay operators.
    """
    seen = prefix(windows, keys, [written], {"_last": ("max", written)}, before=True)
    born = sliced(seen, written, slice_seconds).withColumn("_new", F.coalesce((F.col(written) - F.col("_last") >= ttl).cast("bigint"), F.lit(0)))
    out = running(born.drop("_last"), keys, ["_slice"], [written], {"life": ("sum", "_new")})
    return out.drop("_slice", "_new")
