"""Last writes, top-K and ranked candidate lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.decay import value_at


def last_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key along ``order`` (ties: the larger of the other columns).

    An aggregate rather than ``row_number``: it is combined before the shuffle,
    so a key that is written very often costs one row per task.
    """
    rest = [f.name for f in rows.schema if f.name not in (*keys, *order)]
    # maps have no order
    sortable = [f.name for f in rows.schema if f.name in rest and "map<" not in f.dataType.simpleString()]
    last = F.max_by(F.struct(*order, *rest), F.struct(*order, *sortable)).alias("_last")
    return rows.groupBy(*keys).agg(last).select(
        *[F.col(c) if c in keys else F.col(f"_last.{c}") for c in rows.columns]
    )


def scores(counters: DataFrame, feature: str, interval: int, as_of: int | None = None) -> DataFrame:
    """Score per media id: the value of one counter of one feature.

    Values are taken at each counter's own last update; ``as_of`` fades all of
    them to one time, which makes them comparable.
    """
    # read by subscript: the optimizer then computes no other interval
    c = F.col("counts")[F.lit(interval).cast("bigint")]
    chosen = counters.where(F.col("feature_name") == feature).select(F.col("key").alias("media_id"), c.alias("_c"))
    value = F.col("_c.value") if as_of is None else value_at(F.col("_c"), as_of)
    return chosen.where(F.col("_c").isNotNull()).select(
        "media_id", value.alias("score"), F.col("_c.last_update").alias("last_update")
    )


def top_k(scored: DataFrame, k: int, score: str = "score", id_col: str = "media_id") -> DataFrame:
    """The ``k`` best rows overall; equal scores go by id."""
    return scored.orderBy(F.col(score).desc(), F.col(id_col)).limit(k)


def candidate_list(scored: DataFrame, name: str, k: int) -> DataFrame:
    """One row: the list's name and its ``k`` best candidates, best first."""
    best = top_k(scored, k)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "media_id")))
    return best.groupBy(F.lit(name).alias("name")).agg(ordered.alias("_all")).select(
        "name",
        F.transform("_all", lambda c: F.struct(c["media_id"].alias("media_id"), (-c["s"]).alias("score"))).alias(
            "candidates"
        ),
    )


def ranked(lists: DataFrame) -> DataFrame:
    """Candidate lists as rows with a rank from 1."""
    return lists.select("name", F.posexplode("candidates").alias("_pos", "_c")).select(
        "name", (F.col("_pos") + 1).alias("rank"), "_c.media_id", "_c.score"
    )


def top_k_per(rows: DataFrame, by: list[str], k: int, order: list, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group.

    Spark prunes each task's groups to ``k`` rows before the shuffle, so a large
    group is never gathered.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def merged(tops: DataFrame, name: str, k: int) -> DataFrame:
    """The list of all from the tops of buckets of ids: at most ``k`` rows of each bucket meet."""
    rows = tops.select(F.explode("candidates").alias("_c")).select("_c.media_id", "_c.score", "_c.last_update")
    return candidate_list(rows, name, k)
