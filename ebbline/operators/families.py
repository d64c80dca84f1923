"""Key families: the same counts for users, media, user x creator, ... in one shuffle."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.decay import fade

# executors get this module with the query and need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAMILIES = {
    "user": ["user_id"],
    "media": ["media_id"],
    "creator": ["creator_id"],
    "user_media": ["user_id", "media_id"],
    "user_creator": ["user_id", "creator_id"],
}
CATEGORISED = FAMILIES | {"category": ["category"], "user_category": ["user_id", "category"]}


def categorised(events: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Events with the ``category`` that the catalogue (``media_id``, ``category``) gives their media, else ``""``."""
    named = catalogue.select("media_id", "category").dropDuplicates(["media_id"])
    return events.join(named, "media_id", "left").withColumn("category", F.coalesce("category", F.lit("")))


def family_key(columns: list[str]) -> Column:
    """Ids joined by ``|``; a ``|`` inside an id is escaped, so keys cannot collide."""
    if len(columns) == 1:
        return F.col(columns[0])
    return F.concat_ws("|", *[F.regexp_replace(c, r"([\\|])", r"\\$1") for c in columns])


def fan_out(events: DataFrame, families: dict[str, list[str]] = FAMILIES) -> DataFrame:
    """One copy of each event per family, with columns ``family`` and ``key``."""
    if not families:
        raise ValueError("name at least one key family")
    pairs = [F.struct(F.lit(f).alias("family"), family_key(c).alias("key")) for f, c in families.items()]
    return events.select("*", F.inline(F.array(*pairs)))


def as_features(events: DataFrame, families: dict[str, list[str]] = FAMILIES) -> DataFrame:
    """Events of all families as one stream of features: event name ``like/user_creator``, key in ``key``.

    The counter operators then serve every family with one shuffle and one state.
    """
    return fan_out(events, families).withColumn("event_name", F.concat_ws("/", "event_name", "family")).drop("family")


def family_counts(events: DataFrame, families: dict[str, list[str]] = FAMILIES) -> DataFrame:
    """Events per family, key and event name."""
    return fan_out(events, families).groupBy("family", "key", "event_name").agg(
        F.sum("event_count").alias("n"), F.max("event_ts").alias("last_ts")
    )


def feature_matrix(
    events: DataFrame,
    names: list[str],
    intervals: list[int],
    as_of: int,
    families: dict[str, list[str]] = FAMILIES,
) -> DataFrame:
    """The research sweep: family x event name x (total, unique users, decayed counters), one row per key.

    Users are made distinct by the first grouping, so that no ``count(distinct)``
    has to copy the rows once per event name.
    """
    age = F.lit(as_of).cast("bigint") - F.col("event_ts")
    listed = events.where(F.col("event_name").isin(*names) & (F.col("event_ts") <= as_of))
    per_user = (
        fan_out(listed, families)
        .groupBy("family", "key", "event_name", "user_id")
        .agg(
            F.sum("event_count").alias("_n"),
            *[F.sum(F.col("event_count") * fade(age, d)).alias(f"_d{d}") for d in intervals],
        )
    )
    features = []
    for name in names:
        here = F.col("event_name") == name
        features.append(F.coalesce(F.sum(F.when(here, F.col("_n"))), F.lit(0)).alias(f"{name}_total"))
        features.append(F.count(F.when(here, 1)).alias(f"{name}_users"))
        for d in intervals:
            features.append(F.coalesce(F.sum(F.when(here, F.col(f"_d{d}"))), F.lit(0.0)).alias(f"{name}_{d}s"))
    return per_user.groupBy("family", "key").agg(*features)


KINDS = ("total", "count", "faded")


@dataclass(frozen=True)
class Counter:
    """A counter of a sweep: all events of a name, those of the last ``seconds``, or all faded at that interval."""

    name: str
    event_name: str
    kind: str = "total"
    seconds: int = 1

    def __post_init__(self):
        if self.kind not in KINDS or self.seconds <= 0:
            raise ValueError(f"a counter is one of {KINDS} and has positive seconds, not {self}")


SWEEP_WAYS = 4  # parts of a key's seconds, so that a busy key is not one task's
SWEEP_NUMBERS = 1 << 20  # values of rows by counters held at once


def _sweep_batches(batches: Iterator[pa.RecordBatch], counters: list[Counter]) -> Iterator[pa.RecordBatch]:
    """Rows of a key and event name follow each other; a row with all its counters' values is put out for each.

    Beside the values are the seconds that each counter met, and those whose amount is not null.
    """
    of: dict[str, list[int]] = {}
    for i, c in enumerate(counters):
        of.setdefault(c.event_name, []).append(i)
    periods = {}
    for name, places in of.items():
        kinds = np.array([counters[i].kind for i in places])
        seconds = np.array([counters[i].seconds for i in places], np.float64)
        periods[name] = kinds == "faded", np.where(kinds == "count", seconds, np.inf), seconds
    last, sums = None, None

    def row() -> pa.RecordBatch:
        met = np.flatnonzero(sums[1])
        values = [None if not sums[2][i] else float(sums[0][i]) for i in met]
        places = [of[last[2]][i] for i in met]
        lists = [pa.array([places], pa.list_(pa.int32())), pa.array([values], pa.list_(pa.float64()))]
        keys = [pa.array([last[0]], pa.string()), pa.array([last[1]], key_type)]
        return pa.RecordBatch.from_arrays([*keys, *lists], ["family", "key", "places", "values"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key_type = batch.column(1).type
        codes = np.stack([c.dictionary_encode(null_encoding="encode").indices.to_numpy() for c in batch.columns[:3]])
        begins = np.append(True, (codes[:, 1:] != codes[:, :-1]).any(axis=0))
        starts = np.flatnonzero(begins)
        for start, end in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
            own = tuple(batch.column(i)[start].as_py() for i in range(3))
            if own != last:
                if last is not None:
                    yield row()
                last, sums = own, np.zeros((3, len(of[own[2]])))
            faded, within, seconds = periods[own[2]]
            age = batch.column(3).slice(start, end - start).to_numpy(zero_copy_only=False).astype(np.float64)
            amount = batch.column(4).slice(start, end - start).to_numpy(zero_copy_only=False).astype(np.float64)
            known = ~batch.column(4).slice(start, end - start).is_null().to_numpy(zero_copy_only=False)
            step = max(1, SWEEP_NUMBERS // len(seconds))
            for i in range(0, len(age), step):
                a, n, there = age[i : i + step, None], np.where(known, amount, 0)[i : i + step], known[i : i + step]
                met = a < within
                weight = met.astype(np.float64)
                weight[:, faded] = np.exp(-a / seconds[faded])
                sums += np.stack([n @ weight, met.sum(axis=0), there.astype(np.float64) @ met])
    if last is not None:
        yield row()


def sweep(
    events: DataFrame, counters: list[Counter], as_of: int, families: dict[str, list[str]] = FAMILIES
) -> DataFrame:
    """Any number of counters for every key of the families, as rows ``family, key, counter, value``.

    The counters are a list, not columns: the plan is the same for one and for thousands.  Events are first summed per
    key and second; a key's seconds, sorted, meet all counters of their name at once as a matrix, and only a key's sums
    leave the task.  A counter without events has no row.
    """
    if len({c.name for c in counters}) != len(counters):
        raise ValueError("counters need distinct names")
    known = events.where((F.col("event_ts") <= as_of) & F.col("event_name").isin(*{c.event_name for c in counters}))
    fanned = fan_out(known.select("event_name", "event_ts", "event_count", *_columns(families)), families)
    line = ["family", "key", "event_name"]
    per_second = fanned.groupBy(*line, "event_ts").agg(F.sum("event_count").alias("n"))
    age = (F.lit(as_of).cast("bigint") - F.col("event_ts")).alias("age")
    rows = per_second.select(*line, age, F.col("n").cast("double").alias("n"), F.pmod(F.hash("event_ts"), F.lit(SWEEP_WAYS)).alias("way"))
    rows = rows.repartition(*line, "way").sortWithinPartitions(*line, "way").drop("way")
    key = rows.schema["key"].dataType.simpleString()
    parts = rows.mapInArrow(
        lambda batches: _sweep_batches(batches, counters), f"family string, key {key}, places array<int>, values array<double>"
    )
    met = parts.select("family", "key", F.inline(F.arrays_zip("places", "values")))
    met = met.groupBy("family", "key", "places").agg(F.sum("values").alias("value"))
    schema = "places int, counter string"
    listed = events.sparkSession.createDataFrame([(i, c.name) for i, c in enumerate(counters)], schema)
    return met.join(F.broadcast(listed), "places").select("family", "key", "counter", "value")


def _columns(families: dict[str, list[str]]) -> list[str]:
    return sorted({c for columns in families.values() for c in columns})


def sweep_maps(sparse: DataFrame) -> DataFrame:
    """One row per key, with a map from counter to value; as many entries as counters at most."""
    entries = F.collect_list(F.struct("counter", "value"))
    return sparse.groupBy("family", "key").agg(F.map_from_entries(F.array_sort(entries)).alias("values"))


def sweep_block(sparse: DataFrame, counters: list[str]) -> DataFrame:
    """A matrix of some of the counters, a column each; 0 where there was no event."""
    wide = sparse.where(F.col("counter").isin(*counters)).groupBy("family", "key").pivot("counter", counters)
    return wide.agg(F.first("value")).na.fill(0.0, counters)
