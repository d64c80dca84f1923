"""Running sums and maxima along any order, in range partitions of equal size.

Rows are dealt by ranges of (keys, order), so neither a hot key nor a hot second fills one task.  Each partition runs
over its own rows once, in order, and is written with its number.  Its first key may have begun in partitions before:
two rows per partition, its first and its last, say what those add, and the answer is broadcast.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ebbline.session import shared_dir

# executors get this module with the query and need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOTHING = {"max": np.iinfo(np.int64).min, "sum": 0}
FOLD = {"max": np.maximum, "sum": np.add}


def _begins(keys: list[pa.Array], n: int, last: tuple | None) -> np.ndarray:
    """Where a row's key differs from the row before; nulls are equal to nulls."""
    out = np.zeros(n, bool)
    for k in keys:
        null = pc.is_null(k).to_numpy(zero_copy_only=False)
        differs = pc.fill_null(pc.not_equal(k[1:], k[:-1]), False).to_numpy(zero_copy_only=False)
        out[1:] |= differs | (null[1:] != null[:-1])
    out[0] = last != tuple(k[0].as_py() for k in keys)
    return out


def _run(
    batches: Iterable[pa.RecordBatch], keys: list[str], totals: dict[str, tuple[str, str]], before: bool, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Add running values within the partition.  ``_head`` marks its first key, ``_edge`` its first (1) and last row (2)."""
    last, values, head = None, {}, True
    held: dict | None = None

    def ready(columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pc.cast(pa.array(columns[f.name]), f.type) for f in schema], schema=schema)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        if held is not None:
            yield ready(held)
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        first = last is None
        begins = _begins([columns[k] for k in keys], n, last)
        group = np.cumsum(begins) - first  # the first key of the batch is 0, if it goes on
        opening = (group == 0) & head
        head = bool(opening[-1])
        edge = np.zeros(n, np.int8)
        edge[0] = first  # 1: first row, 2: last row, 3: both
        for name, (kind, column) in totals.items():
            amounts = pc.fill_null(pc.cast(columns[column], pa.int64()), NOTHING[kind]).to_numpy(zero_copy_only=False)
            grouped = pd.Series(amounts).groupby(group)
            run = (grouped.cummax() if kind == "max" else grouped.cumsum()).to_numpy().copy()
            if not first:
                run[group == 0] = FOLD[kind](run[group == 0], values[name])
            shown = run
            if before:
                shown = np.append(values.get(name, NOTHING[kind]), run[:-1])
                shown[begins] = NOTHING[kind]
            columns[name] = pa.array(shown, mask=(shown == NOTHING[kind]) if kind == "max" else None)
            values[name] = run[-1]
            ends = np.full(n, run[-1])
            columns[f"_end_{name}"] = pa.array(ends, mask=(np.arange(n) < n - 1) | ((ends == NOTHING[kind]) & (kind == "max")))
        last = tuple(columns[k][n - 1].as_py() for k in keys)
        held = columns | {"_head": opening, "_edge": edge}
    if held is not None:
        held["_edge"][-1] += 2
        yield ready(held)


def _folded(kind: str, *parts: Column) -> Column:
    if kind == "max":
        return F.greatest(*parts) if len(parts) > 1 else parts[0]
    return sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0))).cast("bigint")


def prefix(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, tuple[str, str]],
    before: bool = False,
    start: dict[str, int] | None = None,
) -> DataFrame:
    """Add running totals ``{name: (sum | max, long column)}`` per key along ``order``.

    Without keys all rows are one line.  ``before`` leaves the current row out.  ``start`` is what every line begins
    with.  A maximum over nothing is null.  Null keys are keys like others, null amounts add nothing, and rows that tie
    in ``order`` come in any order.  ``rows`` should hold no more columns than are wanted: they are written once.
    """
    spark, columns = rows.sparkSession, rows.columns
    line = [*keys, *order]
    dealt = rows.repartitionByRange(*line).sortWithinPartitions(*line).withColumn("_part", F.spark_partition_id())
    more = [T.StructField("_head", T.BooleanType()), T.StructField("_edge", T.ByteType())]
    more += [T.StructField(n, T.LongType()) for t in totals for n in (t, f"_end_{t}")]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in dealt.schema.fields] + more)
    arrow = to_arrow_schema(schema)
    path = shared_dir(spark, "prefix")
    dealt.mapInArrow(lambda batches: _run(batches, keys, totals, before, arrow), schema).write.parquet(path)
    local = spark.read.schema(schema).parquet(path)

    # a partition's last row tells how far its last key came, its first row which key goes on in it
    edges = local.where("_edge > 0").withColumn("_line", F.struct(*keys) if keys else F.lit(0))
    ends = [f"_end_{t}" for t in totals]
    last = edges.where("_edge >= 2").select("_part", "_line", F.lit(1).alias("_kind"), *ends)
    first = edges.where("_edge in (1, 3)").select("_part", "_line", F.lit(0).alias("_kind"))
    first = first.select("*", *[F.lit(None).cast("bigint").alias(e) for e in ends])
    earlier = Window.partitionBy("_line").orderBy("_part", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    kinds = {t: kind for t, (kind, _) in totals.items()}
    carried = [(F.max if kinds[t] == "max" else F.sum)(f"_end_{t}").over(earlier).alias(f"_pre_{t}") for t in totals]
    carried = last.unionByName(first).select("_part", "_kind", *carried).where("_kind = 0").drop("_kind")

    def total(t: str) -> Column:
        kind, begin = kinds[t], F.lit((start or {}).get(t)).cast("bigint")
        return _folded(kind, F.col(t), F.when(F.col("_head"), F.col(f"_pre_{t}")), begin).alias(t)

    # one row per partition of the write
    return local.join(F.broadcast(carried), "_part", "left").select(*columns, *[total(t) for t in totals])
