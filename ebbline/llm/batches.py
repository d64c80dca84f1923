"""Helpers around ``mapInArrow``: rows of a few columns in, rows of a given schema out."""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Columns = dict[str, list]


def map_columns(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterable[Columns]],
    schema: str,
) -> DataFrame:
    """``work`` gets Arrow batches and yields column dictionaries of ``schema``.

    Batches are bounded by rows and bytes (``spark.sql.execution.arrow.*``).
    """
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type)
                    for f, c in ((f, columns[f.name]) for f in arrow)
                ],
                schema=arrow,
            )

    return df.mapInArrow(run, schema)


def keep_rows(
    df: DataFrame, columns: list[str], work: Callable[[Iterator[pa.RecordBatch]], Iterable[Columns]], flag: str
) -> DataFrame:
    """The rows of ``df``, whole, for which ``work`` over their ``columns`` says true in ``flag``.

    ``work`` must yield once for each batch.
    """
    arrow = to_arrow_schema(df.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in work(iter([batch.select(columns)])):
                yield batch.filter(pa.array(out[flag], pa.bool_())).cast(arrow)

    return df.mapInArrow(run, df.schema)


def kept_by_process(name: tuple, build: Callable[[], object]) -> object:
    """What a Python worker builds once and reuses over its tasks.  ``name`` has every parameter of ``build``."""
    store = sys.modules["pyspark"].__dict__.setdefault("_ebbline_kept", {})
    if name not in store:
        store[name] = build()
    return store[name]


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files and copies that nothing refers to any more.

    Its cleaner waits for the driver's garbage collection, which a driver with little to do puts off.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores until no column has it (names differ in more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(rows: DataFrame, path: str) -> DataFrame:
    """``rows``, written to ``path`` in the shared folder; half the size of a checkpoint, but nobody removes it."""
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that ``written`` made and nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
