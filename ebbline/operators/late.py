"""Late rows: what a watermark leaves out, row by row.

A row is late if its window had closed before it arrived: the window's end is not after the greatest event time among
all rows that arrived earlier, less the delay.  The batch form works on a stored table in arrival order; the streaming
form carries the greatest event time from batch to batch, so it gives the same rows however the input is cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.operators.prefix import prefix
from ebbline.operators.running import time_slice

ARRIVAL = ["arrival", "event_id"]
# Seconds of a unit.
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def seconds(length: str) -> int:
    """Seconds of a length such as ``5 minutes``."""
    number, unit = length.split()
    return int(number) * UNITS[unit.removesuffix("s")]


def with_clock(
    rows: DataFrame, order: list[str] | None = None, ts: str = "event_ts", start: int | None = None
) -> DataFrame:
    """Add ``clock``: the greatest event time (``start`` included) among the rows before, null at the first row."""
    begin = {} if start is None else {"clock": start}
    return prefix(rows, [], order or ARRIVAL, {"clock": ("max", ts)}, before=True, start=begin)


def marked(
    rows: DataFrame,
    length: int,
    delay: int = 0,
    order: list[str] | None = None,
    ts: str = "event_ts",
    start: int | None = None,
) -> DataFrame:
    """Add ``window_start`` and ``late``, for tumbling windows of ``length`` seconds and a watermark ``delay`` behind.

    Rows without event time have no window and are never late.
    """
    clocked = with_clock(rows, order, ts, start)
    window = time_slice(ts, length)
    late = F.coalesce(window + length <= F.col("clock") - delay, F.lit(False))
    return clocked.select(*rows.columns, window.alias("window_start"), late.alias("late"))


def counted_in_time(marked_rows: DataFrame, keys: list[str], amount: str = "event_count") -> DataFrame:
    """Window totals of the rows that are not late, with the number of late rows beside them."""
    late = F.sum(F.col("late").cast("bigint")).alias("n_late")
    n = F.sum(F.when(~F.col("late"), F.col(amount)).otherwise(0)).cast("bigint").alias("n")
    return marked_rows.groupBy(*keys, "window_start").agg(n, late)


class LateSplit:
    """The streaming form, as a ``foreachBatch`` function over the raw rows.

    Each micro-batch is marked as a table would be, going on from the clock that the batch before stored.  Rows in time
    go to ``on_time``, late rows to ``on_late`` (a side output); both get ``(rows, batch_id)``.  The clock is stored after both, in the
    shared folder, under its batch: a replayed batch starts from the clock it started from at first.  ``counts`` tells
    how many rows were late.
    """

    def __init__(
        self,
        path: str,
        length: int,
        on_late: Callable[[DataFrame, int], None],
        on_time: Callable[[DataFrame, int], None] | None = None,
        delay: int = 0,
        order: list[str] | None = None,
        ts: str = "event_ts",
    ):
        self.path, self.length, self.delay, self.ts = path, length, delay, ts
        self.order, self.on_late, self.on_time = order or ARRIVAL, on_late, on_time

    def _batches(self, spark: SparkSession) -> DataFrame:
        where = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            return spark.createDataFrame([], "clock bigint, n bigint, n_late bigint, batch_id bigint")
        return spark.read.schema("clock bigint, n bigint, n_late bigint, batch_id bigint").parquet(self.path)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        start = self._batches(spark).where(F.col("batch_id") < batch_id).agg(F.max("clock")).first()[0]
        split = marked(rows, self.length, self.delay, self.order, self.ts, start)
        late = split.where("late")
        self.on_late(late, batch_id)
        if self.on_time is not None:
            self.on_time(split.where("not late"), batch_id)
        clock = F.greatest(F.max(self.ts), F.lit(start).cast("bigint")).cast("bigint").alias("clock")
        facts = split.agg(clock, F.count(F.lit(1)).alias("n"), F.count_if("late").alias("n_late"))
        facts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")  # one row

    def counts(self, spark: SparkSession) -> DataFrame:
        """``batch_id, n, n_late`` of every batch."""
        return self._batches(spark).select("batch_id", "n", "n_late")
