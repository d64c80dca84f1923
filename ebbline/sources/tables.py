"""The benchmark tables in the shape of this library's inputs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.session import shared_dir

# The stream of engagement as it is stored.
STORED_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
CREATORS = 20
PORTIONS, FILE_ROWS = 5, 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def streamed_events(spark: SparkSession, sf_dir: str, closing: bool = True, since: int | None = None) -> DataFrame:
    """The events as they arrive: portions in the order of time, one per micro-batch.

    Every portion has the same number of files, which bounds a micro-batch; a file has ``FILE_ROWS`` rows or more, and
    a portion at most four files for each core.  ``closing`` adds a last file with one view a day later, by user and of
    media -1, which closes all windows before.  ``since`` leaves out what came before that second.
    """
    stored = table(spark, sf_dir, "events").select([f.name for f in STORED_EVENTS])
    if since is not None:
        stored = stored.where(F.col("ts") >= F.timestamp_seconds(F.lit(since)).cast("timestamp_ntz"))
    folder = shared_dir(spark, "arriving")
    first, last = stored.agg(F.min("ts"), F.max("ts")).first()
    files = 1
    if first is not None:
        bounds = [first + (last - first) * i / PORTIONS for i in range(1, PORTIONS)]
        number = sum((F.col("ts") >= F.lit(b).cast("timestamp_ntz")).cast("int") for b in bounds)
        number = F.coalesce(number, F.lit(0))
        sizes = [r["count"] for r in stored.groupBy(number.alias("portion")).count().collect()]  # PORTIONS rows at most
        least = min(sizes) if len(sizes) == PORTIONS else 0
        files = max(1, min(least // FILE_ROWS, 4 * spark.sparkContext.defaultParallelism))
        file = F.pmod(F.xxhash64("event_id", "ts", "user_id"), F.lit(files)).cast("int")
        for i in range(PORTIONS):  # a write each, since files are taken in the order of their making
            stored.where(number == i).repartitionById(files, file).write.mode("append").parquet(folder)
        if closing:
            end = [(None, last + timedelta(days=1), -1, "view", 0.0, '{"k": -1}')]
            spark.createDataFrame(end, STORED_EVENTS).coalesce(1).write.mode("append").parquet(folder)
    else:
        spark.createDataFrame([], STORED_EVENTS).write.parquet(folder)
    return spark.readStream.schema(STORED_EVENTS).option("maxFilesPerTrigger", files).parquet(folder)


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def as_events(stored: DataFrame) -> DataFrame:
    """Stored rows as events: ``props.k`` is the media, ``k % CREATORS`` its creator."""
    media = F.from_json("props", "k bigint")["k"]
    arrival = F.col("ts").cast("timestamp")
    return stored.select(
        F.col("event_type").alias("event_name"),
        _text(F.col("user_id")).alias("user_id"),
        _text(F.pmod(media, F.lit(CREATORS))).alias("creator_id"),
        _text(media).alias("media_id"),
        F.unix_seconds(arrival).alias("event_ts"),
        F.lit(1).cast("bigint").alias("event_count"),
        "event_id",
        "value",
        arrival.alias("arrival"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_events(table(spark, sf_dir, "events"))


def as_lines(stored: DataFrame) -> DataFrame:
    """Stored rows as text lines such as ``view {"k": 29}``, in arrival order."""
    return stored.select(
        F.concat_ws(" ", "event_type", "props").alias("value"),
        F.col("ts").cast("timestamp").alias("arrival"),
        "event_id",
    )
