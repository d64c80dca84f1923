"""Line sources.  Each yields ``value`` (string) and ``arrival`` (timestamp)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.config import SourceConfig
from ebbline.sources import kinesis

# Initial positions and what Kafka calls them.
START = {"TRIM_HORIZON": "earliest", "LATEST": "latest"}
ROLE_SESSION = "ebbline"


def kafka_options(
    servers: str, topic: str, position: str = "TRIM_HORIZON", group: str | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": START[position]}
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_lines(spark: SparkSession, **kwargs) -> DataFrame:
    """A Kafka topic: value only, time stamp of the broker.  Needs Spark's Kafka package."""
    raw = spark.readStream.format("kafka").options(**kafka_options(**kwargs)).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrival"))


def kinesis_options(config: SourceConfig) -> dict[str, str]:
    """Options of :mod:`ebbline.sources.kinesis` from the source section."""
    wanted = {
        "stream": config.datastreamName,
        "region": config.awsRegion,
        "endpoint": config.awsEndpoint,
        "accesskeyid": config.awsAccessKeyId,
        "secretkey": config.awsSecretAccessKey,
        "position": config.streamInitialPosition,
    }
    if config.awsAssumeRoleArn:
        wanted["rolearn"] = config.awsAssumeRoleArn
        wanted["sessionname"] = ROLE_SESSION
    return {k: v for k, v in wanted.items() if v is not None}


def kinesis_lines(
    spark: SparkSession, config: SourceConfig, open_client: Callable[[dict], object] = kinesis.aws_client, **options: str
) -> DataFrame:
    """A Kinesis stream, shard by shard; ``open_client`` gets the options."""
    name = kinesis.register(spark, open_client)
    raw = spark.readStream.format(name).options(**kinesis_options(config), **options).load()
    arrival = F.col("arrival")
    if config.kinesaliteTimestampFix:
        arrival = arrival_time(F.unix_millis(arrival), in_seconds=True)
    return raw.select(F.col("data").cast("string").alias("value"), arrival.alias("arrival"))


def arrival_time(number: Column, in_seconds: bool = False) -> Column:
    """A numeric arrival time; some emulators deliver seconds where milliseconds are due."""
    return F.timestamp_seconds(number) if in_seconds else F.timestamp_millis(number)


def replayed_lines(
    spark: SparkSession, path: str, files_per_batch: int | None = None, pattern: str | None = None
) -> DataFrame:
    """Text files, one record per line, replayed as a stream; arrival is the file's time."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    raw = reader.load(path)
    return raw.select("value", F.col("_metadata.file_modification_time").alias("arrival"))


def stored_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same files as a static table."""
    return spark.read.text(path).select("value", F.col("_metadata.file_modification_time").alias("arrival"))


def decode_base64(lines: DataFrame, value: str = "value") -> DataFrame:
    """Undo producers' base64; off unless a job asks for it."""
    return lines.withColumn(value, F.unbase64(value).cast("string"))
