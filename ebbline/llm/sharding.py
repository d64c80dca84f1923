"""Sharding and shuffling in two passes, with built-in functions only.

The first pass scatters records uniformly into buckets that fit in memory: the shard by rendezvous hashing of the id
(of one seeded hash per shard the largest wins, so that one more shard takes records only into itself), the bucket
within the shard by another seeded hash.  The second pass shuffles each bucket (Spark's ``shuffle`` is Fisher-Yates)
and writes it.  A record's slot follows from the sizes of the buckets before its own, once all are written; a lost
executor can only have its files written anew before that.

The same records get the same shards and slots however they are partitioned (unless a column is a map, which has no
order).  A null id goes to one shard like any other id.  A null text has no bytes.  Equal rows are kept, each with a
slot of its own; they share a bucket, which is as large as they are many.  Other columns are carried along, unless called as one of ``OWN``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.llm.batches import free_name
from ebbline.session import shared_dir

BUCKET_BYTES = 16 << 20
OVERHEAD = 8  # bytes of a record besides its text
SEED = 20240131

OWN = ["shard", "bucket", "place", "slot"]  # columns of the operator; such columns of the input are dropped


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """Rendezvous hashing: a pure function of the key and the number of shards."""
    draws = [F.struct(F.xxhash64(F.lit(seed), F.lit(i), key).alias("draw"), F.lit(i).alias("i")) for i in range(shards)]
    return F.array_max(F.array(*draws))["i"]


def record_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def write_shards(
    docs: DataFrame,
    shards: int,
    path: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    seed: int = SEED,
) -> str:
    """Write ``docs`` in shuffled buckets below ``path`` (a folder shared by all executors); returns the path."""
    docs = docs.drop(*OWN)
    path = path or shared_dir(docs.sparkSession, "shards")
    total = docs.agg(F.sum(record_size(text))).first()[0] or 0
    buckets = max(1, -(-total // (bucket_bytes * shards)))
    scatter = F.pmod(F.xxhash64(F.lit(~seed), F.col(key), F.col(text)), F.lit(buckets)).cast("int")
    scattered = docs.withColumn("shard", shard_of(F.col(key), shards, seed)).withColumn("bucket", scatter)
    task = free_name(scattered.columns, "_task")
    scattered = scattered.withColumn(task, F.col("shard") * F.lit(int(buckets)) + F.col("bucket"))
    scattered = scattered.repartitionById(int(shards * buckets), F.col(task))  # a bucket for each task
    records = F.collect_list(F.struct(*docs.columns))
    if not any("map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString() for f in docs.schema):
        records = F.array_sort(records)  # so that a shuffle depends on the records alone, not on their order
    records = records.alias("_records")
    shuffled = scattered.groupBy(task).agg(records, F.first("shard").alias("shard"), F.first("bucket").alias("bucket"))
    placed = shuffled.select("shard", "bucket", F.posexplode(F.shuffle("_records", F.lit(seed))).alias("place", "_record"))
    placed.select("_record.*", "shard", "bucket", "place").write.parquet(path)
    return path


def slotted(rows: DataFrame) -> DataFrame:
    """``slot`` for written records with ``shard, bucket, place``: from 0 without gaps in each shard."""
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("shard", "bucket").count()
    shift = free_name(rows.columns, "_shift")
    shifts = sizes.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias(shift))
    out = rows.join(shifts, ["shard", "bucket"])
    return out.withColumn("slot", F.col("place") + F.col(shift)).drop("bucket", "place", shift)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The records that ``write_shards`` wrote, with their ``shard`` and ``slot``."""
    return slotted(spark.read.parquet(path))
