"""Session settings the operators depend on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what changes results: event times are UTC, keyed state needs RocksDB.

    Partition counts and memory stay with whoever submits the job.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


def _shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, the folder every executor can reach.

    Only a local master may fall back to a temporary folder: on a cluster the
    other machines could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="ebbline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for checkpoints and tables of one run."""
    return f"{_shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def settle(rows: DataFrame) -> DataFrame:
    """Write rows that several branches of a plan read, so that the input is scanned once.

    Meant for totals, not for raw input.  The copy lies in the shared folder and
    survives the loss of executors.
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared_root(rows.sparkSession))
    return rows.checkpoint()
