"""Where results go: an upsert table, a batched key-value writer, text files, the console."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.operators.topk import candidate_list, last_per_key, scores, top_k

# Fixed value: items per write request.
MAX_BATCH = 20


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path, for folders only Spark can reach."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names in a folder that begin with ``prefix``, sorted."""
    fs, where = _folder(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(n for n in found if n.startswith(prefix))


def _run(spark: SparkSession) -> str:
    """The streaming query that calls, the same after a restart from its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def write_sorted(rows: DataFrame, keys: list[str], path: str) -> None:
    """Files sorted by key, with a Bloom filter of every key column in every row group, so that a lookup of a key reads
    the row groups that may hold it."""
    writer = rows.sortWithinPartitions(*keys).write.mode("overwrite")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(path)


class UpsertTable:
    """Whole-row replacement by key, in a shared folder.

    Each micro-batch writes its last row per key to a folder of its own, named by
    the run and the batch, so a replayed batch overwrites itself and a run with a
    new checkpoint comes after all earlier ones.  Readers take the newest row per
    key.  After ``compact_every`` batches the present rows begin a new generation
    of folders; the generation before the last is removed, so a reader has at
    least that many batches' time.  ``keys`` may be a prefix of the true key to
    drop all but the last row of that prefix within a batch.
    """

    def __init__(
        self, path: str, keys: list[str], order: list[str], within_batch: list[str] | None = None, compact_every: int = 50
    ):
        self.path, self.keys, self.order = path, keys, order
        self.within_batch = within_batch or keys
        self.compact_every = compact_every

    def _generation(self, spark: SparkSession) -> str:
        """The newest whole generation."""
        whole = [n for n in _names(spark, self.path, "generation-") if not n.endswith("-unfinished")]
        return f"{self.path}/{whole[-1]}" if whole else f"{self.path}/generation-000000"

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function."""
        spark = rows.sparkSession
        home, own = self._generation(spark), _run(spark)
        runs = _names(spark, home, "run=")
        run = next((r for r in runs if r.endswith(f"-{own}")), None)
        if run is None:
            number = int(runs[-1].removeprefix("run=").split("-")[0]) + 1 if runs else 1
            run = f"run={number:06d}-{own}"
        write_sorted(last_per_key(rows, self.within_batch, self.order), self.keys, f"{home}/{run}/batch_id={batch_id}")
        if sum(len(_names(spark, f"{home}/{r}", "batch_id=")) for r in {*runs, run}) > self.compact_every:
            self.compact(spark)

    def compact(self, spark: SparkSession) -> None:
        """Begin a new generation with the present rows."""
        number = int(self._generation(spark).rsplit("-", 1)[1]) + 1
        new = f"{self.path}/generation-{number:06d}"
        # run 0 is older than any batch of the new generation, a replayed one too
        write_sorted(self.read(spark), self.keys, f"{new}-unfinished/run=000000-base/batch_id=0")
        fs, unfinished = _folder(spark, f"{new}-unfinished")
        fs.rename(unfinished, _folder(spark, new)[1])
        fs.delete(_folder(spark, f"{self.path}/generation-{number - 2:06d}")[1], True)

    def _rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self._generation(spark))

    def _newest(self, rows: DataFrame) -> DataFrame:
        return last_per_key(rows, self.keys, ["run", "batch_id", *self.order]).drop("run", "batch_id")

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest row of each key."""
        return self._newest(self._rows(spark))

    def get(self, spark: SparkSession, **key) -> DataFrame:
        """Rows of one key; of every file only the row groups are read whose Bloom filter may hold it."""
        rows = self._rows(spark)
        for column, wanted in key.items():
            rows = rows.where(F.col(column) == wanted)
        return self._newest(rows)

    def snapshot(self, spark: SparkSession, path: str) -> UpsertTable:
        """The present rows as a new table."""
        newer = UpsertTable(path, self.keys, self.order, self.within_batch, self.compact_every)
        write_sorted(self.read(spark), self.keys, f"{path}/generation-000000/run=000000-base/batch_id=0")
        return newer


class TopListTable:
    """The ``k`` best ids by their latest score, kept up to date batch by batch.

    The second sink of a counter stream: it needs no state of its own, since the
    list before a batch is the stored one.  Two folders take turns, so a replayed
    batch starts again from the list before it.

    With ``counters``, the table of the latest counters (written before this
    one), ``reserve`` ids are kept and a mark: the highest score among all
    others.  When fewer than ``k`` of the kept are above the mark, the list is
    taken anew from that table; so it is exact at any reserve.  Without it every
    id is kept.  Ids last updated ``max_age`` seconds before the newest update
    leave the list.
    """

    def __init__(
        self,
        path: str,
        name: str,
        feature: str,
        interval: int,
        k: int,
        reserve: int | None = None,
        counters: UpsertTable | None = None,
        max_age: int | None = None,
    ):
        self.max_age = max_age
        self.path, self.name, self.feature, self.interval, self.k = path, name, feature, interval, k
        self.reserve = max(k, 4 * k if reserve is None else reserve)
        self.counters = counters

    def _cut(self, rows: DataFrame, mark: float | None) -> tuple[list, float | None]:
        """The best ``reserve`` rows, and the mark of what is left out."""
        best = top_k(rows.select("media_id", "score", "last_update"), self.reserve + 1).collect()  # bounded by the reserve
        out = [r["score"] for r in best[self.reserve :]]
        return best[: self.reserve], max([*out, *([] if mark is None else [mark])], default=None)

    def _fresh(self, rows: DataFrame, now: int | None) -> DataFrame:
        return rows if now is None else rows.where(F.col("last_update") > now - self.max_age)

    def write(self, counters: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function; rows have feature_name, key, window_end and counts."""
        spark, run = counters.sparkSession, _run(counters.sparkSession)
        newest = last_per_key(counters.where(F.col("feature_name") == self.feature), ["feature_name", "key"], ["window_end"])
        rows = scores(newest, self.feature, self.interval).withColumn("batch", F.lit(1))
        turns = [r.asDict() for r in self._turns(spark)]  # two at most
        own = [t for t in turns if (t["run"], t["batch_id"]) == (run, batch_id)]
        others = [t for t in turns if t not in own]
        mark, version, turn = None, 0, own[0]["turn"] if own else 0
        if others:
            before = others[-1]
            mark, version = before["mark"], before["version"] + 1
            turn = 1 - before["turn"]
            kept = spark.read.parquet(f"{self.path}/turn={before['turn']}").where("media_id is not null")
            kept = kept.select("media_id", "score", "last_update", F.lit(0).alias("batch"))
            rows = last_per_key(kept.unionByName(rows), ["media_id"], ["batch"])
        now = None if self.max_age is None else rows.agg(F.max("last_update")).first()[0]
        rows = self._fresh(rows, now)
        if self.counters is None:
            self._store(rows.select("media_id", "score", "last_update"), turn, run, batch_id, version, None)
            return
        best, mark = self._cut(rows, mark)
        if mark is not None and sum(r["score"] > mark for r in best[: self.k]) < self.k:
            every = scores(self.counters.read(spark), self.feature, self.interval)
            best, mark = self._cut(self._fresh(every, now), None)
        table = spark.createDataFrame(best, "media_id string, score double, last_update bigint")
        self._store(table, turn, run, batch_id, version, mark)

    def _store(self, rows: DataFrame, turn: int, run: str, batch_id: int, version: int, mark: float | None) -> None:
        # a row without id says that the batch was written, if the list is empty
        blank = rows.sparkSession.createDataFrame([(None, None, None)], rows.schema)
        about = {"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint"), "version": F.lit(version).cast("bigint")}
        about["mark"] = F.lit(mark).cast("double")
        rows.unionByName(blank).withColumns(about).write.mode("overwrite").parquet(f"{self.path}/turn={turn}")

    def _turns(self, spark: SparkSession) -> list:
        """What is stored in the two folders, the older first."""
        if not _names(spark, self.path, "turn="):
            return []
        rows = spark.read.parquet(self.path).where("media_id is null")
        return rows.select("turn", "run", "batch_id", "version", "mark").orderBy("version").collect()

    def read(self, spark: SparkSession) -> DataFrame:
        """The list as one row: ``name``, ``candidates``."""
        newest = self._turns(spark)[-1]
        current = spark.read.parquet(f"{self.path}/turn={newest['turn']}").where("media_id is not null")
        return candidate_list(current, self.name, self.k)


class FewViewsTable:
    """A random draw of ``k`` posts with fewer than ``below`` views, exact after every batch of a stream of view counts.

    Posts are drawn in the order of a hash.  ``reserve`` of them are kept, the first ones with few views, and posts
    leave as they pass the threshold; views never fall, so as long as ``k`` are left, these are the draw.  Then the
    catalogue is read once more, beyond the last post kept before, and its views are looked up in ``counts`` (written
    before this one).  Two folders take turns, so a replayed batch starts again from the posts before it.

    ``posts`` is the catalogue (``media_id``), read anew at every refill; :meth:`publish` adds posts in between.
    """

    SCHEMA = "media_id string, draw string, last string, run string, batch_id bigint, version bigint"

    def __init__(
        self, path: str, posts: DataFrame, counts: UpsertTable, below: int, k: int, reserve: int | None = None, seed: str = "0"
    ):
        self.path, self.posts, self.counts, self.below, self.k = path, posts, counts, below, k
        self.reserve, self.seed = max(k, 4 * k if reserve is None else reserve), seed

    def _drawn(self, posts: DataFrame) -> DataFrame:
        return posts.select("media_id", F.md5(F.concat("media_id", F.lit(self.seed))).alias("draw")).distinct()

    def _states(self, spark: SparkSession) -> list[list]:
        """The kept posts by turn, the older turn first; each begins with a row of its own."""
        turns = [n for n in _names(spark, self.path, "turn=")]
        states = [spark.read.schema(self.SCHEMA).parquet(f"{self.path}/{t}").collect() for t in turns]  # reserve at most
        about = [sorted(s, key=lambda r: (r["media_id"] is not None, r["draw"], r["media_id"])) for s in states]
        return sorted(about, key=lambda s: s[0]["version"])

    def _store(self, spark: SparkSession, kept: list[tuple], last: str | None, run: str, batch_id: int, version: int) -> None:
        rows = [(None, None, last, run, batch_id, version), *((m, d, last, run, batch_id, version) for m, d in kept)]
        spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/turn={version % 2}")

    def _refilled(self, spark: SparkSession, kept: list[tuple], last: str | None) -> tuple[list[tuple], str | None]:
        """The kept posts and the next ones of the catalogue; ``last`` is the draw of the last post looked at, "~" beyond all."""
        open_ = self._drawn(self.posts)
        if last is not None:
            open_ = open_.where(F.col("draw") > last)
        full = self.counts.read(spark).where(F.col("views") >= self.below).select("media_id")
        more = open_.join(full, "media_id", "left_anti").orderBy("draw", "media_id").limit(self.reserve).collect()
        kept = kept + [(r["media_id"], r["draw"]) for r in more]
        if len(more) < self.reserve:
            return kept, "~"  # sorts after every hash
        same = open_.where(F.col("draw") == more[-1]["draw"]).join(full, "media_id", "left_anti").collect()  # one, but for a collision
        return sorted({*kept, *((r["media_id"], r["draw"]) for r in same)}, key=lambda p: (p[1], p[0])), more[-1]["draw"]

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function; rows have ``media_id`` and ``views`` so far."""
        spark, run = rows.sparkSession, _run(rows.sparkSession)
        states = [s for s in self._states(spark) if (s[0]["run"], s[0]["batch_id"]) != (run, batch_id)]
        kept, last, version = [], None, 0
        if states:
            kept = [(r["media_id"], r["draw"]) for r in states[-1][1:]]
            last, version = states[-1][0]["last"], states[-1][0]["version"] + 1
            ids = [m for m, _ in kept]
            full = rows.where((F.col("views") >= self.below) & F.col("media_id").isin(ids)) if ids else rows.limit(0)
            gone = {r["media_id"] for r in full.select("media_id").collect()}  # kept posts only
            kept = [p for p in kept if p[0] not in gone]
        if last != "~" and len(kept) < self.k:
            kept, last = self._refilled(spark, kept, last)
        self._store(spark, kept, last, run, batch_id, version)

    def publish(self, posts: DataFrame) -> None:
        """New posts: those whose draw lies among the kept ones join them, the others wait for their turn."""
        spark = posts.sparkSession
        newest = self._states(spark)[-1]
        about = newest[0]
        new = self._drawn(posts).where(F.lit(about["last"]) >= F.col("draw"))
        full = self.counts.read(spark).where(F.col("views") >= self.below).select("media_id")
        joined = {(r["media_id"], r["draw"]) for r in newest[1:]}
        joined |= {(r["media_id"], r["draw"]) for r in new.join(full, "media_id", "left_anti").collect()}
        kept = sorted(joined, key=lambda p: (p[1], p[0]))
        self._store(spark, kept, about["last"], about["run"], about["batch_id"], about["version"] + 1)

    def read(self, spark: SparkSession) -> DataFrame:
        """The draw as of the last batch: ``media_id``, ``views``."""
        states = self._states(spark)
        drawn = [(r["media_id"],) for r in states[-1][1 : self.k + 1]] if states else []
        drawn = spark.createDataFrame(drawn, "media_id string")
        views = self.counts.read(spark).select("media_id", "views")
        return F.broadcast(drawn).join(views, "media_id", "left").select(
            "media_id", F.coalesce("views", F.lit(0).cast("bigint")).alias("views")
        )


def write_items(items: DataFrame, open_client: Callable[[], object], batch_size: int = MAX_BATCH) -> None:
    """Put items in requests of ``batch_size``, one client per task.

    ``open_client`` runs on the executor and returns an object with
    ``put_items(list_of_json)`` and, if it likes, ``close()``.  A put replaces
    the whole item, so a retried task does no harm.  Repeated keys must have
    been dropped before (:func:`last_per_key`): a request may hold a key once.
    """

    def put(rows: Iterator) -> None:
        client = open_client()
        try:
            while batch := [r["item"] for r in islice(rows, batch_size)]:
                client.put_items(batch)
        finally:
            getattr(client, "close", lambda: None)()

    items.select("item").foreachPartition(put)


def item_writer(
    to_items: Callable[[DataFrame], DataFrame],
    keys: list[str],
    order: list[str],
    open_client: Callable[[], object],
    batch_size: int = MAX_BATCH,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: last row per key, item shape, batched puts."""

    def write(rows: DataFrame, batch_id: int) -> None:
        write_items(to_items(last_per_key(rows, keys, order)), open_client, batch_size)

    return write


def fan_out_writer(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Feed one micro-batch to several writers, computing it once."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            for w in writers:
                w(rows, batch_id)
        finally:
            rows.unpersist()

    return write


def as_rows(df: DataFrame) -> DataFrame:
    """Rows as one text column, for the text file sink."""
    return df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]).alias("value"))


def to_files(stream: DataFrame, path: str, checkpoint: str, as_json: bool = False):
    """Append rows to files, as text or JSON lines."""
    out = stream if as_json else as_rows(stream)
    return (
        out.writeStream.format("json" if as_json else "text")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .option("path", path)
    )


def to_console(stream: DataFrame, checkpoint: str, output_mode: str = "append"):
    return (
        stream.writeStream.format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
    )
