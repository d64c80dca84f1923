"""Every operator as a query over the benchmark tables; ``expected.py`` has the SQL twins.

Each entry takes ``(spark, sf_dir)`` and reads whole tables.  Times are epoch
seconds, so results do not depend on a time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions import items
from ebbline.functions.decay import value_at
from ebbline.functions.events import allow_events, decode_events, encode_events
from ebbline.functions.text import explode_words, tokens
from ebbline.operators import decay, engagement, families, generators, late, neighbours, running, topk, windows
from ebbline.session import prepare, shared_dir
from ebbline.sinks.tables import FewViewsTable, TopListTable, UpsertTable, fan_out_writer
from ebbline.sources import lines, tables
from ebbline.streaming import jobs

HOUR, DAY, WEEK = 3600, 86_400, 604_800
SHORT = [5, 10, 15]
LONG = [HOUR, DAY, WEEK]
AS_OF = 1_706_659_200  # 2024-01-31 00:00:00 UTC, after the last event
HALF = AS_OF - 15 * DAY  # about the middle of the events
USER, MEDIA = ["event_name", "user_id"], ["event_name", "media_id"]
K = 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(prepare(spark), sf_dir)

    QUERIES[f.__name__] = run
    return run


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.events(spark, sf_dir).withColumn("event_time", windows.event_clock())


def _counted(spark: SparkSession, sf_dir: str, keys: list[str], length: str = "5 seconds") -> DataFrame:
    return windows.window_counts(_events(spark, sf_dir), keys, length)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _long(counters: DataFrame) -> DataFrame:
    return _rounded(decay.explode_counters(counters), "value")


# ---- text lines -------------------------------------------------------------


def _text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))


@query
def tokens_keep_empty(spark, sf_dir):
    return windows.word_counts(_text_lines(spark, sf_dir), "words_and_blanks")


@query
def tokens_drop_empty(spark, sf_dir):
    return windows.word_counts(_text_lines(spark, sf_dir), "words")


@query
def tokens_whitespace(spark, sf_dir):
    return windows.word_counts(_text_lines(spark, sf_dir), "spaces")


@query
def conversation_words(spark, sf_dir):
    """Word counts per role, i.e. a composite key over text."""
    talk = tables.table(spark, sf_dir, "conversations")
    words = explode_words(talk, value="text", kept=["role"])
    return words.groupBy("role", "word").agg(F.count("*").alias("n"))


@query
def word_window_count(spark, sf_dir):
    arrived = tables.as_lines(tables.table(spark, sf_dir, "events"))
    return windows.word_window_counts(arrived, "1 hour")


@query
def word_lifetime_count(spark, sf_dir):
    arrived = tables.as_lines(tables.table(spark, sf_dir, "events"))
    return running.lifetime_counts(windows.word_window_counts(arrived, "5 seconds"), ["word"])


@query
def word_record_totals(spark, sf_dir):
    """One updated total per input record, no window."""
    arrived = tables.as_lines(tables.table(spark, sf_dir, "events"))
    words = arrived.select(
        "event_id",
        F.unix_seconds("arrival").alias("second"),
        F.posexplode(tokens(F.col("value"))).alias("position", "word"),
    )
    totals = running.record_totals(words, ["word"], ["second", "event_id", "position"])
    return totals.select("word", "event_id", "position", "total")


@query
def word_store_items(spark, sf_dir):
    """Word items as a key-value store holds them, read back."""
    return items.read_word_items(items.word_items(windows.word_counts(_text_lines(spark, sf_dir))))


@query
def item_expiry(spark, sf_dir):
    """Items that name the second after which the store may drop them."""
    counts = running.lifetime_counts(_counted(spark, sf_dir, USER, "1 day"), USER)
    last = topk.last_per_key(counts, ["user_id"], ["window_end", "event_name"]).withColumnRenamed("user_id", "word")
    stored = items.word_items(last, "total", ttl=F.col("window_end") + WEEK)
    parsed = F.get_json_object("item", "$.ttl.N").cast("bigint").alias("expires")
    return stored.select("word", parsed, F.get_json_object("item", "$.count.N").cast("bigint").alias("total"))


# ---- event lines ------------------------------------------------------------


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_events(tables.events(spark, sf_dir).drop("value"))


@query
def event_decode_filter(spark, sf_dir):
    decoded = decode_events(_event_lines(spark, sf_dir), on_bad_record="fail")
    return allow_events(decoded, ["view", "purchase"]).select(
        "event_id", "event_name", "user_id", "creator_id", "media_id", "event_ts", "event_count"
    )


@query
def event_base64_decode(spark, sf_dir):
    sent = _event_lines(spark, sf_dir).withColumn("value", F.base64("value"))
    decoded = decode_events(lines.decode_base64(sent))
    return decoded.select("event_id", "event_name", "user_id", "media_id", "event_ts")


def _mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic on which chat text was sent among the events."""
    talk = tables.table(spark, sf_dir, "conversations").select(F.col("text").alias("value"))
    return _event_lines(spark, sf_dir).select("value").unionByName(talk)


@query
def bad_record_drop(spark, sf_dir):
    good = decode_events(_mixed_lines(spark, sf_dir), on_bad_record="drop")
    return good.groupBy("event_name").agg(F.sum("event_count").alias("n"), F.max("event_ts").alias("last_ts"))


@query
def bad_record_quarantine(spark, sf_dir):
    routed = decode_events(_mixed_lines(spark, sf_dir), on_bad_record="quarantine")
    return routed.where("bad").groupBy("raw").agg(F.count("*").alias("n"))


# ---- windows and lifetime counts -------------------------------------------


@query
def window_count_5s(spark, sf_dir):
    return _counted(spark, sf_dir, USER)


@query
def window_count_1h(spark, sf_dir):
    return _counted(spark, sf_dir, USER, "1 hour")


@query
def window_count_media_1h(spark, sf_dir):
    return _counted(spark, sf_dir, MEDIA, "1 hour")


@query
def window_count_fixed_unit(spark, sf_dir):
    """Arrival times that an emulator delivered in seconds where milliseconds are due, put right, and counted by the day."""
    delivered = tables.events(spark, sf_dir).select(
        "event_name",
        "event_ts",
        "event_count",
        F.unix_seconds("arrival").alias("seconds"),
        F.unix_millis("arrival").alias("millis"),
    )
    in_seconds, in_millis = (
        delivered.withColumn("arrival", lines.arrival_time(F.col(c), in_seconds=c == "seconds")) for c in ("seconds", "millis")
    )
    both = in_seconds.unionByName(in_millis)
    return windows.window_counts(both, ["event_name"], "1 day", time="arrival", ts_policy="max")


@query
def window_count_arrival(spark, sf_dir):
    """Windows cut by the broker's time stamp, carrying the first arrival's event time."""
    late = _late_events(spark, sf_dir)
    return windows.window_counts(late, MEDIA, "1 day", time="arrival", ts_policy="first_arrival")


LATE_DELAYS = [0, HOUR]


def _late_rows(spark: SparkSession, sf_dir: str, delay: int) -> DataFrame:
    """Events in the order of their arrival, stamped up to some hours before, and whether their hour had closed."""
    events = _late_events(spark, sf_dir).select("event_id", "event_name", "arrival", "event_ts", "event_count")
    return late.marked(events, HOUR, delay).withColumn("delay", F.lit(delay))


@query
def late_dropped(spark, sf_dir):
    """The rows that a watermark leaves out, at two delays."""
    parts = [_late_rows(spark, sf_dir, d).where("late").select("delay", "event_id", "event_ts") for d in LATE_DELAYS]
    return parts[0].unionByName(parts[1])


@query
def late_counted(spark, sf_dir):
    """Window counts of the rows in time, and how many were late, at two delays."""
    parts = [late.counted_in_time(_late_rows(spark, sf_dir, d), ["delay", "event_name"]) for d in LATE_DELAYS]
    return parts[0].unionByName(parts[1])


@query
def sliding_count(spark, sf_dir):
    return windows.sliding_counts(tables.events(spark, sf_dir), ["event_name"], HOUR, 300)


@query
def lifetime_count(spark, sf_dir):
    return running.lifetime_counts(_counted(spark, sf_dir, USER), USER)


@query
def lifetime_null_keys(spark, sf_dir):
    """Events without a user count under one key."""
    events = _events(spark, sf_dir)
    events = events.withColumn("user_id", F.when(F.col("user_id").cast("bigint") % 7 != 0, F.col("user_id")))
    return running.lifetime_counts(windows.window_counts(events, USER), USER)


@query
def state_ttl_lifetime(spark, sf_dir):
    """Lifetime counts where state is forgotten two days after its last write."""
    lived = running.lives(_counted(spark, sf_dir, USER), USER, 2 * DAY)
    return running.lifetime_counts(lived, [*USER, "life"])


@query
def state_ttl_as_of(spark, sf_dir):
    """What the state still holds at a given time."""
    lived = running.lives(_counted(spark, sf_dir, USER), USER, 2 * DAY)
    held = lived.groupBy(*USER, "life").agg(F.sum("n").alias("total"), F.max("window_end").alias("written"))
    now = topk.last_per_key(held, USER, ["life"])
    return now.where(F.col("written") + 2 * DAY > AS_OF).select(*USER, "total", "written")


# ---- decayed counters ------------------------------------------------------


@query
def decay_final(spark, sf_dir):
    return _long(decay.decay_final(_counted(spark, sf_dir, USER), USER, SHORT))


@query
def decay_final_long(spark, sf_dir):
    """Every event at its own second, long intervals."""
    return _long(decay.decay_final(tables.events(spark, sf_dir), MEDIA, LONG, amount="event_count"))


@query
def decay_as_of(spark, sf_dir):
    return _long(decay.decay_as_of(tables.events(spark, sf_dir), MEDIA, LONG, AS_OF, amount="event_count"))


@query
def decay_running(spark, sf_dir):
    return _long(decay.decay_running(_counted(spark, sf_dir, USER), USER, LONG))


@query
def decay_running_short(spark, sf_dir):
    return _long(decay.decay_running(_counted(spark, sf_dir, MEDIA, "1 hour"), MEDIA, [5, 600, HOUR]))


def _late_stamped(events: DataFrame) -> DataFrame:
    return events.withColumn("event_ts", F.col("event_ts") - F.floor(F.col("value") * 100))


def _late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that were stamped up to some hours before they arrived."""
    return _late_stamped(tables.events(spark, sf_dir))


@query
def decay_running_late(spark, sf_dir):
    """Windows by arrival; event times go back and forth."""
    counted = windows.window_counts(_late_events(spark, sf_dir), MEDIA, "1 hour", time="arrival")
    return _long(decay.decay_running(counted, MEDIA, LONG, in_order=False))


@query
def decay_merge_two_sides(spark, sf_dir):
    """Counters of two halves of the traffic, added."""
    e = tables.events(spark, sf_dir)
    halves = [
        decay.explode_counters(decay.decay_final(half, MEDIA, LONG, amount="event_count"))
        for half in (e.where("value < 30"), e.where("value >= 30"))
    ]
    return _rounded(decay.merge_counters(*halves, MEDIA), "value")


def _media_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    counters = decay.decay_final(_counted(spark, sf_dir, MEDIA), MEDIA, LONG)
    return counters.withColumnsRenamed({"event_name": "feature_name", "media_id": "key"})


@query
def counter_store_items(spark, sf_dir):
    """Counter items as a key-value store holds them, read back."""
    return _rounded(items.read_counter_items(items.counter_items(_media_counters(spark, sf_dir))), "value")


# ---- sink ------------------------------------------------------------------


def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifetime counts as they reach the sink, in batches of a day."""
    rows = running.lifetime_counts(_counted(spark, sf_dir, USER, "1 hour"), USER)
    return rows.select(
        running.time_slice("window_start", DAY).alias("batch"),
        F.col("user_id").alias("key"),
        F.col("event_name").alias("feature_name"),
        "window_end",
        "total",
    )


@query
def item_dedup_composite(spark, sf_dir):
    return topk.last_per_key(
        _written(spark, sf_dir), ["batch", "key", "feature_name"], ["window_end"]
    )


@query
def item_dedup_partition_key(spark, sf_dir):
    return topk.last_per_key(_written(spark, sf_dir), ["batch", "key"], ["window_end", "feature_name"])


@query
def upsert_replay(spark, sf_dir):
    """Three batches, the last one replayed; the store ends with each key's last write."""
    store = UpsertTable(shared_dir(spark, "upsert"), ["key", "feature_name"], ["window_end"])
    written = _written(spark, sf_dir)
    third = 10 * DAY
    start = AS_OF - 30 * DAY
    for number in (0, 1, 2, 2):
        low = start + number * third
        high = low + third if number < 2 else AS_OF + DAY
        low = low if number else 0
        store.write(written.where((F.col("batch") >= low) & (F.col("batch") < high)), number)
    return store.read(spark).select("key", "feature_name", "window_end", "total")


@query
def upsert_lookup(spark, sf_dir):
    """The rows of some keys, each looked up by itself."""
    store = UpsertTable(shared_dir(spark, "lookup"), ["key", "feature_name"], ["window_end"])
    written = _written(spark, sf_dir)
    for number in range(2):
        store.write(written.where(F.col("batch") < HALF if number == 0 else F.col("batch") >= HALF), number)
    found = [store.get(spark, key=str(user)) for user in range(0, 60, 10)]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.select("key", "feature_name", "window_end", "total")


@query
def upsert_restart(spark, sf_dir):
    """Two runs with checkpoints of their own into one table: the later run's rows hold."""
    home = shared_dir(spark, "restart")
    store = UpsertTable(f"{home}/rows", ["event_name"], ["n"], compact_every=4)
    for run in (1, 2):
        n = F.sum(F.col("event_count") * run).alias("n")
        counts = _event_stream(spark, sf_dir, closing=False).groupBy("event_name").agg(n)
        jobs.run_available(counts, store.write, f"{home}/checkpoint-{run}", "update")
    return store.read(spark)


# ---- candidates ------------------------------------------------------------


@query
def topk_falling_scores(spark, sf_dir):
    """A short list kept over three batches in which scores rise and fall: views in the latest period with any."""
    home = shared_dir(spark, "falling")
    table = UpsertTable(f"{home}/counters", ["feature_name", "key"], ["window_end"])
    best = TopListTable(f"{home}/list", items.TOP_VIEWS, "view", DAY, 3, reserve=3, counters=table)
    views = _events(spark, sf_dir).where("event_name = 'view'")
    views = views.withColumn("window_end", F.floor((AS_OF - F.col("event_ts")) / (10 * DAY)) * -1)
    counts = views.groupBy(F.lit("view").alias("feature_name"), F.col("media_id").alias("key"), "window_end").agg(
        F.count("*").cast("double").alias("n")
    )
    counter = F.struct(
        F.lit(DAY).cast("bigint").alias("decay_interval"), F.col("window_end").alias("last_update"), F.col("n").alias("value")
    )
    counts = counts.withColumn("counts", F.create_map(F.lit(DAY).cast("bigint"), counter)).drop("n")
    for batch, end in enumerate((-2, -1, 0)):
        rows = counts.where(F.col("window_end") == end) if end > -2 else counts.where("window_end <= -2")
        rows = topk.last_per_key(rows, ["feature_name", "key"], ["window_end"])
        table.write(rows, batch)
        best.write(rows, batch)
    return topk.ranked(best.read(spark))


def _scores(spark: SparkSession, sf_dir: str, as_of: int | None = None) -> DataFrame:
    return topk.scores(_media_counters(spark, sf_dir), "view", DAY, as_of)


@query
def topk_candidates(spark, sf_dir):
    return _rounded(topk.top_k(_scores(spark, sf_dir), K), "score")


@query
def topk_ranked_list(spark, sf_dir):
    lists = topk.candidate_list(_scores(spark, sf_dir), items.TOP_VIEWS, K)
    return _rounded(topk.ranked(lists), "score")


@query
def topk_store_items(spark, sf_dir):
    """The list as a key-value store holds it, read back."""
    lists = topk.candidate_list(_scores(spark, sf_dir), items.TOP_VIEWS, K)
    return _rounded(items.read_list_items(items.list_items(lists)), "score")


@query
def topk_as_of(spark, sf_dir):
    """Scores faded to one time before they are compared."""
    return _rounded(topk.top_k(_scores(spark, sf_dir, AS_OF), K), "score")


@query
def topk_fresh_and_overall(spark, sf_dir):
    """Two lists that differ in the counter they rank by."""
    counters = _media_counters(spark, sf_dir)
    fresh = topk.candidate_list(topk.scores(counters, "view", HOUR, AS_OF), "fresh", K)
    overall = topk.candidate_list(topk.scores(counters, "view", WEEK, AS_OF), "overall", K)
    both = topk.ranked(fresh.unionByName(overall))
    # values of an hour's decay may be tiny: compare their logarithm
    return both.withColumn("log_score", F.round(F.log("score"), 6)).drop("score")


@query
def ratio_topk_min_views(spark, sf_dir):
    best = generators.ratio_top_k(tables.events(spark, sf_dir), "purchase", "view", 15, K)
    return _rounded(best, "ratio")


@query
def min_views_candidates(spark, sf_dir):
    return generators.few_views(tables.events(spark, sf_dir), "view", 100, K)


@query
def few_views_of_catalogue(spark, sf_dir):
    """Drawn from all posts, those that nobody has seen included."""
    posts = tables.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("media_id"))
    return generators.few_views(tables.events(spark, sf_dir), "view", 10, K, posts=posts)


@query
def creator_affinity(spark, sf_dir):
    return generators.creator_affinity(tables.events(spark, sf_dir), "view", 5)


@query
def knn_candidates(spark, sf_dir):
    """Media nearest to the mean of what a user viewed."""
    vectors = tables.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("media_id"), "embedding"
    )
    queries = generators.user_vectors(tables.events(spark, sf_dir), vectors, "view", dim=64)
    return _rounded(generators.nearest(queries, vectors, 5), "score")


@query
def knn_indexed(spark, sf_dir):
    """The same from an index of cells, which is written once."""
    vectors = tables.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("media_id"), "embedding"
    )
    path = shared_dir(spark, "neighbours")
    neighbours.write_index(vectors, path)
    queries = generators.user_vectors(tables.events(spark, sf_dir), vectors, "view", dim=64)
    return _rounded(neighbours.nearest_indexed(spark, queries, path, 5), "score").drop("scored")


# ---- features over families and periods -------------------------------------


@query
def key_families(spark, sf_dir):
    return families.family_counts(tables.events(spark, sf_dir))


@query
def category_families(spark, sf_dir):
    """Families by the media's category, alone and with the user."""
    catalogue = tables.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("media_id"), F.col("p_brand").alias("category")
    )
    events = families.categorised(tables.events(spark, sf_dir), catalogue)
    return families.family_counts(events, {f: families.CATEGORISED[f] for f in ("category", "user_category")})


@query
def family_counters(spark, sf_dir):
    """Decayed counters of all key families from one fan-out."""
    fanned = families.fan_out(tables.events(spark, sf_dir), {"user": ["user_id"], "creator": ["creator_id"]})
    keys = ["family", "key", "event_name"]
    return _long(decay.decay_final(fanned, keys, LONG, amount="event_count"))


@query
def feature_matrix(spark, sf_dir):
    wide = families.feature_matrix(
        tables.events(spark, sf_dir),
        ["view", "purchase"],
        [DAY, WEEK],
        AS_OF,
        {"user": ["user_id"], "media": ["media_id"]},
    )
    return _rounded(wide, *[f"{n}_{d}s" for n in ("view", "purchase") for d in (DAY, WEEK)])


def _thousand_counters() -> list[families.Counter]:
    """Four events, 125 periods, and each period counted whole and faded."""
    return [
        families.Counter(f"{name}_{kind}_{seconds}", name, kind, seconds)
        for name in ("view", "click", "purchase", "signup")
        for kind in ("count", "faded")
        for seconds in range(HOUR * 4, HOUR * 4 * 126, HOUR * 4)
    ]


@query
def feature_sweep(spark, sf_dir):
    """A research sweep of a thousand counters per key."""
    sparse = families.sweep(
        tables.events(spark, sf_dir), _thousand_counters(), AS_OF, {"creator": ["creator_id"], "media": ["media_id"]}
    )
    return _rounded(sparse, "value")


@query
def ctr_ratio(spark, sf_dir):
    return _rounded(engagement.ratios(tables.events(spark, sf_dir), ["media_id"], "click", "view"), "ratio")


@query
def counter_ratio(spark, sf_dir):
    """Ratio of two decayed counters, as a reader of the store computes it."""
    c = F.col("counts")[F.lit(WEEK).cast("bigint")]
    now = _media_counters(spark, sf_dir).select("key", "feature_name", value_at(c, AS_OF).alias("v"))
    wide = now.groupBy("key").agg(
        F.sum(F.when(F.col("feature_name") == "click", F.col("v"))).alias("clicks"),
        F.sum(F.when(F.col("feature_name") == "view", F.col("v"))).alias("views"),
    )
    return wide.select("key", F.round(F.try_divide("clicks", "views"), 6).alias("ratio"))


@query
def unique_users(spark, sf_dir):
    return engagement.unique_users(tables.events(spark, sf_dir), ["media_id", "event_name"])


TEN_DAYS = (HALF, HALF + 10 * DAY)


@query
def unique_users_merged(spark, sf_dir):
    """Distinct users over a period of ten days, merged from stored days."""
    days = engagement.user_bitmaps(_events(spark, sf_dir), MEDIA, F.col("user_id").cast("bigint"), "1 day")
    home = shared_dir(spark, "user-days")
    days.write.parquet(home)
    return engagement.users_of_bitmaps(spark.read.parquet(home), MEDIA, *TEN_DAYS)


@query
def users_of_both(spark, sf_dir):
    """Users who viewed and purchased a media within ten days, from stored days."""
    days = engagement.user_bitmaps(_events(spark, sf_dir), MEDIA, F.col("user_id").cast("bigint"), "1 day")
    return engagement.users_of_both(days, ["media_id"], "view", "purchase", *TEN_DAYS)


@query
def period_counts(spark, sf_dir):
    return engagement.period_counts(
        tables.events(spark, sf_dir),
        MEDIA,
        AS_OF,
        {"last_day": DAY, "last_week": WEEK, "last_month": 30 * DAY},
    )


@query
def amount_sums(spark, sf_dir):
    sums = engagement.amount_sums(tables.events(spark, sf_dir), ["user_id", "event_name"], "value")
    return _rounded(sums, "total")


@query
def viewed_not_purchased(spark, sf_dir):
    return engagement.without_reaction(
        tables.events(spark, sf_dir), ["user_id", "media_id"], "view", "purchase", 5 * DAY
    )


@query
def viewed_not_purchased_user(spark, sf_dir):
    """The same by user alone and within an hour."""
    return engagement.without_reaction(tables.events(spark, sf_dir), ["user_id"], "view", "purchase", HOUR)


# ---- streams, run until the input is used up -----------------------------------


def _stored_result(spark: SparkSession, stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run to the end of the input and read the rows back from the shared folder."""
    home = shared_dir(spark, name)
    empty = spark.createDataFrame([], stream.schema)
    jobs.append_table(f"{home}/rows")(empty, -1)
    jobs.run_available(stream, jobs.append_table(f"{home}/rows"), f"{home}/checkpoint", mode)
    return jobs.read_table(spark, f"{home}/rows")


def _event_stream(spark: SparkSession, sf_dir: str, closing: bool = True) -> DataFrame:
    return tables.as_events(tables.streamed_events(spark, sf_dir, closing))


@query
def stream_word_windows(spark, sf_dir):
    arrived = tables.as_lines(tables.streamed_events(spark, sf_dir))
    return _stored_result(spark, jobs.word_windows(arrived, "1 hour"), "word-windows")


@query
def stream_word_totals(spark, sf_dir):
    """Update mode: the store ends with each word's total."""
    arrived = tables.as_lines(tables.streamed_events(spark, sf_dir, closing=False))
    home = shared_dir(spark, "word-totals")
    store = UpsertTable(f"{home}/rows", ["word"], ["n"])
    jobs.run_available(jobs.word_totals(arrived), store.write, f"{home}/checkpoint", "update")
    return store.read(spark)


@query
def stream_lifetime(spark, sf_dir):
    events = jobs.watermarked(_event_stream(spark, sf_dir))
    return _stored_result(
        spark, jobs.lifetime_totals(windows.window_counts(events, USER, "1 hour"), USER), "lifetime"
    )


@query
def stream_counters(spark, sf_dir):
    counters = jobs.event_counters(_event_stream(spark, sf_dir), "media_id", LONG, "1 hour")
    return _long(_stored_result(spark, counters, "counters"))


@query
def stream_late_rows(spark, sf_dir):
    """Late rows on a side output, and the hourly counts of the others, added up by the store."""
    home = shared_dir(spark, "late")
    on_late = jobs.append_table(f"{home}/late")
    split = late.LateSplit(f"{home}/clock", HOUR, on_late, delay=HOUR)
    stream = _late_stamped(_event_stream(spark, sf_dir, closing=False)).select("event_id", "arrival", "event_ts")
    jobs.run_available(stream, split.write, f"{home}/checkpoint")
    return jobs.read_table(spark, f"{home}/late").select("event_id", "event_ts", "window_start")


@query
def stream_late_counts(spark, sf_dir):
    """What the stream counted in time, per hour."""
    home = shared_dir(spark, "in-time")
    store = UpsertTable(f"{home}/rows", ["event_name", "window_start", "batch"], ["n"])

    def in_time(rows: DataFrame, batch_id: int) -> None:
        counts = rows.groupBy("event_name", "window_start").agg(F.sum("event_count").alias("n"))
        store.write(counts.withColumn("batch", F.lit(batch_id)), batch_id)

    split = late.LateSplit(f"{home}/clock", HOUR, jobs.append_table(f"{home}/late"), in_time)
    stream = _late_stamped(_event_stream(spark, sf_dir, closing=False))
    jobs.run_available(stream.drop("value", "user_id", "creator_id", "media_id"), split.write, f"{home}/checkpoint")
    return store.read(spark).groupBy("event_name", "window_start").agg(F.sum("n").alias("n"))


@query
def stream_counters_handover(spark, sf_dir):
    """Counters of a backfill of the first half, and a stream that goes on from them."""
    backfill = _events(spark, sf_dir).where(F.col("event_ts") < HALF)
    counted = windows.window_counts(backfill, MEDIA, "1 hour")
    before = decay.decay_final(counted, MEDIA, LONG).withColumnsRenamed({"event_name": "feature_name", "media_id": "key"})
    arriving = tables.as_events(tables.streamed_events(spark, sf_dir, since=HALF))
    counters = jobs.event_counters(arriving, "media_id", LONG, "1 hour", initial=before)
    streamed = _long(_stored_result(spark, counters, "handover"))
    history = _long(decay.decay_running(counted, MEDIA, LONG))
    return history.withColumnsRenamed({"event_name": "feature_name", "media_id": "key"}).unionByName(streamed)


@query
def stream_delayed_windows(spark, sf_dir):
    """Out-of-order events, waited for as long as they can be late: none is lost."""
    stamped = jobs.watermarked(_late_stamped(_event_stream(spark, sf_dir)), "3 hours")
    return _stored_result(spark, windows.window_counts(stamped, ["event_name"], "1 hour"), "delayed")


@query
def stream_restarted(spark, sf_dir):
    """Two runs from one checkpoint, the second over files that came after the first."""
    home = shared_dir(spark, "restarted")
    stored = tables.table(spark, sf_dir, "events")
    schema = tables.STORED_EVENTS
    early = F.col("ts") < F.timestamp_seconds(F.lit(HALF)).cast("timestamp_ntz")
    for part in (early, ~early):
        stored.select(schema.fieldNames()).where(part).write.mode("append").parquet(f"{home}/in")
        arriving = tables.as_events(spark.readStream.schema(schema).parquet(f"{home}/in"))
        counted = windows.window_counts(jobs.watermarked(arriving), USER, "1 hour")
        totals = jobs.lifetime_totals(counted, USER)
        jobs.run_available(totals, jobs.append_table(f"{home}/rows"), f"{home}/checkpoint")
    # windows that are still open wait in the state
    last = stored.agg(F.unix_seconds(F.max("ts").cast("timestamp"))).first()[0]
    return jobs.read_table(spark, f"{home}/rows").where(F.col("window_end") <= (last or 0))


@query
def stream_lifetime_handover(spark, sf_dir):
    """Lifetime counts of a stream that goes on from a backfill's totals."""
    backfill = _events(spark, sf_dir).where(F.col("event_ts") < HALF)
    totals = backfill.groupBy(*USER).agg(F.sum("event_count").alias("total"))
    arriving = jobs.watermarked(tables.as_events(tables.streamed_events(spark, sf_dir, since=HALF)))
    counted = windows.window_counts(arriving, USER, "1 hour")
    return _stored_result(spark, jobs.lifetime_totals(counted, USER, initial=totals), "lifetime-handover")


@query
def stream_counter_slices(spark, sf_dir):
    """Counters from slice sums that the stream keeps up to date."""
    sums = jobs.counter_slices(_event_stream(spark, sf_dir, closing=False), "media_id", LONG)
    home = shared_dir(spark, "slices")
    store = UpsertTable(f"{home}/rows", ["feature_name", "key", "slice"], ["last_ts"])
    jobs.run_available(sums, store.write, f"{home}/checkpoint", "update")
    return _long(decay.merge_slices(store.read(spark), ["feature_name", "key"], LONG))


@query
def stream_sliding(spark, sf_dir):
    events = jobs.watermarked(_event_stream(spark, sf_dir))
    slid = events.groupBy(F.window("event_time", "1 hour", "20 minutes").alias("w"), "event_name").agg(
        F.count("*").alias("n"), F.approx_count_distinct("user_id").alias("users")
    )
    flat = slid.select("event_name", F.unix_seconds("w.start").alias("window_start"), "n", "users")
    return _stored_result(spark, flat, "sliding").drop("users")


@query
def stream_candidates(spark, sf_dir):
    """Events to window totals to counters and tops by bucket, one query; the list from the tops as last written."""
    views = _event_stream(spark, sf_dir).where("event_name = 'view'")
    counted = windows.window_counts(jobs.watermarked(views), MEDIA, "1 hour")
    tops = jobs.counted_tops(counted, "media_id", "view", DAY, K, buckets=8, reserve=K)
    home = shared_dir(spark, "candidates")
    store = UpsertTable(f"{home}/rows", ["bucket"], ["bucket"])
    jobs.run_available(tops, store.write, f"{home}/checkpoint")
    return _rounded(topk.ranked(topk.merged(store.read(spark), items.TOP_VIEWS, K)), "score")


@query
def stream_candidates_of_counters(spark, sf_dir):
    """The same list from a stream of counters, in three states."""
    counters = jobs.event_counters(_event_stream(spark, sf_dir), "media_id", LONG, "1 hour")
    lists = jobs.top_lists(counters, items.TOP_VIEWS, "view", DAY, K, buckets=8, reserve=K)
    home = shared_dir(spark, "candidates")
    store = UpsertTable(f"{home}/rows", ["name"], ["updated"])
    jobs.run_available(lists, store.write, f"{home}/checkpoint")
    return _rounded(topk.ranked(store.read(spark)), "score")


@query
def stream_improvements(spark, sf_dir):
    """A list to which only risen scores are passed on; lifetime views never fall, so it is exact."""
    views = _event_stream(spark, sf_dir).where("event_name = 'view'")
    counted = windows.window_counts(jobs.watermarked(views), MEDIA, "1 day")
    totals = jobs.lifetime_totals(counted, MEDIA)
    # media of equal views differ by a fraction
    score = F.col("total") + (F.col("media_id").cast("bigint") + 1) / 1e6
    counter = F.struct(
        F.lit(DAY).cast("bigint").alias("decay_interval"), F.col("window_end").alias("last_update"), score.alias("value")
    )
    counters = totals.select(
        F.col("event_name").alias("feature_name"),
        F.col("media_id").alias("key"),
        "window_start",
        F.create_map(F.lit(DAY).cast("bigint"), counter).alias("counts"),
    )
    lists = jobs.top_lists(counters, items.TOP_VIEWS, "view", DAY, K, buckets=4, mode="improvements")
    home = shared_dir(spark, "improvements")
    store = UpsertTable(f"{home}/rows", ["name"], ["updated"])
    jobs.run_available(lists, store.write, f"{home}/checkpoint")
    return _rounded(topk.ranked(store.read(spark)), "score")


@query
def stream_counters_and_list(spark, sf_dir):
    """One counter stream with two sinks: the counter table, and the list kept from it."""
    counters = jobs.event_counters(_event_stream(spark, sf_dir), "media_id", LONG, "1 hour")
    home = shared_dir(spark, "two-sinks")
    table = UpsertTable(f"{home}/counters", ["feature_name", "key"], ["window_end"])
    best = TopListTable(f"{home}/list", items.TOP_VIEWS, "view", DAY, K, reserve=K, counters=table)
    jobs.run_available(counters, fan_out_writer(table.write, best.write), f"{home}/checkpoint")
    return _rounded(topk.ranked(best.read(spark)), "score")


@query
def stream_family_counters(spark, sf_dir):
    """Counters of several key families from one stream."""
    features = families.as_features(
        _event_stream(spark, sf_dir, closing=False), {"media": ["media_id"], "user_creator": ["user_id", "creator_id"]}
    )
    home = shared_dir(spark, "families")
    store = UpsertTable(f"{home}/rows", ["feature_name", "key", "slice"], ["last_ts"])
    jobs.run_available(jobs.counter_slices(features, "key", LONG), store.write, f"{home}/checkpoint", "update")
    return _long(decay.merge_slices(store.read(spark), ["feature_name", "key"], LONG))


@query
def stream_ratio_topk(spark, sf_dir):
    """Best purchase/view ratios from counts that the stream keeps up to date."""
    counts = engagement.ratios(_event_stream(spark, sf_dir, closing=False), ["media_id"], "purchase", "view")
    home = shared_dir(spark, "ratios")
    store = UpsertTable(f"{home}/rows", ["media_id"], ["whole", "part"])
    jobs.run_available(counts, store.write, f"{home}/checkpoint", "update")
    return _rounded(generators.best_ratios(store.read(spark), 15, K), "ratio")


@query
def stream_unique_users(spark, sf_dir):
    """Days of users that the stream keeps up to date; distinct users over ten of them."""
    events = jobs.watermarked(_event_stream(spark, sf_dir, closing=False))
    days = engagement.user_bitmaps(events, MEDIA, F.col("user_id").cast("bigint"), "1 day")
    home = shared_dir(spark, "stream-user-days")
    store = UpsertTable(f"{home}/rows", [*MEDIA, "window_start", "bucket"], ["last_ts"])
    jobs.run_available(days, store.write, f"{home}/checkpoint", "update")
    return engagement.users_of_bitmaps(store.read(spark), MEDIA, *TEN_DAYS)


@query
def stream_few_views(spark, sf_dir):
    """Posts with few views, drawn anew after every batch of views."""
    posts = tables.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("media_id"))
    views = _event_stream(spark, sf_dir, closing=False).where("event_name = 'view'")
    home = shared_dir(spark, "few-views")
    counts = UpsertTable(f"{home}/counts", ["media_id"], ["views"])
    drawn = FewViewsTable(f"{home}/drawn", posts, counts, 10, K, reserve=2 * K)
    totals = views.groupBy("media_id").agg(F.sum("event_count").alias("views"))
    jobs.run_available(totals, fan_out_writer(counts.write, drawn.write), f"{home}/checkpoint", "update")
    return drawn.read(spark)


@query
def stream_creator_affinity(spark, sf_dir):
    """Unseen posts of liked creators, kept fresh by a stream of engagement; posts nobody has seen take part."""
    place = F.col("vec_id").cast("bigint")
    posts = tables.table(spark, sf_dir, "embeddings").select(
        place.cast("string").alias("media_id"), (place % tables.CREATORS).cast("string").alias("creator_id"), place.alias("place")
    )
    home = shared_dir(spark, "affinity")
    store = UpsertTable(f"{home}/rows", generators.KEPT_KEYS, ["n"])
    kept = generators.seen_and_views(_event_stream(spark, sf_dir, closing=False), posts, "view")
    jobs.run_available(kept, store.write, f"{home}/checkpoint", "update")
    return generators.fresh_creator_affinity(store.read(spark), posts, 5)


@query
def stream_viewed_not_purchased(spark, sf_dir):
    missing = jobs.without_reaction(_event_stream(spark, sf_dir), ["user_id"], "view", "purchase", HOUR)
    return _stored_result(spark, missing, "missing")


@query
def stream_missing_reactions_joined(spark, sf_dir):
    """The same by a join of two streams, without Python."""
    missing = jobs.without_reaction_joined(_event_stream(spark, sf_dir), ["user_id"], "view", "purchase", HOUR)
    return _stored_result(spark, missing, "missing-joined")


@query
def stream_ttl_lifetime(spark, sf_dir):
    """Lifetime counts where a key is forgotten after two days of event time; the run ends by itself."""
    events = jobs.watermarked(_event_stream(spark, sf_dir))
    counted = windows.window_counts(events, USER, clocked=True)
    return _stored_result(spark, jobs.lifetime_totals(counted, USER, event_ttl_s=2 * DAY), "ttl-lifetime")


@query
def stream_ttl_counters(spark, sf_dir):
    """Decayed counters where a key is forgotten after a day of event time."""
    counters = jobs.event_counters(_event_stream(spark, sf_dir), "user_id", LONG, "1 hour", event_ttl_s=DAY)
    return _long(_stored_result(spark, counters, "ttl-counters"))


@query
def stream_replayed_lines(spark, sf_dir):
    """JSON lines written to files, replayed as a stream, decoded, filtered and counted."""
    home = shared_dir(spark, "replay")
    _event_lines(spark, sf_dir).select("value").write.text(f"{home}/lines")
    replayed = decode_events(lines.replayed_lines(spark, f"{home}/lines"))
    counts = allow_events(replayed, ["view", "purchase"]).groupBy("event_name", "media_id").agg(
        F.sum("event_count").alias("n")
    )
    store = UpsertTable(f"{home}/rows", MEDIA, ["n"])
    jobs.run_available(counts, store.write, f"{home}/checkpoint", "update")
    return store.read(spark)
