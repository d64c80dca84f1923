"""Mergeable distinct users, the sweep of counters, draws of rarely viewed posts, lookups."""

import hashlib
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from ebbline.operators import engagement, families
from ebbline.sinks.tables import FewViewsTable, UpsertTable

DAY = 86_400
EVENTS = "event_name string, user_id string, media_id string, event_ts long, event_count long"


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(6)
    names, users = ["view", "like"], [*range(40), 32_767, 32_768, 70_000, -5, None]
    rows = [
        (rng.choice(names), rng.choice(users), f"m{rng.randrange(4)}", rng.randrange(12 * DAY), 1) for _ in range(1500)
    ]
    df = spark.createDataFrame([(n, None if u is None else str(u), m, t, c) for n, u, m, t, c in rows], EVENTS)
    return rows, df.withColumn("event_time", F.timestamp_seconds("event_ts"))


@pytest.mark.parametrize("period", [(0, 12 * DAY), (2 * DAY, 3 * DAY), (5 * DAY, 11 * DAY), (20 * DAY, 30 * DAY)])
def test_users_of_any_period(events, period):
    rows, df = events
    keys, (start, end) = ["media_id", "event_name"], period
    days = engagement.user_bitmaps(df, keys, F.col("user_id").cast("bigint"))
    users = {}
    for n, u, m, t, _ in rows:
        if u is not None and start <= t < end:
            users.setdefault((m, n), set()).add(u)
    got = {(r.media_id, r.event_name): r.users for r in engagement.users_of_bitmaps(days, keys, start, end).collect()}
    assert got == {k: len(v) for k, v in users.items()}
    both = engagement.users_of_both(days, ["media_id"], "view", "like", start, end).collect()
    seen = {m for m, _ in users}
    assert {r.media_id: r.users for r in both} == {m: len(users.get((m, "view"), set()) & users.get((m, "like"), set())) for m in seen}


def test_sketches_stay_within_their_error(spark):
    """Ten days of 20,000 users each, half of them new every day; any period within four standard errors."""
    rows = spark.range(200_000).select(
        (F.floor(F.col("id") / 20_000) * DAY).cast("long").alias("event_ts"),
        (F.col("id") % 20_000 + F.floor(F.col("id") / 20_000) * 10_000).cast("string").alias("user_id"),
    )
    rows = rows.withColumn("event_time", F.timestamp_seconds("event_ts"))
    sketches = engagement.user_sketches(rows, [])
    sizes = sketches.select(F.length("sketch").alias("n")).collect()
    assert len(sizes) == 10 and max(r.n for r in sizes) < 4200  # of fixed size
    for start, end in ((0, 1), (0, 10), (3, 7)):
        (row,) = engagement.users_of_sketches(sketches, [], start * DAY, end * DAY).collect()
        true = 20_000 + 10_000 * (end - start - 1)
        assert abs(row.users - true) < 4 * 1.04 / math.sqrt(2**12) * true


def test_sweep_equals_a_loop(events):
    rows, df = events
    as_of = 10 * DAY
    counters = [families.Counter("views", "view"), families.Counter("likes_2d", "like", "count", 2 * DAY)]
    counters += [families.Counter("view_faded", "view", "faded", DAY), families.Counter("never", "error")]
    sparse = families.sweep(df, counters, as_of, {"media": ["media_id"]})
    expected = {}
    for n, _, m, t, _ in rows:
        if t <= as_of:
            for c, name, add in (
                ("views", "view", 1.0),
                ("likes_2d", "like", 1.0 if as_of - t < 2 * DAY else None),
                ("view_faded", "view", math.exp(-(as_of - t) / DAY)),
            ):
                if n == name and add is not None:
                    expected[m, c] = expected.get((m, c), 0.0) + add
    got = {(r.key, r.counter): r.value for r in sparse.collect()}
    assert got == pytest.approx(expected)
    maps = {r.key: r["values"] for r in families.sweep_maps(sparse).collect()}
    assert maps["m1"] == {c: v for (m, c), v in got.items() if m == "m1"}
    block = families.sweep_block(sparse, ["views", "never"])
    assert block.columns == ["family", "key", "views", "never"]
    assert {(r.key, r.views, r.never) for r in block.collect()} == {(f"m{i}", got[f"m{i}", "views"], 0.0) for i in range(4)}
    with pytest.raises(ValueError):
        families.Counter("x", "view", "median")
    with pytest.raises(ValueError):
        families.sweep(df, [counters[0], counters[0]], as_of)


def test_a_thousand_counters_are_planned_like_one(events):
    _, df = events

    def plan(n):
        counters = [families.Counter(f"c{i}", "view", "faded", i + 1) for i in range(n)]
        begin = time.perf_counter()
        text = families.sweep(df, counters, DAY, {"media": ["media_id"]})._jdf.queryExecution().executedPlan().toString()
        return time.perf_counter() - begin, text.count("\n")

    plan(1)
    (_, one), (seconds, many) = plan(1), plan(2000)
    assert many == one and seconds < 5


def _draw(media):
    return hashlib.md5(f"{media}0".encode()).hexdigest(), media


@pytest.mark.parametrize("reserve", [5, 12, 200])
def test_few_views_after_every_batch(spark, tmp_path, reserve):
    """Views come in, posts pass the threshold and leave, the draw stays that of all posts."""
    rng = random.Random(reserve)
    posts = [f"p{i}" for i in range(60)]
    catalogue = spark.createDataFrame([(p,) for p in posts], "media_id string")
    counts = UpsertTable(str(tmp_path / "counts"), ["media_id"], ["views"])
    table = FewViewsTable(str(tmp_path / "drawn"), catalogue, counts, below=4, k=5, reserve=reserve)
    views = dict.fromkeys(posts, 0)
    for batch in range(6):
        for p in rng.choices(sorted(posts, key=_draw)[:40], k=25):
            views[p] += 1
        rows = spark.createDataFrame([(p, v) for p, v in views.items() if v], "media_id string, views long")
        for _ in range(1 + (batch == 3)):  # one batch is replayed
            counts.write(rows, batch)
            table.write(rows, batch)
        expected = sorted((p for p in posts if views[p] < 4), key=_draw)[:5]
        assert sorted((r.media_id, r.views) for r in table.read(spark).collect()) == sorted((p, views[p]) for p in expected)
    table.publish(spark.createDataFrame([(f"new{i}",) for i in range(30)], "media_id string"))
    known = [*(p for p in posts if views[p] < 4), *(f"new{i}" for i in range(30))]
    drawn = {r.media_id for r in table.read(spark).collect()}
    if reserve == 200:
        assert drawn == set(sorted(known, key=_draw)[:5])
    assert len(drawn) == 5 and drawn <= set(known)


def _rows_scanned(df):
    """Rows that the file scans of a plan gave out, after row groups were left out."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        if "Adaptive" in node.nodeName():
            nodes.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_a_lookup_reads_the_files_that_may_hold_the_key(spark, tmp_path):
    """Keys are spread at random over eight batches: the least and greatest key of a file rule nothing out."""
    store = UpsertTable(str(tmp_path / "store"), ["key"], ["n"])
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for batch in range(8):
            rows = spark.range(batch, 80_000, 8).select(F.md5(F.col("id").cast("string")).alias("key"), F.col("id").alias("n"))
            store.write(rows, batch)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    total = store._rows(spark).count()
    assert total == 80_000
    for i in (0, 123, 79_999):
        found = store.get(spark, key=hashlib.md5(str(i).encode()).hexdigest())
        assert [r.n for r in found.collect()] == [i]
        assert _rows_scanned(store.get(spark, key=hashlib.md5(str(i).encode()).hexdigest())) <= total / 8  # of 32 files, few
    assert store.get(spark, key="absent").count() == 0
    assert _rows_scanned(store.get(spark, key="absent")) <= total / 8


def test_a_sweep_forms_no_rows_of_events_by_counters(events):
    """A key's seconds meet the counters as a matrix, in pieces, and a null amount is not zero."""
    _, df = events
    counters = [families.Counter(f"c{i}", "view", kind, 1000 * (i + 1)) for i, kind in enumerate(["faded", "count", "total"] * 9)]
    swept = families.sweep(df, counters, 10 * DAY, {"media": ["media_id"], "user": ["user_id"]})
    assert "MapInArrow" in swept._jdf.queryExecution().executedPlan().toString()
    nulls = df.limit(1).selectExpr("'view' event_name", "'a' media_id", "inline(array(struct(5L, cast(null as bigint)), struct(7L, 2L)))")
    nulls = nulls.withColumnsRenamed({"col1": "event_ts", "col2": "event_count"})
    only = [families.Counter("last", "view", "count", 4), families.Counter("all", "view"), families.Counter("none", "view", "count", 1)]
    got = {r.counter: r.value for r in families.sweep(nulls, only, 8, {"media": ["media_id"]}).collect()}
    assert got == {"last": 2.0, "all": 2.0}
    first = [families.Counter("first", "view", "count", 9)]
    got = families.sweep(nulls.where("event_ts = 5"), first, 8, {"media": ["media_id"]}).collect()
    assert [(r.counter, r.value) for r in got] == [("first", None)]
