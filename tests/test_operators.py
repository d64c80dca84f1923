"""Batch operators against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbline.functions.events import decode_events
from ebbline.operators import decay, engagement, families, generators, running, topk, windows
from tests.samples import T0, counters_of, media_lines, media_scores, user_lines, windows_of

KEYS = ["event_name", "user_id"]
EVENT = "event_name string, user_id string, creator_id string, media_id string, event_ts bigint, event_count bigint"


def _decoded(spark, lines):
    decoded = decode_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    return decoded.withColumn("event_time", windows.event_clock())


def _events(spark, rows):
    return spark.createDataFrame(rows, EVENT).withColumn("event_time", windows.event_clock())


def test_sample_counters(spark):
    counted = windows.window_counts(_decoded(spark, user_lines()), KEYS)
    got = {(r["event_name"], r["user_id"], r["window_start"] - T0): r for r in counted.collect()}
    assert {k: (r["event_ts"] - T0, r["n"]) for k, r in got.items()} == windows_of()
    rows = decay.decay_running(counted, KEYS, [5, 10, 15]).collect()
    assert len(rows) == len(counters_of())
    for r in rows:
        key = r["event_name"], r["user_id"], r["window_start"] - T0
        assert [r["counts"][d]["value"] for d in (5, 10, 15)] == pytest.approx(counters_of()[key], abs=1e-11)
        assert r["counts"][5]["last_update"] == windows_of()[key][0] + T0


def test_sample_media_scores(spark):
    keys = ["event_name", "media_id"]
    counted = windows.window_counts(_decoded(spark, media_lines()), keys)
    rows = decay.decay_running(counted, keys, [5, 10, 15]).orderBy("window_start").collect()
    assert [r["counts"][15]["value"] for r in rows] == pytest.approx(media_scores(15), abs=1e-11)
    final = decay.decay_final(counted, keys, [15]).first()
    assert final["counts"][15]["value"] == pytest.approx(media_scores(15)[-1], abs=1e-11)


def test_timestamp_policies(spark):
    rows = [("view", "u", "c", "m", t, 1) for t in (103, 101, 104)]
    e = _events(spark, rows).withColumn("arrival", F.lit(0) - F.col("event_ts"))
    got = {p: windows.window_counts(e, KEYS, ts_policy=p).first()["event_ts"] for p in windows.TS_POLICIES}
    assert got == {"min": 101, "max": 104, "first_arrival": 104}
    with pytest.raises(ValueError):
        windows.window_counts(e, KEYS, ts_policy="middle")
    with pytest.raises(ValueError):
        windows.event_clock("wall")


def _brute(points, d):
    """Running counter over (order, t, n)."""
    out, last, value = [], 0, 0.0
    for _, t, n in sorted(points):
        now = max(last, t)
        value = value * math.exp(-(now - last) / d) + n * math.exp(-(now - t) / d)
        last = now
        out.append((now, value))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 40_000), st.integers(-30_000, 2_000), st.integers(1, 50)), min_size=1, max_size=60
    ),
    st.lists(st.sampled_from([1, 5, 40, 333, 90_000]), min_size=1, max_size=3, unique=True),
)
def test_running_decay_in_any_order(spark, raw, intervals):
    points = list({o: (o, o + lag, n) for o, lag, n in raw}.values())
    df = spark.createDataFrame([("k", o, t, n) for o, t, n in points], "k string, window_start bigint, event_ts bigint, n bigint")
    got = decay.decay_running(df, ["k"], intervals, in_order=False).orderBy("window_start").collect()
    final = decay.decay_final(df, ["k"], intervals).first()["counts"]
    for d in intervals:
        expected = _brute(points, d)
        assert [r["counts"][d]["last_update"] for r in got] == [t for t, _ in expected]
        assert [r["counts"][d]["value"] for r in got] == pytest.approx([v for _, v in expected], rel=1e-9, abs=1e-100)
        assert final[d]["last_update"] == expected[-1][0]
        assert final[d]["value"] == pytest.approx(expected[-1][1], rel=1e-9, abs=1e-100)


def test_one_hot_key_over_many_slices(spark):
    rng = random.Random(1)
    times = sorted(rng.sample(range(1_700_000_000, 1_700_900_000), 3000))
    points = [(t // 5 * 5, t, rng.randint(1, 9)) for t in {t // 5: t for t in times}.values()]
    df = spark.createDataFrame([("hot", o, o + 5, t, n) for o, t, n in points], "k string, window_start bigint, window_end bigint, event_ts bigint, n bigint")
    got = decay.decay_running(df, ["k"], [5, 3600]).orderBy("window_start").collect()
    for d in (5, 3600):
        assert [r["counts"][d]["value"] for r in got] == pytest.approx([v for _, v in _brute(points, d)], rel=1e-9)
    totals = running.lifetime_counts(df, ["k"], slice_seconds=1000).orderBy("window_start").collect()
    assert [r["total"] for r in totals] == list(np.cumsum([n for _, _, n in sorted(points)]))


def test_decay_edges(spark):
    df = spark.createDataFrame([("zero", 0, 2), ("gap", 10, 5), ("gap", 10 + 746 * 5, 1), ("past", -5, 1)], "k string, event_ts bigint, n bigint")
    got = {r["k"]: r["counts"][5] for r in decay.decay_final(df, ["k"], [5]).collect()}
    assert (got["zero"]["last_update"], got["zero"]["value"]) == (0, 2.0)
    assert got["gap"]["value"] == 1.0
    assert got["past"]["last_update"] == 0 and got["past"]["value"] == pytest.approx(math.exp(-1))
    with pytest.raises(ValueError):
        decay.decay_final(df, ["k"], [5, 5])
    with pytest.raises(ValueError):
        decay.decay_final(df, ["k"], [0])


def test_final_equals_as_of(spark):
    df = spark.createDataFrame([("a", t, 1) for t in range(0, 5000, 7)], "k string, event_ts bigint, n bigint")
    final = decay.decay_final(df, ["k"], [60, 600]).first()["counts"]
    as_of = decay.decay_as_of(df, ["k"], [60, 600], final[60]["last_update"]).first()["counts"]
    assert {d: c["value"] for d, c in final.items()} == pytest.approx({d: c["value"] for d, c in as_of.items()})


def test_merge_is_order_free(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.randint(0, 5000), rng.randint(1, 4), rng.random()) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, event_ts bigint, n bigint, r double")
    parts = [
        decay.explode_counters(decay.decay_final(p, ["k"], [30, 700]))
        for p in (df.where("r < 0.2"), df.where("r between 0.2 and 0.6"), df.where("r > 0.6"))
    ]
    whole = decay.explode_counters(decay.decay_final(df, ["k"], [30, 700]))

    def values(x):
        return {(r["k"], r["decay_interval"]): (r["last_update"], pytest.approx(r["value"], rel=1e-9)) for r in x.collect()}

    one = decay.merge_counters(decay.merge_counters(parts[0], parts[1], ["k"]), parts[2], ["k"])
    two = decay.merge_counters(parts[2], decay.merge_counters(parts[1], parts[0], ["k"]), ["k"])
    assert values(one) == values(two) == values(whole)


def test_lives(spark):
    df = spark.createDataFrame(
        [("a", s, s + 5, 1) for s in (0, 50, 105, 300, 350)], "k string, window_start bigint, window_end bigint, n bigint"
    )
    for slices in (60, 10_000):
        rows = running.lives(df, ["k"], ttl=100, slice_seconds=slices).orderBy("window_start").collect()
        assert [r["life"] for r in rows] == [0, 0, 0, 1, 1]


def test_record_totals(spark):
    rows = [("w", 10), ("x", 11), ("w", 11), ("w", 200), ("x", 500)]
    df = spark.createDataFrame([(w, t, i) for i, (w, t) in enumerate(rows)], "word string, second bigint, id bigint")
    got = running.record_totals(df, ["word"], ["second", "id"]).orderBy("id").collect()
    assert [r["total"] for r in got] == [1, 1, 2, 3, 2]


@pytest.mark.parametrize("length,slide", [(3600, 300), (100, 30), (10, 10), (60, 45)])
def test_sliding_counts(spark, length, slide):
    rng = random.Random(2)
    times = [rng.randint(-500, 9000) for _ in range(200)]
    got = windows.sliding_counts(_events(spark, [("v", "u", "c", "m", t, 1) for t in times]), ["event_name"], length, slide)
    expected = Counter()
    for t in times:
        start = t // slide * slide
        while start + length > t:
            expected[start] += 1
            start -= slide
    assert {r["window_start"]: r["n"] for r in got.collect()} == dict(expected)


@pytest.mark.parametrize("span,withins", [(2000, (1, 7, 60, 5000)), (400_000, (3000, 40_000, 86_400, 100_000))])
def test_without_reaction(spark, span, withins):
    rng = random.Random(3)
    rows = [
        (rng.choice(["view", "like", "other"]), rng.choice("abc"), "c", rng.choice("xy"), rng.randint(0, span), 1)
        for _ in range(600)
    ]
    for within in withins:
        got = engagement.without_reaction(_events(spark, rows), ["user_id", "media_id"], "view", "like", within)
        expected = Counter()
        for n, u, _, m, t, _ in rows:
            if n == "view" and not any(
                r[0] == "like" and (r[1], r[3]) == (u, m) and t <= r[4] <= t + within for r in rows
            ):
                expected[u, m, t] += 1
        assert {(r["user_id"], r["media_id"], r["second"]): r["n"] for r in got.collect()} == dict(expected)


def test_family_keys_cannot_collide(spark):
    rows = [("v", "a|b", "c", "c", 1, 1), ("v", "a", "c", "b|c", 1, 1), ("v", "a\\", "c", "|b", 1, 1)]
    got = families.family_counts(_events(spark, rows), {"user_media": ["user_id", "media_id"]})
    assert got.count() == 3
    with pytest.raises(ValueError):
        families.fan_out(_events(spark, rows), {})


def test_period_counts(spark):
    rows = [("v", "u", "c", "m", t, 1) for t in (0, 50, 90, 100, 101)]
    got = engagement.period_counts(_events(spark, rows), ["media_id"], 100, {"short": 10, "long": 60}).first()
    assert (got["short"], got["long"]) == (1, 3)


def test_ratio_without_views(spark):
    got = engagement.ratios(_events(spark, [("like", "u", "c", "m", 1, 1)]), ["media_id"], "like", "view").first()
    assert (got["part"], got["whole"], got["ratio"]) == (1, 0, None)


def test_top_k_ties_and_ranks(spark):
    scored = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 3.0), ("d", 1.0)], "media_id string, score double")
    for parts in (1, 4):
        lists = topk.candidate_list(scored.repartition(parts), "best", 2)
        assert [tuple(r) for r in topk.ranked(lists).orderBy("rank").collect()] == [("best", 1, "c", 3.0), ("best", 2, "a", 2.0)]
    assert topk.top_k(scored, 10).count() == 4
    assert topk.candidate_list(scored.where("false"), "none", 2).count() == 0


def test_last_per_key_keeps_maps(spark):
    rows = [("k", 1, {1: "a"}), ("k", 2, {1: "b"}), ("j", 5, None)]
    df = spark.createDataFrame(rows, "key string, at int, m map<int,string>")
    assert sorted(topk.last_per_key(df, ["key"], ["at"]).collect(), key=lambda r: r["key"]) == [("j", 5, None), ("k", 2, {1: "b"})]


def test_creator_affinity(spark):
    rng = random.Random(5)
    creator = {f"m{i}": f"c{min(i % 7, 3)}" for i in range(120)}  # c3 owns most media
    rows = []
    for _ in range(900):
        u = rng.choice(["bot", "bot", "u1", "u2", "u3", "u4"])
        m = f"m{rng.randint(0, 119) if u == 'bot' else rng.randint(0, 40)}"
        rows.append((rng.choice(["view", "like"]), u, creator[m], m, 1, 1))
    k = 4
    views, n, seen, media = Counter(), Counter(), set(), defaultdict(set)
    for name, u, c, m, _, _ in rows:
        views[m] += name == "view"
        n[u, c] += 1
        seen.add((u, m))
        media[c].add(m)
    expected = {}
    from hashlib import md5

    for u in {u for u, _ in n}:
        options = []
        for c in {c for v, c in n if v == u}:
            unseen = [m for m in media[c] if (u, m) not in seen]
            options += [(-n[u, c], -views[m], md5(m.encode()).hexdigest()[:3], m) for m in unseen]
        for rank, (*_, m) in enumerate(sorted(options)[:k], 1):
            expected[u, rank] = m
    got = generators.creator_affinity(_events(spark, rows), "view", k).collect()
    assert {(r["user_id"], r["rank"]): r["media_id"] for r in got} == expected


@pytest.mark.parametrize("chunk,block", [(1000, 1000), (3, 17), (3, 1000), (9, 5)])
def test_nearest(spark, chunk, block):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(60, 8))
    vectors[10:30] = vectors[10]  # copies tie
    vectors[31] = 0
    queries = np.vstack([vectors[10] * 2, rng.normal(size=(9, 8))])
    v = spark.createDataFrame([(f"m{i:02d}", x.tolist()) for i, x in enumerate(vectors)], "media_id string, embedding array<double>")
    q = spark.createDataFrame([(f"u{i}", x.tolist()) for i, x in enumerate(queries)], "user_id string, embedding array<double>")
    got = generators.nearest(q, v.repartition(3), 4, chunk, block).collect()
    with np.errstate(invalid="ignore"):
        unit = np.nan_to_num(vectors / np.linalg.norm(vectors, axis=1, keepdims=True))
    cosine = np.round(queries / np.linalg.norm(queries, axis=1, keepdims=True) @ unit.T, 12)
    expected = {}
    for i, row in enumerate(cosine):
        for rank, j in enumerate(sorted(range(60), key=lambda j: (-row[j], j))[:4], 1):
            expected[f"u{i}", rank] = f"m{j:02d}"
    assert {(r["user_id"], r["rank"]): r["media_id"] for r in got} == expected
    assert generators.nearest(q.where("false"), v, 4).count() == 0
    assert generators.nearest(q, v.where("false"), 4, chunk).count() == 0


def test_few_views_is_repeatable(spark):
    rows = [("view", "u", "c", f"m{i}", 1, 1) for i in range(50) for _ in range(i % 4)]
    e = _events(spark, rows + [("like", "u", "c", "unseen", 1, 1)])
    a = generators.few_views(e, "view", 3, 10).collect()
    assert a == generators.few_views(e.repartition(5), "view", 3, 10).collect()
    assert len(a) == 10 and all(r["views"] < 3 for r in a)
    assert a != generators.few_views(e, "view", 3, 10, seed="1").collect()


def test_creators_without_a_chance_are_not_looked_up(spark):
    """A user's best come from the first creators that have enough left; equal affinity keeps all."""
    numbered = spark.createDataFrame([(c, f"{c}{i}", i) for c in "abcd" for i in range(4)], "creator_id string, media_id string, place int")
    seen = spark.createDataFrame([("u", "a", f"a{i}") for i in range(3)] + [("u", "b", "b0")], "user_id string, creator_id string, media_id string")
    affinity = spark.createDataFrame([("u", "a", 9), ("u", "b", 5), ("u", "c", 3), ("u", "d", 3)], "user_id string, creator_id string, affinity long")
    left = {k: sorted(r.creator_id for r in generators._worth_a_look(seen, numbered, affinity, k).collect()) for k in (1, 2, 4, 5)}
    assert left == {1: ["a"], 2: ["a", "b"], 4: ["a", "b"], 5: ["a", "b", "c", "d"]}
