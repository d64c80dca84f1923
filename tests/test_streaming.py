"""Streams against batch twins, hand-computed samples and brute force."""

import json
import random
import time
import uuid
from collections import OrderedDict

import pytest
from pyspark.sql import functions as F

from ebbline.functions.events import allow_events, decode_events
from ebbline.operators import decay, engagement, topk, windows
from ebbline.sinks.tables import UpsertTable, to_console, to_files
from ebbline.sources.lines import replayed_lines, stored_lines
from ebbline.streaming import jobs
from ebbline.streaming.processors import BoundedTop
from tests.samples import SENTINEL, T0, counters_of, lifetime_of, media_lines, media_scores, user_lines, windows_of

KEYS = ["event_name", "user_id"]


def _run(spark, stream, tmp_path, home=None, mode="append"):
    home = home or str(tmp_path / f"run-{uuid.uuid4().hex}")
    progress = jobs.run_available(stream, jobs.append_table(f"{home}/rows"), f"{home}/checkpoint", mode)
    return jobs.read_table(spark, f"{home}/rows").collect(), progress


def _events(spark, folder, per_batch=1):
    return decode_events(replayed_lines(spark, folder, per_batch))


def _line(t, name="view", user="u", media="m"):
    return json.dumps({"eventName": name, "userId": user, "mediaId": media, "eventTs": T0 + t})


def test_sample_lifetime_counts(spark, write_lines, tmp_path):
    lines = user_lines()
    folder = write_lines(lines[:5], lines[5:], [SENTINEL])
    counted = windows.window_counts(jobs.watermarked(_events(spark, folder)), KEYS)
    rows, _ = _run(spark, jobs.lifetime_totals(counted, KEYS), tmp_path)
    last = {}
    for r in sorted(rows, key=lambda r: r["window_start"]):
        last[r["event_name"], r["user_id"]] = r["total"]
    assert last == lifetime_of()


def test_sample_counters(spark, write_lines, tmp_path):
    folder = write_lines(user_lines(), [SENTINEL])
    rows, _ = _run(spark, jobs.event_counters(_events(spark, folder), "user_id", [5, 10, 15]), tmp_path)
    got = {(r["feature_name"], r["key"], r["window_start"] - T0): r["counts"] for r in rows}
    assert set(got) == set(counters_of())
    for key, values in counters_of().items():
        assert [got[key][d]["value"] for d in (5, 10, 15)] == pytest.approx(values, abs=1e-11)
        assert got[key][10]["last_update"] == T0 + windows_of()[key][0]


@pytest.mark.parametrize("one_more,expected", [(True, {10: 1, 15: 2, 90: 1}), (False, {10: 2, 15: 1, 90: 1})])
def test_late_rows(spark, write_lines, tmp_path, one_more, expected):
    times = [12, 16, *([18] if one_more else []), 13, 90, 140]  # the watermark takes effect one batch later
    folder = write_lines(*[[_line(t)] for t in times])
    rows, progress = _run(spark, windows.window_counts(jobs.watermarked(_events(spark, folder)), KEYS), tmp_path)
    assert {r["window_start"] - T0: r["n"] for r in rows} == expected
    dropped = sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"])
    assert dropped == (1 if one_more else 0)


def test_delay_keeps_late_rows(spark, write_lines, tmp_path):
    folder = write_lines(*[[_line(t)] for t in (12, 16, 18, 13, 90, 200)])
    stream = windows.window_counts(jobs.watermarked(_events(spark, folder), "1 minute"), KEYS)
    rows, _ = _run(spark, stream, tmp_path)
    assert {r["window_start"] - T0: r["n"] for r in rows} == {10: 2, 15: 2, 90: 1}


def test_restart_goes_on_from_the_checkpoint(spark, write_lines, tmp_path):
    lines = user_lines()
    home = str(tmp_path / "restarted")

    def run():
        counters = jobs.event_counters(_events(spark, str(tmp_path / "in")), "user_id", [5, 10, 15])
        return _run(spark, counters, tmp_path, home)[0]

    write_lines(lines[:8], lines[8:])
    first = run()
    write_lines([SENTINEL])
    rows = run()
    assert len(rows) > len(first)
    got = {(r["feature_name"], r["key"], r["window_start"] - T0): r["counts"][15]["value"] for r in rows}
    assert len(rows) == len(got)
    assert got == pytest.approx({k: v[-1] for k, v in counters_of().items()}, abs=1e-11)


def _traffic(n, seed, keys=6):
    rng = random.Random(seed)
    times = sorted(rng.randint(0, 400) for _ in range(n))
    return [_line(t, rng.choice(["view", "like"]), f"u{rng.randint(0, keys)}", f"m{rng.randint(0, keys)}") for t in times]


def test_stream_equals_batch(spark, write_lines, tmp_path):
    lines = _traffic(300, 1)
    end = [_line(2000)]
    folder = write_lines(lines[:100], lines[100:180], lines[180:], end)
    stream = jobs.event_counters(_events(spark, folder), "media_id", [5, 60])
    rows, _ = _run(spark, stream, tmp_path)
    keys = ["event_name", "media_id"]
    static = decode_events(stored_lines(spark, folder)).where(F.col("event_ts") < T0 + 2000)
    static = windows.window_counts(static.withColumn("event_time", windows.event_clock()), keys)
    batch = decay.decay_running(static, keys, [5, 60]).collect()
    for d in (5, 60):
        expected = {(r["event_name"], r["media_id"], r["window_start"]): r["counts"][d]["value"] for r in batch}
        assert {(r["feature_name"], r["key"], r["window_start"]): r["counts"][d]["value"] for r in rows} == pytest.approx(
            expected, rel=1e-9
        )


def test_slices_equal_batch_in_any_order(spark, write_lines, tmp_path):
    lines = _traffic(200, 2)
    random.Random(9).shuffle(lines)
    folder = write_lines(lines[:60], lines[60:120], lines[120:])
    home = str(tmp_path / "slices")
    store = UpsertTable(f"{home}/rows", ["feature_name", "key", "slice"], ["last_ts"])
    jobs.run_available(jobs.counter_slices(_events(spark, folder), "media_id", [5, 60]), store.write, f"{home}/cp", "update")
    keys = ["event_name", "media_id"]
    batch = decay.decay_final(decode_events(stored_lines(spark, folder)), keys, [5, 60], amount="event_count").collect()
    got = decay.merge_slices(store.read(spark), ["feature_name", "key"], [5, 60]).collect()
    for d in (5, 60):
        assert {(r["feature_name"], r["key"]): r["counts"][d]["value"] for r in got} == pytest.approx(
            {(r["event_name"], r["media_id"]): r["counts"][d]["value"] for r in batch}, rel=1e-9
        )


def test_latest_list_equals_batch(spark, write_lines, tmp_path):
    lines = _traffic(400, 3, keys=25)
    folder = write_lines(lines[:150], lines[150:300], lines[300:], [_line(2000, media="end")])
    counters = jobs.event_counters(_events(spark, folder), "media_id", [5, 60])
    home = str(tmp_path / "lists")
    store = UpsertTable(f"{home}/rows", ["name"], ["updated"])
    lists = jobs.top_lists(counters, "best", "view", 60, 5, buckets=3, reserve=100)
    jobs.run_available(lists, store.write, f"{home}/cp")
    got = [tuple(c)[:2] for c in store.read(spark).first()["candidates"]]
    keys = ["feature_name", "key"]
    static = decode_events(stored_lines(spark, folder)).where(F.col("event_ts") < T0 + 2000)
    static = windows.window_counts(static.withColumn("event_time", windows.event_clock()), ["event_name", "media_id"])
    final = decay.decay_final(static.withColumnsRenamed({"event_name": "feature_name", "media_id": "key"}), keys, [60])
    batch = topk.top_k(topk.scores(final, "view", 60), 5).collect()
    assert [m for m, _ in got] == [r["media_id"] for r in batch]
    assert [s for _, s in got] == pytest.approx([r["score"] for r in batch], rel=1e-9)


@pytest.mark.parametrize("reserve", [5, 100])
def test_tops_of_buckets_equal_batch(spark, write_lines, tmp_path, reserve):
    """Counters and tops in one state, with falling scores; and the list merged from the stored tops."""
    lines = _traffic(400, 5, keys=25)
    folder = write_lines(lines[:150], lines[150:300], lines[300:], [_line(2000, media="end")])
    counted = windows.window_counts(jobs.watermarked(_events(spark, folder)), ["event_name", "media_id"])
    store = UpsertTable(str(tmp_path / "rows"), ["bucket"], ["bucket"])
    tops = jobs.counted_tops(counted, "media_id", "view", 60, 5, buckets=3, reserve=reserve)
    jobs.run_available(tops, store.write, str(tmp_path / "cp"))
    got = topk.ranked(topk.merged(store.read(spark), "best", 5)).orderBy("rank").collect()
    static = decode_events(stored_lines(spark, folder)).where(F.col("event_ts") < T0 + 2000)
    static = windows.window_counts(static.withColumn("event_time", windows.event_clock()), ["event_name", "media_id"])
    final = decay.decay_final(static.withColumnsRenamed({"event_name": "feature_name", "media_id": "key"}), ["feature_name", "key"], [60])
    batch = topk.top_k(topk.scores(final, "view", 60), 5).collect()
    assert [r.media_id for r in got] == [r.media_id for r in batch]
    assert [r.score for r in got] == pytest.approx([r.score for r in batch], rel=1e-9)


def test_latest_list_is_exact_without_reserve(spark, write_lines, tmp_path):
    """Six ids, the first four fall: the fifth leads, though the list had forgotten it."""
    first = [_line(0, media=f"m{i}") for i in range(6) for _ in range(10 - i)]
    falling = [_line(200, media=f"m{i}") for i in range(4)]
    folder = write_lines(first, falling, [_line(400, media="m0")], [_line(900, name="like")])
    counters = jobs.event_counters(_events(spark, folder), "media_id", [15])
    rows, _ = _run(spark, jobs.top_lists(counters, "best", "view", 15, 1, buckets=1, reserve=1), tmp_path)
    assert {(r["candidates"][0]["media_id"], r["candidates"][0]["score"]) for r in rows} == {("m0", 10.0), ("m4", 6.0)}


def test_improvements_list_keeps_risen_scores(spark, write_lines, tmp_path):
    """A score that fell is not reported in this mode, so the list keeps the higher one."""
    a = [_line(t, media="a") for t in (0, 1, 2)]  # one window: score 3
    later = [_line(100, media="a"), _line(100, media="b"), _line(101, media="b")]  # a falls, b is 2
    folder = write_lines(a, later, [_line(500, name="like")])
    results = {}
    for mode in jobs.MODES:
        counters = jobs.event_counters(_events(spark, folder), "media_id", [15])
        lists = jobs.top_lists(counters, "best", "view", 15, 2, buckets=1, mode=mode)
        rows, _ = _run(spark, lists, tmp_path)
        last = max(rows, key=lambda r: (r["updated"], len(r["candidates"])))
        results[mode] = [(c["media_id"], round(c["score"], 2)) for c in last["candidates"]]
    assert results == {"improvements": [("a", 3.0), ("b", 2.0)], "latest": [("b", 2.0), ("a", 1.0)]}
    with pytest.raises(ValueError):
        jobs.top_lists(counters, "best", "view", 15, 2, mode="all")


def test_media_scores_reach_the_list(spark, write_lines, tmp_path):
    folder = write_lines(media_lines(), media_lines("last", 1, T0 + 9000))
    counters = jobs.event_counters(allow_events(_events(spark, folder), ["view", "like"]), "media_id", [5, 10, 15])
    rows, _ = _run(spark, jobs.top_lists(counters, "TopViews", "view", 15, 2), tmp_path)
    last = max(rows, key=lambda r: r["updated"])
    assert [c["media_id"] for c in last["candidates"]] == ["reel"]
    assert last["candidates"][0]["score"] == pytest.approx(media_scores(15)[-1], abs=1e-11)


class _Plain:
    """The list's rules spelled out with a scan."""

    def __init__(self, size):
        self.size, self.scores = size, OrderedDict()

    def put(self, media, score):
        old = self.scores.pop(media, None)
        self.scores[media] = score
        while len(self.scores) > self.size:
            del self.scores[min(self.scores, key=self.scores.get)]
        return media in self.scores and (old is None or score > old)

    def best(self):
        return sorted(self.scores.items(), key=lambda e: -e[1])


def test_bounded_top():
    rng = random.Random(11)
    for size in (1, 2, 5):
        top, plain = BoundedTop(size), _Plain(size)
        for _ in range(500):
            media, score = f"m{rng.randint(0, 9)}", float(rng.randint(0, 6))
            assert top.put(media, score, 0) == plain.put(media, score)
            assert [(m, s) for m, s, _ in top.best()] == plain.best()


def test_without_reaction(spark, write_lines, tmp_path):
    rng = random.Random(5)
    # midnight, where slices meet, is at T0 + 4600
    lines = [
        _line(4300 + t, rng.choice(["view", "like", "like"]), f"u{rng.randint(0, 3)}", f"m{rng.randint(0, 3)}")
        for t in sorted(rng.randint(0, 600) for _ in range(250))
    ]
    folder = write_lines(lines[:80], lines[80:200], lines[200:], [_line(9000, user="end")], [_line(9001, user="end")])
    keys = ["user_id", "media_id"]
    stream = jobs.without_reaction(_events(spark, folder), keys, "view", "like", 30, delay="10 seconds")
    rows, _ = _run(spark, stream, tmp_path)
    static = decode_events(stored_lines(spark, folder)).where(F.col("event_ts") < T0 + 9000)
    batch = engagement.without_reaction(static, keys, "view", "like", 30).collect()
    assert sorted(tuple(r) for r in rows) == sorted(tuple(r) for r in batch)
    assert len(rows) > 10


def test_state_expires(spark, write_lines, tmp_path):
    """With a time to live the query runs on; a key's state is gone once it is over."""
    folder = write_lines([_line(0)], [_line(100)])
    counted = windows.window_counts(jobs.watermarked(_events(spark, folder)), KEYS)
    totals = jobs.lifetime_totals(counted, KEYS, ttl_ms=4000)
    home = str(tmp_path / "ttl")
    query = (
        totals.writeStream.foreachBatch(jobs.append_table(f"{home}/rows"))
        .option("checkpointLocation", f"{home}/cp")
        .trigger(processingTime="500 milliseconds")
        .start()
    )

    def rows():
        try:
            return {r["window_start"] - T0: r["total"] for r in jobs.read_table(spark, f"{home}/rows").collect()}
        except Exception:
            return {}

    def wait(n):
        until = time.time() + 60
        while len(rows()) < n and time.time() < until:
            time.sleep(0.3)

    try:
        wait(1)
        time.sleep(6)
        write_lines([_line(200)], [_line(300)])
        wait(3)
        got = rows()
    finally:
        query.stop()
    assert got[0] == 1 and got[100] == 1  # the second window closed after the first state had expired
    assert jobs.ttl_millis() == 7 * 86_400_000 and jobs.ttl_millis(None) is None


def test_word_jobs(spark, write_lines, tmp_path):
    folder = write_lines(["Hello, hello!", "world"], ["hello"])
    home = str(tmp_path / "words")
    store = UpsertTable(f"{home}/rows", ["word"], ["n"])
    jobs.run_available(jobs.word_totals(replayed_lines(spark, folder, 1)), store.write, f"{home}/cp", "update")
    assert {r["word"]: r["n"] for r in store.read(spark).collect()} == {"hello": 3, "world": 1}
    # words per window of the files' time, to text files
    folder = write_lines(["late"], ["later"], name="in")
    windowed = jobs.word_windows(replayed_lines(spark, folder, 1), "1 second")
    query = to_files(windowed, f"{home}/out", f"{home}/cp2").trigger(availableNow=True).start()
    query.awaitTermination()
    lines = {r["value"] for r in spark.read.text(f"{home}/out").collect()}
    assert any(line.startswith("hello,") and line.endswith(",2") for line in lines)
    console = to_console(jobs.word_totals(replayed_lines(spark, folder)), f"{home}/cp3", "complete")
    query = console.trigger(availableNow=True).start()
    query.awaitTermination()
