"""State that begins with a backfill, and state that expires in event time."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ebbline.operators import decay, running, windows
from ebbline.plans import submit
from ebbline.sinks.tables import UpsertTable
from ebbline.sources.lines import replayed_lines, stored_lines
from ebbline.functions.events import decode_events
from ebbline.streaming import jobs
from ebbline.streaming.processors import Expiry
from tests.samples import T0
from tests.test_streaming import _events, _line, _run

KEYS = ["event_name", "user_id"]


def _table(rows, *columns):
    return sorted(tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in columns) for r in rows)


def _counted(spark, folder, **options):
    return windows.window_counts(jobs.watermarked(_events(spark, folder, 1)), KEYS, **options)


def _sample(seed, n=120, span=400):
    rng = random.Random(seed)
    times = sorted(rng.randrange(span) * rng.choice([1, 1, 1, 2]) for _ in range(n))
    return [_line(t, user=f"u{rng.randrange(6)}") for t in times]


def _batches(lines, size):
    ordered = sorted(lines, key=lambda line: json.loads(line)["eventTs"])
    return [ordered[i : i + size] for i in range(0, len(ordered), size)] + [[_line(5000, user="last")]]


@pytest.mark.parametrize("size", [7, 60])
@pytest.mark.parametrize("ttl", [20, 60])
def test_event_time_expiry_equals_lives(spark, write_lines, tmp_path, size, ttl):
    """However the input is cut into batches: a life ends when a window's end is that far from the last one's."""
    lines = _sample(ttl)
    folder = write_lines(*_batches(lines, size))
    stored = decode_events(stored_lines(spark, folder)).withColumn("event_time", windows.event_clock())
    lived = running.lives(windows.window_counts(stored, KEYS), KEYS, ttl)
    expected = running.lifetime_counts(lived, [*KEYS, "life"]).where("user_id != 'last'").collect()
    rows, _ = _run(spark, jobs.lifetime_totals(_counted(spark, folder, clocked=True), KEYS, event_ttl_s=ttl), tmp_path)
    columns = [*KEYS, "window_start", "window_end", "n", "total"]
    assert _table([r for r in rows if r.user_id != "last"], *columns) == _table(expected, *columns)

    faded = decay.explode_counters(decay.decay_running(lived, [*KEYS, "life"], [5, 10])).where("user_id != 'last'")
    counters = jobs.decayed_counters(_counted(spark, folder, clocked=True), KEYS, [5, 10], event_ttl_s=ttl)
    home = str(tmp_path / "counters")
    jobs.run_available(counters, jobs.append_table(f"{home}/rows"), f"{home}/checkpoint")
    got = decay.explode_counters(jobs.read_table(spark, f"{home}/rows")).where("user_id != 'last'")
    columns = [*KEYS, "window_start", "decay_interval", "last_update", "value"]
    assert _table(got.collect(), *columns) == _table(faded.collect(), *columns)


def test_expired_keys_leave_no_state(spark, write_lines, tmp_path):
    folder = write_lines([_line(1, user="a"), _line(2, user="b")], [_line(40, user="c")], [_line(300, user="d")], [_line(900, user="e")], [_line(2000, user="f")])
    rows, progress = _run(spark, jobs.lifetime_totals(_counted(spark, folder, clocked=True), KEYS, event_ttl_s=100), tmp_path)
    assert len(rows) == 5
    totals = [p["stateOperators"][0] for p in progress if p["stateOperators"]]  # the operator nearest the sink
    assert totals[-1]["customMetrics"].get("numDeletedStateVars", 0) >= 0
    assert totals[-1]["numRowsTotal"] <= 8  # of six keys at most the last two or so, each with its total, time and timer


def test_one_live_timer_a_key():
    class Handle:
        def __init__(self):
            self.timers, self.value = set(), None

        def getValueState(self, name, schema):
            outer = self

            class State:
                def get(self):
                    return outer.value

                def update(self, value):
                    outer.value = value

            return State()

        def registerTimer(self, at):
            self.timers.add(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    handle, expiry = Handle(), Expiry(10)
    expiry.init(handle)
    for end in (5, 5, 9, 30):
        expiry.moved(expiry.last(), end)
        assert handle.timers == {(end + 10) * 1000}
    assert expiry.over(30, 40) and not expiry.over(30, 39) and not expiry.over(None, 1)


def test_handover_equals_one_run(spark, write_lines, tmp_path):
    """A backfill's counters and totals, then a stream from there; and after a restart the checkpoint holds."""
    lines = [_line(t, user=f"u{t % 3}") for t in range(0, 100, 4)]
    early, late = lines[:13], lines[13:]  # cut between two windows
    whole = write_lines(lines, [_line(5000)], name="whole")
    rest = write_lines(late, [_line(5000)], name="rest")
    old = decode_events(stored_lines(spark, write_lines(early, name="early"))).withColumn("event_time", windows.event_clock())
    counted = windows.window_counts(old, KEYS)
    cut = T0 + 52
    expected, _ = _run(spark, jobs.lifetime_totals(_counted(spark, whole), KEYS), tmp_path)
    initial = counted.groupBy(*KEYS).agg(F.sum("n").alias("total"))
    rows, _ = _run(spark, jobs.lifetime_totals(_counted(spark, rest), KEYS, initial=initial), tmp_path)
    columns = [*KEYS, "window_start", "n", "total"]
    # the window that holds the cut is closed by both sides' rows together only in the run over all
    assert _table([r for r in rows if r.window_start >= cut], *columns) == _table([r for r in expected if r.window_start >= cut], *columns)

    home = str(tmp_path / "jobs")
    table = UpsertTable(f"{home}/backfill", ["feature_name", "key"], ["window_end"])
    before = decay.decay_running(counted, KEYS, [5, 10, 15]).withColumnsRenamed({"event_name": "feature_name", "user_id": "key"})
    table.write(before, 0)
    args = ["counters", "--source", f"files:{rest}", "--checkpoint", f"{home}/cp", "--output", f"{home}/out", "--once",
            "--event-time", "payload", "--initial", f"{home}/backfill", "--ttl-clock", "event", "--ttl-days", "7"]
    for _ in range(2):  # the second run finds its checkpoint and nothing new
        query = jobs.start(submit.build(spark, submit.arguments(args)).trigger(availableNow=True), spark)
        query.awaitTermination()
    got = UpsertTable(f"{home}/out/counters", ["feature_name", "key"], ["window_end"]).read(spark)
    all_ = decode_events(stored_lines(spark, whole)).withColumn("event_time", windows.event_clock()).where(F.col("event_ts") < T0 + 5000)
    final = decay.decay_final(windows.window_counts(all_, KEYS), KEYS, [5, 10, 15])
    columns = ["feature_name", "key", "decay_interval", "last_update", "value"]
    wanted = decay.explode_counters(final.withColumnsRenamed({"event_name": "feature_name", "user_id": "key"}))
    assert _table(decay.explode_counters(got).collect(), *columns) == _table(wanted.collect(), *columns)


def test_joined_missing_reactions_have_no_python(spark, write_lines, tmp_path):
    rng = random.Random(2)
    lines = [_line(t, rng.choice(["view", "like"]), f"u{rng.randrange(3)}") for t in sorted(rng.sample(range(300), 80))]
    folder = write_lines(*[lines[i : i + 20] for i in range(0, 80, 20)], [_line(5000, user="last")], [_line(9000, user="last")])
    events = _events(spark, folder, 1)
    joined = jobs.without_reaction_joined(events, ["user_id"], "view", "like", 10)
    home = str(tmp_path / "run")
    progress = jobs.run_available(joined, jobs.append_table(f"{home}/rows"), f"{home}/checkpoint")
    rows = [r for r in jobs.read_table(spark, f"{home}/rows").collect() if r.user_id != "last"]
    twin, _ = _run(spark, jobs.without_reaction(events, ["user_id"], "view", "like", 10), tmp_path)
    columns = ["user_id", "second", "n"]
    assert rows and _table(rows, *columns) == _table([r for r in twin if r.user_id != "last"], *columns)
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "TransformWithState" not in plan
    # once the clock is far ahead, the join's state holds the last seconds only
    join = [o for p in progress[-1:] for o in p["stateOperators"] if "Join" in o["operatorName"]]
    assert join and join[0]["numRowsTotal"] <= 2


def test_state_is_kept_by_buckets(spark, write_lines, tmp_path):
    """Many keys are few groups: a batch costs calls for each bucket, not for each key."""
    lines = [_line(t, user=f"u{t}") for t in range(60)]
    folder = write_lines(lines, [_line(5000, user="last")])
    counted = _counted(spark, folder, clocked=True)
    rows, progress = _run(spark, jobs.lifetime_totals(counted, KEYS, event_ttl_s=9000, buckets=2), tmp_path)
    assert sorted(r.user_id for r in rows) == sorted(f"u{t}" for t in range(60)) and {r.total for r in rows} == {1}
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]) <= 4
    events = _events(spark, folder, 1)
    home = str(tmp_path / "missing")
    missing = jobs.without_reaction(events, ["user_id"], "view", "like", 10_000, buckets=3)
    progress = jobs.run_available(missing, jobs.append_table(f"{home}/rows"), f"{home}/checkpoint")
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]) <= 3
