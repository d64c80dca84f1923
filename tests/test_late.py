"""Late rows against a loop, in one table and over many batches."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from ebbline.operators import late
from ebbline.plans import submit
from ebbline.streaming import jobs
from tests.test_streaming import _events, _line

SCHEMA = "event_id long, arrival long, event_ts long, event_count long"
# minutes of events that come out of order, in the order of their arrival
MINUTES = [0, 1, 2, -1, 3, 0, 5]


def loop(rows, length, delay):
    """Ids of late rows: the window had closed by the greatest time before."""
    clock, out = None, []
    for i, _, ts, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        if ts is None:
            continue
        if clock is not None and ts // length * length + length <= clock - delay:
            out.append(i)
        clock = ts if clock is None else max(clock, ts)
    return sorted(out)


def _late(marked):
    return sorted(r.event_id for r in marked.where("late").collect())


@pytest.mark.parametrize("delay,expected", [(0, [3, 5]), (60, [3, 5]), (120, [3, 5]), (121, [])])
def test_seven_events_out_of_order(spark, delay, expected):
    rows = [(i, i, 60 * m, 1) for i, m in enumerate(MINUTES)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _late(late.marked(df, 60, delay)) == loop(rows, 60, delay) == expected
    # every event below the greatest time before it: windows of one second, each event in its own
    assert _late(late.marked(df, 1, 0)) == [3, 5]


@pytest.mark.parametrize("length,delay", [(5, 0), (60, 30), (7, 100)])
def test_equals_a_loop(spark, length, delay):
    rng = random.Random(length)
    rows = [(i, rng.randrange(80), rng.choice([None, *range(-200, 200)]), 1) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    marked = late.marked(df, length, delay)
    assert _late(marked) == loop(rows, length, delay)
    assert marked.columns == [*df.columns, "window_start", "late"]
    counted = late.counted_in_time(marked, []).agg(F.sum("n").alias("n"), F.sum("n_late").alias("n_late")).first()
    assert (counted.n, counted.n_late) == (500 - len(loop(rows, length, delay)), len(loop(rows, length, delay)))
    assert late.marked(df.limit(0), length, delay).count() == 0


@pytest.mark.parametrize("batches", [1, 4, 9])
def test_batches_do_not_matter(spark, tmp_path, batches):
    rng = random.Random(11)
    rows = [(i, i // 3, rng.randrange(400), 1) for i in range(300)]
    home = f"{tmp_path}/{uuid.uuid4().hex}"
    split = late.LateSplit(f"{home}/clock", 60, jobs.append_table(f"{home}/late"), jobs.append_table(f"{home}/in"), delay=45)
    size = -(-len(rows) // batches)
    for b in range(batches):
        part = spark.createDataFrame(rows[b * size : (b + 1) * size], SCHEMA)
        for _ in range(1 + (b == 2)):  # one batch is replayed
            split.write(part, b)
    found = sorted(r.event_id for r in jobs.read_table(spark, f"{home}/late").collect())
    assert found == loop(rows, 60, 45)
    assert jobs.read_table(spark, f"{home}/in").count() == len(rows) - len(found)
    counts = split.counts(spark).agg(F.sum("n"), F.sum("n_late")).first()
    assert tuple(counts) == (len(rows), len(found))


def test_job_counts_late_events(spark, write_lines, tmp_path):
    folder = write_lines(*[[_line(60 * m)] for m in MINUTES])
    args = submit.arguments(
        ["late", "--source", f"files:{folder}", "--checkpoint", str(tmp_path / "cp"), "--output", str(tmp_path / "out"),
         "--files-per-batch", "1", "--window", "1 minute", "--event-time", "payload", "--once"]
    )
    query = jobs.start(submit.build(spark, args).trigger(availableNow=True), spark)
    query.awaitTermination()
    found = jobs.read_table(spark, str(tmp_path / "out" / "late")).orderBy("event_ts").collect()
    base = _events(spark, folder).isStreaming and min(r.event_ts for r in found)
    assert [r.event_ts - base for r in found] == [0, 60]
    batches = spark.read.parquet(str(tmp_path / "out" / "batches"))
    assert batches.agg(F.sum("n"), F.sum("n_late")).first()[:] == (len(MINUTES), 2)
    assert late.seconds("5 minutes") == 300 and late.seconds("1 day") == 86_400
