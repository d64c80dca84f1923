"""Submitted jobs, end to end."""

import pytest

from ebbline.functions import items
from ebbline.plans import submit
from ebbline.sinks.tables import TopListTable, UpsertTable
from tests.samples import SENTINEL, lifetime_of, media_lines, user_lines


def _argv(job, folder, tmp_path, *more):
    return [job, "--source", f"files:{folder}", "--checkpoint", str(tmp_path / "cp"), "--once", *more]


def test_counters(spark, write_lines, tmp_path):
    folder = write_lines([*user_lines(), SENTINEL])
    out = str(tmp_path / "out")
    submit.main(_argv("counters", folder, tmp_path, "--output", out, "--event-time", "payload"))
    table = UpsertTable(f"{out}/counters", ["feature_name", "key"], ["window_end"])
    assert {(r["feature_name"], r["key"]) for r in table.read(spark).collect()} == set(lifetime_of())
    assert items.read_counter_items(items.counter_items(table.read(spark))).count() == 3 * len(lifetime_of())


def test_candidates(spark, write_lines, tmp_path):
    end = media_lines("end", 1, 1_800_000_000)
    folder = write_lines(media_lines("reel") + media_lines("clip", 2) + end)
    out = str(tmp_path / "out")
    submit.main(_argv("candidates", folder, tmp_path, "--output", out, "--event-time", "payload"))
    best = TopListTable(f"{out}/candidates", items.TOP_VIEWS, "view", 15, 500).read(spark).first()
    assert best["name"] == "TopViews" and [c["media_id"] for c in best["candidates"]] == ["reel", "clip"]


def open_files(sink, table):
    """A client that keeps each request in a file below the folder that stands for the endpoint."""
    import uuid
    from pathlib import Path

    class Files:
        def put_items(self, batch):
            folder = Path(sink.awsEndpoint, table)
            folder.mkdir(parents=True, exist_ok=True)
            (folder / uuid.uuid4().hex).write_text("\n".join(batch))

    return Files()


def test_configured_tables_and_parameters(spark, write_lines, tmp_path):
    config = tmp_path / "job.yaml"
    config.write_text(
        "source: {datastreamName: s, awsRegion: r}\n"
        f"sink: {{tableName: counters, cgTableName: lists, awsEndpoint: {tmp_path}/kv}}\n"
    )
    # the clip's one view is older than a day when the reel's come
    folder = write_lines(media_lines("clip", 1, 1_690_000_000) + media_lines("reel", 3, 1_690_200_000) + media_lines("end", 1, 1_690_200_900))
    more = ["--config", str(config), "--client", "tests.test_jobs:open_files", "--intervals", "60", "--score-interval", "60"]
    more += ["--window", "10 seconds", "--list-size", "5", "--list-days", "1", "--event-time", "payload", "--allowed", "view"]
    submit.main(_argv("candidates", folder, tmp_path, "--output", str(tmp_path / "out"), *more))

    def stored(table, read):
        files = sorted((tmp_path / "kv" / table).iterdir(), key=lambda f: f.stat().st_mtime)
        lines = [(line,) for f in files for line in f.read_text().split("\n")]
        return read(spark.createDataFrame(lines, "item string")).collect()

    assert {(r["key"], r["decay_interval"]) for r in stored("counters", items.read_counter_items)} == {("clip", 60), ("reel", 60)}
    assert {r["media_id"] for r in stored("lists", items.read_list_items)} == {"reel"}
    with pytest.raises(ValueError, match="--config"):
        submit.build(spark, submit.arguments(_argv("counters", folder, tmp_path, "--output", "o", "--client", "a:b")))


@pytest.mark.parametrize("job", ["words", "lifetime"])
def test_words(spark, write_lines, tmp_path, job):
    folder = write_lines(["a b a"], ["a"])
    # the files' times are a second apart; a later file closes their window
    write_lines(["end"])
    import os

    late = sorted(os.listdir(folder))[-1]
    os.utime(f"{folder}/{late}", (1_800_000_000, 1_800_000_000))
    out = str(tmp_path / "out")
    submit.main(_argv(job, folder, tmp_path, "--output", out))
    if job == "words":
        assert {r["value"].split(",")[0] for r in spark.read.text(out).collect()} == {"a", "b"}
    else:
        rows = UpsertTable(out, ["word"], ["window_end"]).read(spark).collect()
        assert {r["word"]: r["total"] for r in rows} == {"a": 3, "b": 1}


def test_console_and_arguments(spark, write_lines, tmp_path, capfd):
    folder = write_lines(user_lines())
    submit.main(_argv("counters", folder, tmp_path))
    args = submit.arguments(["words", "--source", "nowhere", "--checkpoint", "c"])
    with pytest.raises(ValueError, match="unknown source"):
        submit.source_lines(spark, args)


def test_list_table_replays_a_batch(spark, tmp_path):
    from ebbline.schemas import COUNTER

    def counters(*rows):
        return spark.createDataFrame(
            [("view", m, at, {15: (15, at, v)}) for m, at, v in rows],
            f"feature_name string, key string, window_end bigint, counts map<bigint,{COUNTER}>",
        )

    table = TopListTable(str(tmp_path / "list"), "best", "view", 15, 2)
    table.write(counters(("a", 5, 3.0), ("b", 5, 2.0), ("c", 5, 1.0)), 0)
    for _ in range(2):
        table.write(counters(("a", 10, 0.5), ("c", 10, 0.1), ("c", 15, 9.0)), 1)
    assert [tuple(c) for c in table.read(spark).first()["candidates"]] == [("c", 9.0), ("b", 2.0)]
    table.write(counters(), 2)
    assert [tuple(c) for c in table.read(spark).first()["candidates"]] == [("c", 9.0), ("b", 2.0)]


@pytest.mark.parametrize("with_table", [True, False])
def test_falling_scores_bring_others_back(spark, tmp_path, with_table):
    from ebbline.schemas import COUNTER

    def counters(at, scores):
        return spark.createDataFrame(
            [("view", m, at, {15: (15, at, v)}) for m, v in scores.items()],
            f"feature_name string, key string, window_end bigint, counts map<bigint,{COUNTER}>",
        )

    table = UpsertTable(str(tmp_path / "counters"), ["feature_name", "key"], ["window_end"])
    best = TopListTable(str(tmp_path / "list"), "best", "view", 15, 1, reserve=1, counters=table if with_table else None)
    latest = {}
    batches = [{f"m{i}": 10.0 - i for i in range(6)}, {f"m{i}": 0.01 for i in range(4)}, {"m4": 0.5}, {}, {"m5": 0.2, "m0": 0.3}]
    for batch, scores in enumerate(batches):
        latest |= scores
        for _ in range(2):  # each batch replayed
            table.write(counters(batch, scores), batch)
            best.write(counters(batch, scores), batch)
        top = min(latest.items(), key=lambda c: (-c[1], c[0]))
        assert [tuple(c) for c in best.read(spark).first()["candidates"]] == [top]


def test_tasks_need_no_installed_package(tmp_path):
    """Executors have Spark and NumPy, not this library."""
    import pickle
    import subprocess
    import sys
    from functools import partial

    from pyspark import cloudpickle

    from ebbline.operators import generators
    from ebbline.streaming.processors import DecayedValues, GlobalTop

    payload = tmp_path / "task"
    things = (DecayedValues(["k"], [5]), GlobalTop(2, "latest"), partial(generators._best_pairs, k=3))
    payload.write_bytes(cloudpickle.dumps(things))
    code = f"import pickle, sys; pickle.load(open({str(payload)!r}, 'rb')); assert 'ebbline' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], cwd="/", check=True)
    assert len(pickle.loads(payload.read_bytes())) == 3
