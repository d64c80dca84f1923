import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ebbline.functions import items
from ebbline.session import shared_dir
from ebbline.sinks.tables import UpsertTable, fan_out_writer, item_writer, write_items

COUNTS = "key string, feature_name string, window_end bigint, n bigint"


def _rows(spark, *rows):
    return spark.createDataFrame(rows, COUNTS)


def test_both_features_of_a_key_survive(spark, tmp_path):
    rows = _rows(spark, ("u", "like", 5, 1), ("u", "view", 5, 2), ("u", "view", 10, 3))
    whole = UpsertTable(str(tmp_path / "a"), ["key", "feature_name"], ["window_end"])
    whole.write(rows, 0)
    assert {(r["feature_name"], r["n"]) for r in whole.read(spark).collect()} == {("like", 1), ("view", 3)}
    by_key = UpsertTable(str(tmp_path / "b"), ["key", "feature_name"], ["window_end"], within_batch=["key"])
    by_key.write(rows, 0)
    assert [(r["feature_name"], r["n"]) for r in by_key.read(spark).collect()] == [("view", 3)]


def test_replayed_batch_and_snapshot(spark, tmp_path):
    store = UpsertTable(str(tmp_path / "t"), ["key", "feature_name"], ["window_end"])
    store.write(_rows(spark, ("u", "like", 5, 1), ("v", "like", 5, 1)), 0)
    for _ in range(2):
        store.write(_rows(spark, ("u", "like", 10, 7)), 1)
    expected = {("u", 7), ("v", 1)}
    assert {(r["key"], r["n"]) for r in store.read(spark).collect()} == expected
    newer = store.snapshot(spark, str(tmp_path / "s"))
    newer.write(_rows(spark, ("v", "like", 20, 9)), 2)
    assert {(r["key"], r["n"]) for r in newer.read(spark).collect()} == {("u", 7), ("v", 9)}
    assert [r["n"] for r in newer.get(spark, key="v").collect()] == [9]


def test_last_write_wins_even_if_stamped_earlier(spark, tmp_path):
    store = UpsertTable(str(tmp_path / "t"), ["key"], ["window_end"])
    store.write(_rows(spark, ("u", "like", 10, 1)), 0)
    store.write(_rows(spark, ("u", "like", 5, 2)), 1)
    assert store.read(spark).first()["n"] == 2


def _client(folder):
    def open_client():
        import uuid

        class Files:
            def put_items(self, batch):
                Path(folder, uuid.uuid4().hex).write_text("\n".join(batch))

        return Files()

    return open_client


def test_items_are_put_in_batches(spark, tmp_path):
    rows = spark.range(0, 95, 1, 2).select(F.col("id").cast("string").alias("word"), F.lit(1).alias("n"))
    write_items(items.word_items(rows), _client(str(tmp_path)))
    sizes = [len(f.read_text().split("\n")) for f in tmp_path.iterdir()]
    assert max(sizes) == 20 and sum(sizes) == 95


def test_two_writers_from_one_batch(spark, tmp_path):
    out = tmp_path / "items"
    out.mkdir()
    store = UpsertTable(str(tmp_path / "t"), ["key", "feature_name"], ["window_end"])

    def to_items(df):
        return items.word_items(df.select(F.col("key").alias("word"), "n"))

    both = fan_out_writer(store.write, item_writer(to_items, ["key", "feature_name"], ["window_end"], _client(str(out))))
    both(_rows(spark, ("u", "like", 5, 1), ("u", "like", 10, 2)), 0)
    assert store.read(spark).count() == 1
    put = [json.loads(line) for f in out.iterdir() for line in f.read_text().split("\n")]
    assert put == [{"word": {"S": "u"}, "count": {"N": "2"}}]


def test_shared_folder(spark):
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_items_read_back(spark):
    words = spark.createDataFrame([("a", 1)], "word string, n bigint")
    assert items.read_word_items(items.word_items(words)).collect() == words.collect()
    with pytest.raises(Exception):
        items.word_items(words, count="missing")


def _named_run(monkeypatch, name):
    from ebbline.sinks import tables

    monkeypatch.setattr(tables, "_run", lambda spark: name)


def test_a_new_run_comes_after_older_batches(spark, tmp_path, monkeypatch):
    store = UpsertTable(str(tmp_path / "t"), ["key"], ["window_end"])
    _named_run(monkeypatch, "one")
    for batch in range(3):
        store.write(_rows(spark, ("u", "like", 10, batch)), batch)
    _named_run(monkeypatch, "two")
    store.write(_rows(spark, ("u", "like", 5, 50)), 0)
    assert store.read(spark).first()["n"] == 50
    _named_run(monkeypatch, "one")  # an old batch replayed stays old
    store.write(_rows(spark, ("u", "like", 10, 2)), 2)
    assert store.read(spark).first()["n"] == 50


def test_store_does_not_grow_without_bound(spark, tmp_path):
    store = UpsertTable(str(tmp_path / "t"), ["key"], ["window_end"], compact_every=3)
    for batch in range(12):
        store.write(_rows(spark, (f"u{batch % 2}", "like", batch, batch), ("v", "like", 0, 7)), batch)
    store.write(_rows(spark, ("u1", "like", 11, 11)), 11)  # a replay after a compaction
    assert {(r["key"], r["n"]) for r in store.read(spark).collect()} == {("u0", 10), ("u1", 11), ("v", 7)}
    batches = list((tmp_path / "t").glob("*/run=*/batch_id=*"))
    assert len(batches) <= 2 * (3 + 2)
