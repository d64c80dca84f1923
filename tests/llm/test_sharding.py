import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from ebbline.llm import sharding
from ebbline.llm.queries import QUERIES

from .conftest import SF


def _gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return slots


def test_query(spark, texts):
    df = QUERIES["op1_sharding"](spark, SF)
    rows = df.collect()
    assert Counter(r.doc_id for r in rows) == Counter(list(texts))
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
    _gapless(rows)
    assert {r.grown_shard == 24 for r in rows} == {True, False}
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shards_depend_on_the_id_only(spark):
    ids = spark.range(20000).select(*[sharding.shard_of(F.col("id"), n).alias(f"s{n}") for n in (24, 25)])
    counts = Counter(r.s24 for r in ids.collect())
    assert len(counts) == 24 and max(counts.values()) < 1.2 * 20000 / 24
    moved = ids.where("s24 != s25").count()
    assert 0.8 * 20000 / 25 < moved < 1.2 * 20000 / 25 and ids.where("s24 != s25 and s25 != 24").isEmpty()


def test_records_are_shuffled(spark, documents, tmp_path):
    rows = [(i, "x" * 100) for i in range(4000)]
    path = sharding.write_shards(documents(rows), 2, str(tmp_path / "out"), bucket_bytes=20_000)
    got = sharding.read_shards(spark, path).collect()
    assert spark.read.parquet(path).select("bucket").distinct().count() >= 10
    _gapless(got)
    for shard in (0, 1):
        order = [r.doc_id for r in sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)]
        ranks = np.argsort(np.argsort(order))
        assert abs(np.corrcoef(ranks, np.arange(len(ranks)))[0, 1]) < 0.1
        assert np.mean(np.abs(np.diff(ranks))) > len(ranks) / 4


def test_shuffles_of_a_bucket_are_uniform(spark):
    """Every order of three records is about as frequent."""
    arrays = spark.range(6000).select(F.shuffle(F.array(F.lit(0), F.lit(1), F.lit(2)), F.lit(5)).alias("a"))
    counts = Counter(tuple(r.a) for r in arrays.collect())
    assert len(counts) == 6 and max(counts.values()) < 1.15 * 1000


def test_odd_rows(spark, documents, tmp_path):
    rows = [(0, None), (1, ""), (2, "é" * 70000), (3, "same"), (4, "same"), (5, "twice"), (5, "twice"), (None, "no id"), (None, None)]
    docs = documents(rows).withColumns({c: F.lit("clash") for c in ("shard", "slot", "place", "bucket", "i", "count")})
    path = sharding.write_shards(docs, 3, str(tmp_path / "odd"))
    got = sharding.read_shards(spark, path)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(rows, key=repr)
    assert {r.source for r in got.collect()} == {"s"}
    _gapless(got.collect())
    empty = sharding.write_shards(documents([]), 3, str(tmp_path / "none"))
    assert sharding.read_shards(spark, empty).count() == 0


def test_slots_do_not_depend_on_partitions(spark, documents):
    rows = [(i, f"text {i % 700}") for i in range(1000)] + [(5, "text 5")] * 3
    found = []
    for n in (1, 5, 13):
        path = sharding.write_shards(documents(rows).repartition(n).select("doc_id", "text"), 3, bucket_bytes=2000)
        found.append(sorted(map(tuple, sharding.read_shards(spark, path).select("doc_id", "text", "shard", "slot").collect())))
    assert found[0] == found[1] == found[2]
    assert sorted(r[3] for r in found[0] if r[2] == 0) == list(range(sum(r[2] == 0 for r in found[0])))


def test_clashing_names(spark, documents):
    df = documents([(i, str(i)) for i in range(50)]).withColumnsRenamed({"lang": "_shift", "source": "_records"})
    back = sharding.read_shards(spark, sharding.write_shards(df, 2))
    assert back.count() == 50 and {"_shift", "_records"} <= set(back.columns)
