"""Running totals in range partitions against a loop over all rows."""

import random

import pyarrow as pa
import pytest

from ebbline.operators import prefix

ROWS = "id long, k string, j long, t long, v long"


@pytest.fixture
def many_partitions(spark):
    names = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    names |= {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield spark
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def _sample(seed=3, n=400):
    rng = random.Random(seed)
    keys = ["hot"] * 12 + ["a", "b", None, ""]
    return [(i, rng.choice(keys), rng.choice([1, None]), rng.randrange(50), rng.choice([None, *range(-9, 9)]) if i % 3 else None) for i in range(n)]


def _order(row, keys):
    def place(v):
        return (v is not None, v if v is not None else 0)

    return [place(row[i]) for i in keys] + [row[3], row[0]]


def expected(rows, keys, before, start):
    sums, most, out = {}, {}, {}
    for row in sorted(rows, key=lambda r: _order(r, keys)):
        line, v = tuple(row[i] for i in keys), row[4]
        old = sums.get(line, start.get("s", 0)), most.get(line, start.get("m"))
        sums[line] = old[0] + (v or 0)
        most[line] = old[1] if v is None else v if old[1] is None else max(old[1], v)
        out[row[0]] = old if before else (sums[line], most[line])
    return out


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "j"]])
@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("start", [{}, {"s": 100, "m": 3}])
def test_equals_a_loop(many_partitions, keys, before, start):
    rows = _sample()
    df = many_partitions.createDataFrame(rows, ROWS).repartition(5)
    got = prefix.prefix(df, keys, ["t", "id"], {"s": ("sum", "v"), "m": ("max", "v")}, before, start)
    assert got.columns == ["id", "k", "j", "t", "v", "s", "m"]
    places = [["id", "k", "j"].index(k) for k in keys]
    assert {r.id: (r.s, r.m) for r in got.collect()} == expected(rows, places, before, start)
    assert prefix.prefix(df.limit(0), keys, ["t", "id"], {"s": ("sum", "v")}, before).count() == 0


def test_a_hot_key_spreads(many_partitions):
    df = many_partitions.range(20_000).selectExpr("id", "'hot' AS k", "0L AS t", "1L AS v")
    got = prefix.prefix(df, ["k"], ["t", "id"], {"s": ("sum", "v")})
    assert got.where("s != id + 1").isEmpty()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and plan.count("FileScan parquet") >= 2  # the window sees two rows a partition
    sizes = [r["count"] for r in many_partitions.read.parquet(_folder(got)).groupBy("_part").count().collect()]
    assert len(sizes) == 13 and max(sizes) < 2 * 20_000 / 13


def _folder(df):
    return df.inputFiles()[0].rsplit("/", 1)[0]


def test_batches_without_rows():
    schema = pa.schema([("k", pa.string()), ("v", pa.int64()), ("_head", pa.bool_()), ("_edge", pa.int8()), ("s", pa.int64()), ("_end_s", pa.int64())])

    def batch(k, v):
        return pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array(v, pa.int64())], names=["k", "v"])

    batches = [batch([], []), batch(["a"], [1]), batch([], []), batch(["a", "b"], [2, 5]), batch(["b"], [1])]
    out = pa.Table.from_batches(prefix._run(iter(batches), ["k"], {"s": ("sum", "v")}, False, schema))
    assert out["s"].to_pylist() == [1, 3, 5, 6]
    assert out["_head"].to_pylist() == [True, True, False, False]
    assert out["_edge"].to_pylist() == [1, 0, 0, 2]
