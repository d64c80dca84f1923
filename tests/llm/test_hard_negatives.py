import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import hard_negatives
from ebbline.llm.queries import QUERIES, SQL

from .conftest import SF

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute_force(rows, every=50, scale=256, positives=5, negatives=3, low=50, high=95):
    """Every anchor scored with every row, every window searched by itself."""
    part = set()
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            part.add((i, label, tuple(v)))
    part = [(i, label, [math.floor(scale * x) for x in v]) for i, label, v in part]
    out = []
    for i, label, q in part:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j, other) for j, other, v in part if j != i)
        best = [(-s, j) for s, j, other in scored if other == label][:positives]
        for p, j in best:
            found = [(-s, k) for s, k, other in scored if other != label and low * p <= -100 * s <= high * p]
            out += [(i, j, r, k, p, s) for r, (s, k) in enumerate(found[:negatives], 1)]
    return sorted(out)


def _mined(df, **options):
    got = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **options)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    df = QUERIES["op12_hard_negatives"](spark, SF)
    expected = con.execute(SQL["op12_hard_negatives"])
    assert df.columns == [d[0] for d in expected.description] == COLUMNS
    assert sorted(map(tuple, df.collect())) == sorted(expected.fetchall())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = [(i, (rng.integers(-8, 24, 5) / 8).tolist(), int(rng.integers(0, 3))) for i in range(0, 400, 2)]
    out += [(1000 + i, [1.0, 0.5, -0.25, 0.125, 0.0], i % 2) for i in range(60)]  # copies: ties by id
    out += [(50, out[25][1], out[25][2]), (100, [0.5] * 5, 1), (150, out[75][1], 2)]  # repeated ids, equal and not
    out += [(2000, [0.0] * 5, 0), (2050, [-9.0] * 5, 1), (2100, [1.0, 1.0], 2), (2150, [], 2), (3000, [1.0] * 5, 9)]
    out += [(None, [1.0] * 5, 1), (4000, None, 1), (4050, [1.0] * 5, None), (4100, [None, 1.0, 1.0, 1.0, 1.0], 1)]
    out += [(4150, [float("nan")] * 5, 1), (4200, [float("inf"), 0.0, 0.0, 0.0, 0.0], 1)]
    return out + out[:5]


@pytest.mark.parametrize("sizes", [(8192, 1024, 128), (16, 2, 1)])
def test_equals_every_window_by_itself(spark, monkeypatch, rows, sizes):
    for name, value in zip(("ROWS", "ANCHORS", "SLICE"), sizes, strict=True):
        monkeypatch.setattr(hard_negatives, name, value)
    rows_ = [(i, v, label, 1, "x") for i, v, label in rows]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>, label int, row int, slot string")
    assert _mined(df) == brute_force(rows)
    options = {"positives": 2, "negatives": 5, "low": 20, "high": 110}
    assert _mined(df, **options) == brute_force(rows, **options)
    assert _mined(df.limit(0)) == []


def test_large_components(spark):
    rows = [(0, [2.0**20, 1.5], 0), (1, [2.0**20, -3.0], 0), (2, [2.0**19, 2.0**18], 1), (3, [2.0**20 * 0.95, 0.0], 1)]
    schema = "vec_id long, embedding array<double>, label int"
    assert _mined(spark.createDataFrame(rows, schema)) == brute_force(rows)
    with pytest.raises(Exception, match="may not fit a long"):
        _mined(spark.createDataFrame([(0, [1e16], 0), (1, [1e16], 0)], schema))
