import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import topk
from ebbline.llm.queries import QUERIES, SQL

from .conftest import SF


def brute_force(rows, k=10):
    """Ids and whole-number vectors of the rows that take part; all pairs scored."""
    part = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in part:
        if i % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in part if j != i)
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def _got(df):
    return sorted(map(tuple, df.collect()))


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    df = QUERIES["op7_topk"](spark, SF)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    assert _got(df) == sorted(con.execute(SQL["op7_topk"]).fetchall())


@pytest.mark.parametrize("sizes", [(8192, 1024), (20, 2)])
def test_odd_rows(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "VECTORS", sizes[0])
    monkeypatch.setattr(topk, "QUERIES", sizes[1])
    rng = np.random.default_rng(1)
    rows = [(i, (rng.integers(-3, 4, 5) / 8).tolist()) for i in range(0, 420, 3)]
    rows += [(1000 + i, [0.25, -0.5, 0.0, 0.125, 1.0]) for i in range(60)]
    rows += [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0]), (600, [float("nan")] * 5), (601, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 5)]
    rows += [(700, [0.0] * 5), (800, [0.5, 0.5]), (801, []), (900, [3e6, -3e6, 1e6, 0.0, 2e6])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, block string, id int")
    assert _got(topk.top_k(df, F.col("vec_id") % 100 == 0)) == brute_force(rows)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_fewer_than_k(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [0.5])], "vec_id long, embedding array<float>")
    assert _got(topk.top_k(df, F.col("vec_id") == 0)) == [(0, 1, 1, 1024 * 2048), (0, 2, 2, 1024 * 512)]


def test_stops_early():
    """Where few vectors matter, the lists need not be read to the end."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 50, (4000, 4))
    x[:30] += 900
    lists = topk.Lists(np.arange(4000), x)
    rows, scores, scored = lists.best(-1, np.array([3, 1, 0, 2]), 10)
    all_scores = x @ np.array([3, 1, 0, 2])
    assert scores.tolist() == sorted(all_scores.tolist(), reverse=True)[:10] and scored < 400
    assert len(rows) == 10


@pytest.mark.parametrize("x", [1e16, -1e300, 4e9])
def test_components_beyond_a_long_stop_the_job(spark, x):
    df = spark.createDataFrame([(0, [x]), (1, [x])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fit a long"):
        topk.top_k(df, F.col("vec_id") == 0).collect()
