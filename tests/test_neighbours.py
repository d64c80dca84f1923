"""The index of cells against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.operators import generators, neighbours


def _frame(spark, ids, vectors, name):
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, f"{name} string, embedding array<double>")


def _rows(df):
    return sorted((r.user_id, r["rank"], r.media_id, round(r.score, 9)) for r in df.collect())


def clustered(n=3000, groups=30, dim=16, spread=0.08):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(groups, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    return centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dim)) / np.sqrt(dim), centres


def test_clusters_are_told_apart(spark, tmp_path):
    """Where vectors cluster, a query scores a small part of them; the rest is ruled out, not skipped."""
    x, centres = clustered()
    vectors = _frame(spark, [f"m{i:04d}" for i in range(len(x))], x, "media_id")
    queries = _frame(spark, [f"u{i}" for i in range(20)], centres[:20] + 0.02, "user_id")
    neighbours.write_index(vectors, str(tmp_path / "index"))
    got = neighbours.nearest_indexed(spark, queries, str(tmp_path / "index"), 7)
    assert _rows(got) == _rows(generators.nearest(queries, vectors, 7))
    share = got.select("user_id", "scored").distinct().agg(F.sum("scored")).first()[0] / (20 * len(x))
    assert share < 0.15


@pytest.mark.parametrize(("cells", "block", "first"), [(1, 8192, 1), (9, 10, 1), (40, 7, 3), (5000, 3, 50)])
def test_equals_all_pairs(spark, tmp_path, cells, block, first):
    rng = np.random.default_rng(cells)
    x = rng.integers(-2, 3, (150, 4)).astype(float)  # copies, opposites and vectors without length
    vectors = _frame(spark, [f"m{i:03d}" for i in range(150)], x, "media_id")
    queries = _frame(spark, [f"u{i}" for i in range(12)], rng.integers(-2, 3, (12, 4)).astype(float), "user_id")
    neighbours.write_index(vectors, str(tmp_path / "index"), cells, block)
    for k in (1, 5, 200):
        got = neighbours.nearest_indexed(spark, queries, str(tmp_path / "index"), k, first)
        assert _rows(got) == _rows(generators.nearest(queries, vectors, k))


def test_nothing_to_find(spark, tmp_path):
    vectors = _frame(spark, ["a"], [[1.0, 0.0]], "media_id")
    queries = _frame(spark, ["u"], [[0.5, 0.5]], "user_id")
    neighbours.write_index(vectors.limit(0), str(tmp_path / "none"))
    assert neighbours.nearest_indexed(spark, queries, str(tmp_path / "none"), 3).count() == 0
    neighbours.write_index(vectors, str(tmp_path / "one"))
    assert neighbours.nearest_indexed(spark, queries.limit(0), str(tmp_path / "one"), 3).count() == 0
    assert neighbours.nearest_indexed(spark, queries, str(tmp_path / "one"), 3).count() == 1


def test_what_one_task_holds_is_bounded(spark, tmp_path, monkeypatch):
    """However many queries there are, a query goes once to a block of many cells, and a task sees a chunk of queries."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8))  # without clusters: nearly every cell is looked into
    vectors = _frame(spark, [f"m{i:03d}" for i in range(400)], x, "media_id")
    queries = _frame(spark, [f"u{i:03d}" for i in range(300)], rng.normal(size=(300, 8)), "user_id")
    path = str(tmp_path / "index")
    neighbours.write_index(vectors, path, cells=100, block=100)
    cells, written = spark.read.parquet(f"{path}/cells"), spark.read.parquet(f"{path}/vectors")
    sizes = [r["count"] for r in written.groupBy("block").count().collect()]
    assert cells.count() > 50 and len(sizes) <= 9 and max(sizes) <= 100 and sum(sizes) == 400
    monkeypatch.setattr(neighbours, "PRODUCT", 1000)
    got = neighbours.nearest_indexed(spark, queries, path, 7, chunk=40)
    assert _rows(got) == _rows(generators.nearest(queries, vectors, 7))
    widths = []
    cogroup = type(queries.groupBy("user_id")).cogroup

    def measured(self, other):
        widths.append(self._df.groupBy("chunk", "block").count().agg(F.max("count")).first()[0])
        return cogroup(self, other)

    monkeypatch.setattr(type(queries.groupBy("user_id")), "cogroup", measured)
    neighbours.nearest_indexed(spark, queries, path, 7, chunk=40).count()
    assert len(widths) == 2 and max(widths) <= 80  # chunks go by hash, so not all are equal
