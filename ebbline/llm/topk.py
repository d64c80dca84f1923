"""Exact top-k search by inner product: Fagin's threshold algorithm over sorted lists per dimension.

Vectors and queries are dealt into blocks of bounded size; each block of vectors meets each block of queries once.
Within a block every dimension has its list, sorted; a query goes down all lists at once (from the end that its sign
makes the better one), scores what it meets in full, and stops when even a vector at the current place in every list
would fall short of the k-th score.  The blocks' best are ranked together.

Components become ``floor(scale * x)``; if one, or a score, does not fit a long, the job stops.  Vectors that are null or hold a null or non-finite
component take no part, nor do rows without id.  Shorter vectors count as filled up with zeros.  Ties go to the
smaller id.  A query does not find rows of its own id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VECTORS, QUERIES = 8192, 1024  # rows of a block, about
FIRST_DEPTH = 16


def scaled(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``(id, v)`` of the rows that take part."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~odd)
    wide = F.raise_error(F.lit("a component does not fit a long at this scale"))
    whole = F.transform(
        vector, lambda x: F.when(F.abs(scale * x.cast("double")) < 2.0**63, F.floor(scale * x.cast("double")).cast("long")).otherwise(wide)
    )
    return rows.select(F.col(key).alias("id"), whole.alias("v"))


def table(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Lists:
    """A block of vectors, rows by id, with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        up = np.argsort(self.x, axis=0, kind="stable").T
        self.lists = np.stack([up, up[:, ::-1]])  # by direction, dimension and place; ascending first

    def best(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and scores of the ``k`` best, best first, and how many rows were scored."""
        n, dims = len(self.ids), np.flatnonzero(q)
        way, weights = (q[dims] > 0).astype(int), q[dims]
        open_, every = self.ids != own, None
        rows, scores, scored, start, depth = np.zeros(0, int), np.zeros(0, q.dtype), 0, 0, FIRST_DEPTH
        while start < n:
            met = np.zeros(n, bool)
            met[self.lists[way, dims, start:depth].ravel() if len(dims) else slice(None)] = True
            met = np.flatnonzero(met & open_)
            open_[met] = False
            scored += len(met)
            if every is None and len(met) > n // 8:
                every = self.x @ q  # so many at once are cheaper without picking them
            rows = np.append(rows, met)
            scores = np.append(scores, self.x[met] @ q if every is None else every[met])
            if len(scores) > k:
                least = np.partition(scores, -k)[-k]
                rows, scores = rows[scores >= least], scores[scores >= least]
            order = np.lexsort((rows, -scores))[:k]
            rows, scores = rows[order], scores[order]
            start, depth = min(depth, n) if len(dims) else n, depth * 4
            if start < n and len(rows) == k and (self.x[self.lists[way, dims, start], dims] * weights).sum() < scores[-1]:
                break
        return rows, scores, scored


def top_k(
    rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row where ``is_query`` holds, the ``k`` best of all other rows."""
    every = scaled(rows, key, vector, scale)
    asked = scaled(rows.where(is_query), key, vector, scale)
    size, width = every.agg(F.count("id"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    queries = asked.count()
    blocks, chunks = max(1, -(-size // VECTORS)), max(1, -(-queries // QUERIES))

    def deal(n: int) -> Column:
        return F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    found_in = every.select("id", "v", deal(blocks).alias("block"), each(chunks).alias("chunk"), F.lit(False).alias("asks"))
    asking = asked.select("id", "v", each(blocks).alias("block"), deal(chunks).alias("chunk"), F.lit(True).alias("asks"))
    sides = found_in.unionByName(asking)

    def search(group: pa.Table) -> pa.Table:
        asks, ids = (np.array(group[n].to_pylist()) for n in ("asks", "id"))
        x = table(group["v"].to_pylist(), width)
        most = float(np.abs(x.astype(float)).max(initial=0)) ** 2 * max(width, 1)
        if most < 2**52:
            x = x.astype(float)  # sums stay exact, and products are faster
        asks = asks.astype(bool)
        found = [[], [], []]
        if not asks.all():
            lists = Lists(ids[~asks], x[~asks])
            for own, q in zip(ids[asks], x[asks], strict=True):
                if most >= 2**63 and (np.abs(x[~asks].astype(float) @ q.astype(float))[ids[~asks] != own] >= 2**63).any():
                    raise ValueError("a score does not fit a long at this scale")
                places, scores, _ = lists.best(own, q, k)
                found[0] += [own] * len(places)
                found[1] += lists.ids[places].tolist()
                found[2] += scores.tolist()
        names = ("query_id", "vec_id", "score")
        return pa.table({n: pa.array(np.array(c, np.int64)) for n, c in zip(names, found, strict=True)})

    best = sides.groupBy("block", "chunk").applyInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
