"""Exact nearest neighbours by cosine over an index of cells.

Vectors belong to the nearest of some centres, drawn from them by hash.  A cell knows the greatest angle between its
centre and a vector, its radius, and every vector its own angle.  Angles obey the triangle inequality, so a vector in a
cell is at least ``angle(query, centre) - radius`` away from a query, and at least the difference of both angles to the
centre.  A query looks into its nearest cells first; the k-th angle found rules out cells and vectors, and the rest is
scored.  So results are those of comparing everything; how much is compared depends on how the vectors cluster.

The index is written once.  Small cells share a block with cells nearby and a cell of many vectors is cut into blocks,
so a block has about ``BLOCK`` vectors at most.  Queries meet blocks in chunks: a task holds one block and one chunk, and a
query is sent once to a block, however many of its cells it looks into.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.operators.topk import top_k_per
from ebbline.session import settle

# executors get these functions with the query and need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 8192  # vectors of a block, about
CHUNK = 8192  # queries that meet a block at once, about
PRODUCT = 1 << 21  # cosines held at once
MOST_CELLS = 4096  # centres are broadcast: at most so many
SLACK = 1e-7  # angles are computed; a bound must be passed by more than this

INDEXED = "media_id string, embedding array<double>, cell int, angle double"
FOUND = "user_id string, media_id string, score double, scored bigint"


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one width as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) % max(1, len(column)):
        raise ValueError("vectors must be of one width")
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _lists(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _slices(n: int, width: int) -> Iterator[slice]:
    """Slices of ``n`` rows, so that a slice by ``width`` columns has ``PRODUCT`` numbers at most."""
    step = max(1, PRODUCT // max(1, width))
    return (slice(i, min(i + step, n)) for i in range(0, n, step))


def _blocks(sizes: np.ndarray, centres: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The first block of each cell, and over how many a cell is spread; cells that share one follow on an axis."""
    wide = centres - centres.mean(axis=0) if len(centres) else centres
    along = wide @ np.linalg.eigh(wide.T @ wide)[1][:, -1] if len(centres) else np.zeros(0)
    first, parts, number, room = np.zeros(len(sizes), int), -(-sizes // block), 0, 0
    for i in np.argsort(along, kind="stable"):
        if sizes[i] > block:
            first[i], number = number, number + parts[i]
            room = 0
            continue
        if sizes[i] > room:
            number, room = number + 1, block
        first[i], room = number - 1, room - sizes[i]
    return first, parts


def write_index(vectors: DataFrame, path: str, cells: int | None = None, block: int = BLOCK) -> None:
    """The index of ``vectors`` (``media_id``, ``embedding``, all of one width) in a folder every executor can reach.

    ``cells`` is the square root of their number unless given, and ``MOST_CELLS`` at most.  A vector without length
    belongs to a cell like others; its cosine with anything is 0.
    """
    spark = vectors.sparkSession
    vectors = vectors.select("media_id", "embedding").where("media_id is not null and embedding is not null")
    size = vectors.count()
    wanted = max(1, min(cells or int(size**0.5), MOST_CELLS))
    drawn = vectors.orderBy(F.xxhash64("media_id"), "media_id").limit(wanted).collect()  # MOST_CELLS at most
    centres = np.unique(_unit(np.array([r["embedding"] for r in drawn], np.float64).reshape(len(drawn), -1 if drawn else 1)), axis=0)
    held = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column(1))
            for some in _slices(len(m), len(held.value)):
                cosines = _unit(m[some]) @ held.value.T
                best = cosines.argmax(axis=1)
                angle = _angles(cosines[np.arange(len(best)), best])
                ids = batch.column(0).slice(some.start, len(best))
                columns = [ids, _lists(m[some]), pa.array(best, pa.int32()), pa.array(angle)]
                yield pa.RecordBatch.from_arrays(columns, ["media_id", "embedding", "cell", "angle"])

    placed = vectors.mapInArrow(assign, INDEXED) if size else spark.createDataFrame([], INDEXED)
    placed.write.mode("overwrite").parquet(f"{path}/placed")
    placed = spark.read.parquet(f"{path}/placed")
    facts = placed.groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("size"))
    facts = sorted(facts.collect(), key=lambda r: r["cell"])  # MOST_CELLS rows at most
    own = centres[[r["cell"] for r in facts]]
    first, parts = _blocks(np.array([r["size"] for r in facts], int), own, block)
    rows = [
        (r["cell"], [float(x) for x in c], r["radius"], int(b), int(n))
        for r, c, b, n in zip(facts, own, first, parts, strict=True)
    ]
    cell = spark.createDataFrame(rows, "cell int, centre array<double>, radius double, first int, blocks int")
    cell.coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")  # a row for each cell
    blocks = placed.join(F.broadcast(cell.select("cell", "first", "blocks")), "cell")
    part = F.pmod(F.xxhash64("media_id"), F.col("blocks"))
    blocks = blocks.withColumn("block", (F.col("first") + part).cast("int")).drop("first", "blocks")
    blocks.repartition("block").sortWithinPartitions("block").write.mode("overwrite").parquet(f"{path}/vectors")


def nearest_indexed(
    spark: SparkSession, queries: DataFrame, path: str, k: int, first: int = 4, chunk: int = CHUNK
) -> DataFrame:
    """The ``k`` vectors of highest cosine to each query (``user_id``, ``embedding``), and how many were ``scored``.

    ``first`` cells are looked into before the others are ruled out.  Ties go by id.
    """
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").toArrow()  # MOST_CELLS rows at most
    vectors = spark.read.parquet(f"{path}/vectors")
    numbers = (cells[n].to_numpy() for n in ("cell", "radius", "first", "blocks"))
    held = spark.sparkContext.broadcast((*numbers, _unit(_matrix(cells["centre"]))))

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cells, by their places, that each query looks into first."""
        number, radius, _, _, centres = held.value
        for batch in batches:
            m = _matrix(batch.column(1))
            for some in _slices(len(m) if len(number) else 0, len(number)):
                lower = _angles(_unit(m[some]) @ centres.T) - radius[None, :]
                firsts = np.argsort(lower, axis=1, kind="stable")[:, :first].astype(np.int32)
                columns = [batch.column(0).slice(some.start, len(lower)), _lists(m[some]), _lists(firsts)]
                yield pa.RecordBatch.from_arrays(columns, ["user_id", "embedding", "firsts"])

    planned = queries.select("user_id", "embedding").mapInArrow(plan, "user_id string, embedding array<double>, firsts array<int>")
    queries = settle(planned)
    chunks = max(1, -(-queries.count() // chunk))

    def visits(asked: DataFrame, later: bool) -> DataFrame:
        """A row for each block that a query looks into, with its cells there: the first, or those the k-th angle leaves."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, radius, start, parts, centres = held.value
            most = int((start + parts).max()) if len(number) else 1
            for batch in batches:
                m, kth = _matrix(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
                firsts = _matrix(batch.column(3)).astype(int)
                # a slice's rows, each with a vector, stay few too
                for some in _slices(len(m), max(len(number), most * m.shape[1])):
                    chosen = np.zeros((some.stop - some.start, len(number)), bool)
                    np.put_along_axis(chosen, firsts[some], True, axis=1)
                    if later:
                        lower = _angles(_unit(m[some]) @ centres.T) - radius[None, :]
                        chosen = ~chosen & (lower <= kth[some, None] + SLACK)
                    q, c = np.nonzero(chosen)
                    at = np.repeat(np.arange(len(q)), parts[c])
                    block = start[c][at] + np.arange(len(at)) - np.repeat(np.cumsum(parts[c]) - parts[c], parts[c])
                    q, c = q[at], c[at]
                    order = np.lexsort((c, block, q))
                    q, c, block = q[order], c[order], block[order]
                    begins = np.flatnonzero(np.append(True, (q[1:] != q[:-1]) | (block[1:] != block[:-1]))[: len(q)])
                    offsets = pa.array(np.append(begins, len(q)), pa.int32())
                    q, block = q[begins] + some.start, block[begins]
                    columns = [batch.column(0).take(pa.array(q)), _lists(m[q]), pa.array(kth[q])]
                    columns += [pa.ListArray.from_arrays(offsets, pa.array(c, pa.int32())), pa.array(block, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, ["user_id", "embedding", "kth", "cells", "block"])

        schema = "user_id string, embedding array<double>, kth double, cells array<int>, block int"
        return asked.select("user_id", "embedding", "kth", "firsts").mapInArrow(run, schema)

    def look(asked: pa.Table, block: pa.Table) -> pa.Table:
        out = {"user_id": [], "media_id": [], "score": [], "scored": []}
        if asked.num_rows and block.num_rows:
            number, _, _, _, centres = held.value
            block = block.sort_by("media_id")
            ids, own = block["media_id"].to_pylist(), block["angle"].to_numpy()
            x = _unit(_matrix(block["embedding"]))
            here, of = np.unique(np.searchsorted(number, block["cell"].to_numpy()), return_inverse=True)
            lists = asked["cells"].combine_chunks()
            sizes = lists.value_lengths().to_numpy()
            ends, cell = np.cumsum(sizes), lists.flatten().to_numpy()
            order = np.argsort(cell[ends - sizes], kind="stable")  # queries of the same cells follow each other
            q, users, kths = _unit(_matrix(asked["embedding"])), asked["user_id"].to_pylist(), asked["kth"].to_numpy()
            for some in _slices(len(order), len(ids)):
                rows = order[some]
                wanted = np.zeros((len(rows), len(number)), bool)
                for i, n in enumerate(rows):
                    wanted[i, cell[ends[n] - sizes[n] : ends[n]]] = True
                to_centre = _angles(q[rows] @ centres[here].T)
                near = wanted[:, here][:, of] & (np.abs(own - to_centre[:, of]) <= kths[rows, None] + SLACK)
                columns = np.flatnonzero(near.any(axis=0))
                near = near[:, columns]
                cosine = np.round(q[rows] @ x[columns].T, 12)  # copies of a vector must tie exactly
                for i, n in enumerate(rows):
                    among = np.flatnonzero(near[i])
                    found = cosine[i, among]
                    if len(among) > k:  # all that tie with the k-th
                        among = among[found >= -np.partition(-found, k - 1)[k - 1]]
                        found = cosine[i, among]
                    best = np.lexsort((among, -found))[:k]
                    out["user_id"] += [users[n]] * (len(best) + 1)
                    out["media_id"] += [*(ids[j] for j in columns[among[best]]), None]  # the last row only counts
                    out["score"] += [*found[best].tolist(), None]
                    out["scored"] += [0] * len(best) + [int(near[i].sum())]
        kinds = {"user_id": pa.string(), "media_id": pa.string(), "score": pa.float64(), "scored": pa.int64()}
        return pa.table({n: pa.array(v, kinds[n]) for n, v in out.items()})

    def found(asked: DataFrame) -> DataFrame:
        asked = asked.withColumn("chunk", F.pmod(F.xxhash64("user_id"), F.lit(chunks)).cast("int"))
        copies = vectors.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        meeting = asked.groupBy("chunk", "block").cogroup(copies.groupBy("chunk", "block"))
        return meeting.applyInArrow(look, FOUND)

    early = settle(found(visits(queries.withColumn("kth", F.lit(float(np.pi))), later=False)))
    order = [F.col("score").desc(), F.col("media_id")]
    best = top_k_per(early.where("media_id is not null"), ["user_id"], k, order)
    kth = best.groupBy("user_id").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    angle = F.when(F.col("n") == k, F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "score"))))
    asked = queries.join(kth.select("user_id", angle.alias("kth")), "user_id", "left")
    late = found(visits(asked.withColumn("kth", F.coalesce("kth", F.lit(float(np.pi)))), later=True))
    every = early.unionByName(late).withColumn("scored", F.sum("scored").over(Window.partitionBy("user_id")))
    top = top_k_per(every.where("media_id is not null"), ["user_id"], k, order)
    return top.select("user_id", "rank", "media_id", "score", "scored")
