"""Packing of tokenised documents into sequences of fixed length: cutting stock by column generation.

Each document is cut into whole sequences and a remainder.  Remainders fall into classes of length (``GRAIN`` tokens
wide); the histogram of the classes is the demand of a cutting-stock problem.  Its linear program is solved over
patterns: the master problem by the revised simplex method, new patterns by dynamic programming over the knapsack
that the dual prices define.  The patterns' counts are rounded down, what is left over is packed first fit, longest
first.  Documents are then ranked within their class, and a rank says which pattern, which copy and which place.

The ids of the pieces are written once, compressed, and meet their places in one join at the end.

Spark counts, ranks and assigns.  The driver sees the histogram only, whose size does not depend on the data.  Ranks
are counted inside each partition and shifted by the partitions before, so that a class may hold most rows.

Null texts count as empty; an empty document is its end token.  Equal rows are packed each.  An empty table gives an
empty result.  Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.batches import kept_by_process, map_columns, written
from ebbline.llm.bpe import read_ranks
from ebbline.session import settle, shared_dir

CAPACITY = 2048
GRAIN = 4
GAP = 1e-4  # of the linear program, at which no more patterns are priced
MAX_ROUNDS = 1000  # the solution is feasible at any time

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
SLICE = 1000  # rows whose ids are expanded at once


class TextEncoder:
    """Token ids as the tokenizer file gives them, without added tokens.

    The rank file has the same vocabulary.  Its library is several times as fast; a text that spells one of the
    tokenizer's special tokens goes to the tokenizer itself.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text).astype("<u4", copy=False)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    pattern: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    held: bool = False,
) -> DataFrame:
    """The documents' tokens and ``end_id``, cut at multiples of ``capacity``.

    ``with_ids`` adds the ids themselves, ``held`` in the small form that ``pack`` carries.
    """

    def work(batches):
        encoder = kept_by_process(
            ("encoder", tokenizer, ranks, pattern), lambda: TextEncoder(tokenizer, ranks, pattern)
        )
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.append(encoder.encode(text or ""), np.array([end_id], "<u4"))
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    row = (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids))
                    rows.append(row + (part,) * with_ids + ((compressed(part),) if held else ()))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids + ["held"] * held
            yield dict(zip(names, zip(*rows, strict=True) if rows else [[] for _ in names], strict=True))

    schema = PIECE + ", ids array<long>" * with_ids + ", held binary" * held
    return map_columns(docs.select("doc_id", "text"), work, schema)


# ---- ids in a small form -----------------------------------------------------


def compressed(ids: np.ndarray) -> bytes:
    """The width of an id in bytes, then the ids."""
    width = 2 if ids.max(initial=0) < 1 << 16 else 4
    return bytes([width]) + pa.Codec("zstd", 1).compress(ids.astype(f"<u{width}").tobytes(), asbytes=True)


def expanded(held: bytes, length: int) -> np.ndarray:
    width = held[0]
    return np.frombuffer(pa.Codec("zstd").decompress(held[1:], width * length, asbytes=True), f"<u{width}")


def _compress(batches):
    for batch in batches:
        out = {n: batch.column(n) for n in batch.schema.names if n != "ids"}
        yield out | {"held": [compressed(np.array(ids, "<u4")) for ids in batch.column("ids").to_pylist()]}


def _expand(batches):
    for whole in batches:
        for i in range(0, whole.num_rows, SLICE):
            batch = whole.slice(i, SLICE)
            pairs = zip(batch.column("held").to_pylist(), batch.column("length").to_pylist(), strict=True)
            out = {n: batch.column(n) for n in batch.schema.names if n != "held"}
            yield out | {"ids": [expanded(held, n).astype("<u4").tobytes() for held, n in pairs]}


# ---- the plan ----------------------------------------------------------------


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of ``sizes`` within ``capacity`` of the highest total price."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fitting = np.searchsorted(sizes, room, "right")
        value[room] = value[room - 1]
        if fitting:
            totals = value[room - sizes[:fitting]] + prices[:fitting]
            best = int(totals.argmax())
            if totals[best] > value[room]:
                value[room], choice[room] = totals[best], best
    pattern, room = np.zeros(len(sizes)), capacity
    while room:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(value[capacity]), pattern


def greedy_basis(demand: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """As many patterns (as columns) as sizes, independent of each other.

    Each takes the largest sizes still wanted and is used until one of them runs out; later ones lack that size.
    """
    left, open_, columns = demand.astype(float).copy(), np.ones(len(sizes), bool), []
    while open_.any():
        pattern, room = np.zeros(len(sizes)), capacity
        for k in np.flatnonzero(open_)[::-1]:
            pattern[k], room = divmod(room, sizes[k])
        inside = np.flatnonzero(pattern)
        times = left[inside] / pattern[inside]
        first = inside[times.argmin()]
        left -= pattern * times.min()
        open_[first] = False
        columns.append(pattern)
    return np.array(columns).T


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivots.  (The threads of LAPACK's inverse were seen to hang in a Spark driver.)"""
    n = len(matrix)
    work = np.concatenate([matrix, np.eye(n)], axis=1)
    for i in range(n):
        pivot = i + int(np.abs(work[i:, i]).argmax())
        work[[i, pivot]] = work[[pivot, i]]
        work[i] /= work[i, i]
        others = work[:, i].copy()
        others[i] = 0
        touched = np.flatnonzero(others)
        work[touched] -= others[touched, None] * work[i]
    return work[:, n:].copy()


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return np.einsum("ij,j->i", matrix, vector)


def column_generation(demand: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (as rows) and how often each is used, a basic solution of the linear program."""
    basis = greedy_basis(demand, sizes, capacity)
    inverse = inverted(basis)
    used = np.maximum(_times(inverse, demand), 0)
    for round_ in range(MAX_ROUNDS):
        prices = inverse.sum(axis=0)
        value, pattern = best_pattern(np.maximum(prices, 0), sizes, capacity)
        least = (prices * demand).sum() / value  # Farley's bound
        if value <= 1 + 1e-9 or used.sum() - least <= max(0.5, GAP * used.sum()):
            break
        direction = _times(inverse, pattern)
        ratios = np.full(len(used), np.inf)
        np.divide(used, direction, out=ratios, where=direction > 1e-9)
        out = int(ratios.argmin())
        used = used - ratios[out] * direction
        used[out] = ratios[out]
        used = np.maximum(used, 0)
        basis[:, out] = pattern
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        if round_ % 200 == 199:
            inverse = inverted(basis)
            used = np.maximum(_times(inverse, demand), 0)
    return basis.T.astype(int), used


def first_fit(demand: np.ndarray, sizes: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns that pack ``demand`` one by one, longest first."""
    patterns: list[np.ndarray] = []
    room = np.zeros(0, int)
    for k in range(len(sizes) - 1, -1, -1):
        for _ in range(demand[k]):
            fits = np.flatnonzero(room >= sizes[k])
            if not len(fits):
                patterns.append(np.zeros(len(sizes), int))
                room = np.append(room, capacity)
                fits = [len(room) - 1]
            patterns[fits[0]][k] += 1
            room[fits[0]] -= sizes[k]
    return patterns


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """From counts by size: ``(size, first rank, copies, first sequence, place)`` runs, and the number of sequences.

    A run's ranks fill ``copies`` places of each sequence in turn.
    """
    sizes = np.array(sorted(histogram), int)
    demand = np.array([histogram[s] for s in sizes], int)
    if not len(sizes):
        return [], 0
    patterns, used = column_generation(demand.astype(float), sizes, capacity)
    counts = np.floor(used + 1e-9).astype(int)
    while (excess := (patterns.T @ counts > demand)).any():  # rounding errors of the solver
        counts[np.flatnonzero((patterns[:, excess] > 0).any(axis=1) & (counts > 0))[0]] -= 1
    left = first_fit(demand - patterns.T @ counts, sizes, capacity)
    runs, rank, sequence = [], np.zeros(len(sizes), int), 0
    for pattern, count in [*zip(patterns, counts, strict=True), *((p, 1) for p in left)]:
        if count:
            for k in np.flatnonzero(pattern):
                runs.append((int(sizes[k]), int(rank[k]), int(pattern[k]), sequence, int(pattern[:k].sum())))
                rank[k] += pattern[k] * count
            sequence += int(count)
    return runs, sequence


# ---- the assignment ----------------------------------------------------------


def ranked(rows: DataFrame, group: str) -> DataFrame:
    """``rank`` from 0 within each group, in no particular order.

    ``rows`` must be written rows, whose partitions are the same each time they are read.
    """
    rows = rows.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = rows.groupBy(group, "_part").count().withColumn("_shift", F.coalesce(F.sum("count").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(group, "_part").orderBy("_row")) - 1
    return (
        rows.withColumn("_inside", inside)
        .join(shift.drop("count"), [group, "_part"])
        .withColumn("rank", F.col("_inside") + F.col("_shift"))
        .drop("_part", "_row", "_inside", "_shift")
    )


def pack(cut: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """``sequence_id`` and ``offset`` for each piece of ``pieces``.

    Where ``cut`` has the ids in either form, each piece comes with its ``ids``: 32 bits each, little-endian, as binary.
    """
    whole = None
    if "ids" in cut.columns:
        cut = map_columns(cut, _compress, PIECE + ", held binary")
    if "held" in cut.columns:
        whole = cut.withColumn("piece", F.monotonically_increasing_id())
        whole = written(whole, shared_dir(cut.sparkSession, "pieces"))
        cut = whole.drop("held")
    cut = settle(cut)
    size = F.when(F.col("length") < capacity, F.ceil(F.col("length") / grain)).otherwise(0).cast("int")
    cut = settle(ranked(cut.withColumn("size", size), "size"))
    histogram = {r["size"]: r["count"] for r in cut.groupBy("size").count().collect()}  # capacity / grain rows at most
    runs, sequences = plan({s: n for s, n in histogram.items() if s}, capacity // grain)
    by_size: dict[int, list] = {}
    for size_, *run in runs:
        by_size.setdefault(size_, []).append(run)
    tables = {s: np.array(r).T for s, r in by_size.items()}
    key = ["piece"] * (whole is not None)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *key]

    def work(batches):
        for batch in batches:
            sizes, ranks = (batch.column(n).to_numpy() for n in ("size", "rank"))
            sequence, place = sequences + ranks, np.zeros(len(ranks), int)
            for s in np.unique(sizes[sizes > 0]):
                first, copies, base, before = tables[s]
                at = np.flatnonzero(sizes == s)
                run = np.searchsorted(first, ranks[at], "right") - 1
                inside = ranks[at] - first[run]
                sequence[at] = base[run] + inside // copies[run]
                place[at] = before[run] + inside % copies[run]
            yield {n: batch.column(n) for n in names} | {"sequence_id": sequence, "place": place}

    placed = map_columns(cut, work, PIECE + ", piece long" * len(key) + ", sequence_id long, place long")
    before = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("place")
    if whole is None:
        return placed
    rows = placed.join(whole.select("piece", "held"), "piece").drop("piece")
    return map_columns(rows, _expand, PIECE + ", sequence_id long, offset long, ids binary")


def write_sequences(packed: DataFrame) -> DataFrame:
    """The packed ids, written: rows of ``sequence_id, offset, ids`` and where the ids come from."""
    path = shared_dir(packed.sparkSession, "sequences")
    rows = packed.select("sequence_id", "offset", "doc_id", "start", "doc_tokens", "ids")
    rows.write.options(compression="zstd", **{"parquet.block.size": 32 << 20}).parquet(path)
    return packed.sparkSession.read.parquet(path)


def digests(sequences: DataFrame) -> DataFrame:
    """The rows of written sequences, with length and CRC of the ids instead of the ids."""
    length = (F.octet_length("ids") / 4).cast("long")
    return sequences.select(
        "doc_id",
        "start",
        length.alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
