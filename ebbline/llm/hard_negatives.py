"""Hard negatives by slots between the positives' upper limits.

An anchor's positives are its best rows of the same label.  Each positive opens a window of scores, relative to its own
score; negatives are the best rows of another label inside it.  Windows of one anchor overlap, so rows are not selected
for each window.  The windows' upper limits, best first, split all scores into disjoint slots, and a row's score lies in
one slot at most.

1. Blocks of rows meet chunks of anchors once for the positives: a block keeps an anchor's best ``k`` of its label, and
   the blocks' best are ranked together.
2. They meet once more for the negatives: a block keeps the best ``n`` of each slot (the combiner), and the blocks' are
   merged slot by slot.
3. A window takes the first ``n`` from its own slot and the slots below it, down to its lower limit.  At most ``k * n``
   rows of an anchor come here.

Components become ``floor(scale * x)``; a vector whose score could leave a long stops the job.  Rows with a null id,
label or vector, or with a null or non-finite component, take no part.  Shorter vectors count as filled up with zeros.
Ties go to the smaller id.  Equal rows (id, label and components) count once; other rows that share an id are anchors
and candidates of their own, but no row finds one of its own id.  Windows of a score of zero hold that score only,
those of negative scores are empty.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.session import settle

ROWS, ANCHORS = 8192, 1024  # rows of a block and anchors of a chunk, about
SLICE = 128  # anchors scored at a time
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a negative's score as a percentage of the positive's
SCALE = 256


def taking_part(rows: DataFrame, is_anchor: Column, key: str, vector: str, label: Column | str) -> DataFrame:
    """``id, label, v, is_anchor, row``: the rows that take part, equal ones once, with a number of the row's content."""
    label = F.col(label) if isinstance(label, str) else label
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col(key).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & ~odd)
    asks = F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")
    rows = rows.select(F.col(key).alias("id"), label.cast("long").alias("label"), F.col(vector).alias("v"), asks)
    rows = rows.groupBy("id", "label", "v").agg(F.max("is_anchor").alias("is_anchor"))
    return rows.withColumn("row", F.xxhash64("id", "label", "v"))


def whole_numbers(vectors: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as a table, of a type in which scores are exact."""
    vectors = vectors.combine_chunks()
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((len(vectors), width))
    out[np.repeat(np.arange(len(vectors)), lengths), column] = np.floor(scale * flat)
    most = np.abs(out).max(initial=0) ** 2 * max(width, 1)
    if most >= 2**63:
        raise ValueError("a score may not fit a long: components are too large for this scale")
    return out if most < 2**53 else out.astype(np.int64)


def _first(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of every owner: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, owner))
    sorted_ = owner[order]
    starts = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(order) else np.zeros(0, int)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < n]


class Block:
    """Rows and anchors of one meeting."""

    def __init__(self, group: pa.Table, width: int, scale: int):
        asks, ids, labels, rows = (group[n].combine_chunks().to_numpy(zero_copy_only=False) for n in ("asks", "id", "label", "row"))
        x = whole_numbers(group["v"], width, scale)
        self.x, self.ids, self.labels, self.rows = x[~asks], ids[~asks], labels[~asks], rows[~asks]
        self.q, self.own, self.own_labels, self.keys = x[asks], ids[asks], labels[asks], rows[asks]
        self.asks = asks

    def scores(self):
        """Anchors slice by slice: their places, scores of all rows, and which rows are others of the same label."""
        for start in range(0, len(self.own), SLICE):
            at = np.arange(start, min(start + SLICE, len(self.own)))
            same = self.own_labels[at][:, None] == self.labels[None, :]
            other = self.own[at][:, None] != self.ids[None, :]
            yield at, self.q[at] @ self.x.T, same, other

    def positives(self, k: int) -> dict[str, np.ndarray]:
        found = [[], [], [], []]
        for at, scores, same, other in self.scores():
            a, b = np.nonzero(same & other)
            best = _first(a, scores[a, b], self.ids[b], k)
            a, b = a[best], b[best]
            for out, part in zip(found, (self.own[at[a]], self.keys[at[a]], self.ids[b], scores[a, b]), strict=True):
                out.append(part)
        return _columns(("anchor_id", "anchor", "positive_id", "score"), found)

    def negatives(self, highs: np.ndarray, lows: np.ndarray, n: int) -> dict[str, np.ndarray]:
        """``highs`` (falling) and ``lows`` of the anchors' windows; unused places hold limits that no score meets."""
        found = [[], [], [], [], []]
        for at, scores, same, other in self.scores():
            wanted = ~same & other & (scores <= highs[at][:, :1]) & (scores >= lows[at].min(axis=1)[:, None])
            a, b = np.nonzero(wanted)
            score = scores[a, b]
            slot = (highs[at][a] >= score[:, None]).sum(axis=1) - 1
            best = _first(a * highs.shape[1] + slot, score, self.ids[b], n)
            a, b, slot = a[best], b[best], slot[best]
            parts = self.own[at[a]], self.keys[at[a]], slot, self.ids[b], scores[a, b]
            for out, part in zip(found, parts, strict=True):
                out.append(part)
        return _columns(("anchor_id", "anchor", "slot", "negative_id", "score"), found)


def _columns(names: tuple, found: list) -> pa.Table:
    arrays = [np.concatenate([np.zeros(0, np.int64), *f]).astype(np.int64) for f in found]
    return pa.table({n: pa.array(a, pa.int64()) for n, a in zip(names, arrays, strict=True)})


def mine(
    rows: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For every row where ``is_anchor`` holds and each of its ``positives`` best rows of the same label, the first
    ``negatives`` rows of another label that score between ``low`` and ``high`` percent of the positive.
    """
    every = settle(taking_part(rows, is_anchor, key, vector, label))
    asked = every.where("is_anchor")
    facts = F.count("id"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.count_if("is_anchor")
    size, width, anchors = every.agg(*facts).first()
    blocks, chunks = max(1, -(-size // ROWS)), max(1, -(-anchors // ANCHORS))

    def deal(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    kept = ["block", "chunk", "id", "label", "v", "row", "asks", "highs", "lows"]
    none = F.lit(None).cast("array<long>")
    found_in = every.select("*", deal(blocks).alias("block"), each(chunks).alias("chunk"), F.lit(False).alias("asks"))
    found_in = found_in.withColumn("highs", none).withColumn("lows", none).select(kept)
    asking = asked.select("*", each(blocks).alias("block"), deal(chunks).alias("chunk"), F.lit(True).alias("asks"))

    def positives_of(group: pa.Table) -> pa.Table:
        return Block(group, width, scale).positives(positives)

    sides = found_in.unionByName(asking.withColumn("highs", none).withColumn("lows", none).select(kept))
    best = sides.groupBy("block", "chunk").applyInArrow(
        positives_of, "anchor_id long, anchor long, positive_id long, score long"
    )
    order = Window.partitionBy("anchor_id", "anchor").orderBy(F.desc("score"), "positive_id")
    best = best.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives)
    # falling scores, since the place is their rank; a percentage of a whole number, rounded inwards
    limits = best.select(
        "anchor_id",
        "anchor",
        "place",
        "positive_id",
        "score",
        F.floor(F.col("score").cast("decimal(38, 0)") * high / 100).cast("long").alias("high"),
        F.ceil(F.col("score").cast("decimal(38, 0)") * low / 100).cast("long").alias("low"),
    )
    ranked = F.array_sort(F.collect_list(F.struct("place", "positive_id", "score", "high", "low")))  # ``positives`` at most
    windows = settle(limits.groupBy("anchor_id", "anchor").agg(ranked.alias("w")))

    limited = asking.join(
        windows.select(F.col("anchor_id").alias("id"), F.col("anchor").alias("row"), F.col("w.high").alias("highs"), F.col("w.low").alias("lows")),
        ["id", "row"],
    ).select(kept)

    def negatives_of(group: pa.Table) -> pa.Table:
        block = Block(group, width, scale)
        limits = [group[n].filter(pa.array(block.asks)).to_pylist() for n in ("highs", "lows")]
        # places without a positive: below every score, and above every score
        highs, lows = (np.full((len(block.own), positives), v) for v in (np.iinfo(np.int64).min, np.iinfo(np.int64).max))
        for i, (h, w) in enumerate(zip(*limits, strict=True)):
            highs[i, : len(h)], lows[i, : len(w)] = h, w
        return block.negatives(highs, lows, negatives)

    sides = found_in.unionByName(limited)
    slots = sides.groupBy("block", "chunk").applyInArrow(
        negatives_of, "anchor_id long, anchor long, slot long, negative_id long, score long"
    )
    order = Window.partitionBy("anchor_id", "anchor", "slot").orderBy(F.desc("score"), "negative_id")
    slots = slots.withColumn("place", F.row_number().over(order)).where(F.col("place") <= negatives)
    falling = F.struct((-F.col("score")).alias("down"), F.col("negative_id").alias("id"), F.col("slot").alias("slot"))
    slots = slots.groupBy("anchor_id", "anchor").agg(F.array_sort(F.collect_list(falling)).alias("found"))

    opened = windows.join(slots, ["anchor_id", "anchor"]).select("anchor_id", "found", F.explode("w").alias("w"))
    below = F.filter("found", lambda x: (x["slot"] >= F.col("w.place")) & (-x["down"] >= F.col("w.low")))
    opened = opened.select("anchor_id", "w", F.posexplode(F.slice(below, 1, negatives)).alias("at", "n"))
    return opened.select(
        "anchor_id",
        F.col("w.positive_id").alias("positive_id"),
        (F.col("at") + 1).alias("rank"),
        F.col("n.id").alias("negative_id"),
        F.col("w.score").alias("positive_score"),
        (-F.col("n.down")).alias("negative_score"),
    )
