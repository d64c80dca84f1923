"""Near-duplicates by MinHash banding of fixed depth, links confirmed on full shingle sets.

1. Every text gives its set of word shingles, a fingerprint of the set, and one label per tree: the MinHash values
   of the tree's own hash functions.  Equal sets fall together at once.
2. Sets whose whole labels, of five values, agree in some tree are candidates of each other; their connected
   components are regions.  With 32 trees of depth 5, a pair at the threshold of 0.8 stays apart in all trees with
   probability (1 - 0.8^5)^32 < 4e-6.
3. A region of at most ``BLOCK`` sets is compared whole.  A larger one is sorted by a tree's full label and cut into
   blocks, so that a dense region is compared among neighbours with long common prefixes, a sparse one at shorter
   ones.  This is done in the order of several trees.
4. Large regions that are still more than one component go through the n-gram join (``ngram_join``), which compares
   what shares enough of its rarest shingles: all that can be similar, and little of what only has a template in
   common.  So no pair within a region goes unseen unless links join it already.

Sets move only where there are candidates; blocks are bounded, whatever the size of a group of copies.  Words are
split at ASCII white space after folding A-Z.  A text with fewer words than a shingle is one shingle; without words
(or null) the set is empty and linked with nothing.  Equal rows are linked, as rows of one id always are.  Of
``docs`` only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.batches import map_columns
from ebbline.llm.graph import components
from ebbline.llm.ngram_join import joining
from ebbline.llm.shingling import GOLD, mix, shingles
from ebbline.session import settle

SHINGLE = 5  # words
PERCENT = 80  # least similarity
TREES, DEPTH = 32, 5
ORDERS, ORDER_DEPTH = 4, 8  # trees whose order large regions are compared in, and the depth of those orders
BLOCK = 256

def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and shifts of the hash functions: each tree's, then more for the orders."""
    rng = np.random.default_rng(20240131)
    n = TREES * DEPTH + ORDERS * ORDER_DEPTH
    return rng.integers(1, 1 << 32, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 32, n, np.uint64)


def signature(hashes: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """MinHash values, 32 bits each."""
    low = (hashes >> np.uint64(32))[None, :]
    out = np.full(len(functions[0]), np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), 4096):
            values = low[:, i : i + 4096] * functions[0][:, None] + functions[1][:, None]
            out = np.minimum(out, (values & np.uint64(0xFFFFFFFF) ^ values >> np.uint64(32)).min(axis=1))
    return out


def sign(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, n_shingles, f, g, buckets, orders)``: the size of the set, its fingerprint, a key for each tree's
    label, and the labels that sort large regions."""
    functions = _functions()

    def work(batches):
        for batch in batches:
            out = {"doc_id": batch.column(0), "n_shingles": [], "f": [], "g": [], "buckets": [], "orders": []}
            for text in batch.column(1).to_pylist():
                hashes = shingles(text, size)
                out["n_shingles"].append(len(hashes))
                with np.errstate(over="ignore"):
                    out["f"].append(int(np.add.reduce(mix(hashes), dtype=np.uint64).astype(np.int64)))
                    out["g"].append(int(np.bitwise_xor.reduce(mix(hashes * GOLD), initial=0).astype(np.int64)))
                if not len(hashes):
                    out["buckets"].append([])
                    out["orders"].append([])
                    continue
                values = signature(hashes, functions)
                keys = np.arange(TREES, dtype=np.uint64)
                for depth in range(DEPTH):
                    keys = mix(keys * GOLD + values[depth : TREES * DEPTH : DEPTH])
                out["buckets"].append(keys.astype(np.int64).tolist())
                label = values[TREES * DEPTH :].astype(np.uint8).tobytes()
                out["orders"].append([label[k * ORDER_DEPTH : (k + 1) * ORDER_DEPTH] for k in range(ORDERS)])
            yield out

    schema = "doc_id long, n_shingles long, f long, g long, buckets array<long>, orders array<binary>"
    return map_columns(docs.select("doc_id", "text"), work, schema)


# ---- blocks ------------------------------------------------------------------


def linked(sets: list[np.ndarray], percent: int, others: list[np.ndarray] | None = None) -> np.ndarray:
    """Which of ``sets`` are similar enough to which of ``others`` (or of themselves), on the full sets."""
    every = sets + (others or [])
    sizes = np.array([len(s) for s in every])
    values, inverse, counts = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    shared, of = counts[inverse] > 1, np.repeat(np.arange(len(every)), sizes)
    rows, columns = of[shared], column[inverse[shared]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    n = len(sets)
    both = np.zeros((n, len(every)))
    for start in range(0, int(columns[-1]) + 1 if len(columns) else 0, 4096):
        a, b = np.searchsorted(columns, [start, start + 4096])
        table = np.zeros((len(every), 4096), np.float32)
        table[rows[a:b], columns[a:b] - start] = 1
        both += table[:n] @ table.T
    union = sizes[:n, None] + sizes[None, :] - both
    out = 100 * both >= percent * union
    return out[:, n:] if others is not None else out


def _edges(ids: list[int], comps: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join different components within a block, as edges to the smallest id of each joined part."""
    if len(set(comps)) < 2:
        return []
    near = linked(sets, percent)
    near |= np.array(comps)[:, None] == np.array(comps)[None, :]
    label = np.arange(len(ids))
    while True:
        low = np.where(near, label[None, :], len(ids)).min(axis=1)
        if (low == label).all():
            break
        label = low
    first: dict[int, int] = {}
    for i, k in enumerate(label):
        first[k] = min(first.get(k, ids[i]), ids[i])
    return [(i, first[k]) for i, k in zip(ids, label, strict=True) if i != first[k]]


def _rows(batches):
    for batch in batches:
        values = batch.column(3)
        for i, (region, rep, comp) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True)):
            yield region, rep, comp, values[i].values.to_numpy(zero_copy_only=False).view(np.uint64)


def _compare_blocks(rows: DataFrame, percent: int, block: int) -> DataFrame:
    """``rows``: ``region, rep, comp, hashes``, the rows of a region (or of its stretch) in a row."""

    def work(batches):
        held: list[tuple] = []
        edges: list[tuple[int, int]] = []

        def compare():
            _, ids, comps, sets = map(list, zip(*held, strict=True))
            edges.extend(_edges(ids, comps, sets, percent))
            held.clear()

        for row in _rows(batches):
            if held and (held[0][0] != row[0] or len(held) == block):
                compare()
            held.append(row)
            if len(edges) >= 10_000:
                yield dict(zip("ab", zip(*edges, strict=True), strict=True))
                edges.clear()
        if held:
            compare()
        if edges:
            yield dict(zip("ab", zip(*edges, strict=True), strict=True))

    return map_columns(rows, work, "a long, b long")


def _compare_rest(rows: DataFrame, percent: int) -> DataFrame:
    """Edges that join all linked sets of the regions that are more than one component yet.

    ``rows``: ``region, rep, comp, f, hashes``.
    """
    apart = rows.groupBy("region").agg(F.min("comp").alias("least"), F.max("comp").alias("most"))
    apart = apart.where("least != most").select("region")
    n = F.size("hashes").cast("long").alias("n")
    left = rows.join(apart, "region").select("f", "rep", n, F.col("hashes").alias("tokens"), "comp")
    return joining(settle(left), percent)


# ---- the operator ------------------------------------------------------------


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``n_shingles, component_id, kept`` of every document; the smallest id of a component stays."""
    signed = settle(sign(docs, size))
    classes = signed.where("n_shingles > 0 and doc_id is not null").groupBy("f", "g", "n_shingles")
    firsts = [F.first(c).alias(c) for c in ("buckets", "orders")]  # equal in all rows of a class
    classes = settle(classes.agg(F.min("doc_id").alias("rep"), *firsts))

    labels = classes.select("rep", F.explode("buckets").alias("bucket"))
    crowded = labels.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("other")).where("hub != other")
    met = labels.join(crowded, "bucket").where("rep != hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    regions = settle(components(met).select(F.col("node").alias("rep"), F.col("component").alias("region")))

    def sets(batches):
        for batch in batches:
            every = [shingles(t, size).view(np.int64) for t in batch.column(2).to_pylist()]
            offsets = np.cumsum([0, *map(len, every)])
            flat = pa.array(np.concatenate([np.zeros(0, np.int64), *every]))
            kept = {n: batch.column(i) for i, n in ((0, "rep"), (1, "region"), (3, "orders"), (4, "large"))}
            yield kept | {"hashes": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)}

    # counted in rows of docs, of which an id may have several with different texts
    sizes = signed.select(F.col("doc_id").alias("rep")).join(regions, "rep").groupBy("region").count()
    sizes = sizes.select("region", (F.col("count") > block).alias("large"))
    chosen = regions.join(sizes, "region").join(classes.select("rep", "orders"), "rep")
    texts = docs.select(F.col("doc_id").alias("rep"), "text").join(chosen, "rep")
    firsts = [F.first(c).alias(c) for c in ("region", "orders", "large")]  # equal in all rows of a rep
    texts = texts.groupBy("rep", "text").agg(*firsts)
    wanted = settle(
        map_columns(
            texts.select("rep", "region", "text", "orders", "large"),
            sets,
            "rep long, region long, orders array<binary>, large boolean, hashes array<long>",
        )
    )
    small = wanted.where("not large").select("region", "rep", F.col("rep").alias("comp"), "hashes")
    small = small.repartition("region").sortWithinPartitions("region")
    links = settle(_compare_blocks(small, percent, block + 1))

    # a name for each set, as a rep may have several; it lasts, as the rows are written
    large = wanted.where("large").withColumn("f", F.monotonically_increasing_id())
    if not large.isEmpty():
        # every order at once: a set meets its neighbours in each
        orders = large.select("region", "rep", "hashes", F.posexplode("orders").alias("order", "label"))
        orders = orders.repartitionByRange("order", "region", "label", "rep")
        orders = orders.sortWithinPartitions("order", "region", "label", "rep")
        stretches = orders.select(F.struct("order", "region").alias("region"), "rep", F.col("rep").alias("comp"), "hashes")
        found = settle(_compare_blocks(stretches, percent, block))
        joined = components(found).select(F.col("node").alias("rep"), F.col("component").alias("comp"))
        joined = large.select("region", "rep", "f", "hashes").join(joined, "rep", "left")
        joined = joined.select("region", "rep", F.coalesce("comp", "rep").alias("comp"), "f", "hashes")
        rest = settle(_compare_rest(joined, percent))
        links = links.unionByName(found).unionByName(rest)

    comps = components(links).select(F.col("node").alias("rep"), "component")
    reps = classes.select("f", "g", "n_shingles", "rep").join(comps, "rep", "left")
    reps = reps.select("f", "g", "n_shingles", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "f", "g").join(reps, ["f", "g", "n_shingles"], "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))



def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with all its columns, and one row of each id.

    Rows without id, and documents without a word, stay.
    """
    gone = near_duplicates(docs.select("doc_id", "text"), size, percent).where("not kept").select("doc_id").distinct()
    gone = settle(gone)
    kept = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return kept.select(docs.columns).unionByName(docs.where("doc_id is null"))
