"""N-gram Jaccard join with adaptive multi-match prefixes, for links between whole texts.

A set of ``n`` shingles may lack at most ``e = n - ceil(percent * n / 100)`` of its own in a similar set.  So whatever
the order of all shingles, the first ``l`` shared ones lie among the first ``e + l`` of both sets, its prefix of level
``l``.  Two similar sets of levels ``l`` and ``m`` share at least ``min(l, m)`` shingles of their prefixes.

1. Every text gives its set and a fingerprint; equal sets fall together at once.
2. Prefixes in the order of the hashes, at a level that follows from the size alone, rule out sets of which too few
   prefix shingles occur in any other set's prefix.
3. Over the sets left, all shingles are counted and ordered by that count, rare ones first.  Sets whose shared
   shingles cannot reach the threshold go.  Sets of one size that differ only in shingles of their own are one kernel:
   their links to all others are the same, so one of them stands for all.
4. Each kernel picks its level: a longer prefix reads more postings, but more shared shingles are asked for.  The
   level with the least estimated cost is taken, a candidate being charged by the set's size.
5. Each posting list ties its sets to its most central one; what is confirmed gives first components.
6. Posting lists, cut into blocks of ``LIST`` rows that meet in pairs, yield the pairs of different components that
   share enough prefix shingles, counting only places that the pair's sizes and shared shingles allow.  Candidates are confirmed on full sets, in tiles of neighbouring sets, so that sets of a
   dense group move once for each tile and not for each pair.

Words are split at ASCII white space after folding A-Z.  A text with fewer words than a shingle is one shingle; a text
without words (or null) has an empty set, is linked with nothing and keeps its own id.  Rows that share an id are one
document, equal to the links of all their texts; a row without id is linked with nothing and gets no component.  Other
columns of ``docs`` are not read, so their names are free.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.batches import map_columns, release
from ebbline.llm.graph import components
from ebbline.llm.shingling import shingles
from ebbline.session import settle

SHINGLE = 5  # words
PERCENT = 80  # least similarity
SPREAD = 16  # a set of n shingles has level 1 + n // SPREAD in the first filter
CANDIDATE = 64  # confirming a candidate costs as much as reading one posting for so many shingles
LIST = 2048  # rows of a block of a posting list
TILE = 256  # sets of a side of a tile, about
BROADCAST = 1_000_000  # rows of two longs that may be broadcast
PARITY = ["p0", "p1", "p2", "p3"]  # 256 bits of a set, see ``parity``

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever its order."""
    with np.errstate(over="ignore"):
        f = np.add.reduce(_mixed(hashes), dtype=np.uint64)
        g = np.add.reduce(_mixed(hashes ^ _ODD), dtype=np.uint64)
    return int(f.astype(np.int64)), int(g.astype(np.int64))


def least_shared(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` must share with a similar one, which is also the least size of a similar one."""
    return -(-percent * n // 100)


def similar(n: Column, m: Column, shared: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n + m - shared)


# ---- sets --------------------------------------------------------------------


def sign(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, f, g, prefix``: fingerprint and first prefix of every text's set."""

    def work(batches):
        for batch in batches:
            out = {"doc_id": batch.column(0), "n_shingles": [], "f": [], "g": [], "prefix": []}
            for text in batch.column(1).to_pylist():
                hashes = shingles(text, size)
                n = len(hashes)
                f, g = fingerprint(hashes)
                out["n_shingles"].append(n)
                out["f"].append(f)
                out["g"].append(g)
                length = n - least_shared(n, percent) + 1 + n // SPREAD
                out["prefix"].append(hashes[:length].view(np.int64) if n else None)
            yield out

    return map_columns(
        docs.select("doc_id", "text"), work, "doc_id long, n_shingles long, f long, g long, prefix array<long>"
    )


def _met(batches):
    """Rows ``token, f`` in order: how often each ``f`` meets another one at a token.

    A run at the edge of a partition may go on in the next one, so it counts as met.
    """
    last, pending = None, None
    for batch in batches:
        token, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(token):
            continue
        same = np.append(token[:-1] == token[1:], False)
        met = np.append(False, same[:-1]) | same
        met[0] |= last is None or last == token[0]
        hits = f[:-1][met[:-1]]
        if pending is not None and last == token[0]:
            hits = np.append(hits, pending)
        if met[-1]:
            hits = np.append(hits, f[-1])
        pending, last = None if met[-1] else f[-1], token[-1]
        ids, counts = np.unique(hits, return_counts=True)
        yield {"f": ids, "hits": counts}
    if pending is not None:
        yield {"f": [pending], "hits": [1]}


def _alive(whole: DataFrame, percent: int) -> DataFrame:
    """``f, rep`` of the sets of which enough prefix shingles occur in other sets' prefixes."""
    classes = whole.groupBy("f", "g", "n").agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"))
    tokens = classes.select(F.explode("prefix").alias("token"), "f")  # the prefix is the same in all rows of a class
    tokens = tokens.repartitionByRange("token", "f").sortWithinPartitions("token", "f")
    met = map_columns(tokens, _met, "f long, hits long").groupBy("f").agg(F.sum("hits").alias("hits"))
    least = F.floor(F.ceil(F.col("n") * percent / 100) / SPREAD) + 1
    classes = whole.groupBy("f", "g", "n").agg(F.min("doc_id").alias("rep"))
    return settle(classes.join(met, "f").where(F.col("hits") >= least).select("f", "rep"))


def _sets(docs: DataFrame, alive: DataFrame, size: int) -> DataFrame:
    """``f, rep, n, tokens`` of the sets in ``alive``, read again from the texts."""
    wanted = alive.select("f", F.col("rep").alias("doc_id"))
    if alive.count() <= BROADCAST:  # else the texts are shuffled, with the same result
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text").join(wanted, "doc_id").select("f", "doc_id", "text")

    def work(batches):
        for batch in batches:
            f, rep, texts = (batch.column(i).to_pylist() for i in range(3))
            every = [shingles(t, size) for t in texts]
            own = [i for i, x in enumerate(every) if fingerprint(x)[0] == f[i]]  # an id may have more texts
            every = [every[i].view(np.int64) for i in own]
            sizes = list(map(len, every))
            tokens = pa.array(np.concatenate([np.zeros(0, np.int64), *every]))
            tokens = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), tokens)
            yield {"f": [f[i] for i in own], "rep": [rep[i] for i in own], "n": sizes, "tokens": tokens}

    return settle(map_columns(texts, work, "f long, rep long, n long, tokens array<long>"))


# ---- levels ------------------------------------------------------------------


def level(counts: np.ndarray, n: int, percent: int) -> tuple[int, int]:
    """Level and prefix length of a set of ``n`` shingles, of which ``counts`` are those that others have too, in order.

    The others come first in the order and use up the prefix without a posting.  ``S(l)`` postings are read at level
    ``l``; at most ``S(l) / l`` sets can share ``l`` of them.
    """
    lone = n - len(counts)
    spare = n - least_shared(n, percent) - lone  # what a similar set may lack of the shared ones
    levels = np.arange(1, len(counts) - spare + 1)
    read = np.cumsum(counts - 1.0)[levels + spare - 1]
    best = int(np.argmin(read * (1 + max(1.0, n / CANDIDATE) / levels)))
    return int(levels[best]), int(levels[best]) + spare


def parity(tokens: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles ends in each byte: two sets differ in as many shingles as bits, or more."""
    odd = np.bincount((tokens & 255).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _plan(rows: DataFrame, percent: int) -> DataFrame:
    """``rows``: ``f, count, token`` in order, a set's first row having its size as a negative count.

    Sets that cannot be linked go.
    """

    def work(batches):
        names = ["f", "n", "m", "kernel", "level", "region", "crowd", *PARITY, "prefix", "counts"]
        held: list[tuple] = []

        def plan(out):
            f = held[0][0]
            counts, tokens = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            n = -int(counts[0])
            kept = counts > 0
            kept[1:] &= (tokens[1:] != tokens[:-1]) | (counts[1:] != counts[:-1])  # repeated rows of an id
            counts, tokens = counts[kept], tokens[kept]
            held.clear()
            if 100 * len(counts) < percent * n:
                return
            chosen, length = level(counts, n, percent)
            row = (f, n, len(counts), fingerprint(tokens.view(np.uint64))[1], chosen, tokens[-1], counts[-1], *parity(tokens))
            for name, value in zip(names, (*row, tokens[:length], counts[:length]), strict=True):
                out[name].append(value)

        for batch in batches:
            out = {name: [] for name in names}
            f, counts, tokens = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = [0, *(np.flatnonzero(f[1:] != f[:-1]) + 1).tolist(), len(f)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if held and held[0][0] != f[start]:
                    plan(out)
                held.append((int(f[start]), counts[start:end], tokens[start:end]))
            yield out
        if held:
            out = {name: [] for name in names}
            plan(out)
            yield out

    schema = "f long, n long, m long, kernel long, level long, region long, crowd long"
    schema = ", ".join([schema, *(f"{p} long" for p in PARITY), "prefix array<long>", "counts array<long>"])
    return map_columns(rows, work, schema)


def _planned(sets: DataFrame, percent: int) -> DataFrame:
    """The sets that can be linked, with their prefixes, and ``k``, the one that stands for a set's kernel.

    Sets of different ``comp``, where given, are different kernels.
    """
    entries = sets.select("f", F.explode("tokens").alias("token"))
    # a shingle has one row for each set at most, so even a common one is a small part of all rows
    entries = entries.withColumn("count", F.count("f").over(Window.partitionBy("token"))).where("count > 1")
    sizes = sets.select("f", (-F.col("n")).alias("count"), F.lit(0).cast("long").alias("token"))
    rows = entries.select("f", "count", "token").unionByName(sizes)
    rows = rows.repartition("f").sortWithinPartitions("f", "count", "token")
    rows = settle(_plan(rows, percent))
    own = [c for c in sets.columns if c == "comp"]
    if own:
        rows = rows.join(sets.select("f", "comp"), "f")
    of = rows.groupBy("kernel", "n", "m", *own).agg(F.min("f").alias("k")).toDF("of", "size", "common", *(["joined"] if own else []), "k")
    same = (F.col("kernel") == F.col("of")) & (F.col("n") == F.col("size")) & (F.col("m") == F.col("common"))
    same = same & (F.col("comp") == F.col("joined")) if own else same
    place = F.xxhash64("region", F.pmod(F.xxhash64("f"), F.ceil(F.col("crowd") / TILE))).alias("place")
    own += PARITY if own else []
    return settle(rows.join(of, same).select("f", "n", "m", "level", "prefix", "counts", "k", place, *own))


# ---- confirming --------------------------------------------------------------


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar.  ``x`` and ``y`` are their places among the tiles."""
    turned = F.col("x") > F.col("y")
    first, second = (F.when(turned, F.struct(p, q)).otherwise(F.struct(q, p)) for p, q in (("b", "y"), ("a", "x")))
    ends = [F.when(turned, F.col(p)).otherwise(F.col(q)) for p, q in (("b", "a"), ("a", "b"), ("y", "x"), ("x", "y"))]
    pairs = pairs.select(*(e.alias(n) for e, n in zip(ends, "abxy", strict=True)))
    members = pairs.select("x", "y", F.explode(F.array("a", "b")).alias("f")).distinct()
    members = members.join(sets.select("f", "tokens"), "f").select("x", "y", F.lit(0).alias("kind"), "f", F.lit(0).alias("b"), "tokens")
    asked = pairs.select("x", "y", F.lit(1).alias("kind"), F.col("a").alias("f"), "b", F.lit(None).cast("array<long>").alias("tokens"))
    rows = members.unionByName(asked).repartition("x", "y").sortWithinPartitions("x", "y", "kind", "f", "b")

    def work(batches):
        tile, sets_, asked_ = None, {}, {}

        def compare():
            found = []
            for a, partners in asked_.items():
                own, others = sets_[a], [sets_[b] for b in partners]
                flat, sizes = np.concatenate(others), np.array([len(o) for o in others])
                at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                shared = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
                near = 100 * shared >= percent * (len(own) + sizes - shared)
                found += [(a, b) for b, is_near in zip(partners, near, strict=True) if is_near]
            return dict(zip("ab", map(list, zip(*found, strict=True)) if found else ([], []), strict=True))

        for batch in batches:
            x, y, kind, f, b = (batch.column(i).to_pylist() for i in range(5))
            tokens = batch.column(5)
            for i, place in enumerate(zip(x, y, strict=True)):
                if place != tile:
                    if asked_:
                        yield compare()
                    tile, sets_, asked_ = place, {}, {}
                if kind[i] == 0:
                    sets_[f[i]] = np.sort(tokens[i].values.to_numpy(zero_copy_only=False))
                else:
                    asked_.setdefault(f[i], []).append(b[i])
        if asked_:
            yield compare()

    return map_columns(rows, work, "a long, b long")


# ---- the operator ------------------------------------------------------------


def _postings(kernels: DataFrame) -> DataFrame:
    """A row for each prefix shingle, at its place among the set's shared ones."""
    kept = ["f", "n", "m", "level", "place", "comp", *(c for c in PARITY if c in kernels.columns)]
    zipped = F.posexplode(F.arrays_zip("prefix", "counts")).alias("at", "p")
    rows = kernels.select(*kept, zipped)
    return rows.select(*kept, (F.col("at") + 1).alias("at"), F.col("p.prefix").alias("token"), F.col("p.counts").alias("count"))


def _could_link(n: str, m: str, sides: tuple[str, str], percent: int) -> Column:
    (n1, n2), (m1, m2) = ([F.col(f"{s}.{c}") for s in sides] for c in (n, m))
    return similar(n1, n2, F.least(m1, m2, n1, n2), percent)


def _central(kernels: DataFrame, percent: int) -> DataFrame:
    """Every set with the most central one of each of its posting lists: the one with the fewest shingles of its own."""
    rows = _postings(kernels)
    hub = F.min(F.struct((F.col("n") - F.col("m")).alias("own"), "f", "n", "m", "place", "comp")).alias("hub")
    hubs = rows.groupBy("token").agg(hub).select("token", "hub.*").alias("h")
    met = rows.alias("r").join(hubs, F.col("r.token") == F.col("h.token"))
    met = met.where((F.col("r.comp") != F.col("h.comp")) & _could_link("n", "m", ("r", "h"), percent))
    ends = [F.col(c).alias(n) for c, n in (("r.f", "a"), ("h.f", "b"), ("r.place", "x"), ("h.place", "y"))]
    return met.select(ends).distinct()


def candidates(kernels: DataFrame, percent: int, block: int = LIST) -> DataFrame:
    """Pairs of different components that share as many prefix shingles as the lower of their levels."""
    rows = _postings(kernels).withColumn("blocks", F.ceil(F.col("count") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("f"), F.col("blocks")).cast("int"))
    given = [c for c in PARITY if c in kernels.columns]
    kept = ["token", "f", "n", "m", "level", "place", "comp", "at", *given]
    after = F.explode(F.sequence("own", F.col("blocks") - 1))
    before = F.explode(F.sequence(F.lit(0), "own"))
    left = rows.select(*kept, F.col("own").alias("i"), after.alias("j")).alias("l")
    right = rows.select(*kept, before.alias("i"), F.col("own").alias("j")).alias("r")
    keys = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("token", "i", "j")]
    once = (F.col("l.i") != F.col("l.j")) | (F.col("l.f") < F.col("r.f"))
    apart = (F.col("l.f") != F.col("r.f")) & (F.col("l.comp") != F.col("r.comp"))
    # the first shingles that two similar sets share come no later than this, whatever else they lack
    level = F.least("l.level", "r.level")
    in_reach = [
        percent * (F.col("l.n") + F.col("r.n")) <= (100 + percent) * (F.col(f"{s}.m") + level - F.col(f"{s}.at"))
        for s in ("l", "r")
    ]
    near = once & apart & in_reach[0] & in_reach[1] & _could_link("n", "m", ("l", "r"), percent)
    if given:  # groups of copies, of which many are just too different, have long lists at every shingle
        apart_in = sum((F.bit_count(F.col(f"l.{c}").bitwiseXOR(F.col(f"r.{c}"))) for c in given), F.lit(0))
        apart_in += F.col("l.n") - F.col("l.m") + F.col("r.n") - F.col("r.m")
        near = near & ((100 + percent) * apart_in <= (100 - percent) * (F.col("l.n") + F.col("r.n")))
    met = left.join(right, keys[0] & keys[1] & keys[2] & near)
    turned = F.col("l.f") > F.col("r.f")

    def end(c: str, greater: bool) -> Column:
        return F.when(turned == F.lit(greater), F.col(f"l.{c}")).otherwise(F.col(f"r.{c}"))

    met = met.select(
        end("f", False).alias("a"),
        end("f", True).alias("b"),
        end("place", False).alias("x"),
        end("place", True).alias("y"),
        level.alias("level"),
    )
    return met.groupBy("a", "b", "x", "y", "level").count().where("count >= level").drop("level", "count")


def _found(planned: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` that join all linked sets among the kernels' own."""
    kernels = planned.where("f = k")
    given = "comp" in kernels.columns
    kernels = kernels if given else kernels.withColumn("comp", F.col("f"))
    central = settle(_confirm(_central(kernels, percent), sets, percent))
    ends = central
    if given:  # what is in one component counts as one set
        of = kernels.select("f", "comp")
        ends = ends.join(of.toDF("a", "u"), "a").join(of.toDF("b", "v"), "b").select(F.col("u").alias("a"), F.col("v").alias("b"))
    joined = components(ends).select(F.col("node").alias("comp"), F.col("component").alias("joined"))
    kernels = kernels.join(joined, "comp", "left").withColumn("comp", F.coalesce("joined", "comp")).drop("joined")
    kernels = settle(kernels)
    return settle(_confirm(candidates(kernels, percent), sets, percent)).unionByName(central)


def joining(sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` between the ``rep``s of ``sets`` (``f, rep, n, tokens``) that join all that are linked.

    Sets of one ``comp``, where ``sets`` has this column, are joined already; the edges join these components.
    """
    planned = _planned(sets, percent)
    release(sets.sparkSession)
    edges = found = _found(planned, sets, percent)
    release(sets.sparkSession)

    if "comp" not in sets.columns:  # else the members of a kernel are joined
        linked = found.select(F.explode(F.array("a", "b")).alias("k")).distinct().withColumn("linked", F.lit(True))
        members = planned.where("f != k").join(linked, "k", "left")
        members = members.where(F.col("linked").isNotNull() | similar(F.col("n"), F.col("n"), F.col("m"), percent))
        edges = found.unionByName(members.select(F.col("f").alias("a"), F.col("k").alias("b")))
    names = sets.select("f", "rep")
    edges = edges.join(names.select(F.col("f").alias("a"), F.col("rep").alias("u")), "a")
    edges = edges.join(names.select(F.col("f").alias("b"), F.col("rep").alias("v")), "b")
    return edges.select(F.col("u").alias("a"), F.col("v").alias("b"))


def links(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Every text's ``doc_id, n_shingles, rep``, and edges ``a, b`` between ``rep``s that join all linked texts."""
    signed = settle(sign(docs, size, percent))
    whole = signed.where("n_shingles > 0 and doc_id is not null").withColumnRenamed("n_shingles", "n")
    alive = _alive(whole, percent)
    release(docs.sparkSession)
    edges = joining(_sets(docs, alive, size), percent)

    classes = whole.groupBy("f", "g", F.col("n").alias("n_shingles")).agg(F.min("doc_id").alias("rep"))
    texts = signed.select("doc_id", "n_shingles", "f", "g").join(classes, ["f", "g", "n_shingles"], "left")
    texts = settle(texts.select("doc_id", "n_shingles", "rep"))
    return texts, edges.unionByName(classes_of_an_id(texts))


def classes_of_an_id(texts: DataFrame) -> DataFrame:
    """Edges between the classes of ids that have several texts."""
    ids = texts.where("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("other"))
    ids = ids.where("a != other").select("doc_id", "a")
    return texts.join(ids, "doc_id").select("a", F.col("rep").alias("b")).where("b is not null").distinct()


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; the component is the smallest id reachable by links."""
    texts, edges = links(docs, size, percent)
    comps = components(edges).select(F.col("node").alias("rep"), F.col("component").alias("joined"))
    out = texts.join(comps, "rep", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("joined", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))
