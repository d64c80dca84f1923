"""Candidate generators other than the plain top list."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.operators.engagement import ratios
from ebbline.operators.running import running
from ebbline.operators.topk import top_k, top_k_per
from ebbline.session import settle

# executors get these functions with the query and need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# query vectors, and vectors compared with them, held by one task at a time
KNN_CHUNK = 2048
KNN_BLOCK = 8192
WORD = 64  # places in a word of bits
KEPT_KEYS = ["kind", "user_id", "creator_id", "part"]


def ratio_top_k(events: DataFrame, part: str, whole: str, min_whole: int, k: int) -> DataFrame:
    """Best media by e.g. likes per view, among those with enough views."""
    return best_ratios(ratios(events, ["media_id"], part, whole), min_whole, k)


def best_ratios(counted: DataFrame, min_whole: int, k: int) -> DataFrame:
    """The same from counted ratios, such as a stream keeps them in a table."""
    return top_k(counted.where(F.col("whole") >= min_whole), k, "ratio")


def few_views(
    events: DataFrame, name: str, below: int, k: int, seed: str = "0", posts: DataFrame | None = None
) -> DataFrame:
    """``k`` media drawn at random (by hash, so repeatably) from those with few views.

    ``posts`` is the catalogue: its ``media_id``s are drawn from, those without any event too.
    """
    views = events.groupBy("media_id").agg(
        F.sum(F.when(F.col("event_name") == name, F.col("event_count")).otherwise(0)).alias("views")
    )
    if posts is not None:
        views = posts.select("media_id").distinct().join(views, "media_id", "left")
        views = views.select("media_id", F.coalesce("views", F.lit(0).cast("bigint")).alias("views"))
    draw = F.md5(F.concat(F.col("media_id"), F.lit(seed)))
    return views.where(F.col("views") < below).orderBy(draw, "media_id").limit(k)


def creator_affinity(events: DataFrame, name: str, k: int) -> DataFrame:
    """Per user, unseen media by creators the user engaged with.

    Best first by the user's number of engagements with the creator, then the
    media's number of ``name`` events, then a hash of the media id; ``k`` per user.

    Joining users to all media of their creators would emit every pair.  Media
    are numbered per creator instead, and from the numbers a user has seen the
    first ``k`` unseen ones follow by counting, so only those are looked up, and only
    for creators that those of higher affinity do not leave without a chance.
    """
    pairs = settle(
        events.groupBy("user_id", "creator_id", "media_id").agg(
            F.sum("event_count").alias("_n"),
            F.sum(F.when(F.col("event_name") == name, F.col("event_count")).otherwise(0)).alias("_views"),
        )
    )
    media = pairs.groupBy("creator_id", "media_id").agg(F.sum("_views").alias("views"))
    affinity = pairs.groupBy("user_id", "creator_id").agg(F.sum("_n").alias("affinity"))
    return unseen_by_affinity(pairs.select("user_id", "creator_id", "media_id"), media, affinity, k)


def seen_and_views(events: DataFrame, posts: DataFrame, name: str) -> DataFrame:
    """What the fresh form of :func:`creator_affinity` keeps, for a table or, in update mode, for a stream.

    ``posts`` is the catalogue: ``media_id``, ``creator_id`` and a fixed ``place`` of each post, a whole number from 0
    that no other post has.  Rows of kind ``seen`` have, per user and creator, the user's engagements ``n`` and the
    places seen as the bits of words of 64; rows of kind ``views`` count a post's ``name`` events, ``part`` being its
    place.  Words without a bit have no row.  Both kinds come from one aggregation, to be upserted by ``KEPT_KEYS``.
    """
    placed = events.drop("creator_id").join(posts.select("media_id", "creator_id", "place"), "media_id")
    own = F.struct(
        F.lit("seen").alias("kind"),
        F.col("user_id").alias("user_id"),
        "creator_id",
        F.floor(F.col("place") / WORD).alias("part"),
        F.expr(f"shiftleft(1L, cast(place % {WORD} as int))").alias("bits"),
        F.col("event_count").alias("n"),
    )
    views = F.when(F.col("event_name") == name, F.col("event_count")).otherwise(0).cast("bigint")
    post = F.struct(
        F.lit("views").alias("kind"),
        F.lit("").alias("user_id"),
        "creator_id",
        F.col("place").alias("part"),
        F.lit(0).cast("bigint").alias("bits"),
        views.alias("n"),
    )
    rows = placed.select(F.inline(F.array(own, post)))
    return rows.groupBy(*KEPT_KEYS).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))


def fresh_creator_affinity(kept: DataFrame, posts: DataFrame, k: int) -> DataFrame:
    """The candidates of :func:`creator_affinity` from what a stream keeps; posts without any event take part."""
    kept = settle(kept)
    seen = kept.where("kind = 'seen'")
    affinity = seen.groupBy("user_id", "creator_id").agg(F.sum("n").alias("affinity"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.bit_get("bits", i) == 1)
    places = seen.select("user_id", "creator_id", "part", F.explode(bits).alias("_bit"))
    places = places.select("user_id", "creator_id", (F.col("part") * WORD + F.col("_bit")).alias("place"))
    posts = posts.select("media_id", "creator_id", "place")
    seen = _spread_join(places, posts, ["creator_id", "place"], spread_by="user_id")
    views = kept.where("kind = 'views'").select("creator_id", F.col("part").alias("place"), F.col("n").alias("views"))
    media = posts.join(views, ["creator_id", "place"], "left")
    media = media.select("creator_id", "media_id", F.coalesce("views", F.lit(0).cast("bigint")).alias("views"))
    return unseen_by_affinity(seen.select("user_id", "creator_id", "media_id"), media, affinity, k)


def unseen_by_affinity(seen: DataFrame, media: DataFrame, affinity: DataFrame, k: int) -> DataFrame:
    """The best ``k`` unseen media per user from the distinct pairs seen, all media, and the users' affinities."""
    numbered = settle(_numbered(media))
    affinity = settle(_worth_a_look(seen, numbered, affinity, k))
    seen = seen.join(affinity.select("user_id", "creator_id"), ["user_id", "creator_id"], "left_semi")
    places = _spread_join(
        seen, numbered.select("creator_id", "media_id", "place"), ["creator_id", "media_id"], spread_by="user_id"
    )
    # the i-th seen place has (place - i) unseen places before it
    counted = running(
        places.select(
            "user_id",
            "creator_id",
            "place",
            F.floor(F.col("place") / 100_000).alias("_slice"),
            F.lit(1).cast("bigint").alias("_one"),
        ),
        ["user_id", "creator_id"],
        ["_slice"],
        ["place"],
        {"_i": ("sum", "_one")},
    )
    gaps = (
        counted.select("user_id", "creator_id", (F.col("place") - F.col("_i")).alias("_gap"))
        .where(F.col("_gap") < k)
        .groupBy("user_id", "creator_id", "_gap")
        .agg(F.count("*").alias("_seen"))
        .groupBy("user_id", "creator_id")
        .agg(F.collect_list(F.struct("_gap", "_seen")).alias("_gaps"))
    )
    nth_unseen = F.transform(
        F.sequence(F.lit(1), F.lit(k)),
        lambda j: j.cast("bigint")
        + F.aggregate(
            F.filter("_gaps", lambda g: g["_gap"] < j),
            F.lit(0).cast("bigint"),
            lambda total, g: total + g["_seen"],
        ),
    )
    wanted = (
        affinity.join(gaps, ["user_id", "creator_id"], "left")
        .withColumn("_gaps", F.coalesce("_gaps", F.expr("cast(array() as array<struct<_gap:bigint,_seen:bigint>>)")))
        .select("user_id", "creator_id", "affinity", F.explode(nth_unseen).alias("place"))
    )
    found = _spread_join(wanted, numbered, ["creator_id", "place"], spread_by="user_id")
    order = [F.col("affinity").desc(), F.col("views").desc(), _hash_slice(), F.col("media_id")]
    best = top_k_per(found, ["user_id"], k, order)
    return best.select("user_id", "rank", "media_id", "creator_id", "affinity", "views")


def _worth_a_look(seen: DataFrame, numbered: DataFrame, affinity: DataFrame, k: int) -> DataFrame:
    """Without the creators that cannot come into a user's best ``k``: those of higher affinity have enough unseen media.

    What a creator surely has left is all media less the seen ones, each as often as one is listed.
    """
    listed = numbered.groupBy("creator_id", "media_id").agg(F.count("*").alias("_times"))
    sizes = listed.groupBy("creator_id").agg(F.sum("_times").alias("_size"), F.max("_times").alias("_times"))
    known = seen.groupBy("user_id", "creator_id").agg(F.count("*").alias("_seen"))
    left = F.col("_size") - F.col("_times") * F.coalesce("_seen", F.lit(0))
    offered = _spread_join(affinity.join(known, ["user_id", "creator_id"], "left"), sizes, ["creator_id"], spread_by="user_id")
    offered = offered.select("user_id", "creator_id", "affinity", F.greatest(F.lit(0), F.least(F.lit(k), left)).alias("_left"))
    above = Window.partitionBy("user_id").orderBy((-F.col("affinity")).alias("_less")).rangeBetween(Window.unboundedPreceding, -1)
    ahead = offered.withColumn("_ahead", F.coalesce(F.sum("_left").over(above), F.lit(0)))
    return ahead.where(F.col("_ahead") < k).select("user_id", "creator_id", "affinity")


def _hash_slice() -> Column:
    return F.substring(F.md5("media_id"), 1, 3)


def _numbered(media: DataFrame) -> DataFrame:
    """Add each media's ``place`` among its creator's: most views first, then by hash and id.

    Media of equal views are numbered by hash slices, then moved behind those of
    more views, so neither step has a large group.
    """
    one = media.select(
        "*",
        (-F.col("views")).alias("_less"),
        _hash_slice().alias("_hash"),
        F.lit(1).cast("bigint").alias("_one"),
    )
    equals = running(
        one, ["creator_id", "_less"], ["_hash"], ["_hash", "media_id"], {"_place": ("sum", "_one")}
    )
    better = Window.partitionBy("creator_id").orderBy("_less").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        one.groupBy("creator_id", "_less")
        .agg(F.sum("_one").alias("_size"))
        .select("creator_id", "_less", F.coalesce(F.sum("_size").over(better), F.lit(0)).alias("_ahead"))
    )
    placed = _spread_join(equals, ahead, ["creator_id", "_less"], spread_by="media_id")
    return placed.select("creator_id", "media_id", "views", (F.col("_place") + F.col("_ahead")).alias("place"))


def _spread_join(many: DataFrame, one: DataFrame, on: list[str], spread_by: str, ways: int = 16) -> DataFrame:
    """Many-to-one join whose hot keys are split ``ways`` ways; ``one`` is copied to each."""
    left = many.withColumn("_way", F.pmod(F.hash(spread_by), F.lit(ways)))
    right = one.withColumn("_way", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    return left.join(right, [*on, "_way"]).drop("_way")


def user_vectors(events: DataFrame, vectors: DataFrame, name: str, dim: int) -> DataFrame:
    """A user's vector: the mean of the vectors of the media in their ``name`` events.

    ``vectors`` has ``media_id`` and ``embedding``, all ``dim`` wide, else the job stops.  A media seen by very many
    users makes a skewed partition, which adaptive execution splits.
    """
    counted = (
        events.where(F.col("event_name") == name)
        .groupBy("user_id", "media_id")
        .agg(F.sum("event_count").alias("_n"))
    )
    wrong = F.raise_error(F.concat(F.lit(f"a vector is not {dim} wide: "), F.col("media_id")))
    checked = F.when(F.size("embedding") == dim, F.col("embedding")).otherwise(wrong)
    joined = counted.join(vectors.withColumn("embedding", checked), "media_id")
    weight = F.sum("_n")
    sums = [F.sum(F.col("_n") * F.col("embedding")[i].cast("double")) for i in range(dim)]
    return joined.groupBy("user_id").agg(F.array(*[s / weight for s in sums]).alias("embedding"))


def nearest(
    queries: DataFrame, vectors: DataFrame, k: int, chunk: int = KNN_CHUNK, block: int = KNN_BLOCK
) -> DataFrame:
    """The ``k`` vectors of highest cosine to each query, exactly.

    ``queries`` has ``user_id`` and ``embedding``, ``vectors`` has ``media_id`` and
    ``embedding``.  Up to ``chunk`` queries are sent to every task and the vectors
    stay where they are.  More are cut into chunks, the vectors into blocks, and
    each chunk meets each block in a task of its own.  Either way a task returns
    the best ``k`` per query, never the pairs.
    """
    queries = settle(queries.select("user_id", "embedding"))
    vectors = vectors.select("media_id", "embedding")
    total = queries.count()
    if total <= chunk:
        found = _from_broadcast(queries, vectors, k)
    else:
        found = _from_blocks(queries, -(-total // chunk), vectors, -(-vectors.count() // block), k)
    top = top_k_per(found, ["user_id"], k, [F.col("score").desc(), F.col("media_id")])
    return top.select("user_id", "rank", "media_id", "score")


FOUND = "user_id string, media_id string, score double"


def _from_broadcast(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    few = queries.toPandas()  # at most one chunk
    held = queries.sparkSession.sparkContext.broadcast(few)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _best_pairs(held.value, batch, k)

    return vectors.mapInPandas(search, FOUND)


def _from_blocks(queries: DataFrame, chunks: int, vectors: DataFrame, blocks: int, k: int) -> DataFrame:
    def placed(df: DataFrame, id_col: str, own: str, mine: int, other: str, others: int) -> DataFrame:
        part = F.pmod(F.xxhash64(id_col), F.lit(mine)).alias(own)
        return df.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(max(others, 1) - 1))).alias(other))

    q = placed(queries, "user_id", "chunk", chunks, "block", blocks)
    v = placed(vectors, "media_id", "block", max(blocks, 1), "chunk", chunks)
    # both sides must agree on the type of the grouping columns
    q, v = (df.withColumns({c: F.col(c).cast("bigint") for c in ("chunk", "block")}) for df in (q, v))
    meeting = q.groupBy("chunk", "block").cogroup(v.groupBy("chunk", "block"))
    return meeting.applyInPandas(lambda a, b: _best_pairs(a, b, k), FOUND)


def _best_pairs(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    if queries.empty or vectors.empty:
        kinds = {"user_id": str, "media_id": str, "score": float}
        return pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in kinds.items()})
    vectors = vectors.sort_values("media_id")
    left, right = (_unit(np.stack(df["embedding"].to_numpy()).astype(np.float64)) for df in (queries, vectors))
    # copies of a vector must tie exactly, wherever they sit in the product
    cosine = np.round(left @ right.T, 12)
    query, column = np.nonzero(_best(cosine, k))
    return pd.DataFrame(
        {
            "user_id": queries["user_id"].to_numpy()[query],
            "media_id": vectors["media_id"].to_numpy()[column],
            "score": cosine[query, column],
        }
    )


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def _best(cosine: np.ndarray, k: int) -> np.ndarray:
    """Mask of the k largest entries of each row; equal ones are taken from the left."""
    if cosine.shape[1] <= k:
        return np.ones(cosine.shape, dtype=bool)
    kth = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
    above, equal = cosine > kth, cosine == kth
    room = k - above.sum(axis=1, keepdims=True)
    return above | (equal & (np.cumsum(equal, axis=1) <= room))
