"""Key-value items: typed attributes S (text), N (number, as text), M (map), L (list)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Attribute names of the stored items, and the name of the default list.
KEY, FEATURE, COUNTS = "key", "featureName", "counts"
INTERVAL, UPDATED, VALUE = "decayInterval", "lastUpdate", "value"
LIST_NAME, LIST_ITEMS, MEDIA, SCORE = "CGName", "Candidates", "mediaId", "score"
TOP_VIEWS = "TopViews"

NUMBER = "struct<N:string>"
TEXT = "struct<S:string>"
COUNTER_ITEM = (
    f"struct<{KEY}:{TEXT},{FEATURE}:{TEXT},"
    f"{COUNTS}:struct<M:map<string,struct<M:struct<{INTERVAL}:{NUMBER},{UPDATED}:{NUMBER},{VALUE}:{NUMBER}>>>>>"
)
LIST_ITEM = f"struct<{LIST_NAME}:{TEXT},{LIST_ITEMS}:struct<L:array<struct<M:struct<{MEDIA}:{TEXT},{SCORE}:{NUMBER}>>>>>"
WORD_ITEM = f"struct<word:{TEXT},count:{NUMBER}>"


def _s(c: Column | str) -> Column:
    return F.struct((F.col(c) if isinstance(c, str) else c).cast("string").alias("S"))


def _n(c: Column | str) -> Column:
    return F.struct((F.col(c) if isinstance(c, str) else c).cast("string").alias("N"))


def _ttl(ttl: Column | None) -> list[Column]:
    return [] if ttl is None else [_n(ttl).alias("ttl")]


def word_items(words: DataFrame, count: str = "n", ttl: Column | None = None) -> DataFrame:
    item = F.struct(_s("word").alias("word"), _n(count).alias("count"), *_ttl(ttl))
    return words.select("word", F.to_json(item).alias("item"))


def counter_items(counters: DataFrame, ttl: Column | None = None) -> DataFrame:
    """``key``, ``feature_name``, ``counts`` (map by interval) as one item per row."""
    by_text = F.transform_keys("counts", lambda k, _: k.cast("string"))
    counts = F.transform_values(
        by_text,
        lambda _, c: F.struct(
            F.struct(
                _n(c["decay_interval"]).alias(INTERVAL),
                _n(c["last_update"]).alias(UPDATED),
                _n(c["value"]).alias(VALUE),
            ).alias("M")
        ),
    )
    item = F.struct(
        _s("key").alias(KEY), _s("feature_name").alias(FEATURE), F.struct(counts.alias("M")).alias(COUNTS), *_ttl(ttl)
    )
    return counters.select("key", "feature_name", F.to_json(item).alias("item"))


def list_items(lists: DataFrame, ttl: Column | None = None) -> DataFrame:
    """``name``, ``candidates`` as one item per list."""
    members = F.transform(
        "candidates",
        lambda c: F.struct(F.struct(_s(c["media_id"]).alias(MEDIA), _n(c["score"]).alias(SCORE)).alias("M")),
    )
    item = F.struct(_s("name").alias(LIST_NAME), F.struct(members.alias("L")).alias(LIST_ITEMS), *_ttl(ttl))
    return lists.select("name", F.to_json(item).alias("item"))


def read_counter_items(items: DataFrame, item: str = "item") -> DataFrame:
    """Items back to rows: key, feature_name, decay_interval, last_update, value."""
    parsed = items.select(F.from_json(item, COUNTER_ITEM).alias("_i"))
    rows = parsed.select(
        F.col(f"_i.{KEY}.S").alias("key"),
        F.col(f"_i.{FEATURE}.S").alias("feature_name"),
        F.explode(F.map_values(f"_i.{COUNTS}.M")).alias("_c"),
    )
    return rows.select(
        "key",
        "feature_name",
        F.col(f"_c.M.{INTERVAL}.N").cast("bigint").alias("decay_interval"),
        F.col(f"_c.M.{UPDATED}.N").cast("bigint").alias("last_update"),
        F.col(f"_c.M.{VALUE}.N").cast("double").alias("value"),
    )


def read_list_items(items: DataFrame, item: str = "item") -> DataFrame:
    """Items back to rows: name, rank, media_id, score."""
    parsed = items.select(F.from_json(item, LIST_ITEM).alias("_i"))
    rows = parsed.select(F.col(f"_i.{LIST_NAME}.S").alias("name"), F.posexplode(f"_i.{LIST_ITEMS}.L").alias("_p", "_c"))
    return rows.select(
        "name",
        (F.col("_p") + 1).alias("rank"),
        F.col(f"_c.M.{MEDIA}.S").alias("media_id"),
        F.col(f"_c.M.{SCORE}.N").cast("double").alias("score"),
    )


def read_word_items(items: DataFrame, item: str = "item") -> DataFrame:
    parsed = items.select(F.from_json(item, WORD_ITEM).alias("_i"))
    return parsed.select(F.col("_i.word.S").alias("word"), F.col("_i.count.N").cast("bigint").alias("n"))
