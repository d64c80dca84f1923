"""The operators as queries over whole tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import (
    bpe,
    hard_negatives,
    language,
    licenses,
    neardup,
    ngram_join,
    packing,
    quality,
    repair,
    repeats,
    sharding,
    topk,
    toxicity,
)
from ebbline.session import prepare
from ebbline.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(prepare(spark), sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op2_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op4_packing(spark, sf_dir):
    path = public_tokenizers.path
    cut = packing.pieces(
        table(spark, sf_dir, "documents"),
        path("byte_bpe_50k.json"),
        path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        held=True,
    )
    return packing.digests(packing.write_sequences(packing.pack(cut)))


@query
def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op8_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language.remainder("doc_id", 4) == 2, F.lit(False))
    models = language.train(docs.where(language.remainder("doc_id", 4) != 2))
    return language.identify(docs, models).withColumn("held_out", held_out)


@query
def op6_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    counted, _, index = toxicity.train(docs, labels.where(language.remainder("doc_id", 5) != 0))
    held_out = F.coalesce(language.remainder("doc_id", 5) == 0, F.lit(False))
    return toxicity.score(counted, index).withColumn("held_out", held_out)


@query
def op9_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2)


@query
def op3_repeats(spark, sf_dir):
    return repeats.digests(table(spark, sf_dir, "documents"))


@query
def op1_sharding(spark, sf_dir):
    path = sharding.write_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), 24)
    text = F.coalesce("text", F.lit(""))
    digests = spark.read.parquet(path).select(
        "doc_id",
        sharding.record_size().alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "bucket",
        "place",
        sharding.shard_of(F.col("doc_id"), 25).alias("grown_shard"),
    )
    return sharding.slotted(digests)


@query
def op7_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SQL["op7_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op5_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op13_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


SQL["op13_ngram_join"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS s
  FROM worded
), tokens AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM tokens AS a JOIN tokens AS b ON a.token = b.token AND a.doc_id < b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), links AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id
FROM sets JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) AS c ON c.node = sets.doc_id
"""


@query
def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


SQL["op12_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), rows_ AS (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM v
), scored AS (
  SELECT q.row AS anchor, q.vec_id AS anchor_id, r.vec_id, q.label = r.label AS same,
    CAST(list_inner_product(q.e, r.e) AS BIGINT) AS score
  FROM rows_ AS q JOIN rows_ AS r ON q.vec_id <> r.vec_id
  WHERE q.vec_id % 50 = 0
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place FROM scored WHERE same
), ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives AS p JOIN scored AS n ON n.anchor = p.anchor AND NOT n.same
  WHERE p.place <= 5 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""


@query
def op11_repair(spark, sf_dir):
    return repair.digests(repair.damaged(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")
