"""From raw documents to packed sequences, in five stages.

Each stage takes what the one before kept, from Parquet in the shared folder, and all but the last return the columns
of ``documents``.  A document without id goes through the stages that look at documents one by one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import language, neardup, packing, quality, repeats
from ebbline.llm.batches import discard
from ebbline.session import prepare, shared_dir
from ebbline.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counting rules and are mostly content."""
    return quality.keep_good(docs, quality.train(docs, table(prepare(spark), sf_dir, "labels")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus has; ``lang`` stays as given."""
    prepare(spark)
    return language.keep_known(docs, language.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return neardup.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that occur earlier."""
    prepare(spark)
    return repeats.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, in pieces, and their places in sequences."""
    prepare(spark)
    path = public_tokenizers.path
    files = path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return packing.pack(packing.pieces(docs, *files, held=True))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("packing", pack),
]

#: No SQL for trained models and tokens.  The tests compare near-duplicates, repeats and packing with brute-force
#: versions, and the two stages of trained models with the operators' own verdicts, which have tests of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed tokens of ``documents``.  A stage's table is removed once the next one is written."""
    rows, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_dir(spark, name.replace(" ", "-"))
        stage(spark, rows, sf_dir).write.parquet(path)
        if before is not None:
            discard(spark, before)
        rows, before = spark.read.parquet(path), path
    return rows
