"""The corpus pipeline: five stages over ``documents``, each one an operator of ``tidemark.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, langid, mixing, sharding, simhash
from tidemark.session import materialized


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language stays unclear go."""
    return langid.recognised(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays: three-word shingles, two bits."""
    return simhash.one_of_each_group(docs, simhash.SHINGLE_WORDS, simhash.MAX_DISTANCE)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document may be left out, taken once or repeated."""
    return mixing.mixed(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard."""
    return sharding.with_shards(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("sharding", assign_shards),
]

# SimHash groups and learned language models have no SQL counterpart; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = materialized(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
