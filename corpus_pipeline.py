"""The corpus pipeline: five stages of ``fundlake.llm`` applied one after the other.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of ``documents``; sharding adds ``shard``, ``slot`` and ``size``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm import decontaminate, kdtree, mixing, neardup, ordinal
from fundlake.llm.queries import N_SHARDS
from fundlake.llm.tables import stored


#: Shares of words wanted of texts labelled toxic (t1) and not (t0); the quality stage has dealt with the other label.
TOXIC_TARGETS = {"t0": 0.95, "t1": 0.05}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of quality 1 is below one half go."""
    ratings = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("rating"))
    return ordinal.select(docs, ordinal.fit(docs, ratings), least=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays: the one with the smallest id."""
    return neardup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the rates of their domains say."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic is not null")
    domains = labels.select("doc_id", F.format_string("t%d", "toxic").alias("domain"))
    return mixing.mix(docs, mixing.fit(docs, domains), TOXIC_TARGETS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard and its place there."""
    assigned, n_shards = kdtree.assign(docs, n_shards=N_SHARDS)
    placed = kdtree.numbered(assigned, n_shards)
    others = [c for c in docs.columns if c not in ("shard", "slot", "size")]
    return placed.select(*others, F.col("_kd_shard").alias("shard"), F.col("_kd_slot").alias("slot"), F.col("_kd_size").alias("size"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("sharding", sharding),
]
#: The classifiers cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's result is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
