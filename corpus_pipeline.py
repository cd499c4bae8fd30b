"""A corpus from raw documents: quality rules, near-dedup, decontamination, mixing and sharding.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and returns a DataFrame; the
tables it needs besides (labels, benchmark) come from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, nearcopies, quality, sharding, simhash
from tidemark.llm.common import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, found=nearcopies.near_copies)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded(docs)


STAGES = [("quality", keep_good), ("near_dedup", drop_near_copies), ("decontaminate", drop_benchmark), ("mix", mix_sources), ("shard", shard)]

#: SimHash, binomial thresholds and phrase search have no plain SQL form; a brute-force version tests the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
