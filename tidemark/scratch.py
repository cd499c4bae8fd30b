"""Tables between steps, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT = "spark.checkpoint.dir"


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names; a fresh local one only for a local master that names none (tests)."""
    base = spark.conf.get(CHECKPOINT, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT} must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        base = _own[app]
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, for work that costs more than a shuffle of its rows.

    A large input has more partitions than that and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
