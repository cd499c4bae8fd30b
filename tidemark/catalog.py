"""All queries of the library but the corpus operators', and their SQL.

A query's name begins with the inventory ids it covers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.plans import contents, corpora, engagement, ingest, maintenance, models, operations, reporting, sourcing, streams, texts

FLAGSHIP = "b8_velocity"
MODULES = (engagement, contents, corpora, ingest, maintenance, operations, reporting, sourcing, streams, texts, models)


def _plain(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with timestamps without zone, as the tables have them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
        return df.withColumns({c: df[c].cast("timestamp_ntz") for c in zoned}) if zoned else df

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _plain(q) for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
