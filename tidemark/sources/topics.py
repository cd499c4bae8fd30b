"""Reading topics: envelopes of (topic, partition, offset, timestamp, value), decoding, tagging and dead letters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identity import rejected

ENVELOPE = "topic string, partition int, offset long, timestamp timestamp, value string"
EVENT = "event_id long, user_id long, event_type string, value long"
#: Canonical events of posts, with what is nested in them; every field may be missing.
POST = """event_id string, observation_id string, source string, platform_event_id string, user_id string, content_id string, root_content_id string, parent_content_id string, event_type string, content_type string, relation_type string,
title string, raw_text string, clean_text string, text_for_model string, language string, url string, published_at string, collected_at string, view_count long, like_count long, comment_count long,
author struct<id: string, name: string, biography: string>, mentions array<string>, comments array<struct<id: string, author: string, text: string>>, extra map<string, string>, transcript_text string, transcript_status string, metadata_json string"""
_BAD = "_corrupt_record"


def topic_stream(spark: SparkSession, path: str, servers: str | None = None, topic: str | None = None, allow_data_loss: bool = False) -> DataFrame:
    """A topic as a stream; without brokers, a folder of JSON envelopes stands in."""
    if servers:
        raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").option("failOnDataLoss", str(not allow_data_loss).lower()).load()
        return raw.select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))
    return spark.readStream.schema(ENVELOPE).json(path)


def topic_batch(spark: SparkSession, path: str) -> DataFrame:
    """All that a topic holds now."""
    return spark.read.schema(ENVELOPE).json(path)


def table_stream(spark: SparkSession, path: str) -> DataFrame:
    """S3: a table's new files as a stream."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def heartbeat(spark: SparkSession, per_batch: int = 1) -> DataFrame:
    """A rate source, which only says when to read again."""
    return spark.readStream.format("rate-micro-batch").option("rowsPerBatch", per_batch).load()


def decoded(envelopes: DataFrame, schema: str = EVENT) -> DataFrame:
    """The message's fields beside its envelope, and ``decode_error`` for text that is no JSON of this form."""
    return decoded_by_topic(envelopes, {None: schema})


def fields_of(schemas: Mapping[str | None, str]) -> dict[str, T.DataType]:
    """All fields of some schemas in order; a name has one type in all of them."""
    out: dict[str, T.DataType] = {}
    for schema in schemas.values():
        for f in T.StructType.fromDDL(schema):
            if out.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"{f.name} is {out[f.name].simpleString()} and {f.dataType.simpleString()}")
    return out


def decoded_by_topic(envelopes: DataFrame, schemas: Mapping[str | None, str]) -> DataFrame:
    """Messages read by the schema registered for their topic (None: for all others), with the fields of all schemas, null where a topic has none.

    ``decode_error`` is malformed_json or unregistered_topic; a broken message gives no field at all.
    """
    fields, bad, known, out = fields_of(schemas), F.lit(False), F.lit(False), {}
    rows = envelopes.withColumnRenamed("value", "raw")
    for k, (topic, schema) in enumerate(schemas.items()):
        own = {f.name for f in T.StructType.fromDDL(schema)}
        mine = ~known if topic is None else F.col("topic") == topic
        rows = rows.withColumn(f"_p{k}", F.when(mine, F.from_json("raw", f"{schema}, {_BAD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})))
        p = F.col(f"_p{k}")
        bad = F.when(mine, p[_BAD].isNotNull() | p.isNull()).otherwise(bad)
        for name in own:
            out[name] = F.when(mine & p[_BAD].isNull(), p[name]).otherwise(out.get(name, F.lit(None).cast(fields[name])))
        known = known | mine
    error = F.when(~known, "unregistered_topic").when(bad, "malformed_json")
    return rows.select("topic", "partition", "offset", "timestamp", "raw", error.alias("decode_error"), *[out[n].alias(n) for n in fields])


def framed(value: Column, writers: dict[int, str]) -> tuple[Column, Column]:
    """The body of a framed message (a zero byte, a schema id of four bytes, the body) by its writer's schema, and the error.

    Bodies are JSON here; with the Avro reader on the class path the same dispatch takes ``from_avro``.
    """
    known = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")
    body = F.decode(F.substring(value, 6, 1 << 30), "UTF-8")
    names = list(dict.fromkeys(x.strip().split()[0] for s in writers.values() for x in s.split(",")))
    chain = None
    for number, schema in writers.items():
        own = {x.strip().split()[0] for x in schema.split(",")}
        parsed = F.from_json(body, schema)
        row = F.struct(*[(parsed[n] if n in own else F.lit(None)).cast("string").alias(n) for n in names])
        chain = F.when(known == number, row) if chain is None else chain.when(known == number, row)
    return chain, F.when(~known.isin(*writers) | (F.hex(F.substring(value, 1, 1)) != "00"), "unregistered_writer_schema")


def first_failure(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule that holds, or null."""
    out = None
    for condition, name in rules:
        condition = F.coalesce(condition, F.lit(False))
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return out


def tagged(rows: DataFrame) -> DataFrame:
    """The first reason to reject a decoded event; a schema without readings has none that is negative."""
    negative = F.col("value") < 0 if "value" in rows.columns else F.lit(False)
    first = first_failure((F.col("user_id").isNull(), "missing_user_id"), (F.col("event_type").isNull(), "missing_event_type"), (F.col("event_type") == "error", "collector_error"), (negative, "negative_value"))
    return rows.withColumn("reason", F.coalesce(F.col("decode_error"), first))


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid rows, and dead letters that keep nothing of the payload but its size and hash."""
    good = rows.where("reason is null").drop("reason", "raw", "decode_error")
    return good, rows.where("reason is not null").select("topic", "partition", "offset", "reason", rejected(F.col("raw")).alias("payload"), *[c for c in ("day",) if c in rows.columns])
