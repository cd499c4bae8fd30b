"""The driver's tables in the shapes the operators take, as DataFrames and as SQL.

``observations`` are running counts a post (a user of ``events``): views, clicks as likes and purchases as
comments; every 11th event reads three too low, and errors observe nothing. ``posts`` are ``documents``,
``event_log`` is a topic of JSON messages with some broken ones, ``interactions`` are ``conversations`` as reply
threads, ``activity`` are ``orders`` by customer and nation, ``measurements`` are ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SOURCES = ("youtube", "x", "reddit")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _source(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, SOURCES)), (F.pmod(number, F.lit(3)) + 1).cast("int"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    so_far = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.col("event_type") != "error"

    def running(kind: str) -> Column:
        n = F.sum((F.col("event_type") == kind).cast("long")).over(so_far)
        return F.when(seen, F.greatest(n - F.when(F.col("event_id") % 11 == 0, 3).otherwise(0), F.lit(0)).cast("long"))

    return events.select(
        _source(F.col("user_id")).alias("source"),
        F.col("user_id").cast("string").alias("platform_event_id"),
        F.concat(F.lit("https://example.com/p/"), F.col("user_id").cast("string")).alias("url"),
        F.col("event_id"),
        F.min("ts").over(Window.partitionBy("user_id")).alias("created_at"),
        F.col("ts").alias("observed_at"),
        *[running(kind).alias(name) for name, kind in (("view_count", "view"), ("like_count", "click"), ("comment_count", "purchase"))],
        *[seen.alias(f"{name}_available") for name in ("view_count", "like_count", "comment_count")],
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        _source(F.col("doc_id")).alias("source"),
        F.col("doc_id").cast("string").alias("platform_event_id"),
        F.sha2(F.concat(F.lit("salt:"), (F.col("doc_id") % 97).cast("string")), 256).alias("author_hash"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("doc_id").cast("int"))).alias("event_ts"),
        F.col("text"),
        F.col("lang"),
        F.col("source").alias("community"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    body = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"), F.when(F.col("event_id") % 19 == 0, "").otherwise(F.concat(F.lit(',"user_id":'), F.col("user_id").cast("string"))),
        F.lit(',"event_type":"'), F.col("event_type"), F.lit('","value":'), F.floor("value").cast("string"), F.lit("}"),
    )
    whole = F.when(F.col("event_id") % 17 == 0, F.substring(body, F.lit(1), F.length(body) - 5)).otherwise(body)
    return e.select(F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"), whole.alias("value"))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("root_content_id"), F.col("turn").alias("position_in_thread"), F.concat(F.col("role"), F.col("conv_id").cast("string")).alias("author_id_hash"), _source(F.col("conv_id")).alias("source"), "text", F.length("text").cast("long").alias("score"))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("identifier"), F.col("n_name").alias("source"), F.col("c_mktsegment").alias("role"), F.col("o_orderdate").cast("timestamp").alias("event_ts"), F.col("o_orderkey").alias("event_id"), F.floor("o_totalprice").cast("long").alias("view_count"), F.when(F.col("o_orderstatus") != "P", F.length("o_orderpriority").cast("long")).alias("like_count"), (F.col("o_orderstatus") == "F").alias("is_reply"), F.col("o_orderpriority").alias("text")
    )


#: The same shapes in SQL; ``with_`` puts those named, and what they need, before a query.
CTE = {
    "observations": """observations AS (
  SELECT CASE user_id % 3 WHEN 0 THEN 'youtube' WHEN 1 THEN 'x' ELSE 'reddit' END AS source, user_id::VARCHAR AS platform_event_id,
    'https://example.com/p/' || user_id::VARCHAR AS url, event_id, min(ts) OVER (PARTITION BY user_id) AS created_at, ts AS observed_at,
    CASE WHEN event_type <> 'error' THEN greatest(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER w - CASE WHEN event_id % 11 = 0 THEN 3 ELSE 0 END, 0)::BIGINT END AS view_count,
    CASE WHEN event_type <> 'error' THEN greatest(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER w - CASE WHEN event_id % 11 = 0 THEN 3 ELSE 0 END, 0)::BIGINT END AS like_count,
    CASE WHEN event_type <> 'error' THEN greatest(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER w - CASE WHEN event_id % 11 = 0 THEN 3 ELSE 0 END, 0)::BIGINT END AS comment_count,
    event_type <> 'error' AS view_count_available, event_type <> 'error' AS like_count_available, event_type <> 'error' AS comment_count_available
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))""",
    "posts": """posts AS (
  SELECT CASE doc_id % 3 WHEN 0 THEN 'youtube' WHEN 1 THEN 'x' ELSE 'reddit' END AS source, doc_id::VARCHAR AS platform_event_id, sha256('salt:' || (doc_id % 97)::VARCHAR) AS author_hash,
    TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS event_ts, text, lang, source AS community FROM documents)""",
    "event_log": """event_log AS (
  SELECT topic, "partition", "offset", ts AS "timestamp", CASE WHEN "offset" % 17 = 0 THEN substr(body, 1, length(body) - 5) ELSE body END AS value FROM (
    SELECT event_type AS topic, (user_id % 4)::INTEGER AS "partition", event_id AS "offset", ts, '{"event_id":' || event_id || CASE WHEN event_id % 19 = 0 THEN '' ELSE ',"user_id":' || user_id END || ',"event_type":"' || event_type || '","value":' || floor(value)::BIGINT || '}' AS body FROM events))""",
    "interactions": """interactions AS (
  SELECT conv_id AS root_content_id, turn AS position_in_thread, role || conv_id::VARCHAR AS author_id_hash, CASE conv_id % 3 WHEN 0 THEN 'youtube' WHEN 1 THEN 'x' ELSE 'reddit' END AS source, text, length(text)::BIGINT AS score FROM conversations)""",
    "activity": """activity AS (
  SELECT c_custkey AS identifier, n_name AS source, c_mktsegment AS role, o_orderdate AS event_ts, o_orderkey AS event_id, floor(o_totalprice)::BIGINT AS view_count, CASE WHEN o_orderstatus <> 'P' THEN length(o_orderpriority)::BIGINT END AS like_count, o_orderstatus = 'F' AS is_reply, o_orderpriority AS text
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
}


def with_(names: str, rest: str) -> str:
    """A SQL query whose WITH clause begins with the shapes in ``names``; ``rest`` may add more (", x AS (...) SELECT ...")."""
    return "WITH " + ", ".join(CTE[n] for n in names.split()) + " " + rest
