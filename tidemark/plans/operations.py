"""Queries of operations: calendars, requests, contracts, usage and health; and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import bindings as b
from tidemark.bindings import with_
from tidemark.operators import operations as o

NOW = "2024-01-20 00:00:00"
SILENCE = 3600


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """People of ``events`` are contents, their views the readings that were made."""
    e = _events(spark, sf)
    contents = e.select(F.col("user_id").alias("content_id"), F.col("ts").alias("first_seen_at"))
    readings = e.where("event_type = 'view'").select(F.col("user_id").alias("content_id"), F.col("ts").alias("observed_at"))
    return o.refresh_requests(contents, readings, F.lit(NOW).cast("timestamp"))


def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    p = b.posts(spark, sf)
    n = F.col("platform_event_id").cast("long")
    rows = p.select(F.when(n % 11 != 0, F.concat(F.lit(" v"), "platform_event_id")).alias("root_content_id"), F.when(n % 2 == 0, F.col("platform_event_id")).alias("content_id"), F.when(n % 3 != 0, F.col("lang")).alias("requested_language_code"), F.when(n % 5 == 0, F.upper("lang")).alias("requested_language"), F.col("event_ts").alias("created_at"), F.col("lang").alias("language"))
    return o.transcript_requests(rows)


def contracts(spark: SparkSession, sf: str) -> DataFrame:
    """What predictions, examples and context rows made from ``events`` break of their contracts; every row is checked."""
    e = _events(spark, sf)
    n = F.col("event_id")
    source = F.element_at(F.array(*map(F.lit, ("youtube", "x", "reddit", "blog"))), (n % 4 + 1).cast("int"))
    base = e.select("event_id", F.when(n % 13 != 0, source).alias("source"), F.when(n % 17 != 0, F.col("user_id").cast("string")).otherwise("").alias("platform_event_id"), "ts", "event_type", "value")
    prediction = base.select("event_id", "source", "platform_event_id", F.when(n % 19 != 0, F.col("ts")).alias("prediction_ts"), F.lit("m1").alias("model_version"), F.col("event_type").alias("predicted_class"), F.when(n % 23 == 0, F.lit(float("nan"))).otherwise(F.col("value") / 100 - 0.1).alias("confidence"))
    version = F.when(n % 2 == 0, "v2")
    example = base.select("event_id", "source", "platform_event_id", F.col("event_type").alias("text_for_model"), F.lit("viral").alias("label_value"), F.element_at(F.array(*map(F.lit, ("1h", "6h", "2h"))), (n % 3 + 1).cast("int")).alias("label_horizon"), version.alias("schema_version"), F.when(n % 7 == 0, "test").otherwise("train").alias("split_name"), F.lit("platform_reference_quantile").alias("virality_policy"), F.when(n % 5 == 0, "beef").otherwise(F.sha2(n.cast("string"), 256)).alias("virality_contract_fingerprint"))
    context = base.select("event_id", "source", "platform_event_id", F.col("event_type").alias("topic"), (n % 9 - 1).alias("recent_posts_1h"), (F.col("value") - 20).alias("trend_growth_1h"), F.lit("fast").alias("trend_growth_24h"))
    parts = [o.broken(rows, o.CONTRACTS[name], ["event_id"]).withColumn("contract", F.lit(name)) for name, rows in (("prediction", prediction), ("training_example", example), ("context", context))]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("contract", "field", "rule").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.sum("event_id").alias("ids"))


def usage(spark: SparkSession, sf: str) -> DataFrame:
    """Usage rows of an earlier form, which lack costs, status and buckets, by day and operation."""
    e = _events(spark, sf)
    n = F.col("event_id")
    endpoint = F.element_at(F.array(*map(F.lit, ("search.list", "videos.list", "captions.list", "", "other"))), (n % 5 + 1).cast("int"))
    rows = o.usage_rows(e.select(n.alias("usage_id"), endpoint.alias("endpoint"), (F.floor("value").cast("long") - 5).alias("request_count"), F.when(n % 3 == 0, n % 4 - 1).alias("error_count"), F.col("ts").alias("observed_at")))
    return rows.groupBy("usage_date", "operation", "quota_bucket", "status").agg(F.sum("request_count").alias("request_count"), F.sum("quota_units").alias("quota_units"), F.sum("error_count").alias("error_count"), F.count_distinct("external_usage_id").alias("n"))


def health(spark: SparkSession, sf: str) -> DataFrame:
    """The types of ``events`` are workers and their events heartbeats."""
    return o.worker_health(_events(spark, sf), "event_type", "ts", F.lit(NOW).cast("timestamp"), SILENCE)


def runs(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.observations(spark, sf)
    return o.liveness(rows, "platform_event_id", "observed_at", 6 * SILENCE).select("platform_event_id", "start", "end", "beats")


QUERIES = {"f26_b20_refresh_requests": requests, "b20_transcript_requests": transcripts, "p21_row_contracts": contracts, "s14_usage": usage, "s14_b21_worker_health": health, "s14_liveness": runs}

_AGE = "(floor(epoch({0})) - floor(epoch(born))) / 3600"
_SLOT = "len(list_filter([" + ", ".join(map(str, o.OFFSETS)) + "], lambda h: {0} >= h))"
_BASE = "b AS (SELECT event_id AS n, event_id, CASE WHEN event_id % 13 <> 0 THEN ['youtube', 'x', 'reddit', 'blog'][event_id % 4 + 1] END AS source, CASE WHEN event_id % 17 <> 0 THEN user_id::VARCHAR ELSE '' END AS pid, value FROM events)"
_RUNS = """beats AS (SELECT {0} AS worker, {1} AS at_, floor(epoch({1}))::BIGINT AS sec FROM {2}), marked AS (SELECT *, CASE WHEN sec - lag(sec) OVER w <= {3} THEN 0 ELSE 1 END AS fresh FROM beats WINDOW w AS (PARTITION BY worker ORDER BY sec)),
islands AS (SELECT worker, sec, sum(fresh) OVER (PARTITION BY worker ORDER BY sec ROWS UNBOUNDED PRECEDING) AS run FROM marked), runs AS (SELECT worker, run, min(sec) AS a, max(sec) AS b, count(*) AS n FROM islands GROUP BY ALL)"""
SQL = {
    "f26_b20_refresh_requests": f"""WITH born AS (SELECT user_id AS content_id, min(ts) AS born FROM events GROUP BY 1), cal AS (SELECT content_id, born, unnest([{", ".join(map(str, o.OFFSETS))}])::DOUBLE AS offset_hours, unnest(range(1, {len(o.OFFSETS) + 1})) AS slot FROM born),
made AS (SELECT user_id AS content_id, {_SLOT.format(_AGE.format("ts"))} AS slot FROM events JOIN born ON content_id = user_id WHERE event_type = 'view' AND ts <= TIMESTAMP '{NOW}'), last AS (SELECT content_id, max(slot) AS last FROM made WHERE slot > 0 GROUP BY 1),
due AS (SELECT *, date_trunc('second', born) + to_seconds(offset_hours * 3600) AS due_at FROM cal)
SELECT sha256('metadata.refresh' || chr(31) || due.content_id || chr(31) || slot) AS request_id, 'metadata.refresh.requested' AS event_type, due.content_id AS content_id, slot AS refresh_count, offset_hours, due_at, floor((epoch(TIMESTAMP '{NOW}') - epoch(due_at)) / 60)::BIGINT AS late_minutes, coalesce(slot < last, false) AS is_overtaken, 'pending' AS collection_status
FROM due LEFT JOIN last ON last.content_id = due.content_id WHERE due_at <= TIMESTAMP '{NOW}' AND NOT EXISTS (SELECT 1 FROM made m WHERE m.content_id = due.content_id AND m.slot = due.slot)""",
    "b20_transcript_requests": with_("posts", """, r AS (SELECT platform_event_id::BIGINT AS n, * FROM posts), c AS (SELECT *, CASE WHEN n % 3 <> 0 THEN lang ELSE 'en' END AS code FROM r WHERE n % 11 <> 0)
SELECT sha256('transcript' || chr(31) || 'v' || n || chr(31) || code) AS request_id, 'youtube.transcript.requested' AS event_type, 'v' || n AS video_id, CASE WHEN n % 2 = 0 THEN n::VARCHAR ELSE 'v' || n END AS correlation_id, event_ts AS published_at, lang AS language, CASE WHEN n % 5 = 0 THEN upper(lang) ELSE code END AS transcript_requested_language, code AS transcript_requested_language_code, 'pending' AS collection_status FROM c"""),
    "p21_row_contracts": f"""WITH {_BASE}, v AS (
  SELECT n, 'prediction' AS contract, unnest([CASE WHEN source IS NULL THEN 'source:required' END, CASE WHEN source = 'blog' THEN 'source:values' END, CASE WHEN pid = '' THEN 'platform_event_id:required' END, CASE WHEN n % 19 = 0 THEN 'prediction_ts:required' END, CASE WHEN n % 23 = 0 OR value / 100 - 0.1 < 0 OR value / 100 - 0.1 > 1 THEN 'confidence:range' END]) AS what FROM b
  UNION ALL SELECT n, 'training_example', unnest([CASE WHEN source IS NULL THEN 'source:required' END, CASE WHEN source = 'blog' THEN 'source:values' END, CASE WHEN pid = '' THEN 'platform_event_id:required' END, CASE WHEN n % 3 = 2 THEN 'label_horizon:values' END, CASE WHEN n % 14 = 0 THEN 'split_name:values' END, CASE WHEN n % 10 = 0 THEN 'virality_contract_fingerprint:pattern' END]) FROM b
  UNION ALL SELECT n, 'context', unnest([CASE WHEN source IS NULL THEN 'source:required' END, CASE WHEN source = 'blog' THEN 'source:values' END, CASE WHEN pid = '' THEN 'platform_event_id:required' END, CASE WHEN n % 9 = 0 THEN 'recent_posts_1h:range' END, CASE WHEN value - 20 < -1 THEN 'trend_growth_1h:range' END, 'trend_growth_24h:type!string', 'topic_freshness_hours:missing']) FROM b)
SELECT contract, split_part(what, ':', 1) AS field, replace(split_part(what, ':', 2), '!', ':') AS rule, count(*) AS n, min(n) AS first_id, sum(n)::BIGINT AS ids FROM v WHERE what IS NOT NULL GROUP BY ALL""",
    "s14_usage": """WITH r AS (SELECT event_id, ts::DATE AS usage_date, ['search.list', 'videos.list', 'captions.list', 'unknown', 'other'][event_id % 5 + 1] AS operation, [100, 1, 50, 0, 0][event_id % 5 + 1] AS cost, greatest(0, floor(value)::BIGINT - 5) AS requests, CASE WHEN event_id % 3 = 0 THEN greatest(0, event_id % 4 - 1) ELSE 0 END AS errors FROM events)
SELECT usage_date, operation, 'legacy' AS quota_bucket, CASE WHEN errors > 0 THEN 'error' ELSE 'success' END AS status, sum(requests)::BIGINT AS request_count, sum(requests * cost)::BIGINT AS quota_units, sum(errors)::BIGINT AS error_count, count(*) AS n FROM r GROUP BY ALL""",
    "s14_b21_worker_health": "WITH " + _RUNS.format("event_type", "ts", f"(SELECT * FROM events WHERE ts <= TIMESTAMP '{NOW}')", SILENCE) + f""", g AS (SELECT *, coalesce(lead(a) OVER (PARTITION BY worker ORDER BY a), epoch(TIMESTAMP '{NOW}')::BIGINT) - b AS gap FROM runs), t AS (SELECT worker, count(*) AS runs, sum(n)::BIGINT AS beats, sum(b - a)::BIGINT AS alive_seconds, max(gap) AS longest_silence, max(b) AS newest FROM g GROUP BY 1)
SELECT worker AS event_type, runs, beats, alive_seconds, longest_silence, make_timestamp(newest * 1000000) AS last_seen_at, epoch(TIMESTAMP '{NOW}')::BIGINT - newest AS silent_seconds, CASE WHEN epoch(TIMESTAMP '{NOW}') - newest <= {SILENCE} THEN 'alive' WHEN epoch(TIMESTAMP '{NOW}') - newest <= {10 * SILENCE} THEN 'late' ELSE 'dead' END AS state FROM t""",
    "s14_liveness": with_("observations", ", " + _RUNS.format("platform_event_id", "observed_at", "observations", 6 * SILENCE) + ' SELECT worker AS platform_event_id, make_timestamp(a * 1000000) AS start, make_timestamp(b * 1000000) AS "end", n AS beats FROM runs'),
}
