"""Streaming queries run over the driver's tables as topics, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import bindings as b
from tidemark.bindings import with_
from tidemark.operators import tables
from tidemark.plans.ingest import _DECODED
from tidemark.plans.texts import _CLEAN
from tidemark.scratch import new_path, spread
from tidemark.sources import topics
from tidemark.streaming import pipeline as p


SALT = "salt"


def _topic(spark: SparkSession, sf: str) -> str:
    path = new_path(spark, "topic")
    b.event_log(spark, sf).repartition(4).write.json(path)
    return path


def _journalled(spark: SparkSession, sf: str) -> str:
    base = new_path(spark, "journal")
    p.journal(topics.topic_stream(spark, _topic(spark, sf)), base, p.checkpoint_name(base, "journal", "events", "v1"), SALT).awaitTermination()
    return base


def journal(spark: SparkSession, sf: str) -> DataFrame:
    return tables.stored(spark, f"{_journalled(spark, sf)}/journal").select("topic", "offset", "event_id", "user_id", "event_type", "value")


def state(spark: SparkSession, sf: str) -> DataFrame:
    base = _journalled(spark, sf)
    p.apply_events(spark, base)
    p.apply_events(spark, base)  # nothing is left to apply
    return tables.stored(spark, f"{base}/state").select("user_id", "event_id", "event_type", "value")


def windows(spark: SparkSession, sf: str) -> DataFrame:
    """Hours that the watermark closed: all but those after the last event's hour less the delay."""
    base = new_path(spark, "hours")
    path = new_path(spark, "events")
    b.table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts")).write.parquet(path)
    p.to_table(p.hourly(topics.table_stream(spark, path), "ts", "event_type"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema("event_type string, hour timestamp, n long").parquet(f"{base}/out")


def dead_letter_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All that the topic holds now, read once, and its broken messages by topic and reason."""
    rows = topics.tagged(topics.decoded(topics.topic_batch(spark, _topic(spark, sf))))
    return topics.split(rows)[1].groupBy("topic", "reason").agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("last_offset"))


def sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Events of 24 hours by the hour, for windows that the watermark closed."""
    base, path = new_path(spark, "days"), new_path(spark, "events")
    b.table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts")).write.parquet(path)
    p.to_table(p.daily_sliding(topics.table_stream(spark, path), "ts", "event_type"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema("event_type string, until timestamp, n long").parquet(f"{base}/out")


def once_in_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events sent twice, once each, with state that a watermark bounds."""
    base, path = new_path(spark, "once"), new_path(spark, "twice")
    e = b.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    e.unionByName(e.where("event_id % 3 = 0")).write.parquet(path)
    p.to_table(p.deduplicated(topics.table_stream(spark, path), "event_id", "ts", "1 day"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema("event_id long, ts timestamp, event_type string").parquet(f"{base}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


def once_over_days(spark: SparkSession, sf: str) -> DataFrame:
    """Events that come again on later days, in the same batch and in others, stand once in the journal, on the first day of their first batch."""
    path = new_path(spark, "once")
    e = b.table(spark, sf, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    later = e.withColumn("day", F.date_add("day", 2))
    tables.append_once(e.where("event_id % 3 = 0").unionByName(later.where("event_id % 6 <> 1")), path, "event_id", "day")
    tables.append_once(e, path, "event_id", "day")
    tables.append_once(later, path, "event_id", "day")
    return tables.stored(spark, path).select("event_id", "event_type", "day")


def protected(spark: SparkSession, sf: str) -> DataFrame:
    """Posts with texts in nested, listed and mapped fields go through the journal; people are hashed and all texts cleaned."""
    base, path = new_path(spark, "protected"), new_path(spark, "posts")
    d = spread(b.posts(spark, sf))
    fields = F.struct(
        F.col("platform_event_id").alias("event_id"), F.lit("post").alias("event_type"), F.col("community").alias("user_id"), F.col("text").alias("raw_text"), F.struct(F.col("lang").alias("id"), F.substring("text", -300, 300).alias("biography")).alias("author"),
        F.array(F.struct(F.lit("c").alias("id"), F.col("community").alias("author"), F.concat(F.lit("re: "), F.coalesce("text", F.lit(""))).alias("text"))).alias("comments"), F.create_map(F.lit("note"), F.col("text")).alias("extra"),
    )
    d.select(F.lit("posts").alias("topic"), F.lit(0).alias("partition"), F.col("platform_event_id").cast("long").alias("offset"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"), F.to_json(fields).alias("value")).write.json(path, compression="gzip")  # a topic holds each text three times
    p.journal(topics.topic_stream(spark, path), base, f"{base}/mark", SALT, schemas={"posts": topics.POST}).awaitTermination()
    hashed = lambda c: F.sha2(c, 256)
    return tables.stored(spark, f"{base}/journal").select("event_id", "user_id", hashed(F.col("raw_text")).alias("raw_text"), F.col("author.id").alias("author_id"), hashed(F.col("author.biography")).alias("biography"), F.col("comments")[0]["author"].alias("comment_author"), hashed(F.col("comments")[0]["text"]).alias("comment"), hashed(F.col("extra")["note"]).alias("note"))


def growth(spark: SparkSession, sf: str) -> DataFrame:
    """How each event's topic grew by hour and by day, from streams alone, for days that are closed."""
    base, path = new_path(spark, "growth"), new_path(spark, "events")
    b.table(spark, sf, "events").select("event_id", F.col("event_type").alias("topic"), F.col("ts").cast("timestamp").alias("ts")).write.parquet(path)
    p.growth(spark, path, base, "event_id", "topic", "ts")
    return p.grown(spark, base).select("event_id", "topic", *[F.round(c, 6).alias(c) for c in p.GROWTH])


def reread(spark: SparkSession, sf: str) -> DataFrame:
    """Orders meet their customers' table as it is at the last of three beats."""
    table, news, out, mark = (new_path(spark, x) for x in ("customers", "orders", "met", "mark"))
    c = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    b.table(spark, sf, "orders").select("o_orderkey", "o_custkey").write.parquet(news)
    for beat, rows in ((9, c.where("o_custkey % 2 = 0")), (10, c), (11, c.where("o_custkey % 3 <> 0").withColumn("c_mktsegment", F.lower("c_mktsegment")))):
        tables.snapshot(rows, table, str(beat))
        p.reread(spark, table, news, ["o_custkey"], out, mark)
    return tables.pinned(spark, out).select("o_orderkey", "o_custkey", "c_mktsegment")


QUERIES = {"r1_r3_s1_k2_stream_journal": journal, "r4_stream_state": state, "e1_s3_stream_windows": windows, "s2_dead_letter_scan": dead_letter_scan, "e1_sliding_windows": sliding, "r5_once_in_stream": once_in_stream, "k3_r3_once_over_days": once_over_days, "r2_p4_protected_stream": protected, "e1_b24_stream_growth": growth, "s4_reread": reread}
_CLEANED = lambda c, name: _CLEAN.replace("FROM posts", f"FROM (SELECT platform_event_id, {c} AS text FROM posts)").replace("scrubbed", f"s_{name}").replace("cleaned", f"c_{name}").replace("ready", f"r_{name}")
SQL = {
    "k3_r3_once_over_days": """WITH e AS (SELECT event_id, event_type, ts::DATE AS day FROM events)
SELECT event_id, event_type, CASE WHEN event_id % 3 <> 0 AND event_id % 6 <> 1 THEN (day + INTERVAL 2 DAY)::DATE ELSE day END AS day FROM e""",
    "r2_p4_protected_stream": with_("posts", _CLEANED("text", "raw") + _CLEANED("right(text, 300)", "bio") + _CLEANED("'re: ' || coalesce(text, '')", "re") + """
SELECT p.platform_event_id AS event_id, sha256('salt:' || community) AS user_id, sha256(r.clean_text) AS raw_text, sha256('salt:' || lang) AS author_id, sha256(b.clean_text) AS biography, sha256('salt:' || community) AS comment_author, sha256(e.clean_text) AS comment, sha256(r.clean_text) AS note
FROM posts p JOIN r_raw r USING (platform_event_id) JOIN r_bio b USING (platform_event_id) JOIN r_re e USING (platform_event_id) WHERE community IS NOT NULL"""),
    "e1_b24_stream_growth": """WITH e AS (SELECT event_id, event_type AS topic, ts, floor(epoch(ts))::BIGINT AS sec FROM events), h AS (SELECT topic, sec // 3600 AS h, count(*) AS n FROM e GROUP BY ALL), d AS (SELECT topic, sec // 86400 AS d, count(*) AS n FROM e GROUP BY ALL)
SELECT event_id, e.topic AS topic, round((h1.n - h0.n) / h0.n, 6) AS trend_growth_1h, round((d1.n - d0.n) / d0.n, 6) AS trend_growth_24h FROM e
JOIN h h1 ON h1.topic = e.topic AND h1.h = sec // 3600 LEFT JOIN h h0 ON h0.topic = e.topic AND h0.h = sec // 3600 - 1 JOIN d d1 ON d1.topic = e.topic AND d1.d = sec // 86400 LEFT JOIN d d0 ON d0.topic = e.topic AND d0.d = sec // 86400 - 1
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    "s4_reread": "SELECT o_orderkey, o_custkey, lower(c_mktsegment) AS c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON c_custkey = o_custkey",
    "r1_r3_s1_k2_stream_journal": with_("event_log", _DECODED + """ SELECT topic, "offset", event_id, sha256('salt:' || user_id) AS user_id, event_type, value FROM g WHERE reason IS NULL"""),
    "r4_stream_state": with_("event_log", _DECODED + """, v AS (SELECT g.*, e.ts FROM g JOIN events e ON e.event_id = g."offset" WHERE reason IS NULL)
SELECT sha256('salt:' || user_id) AS user_id, event_id, event_type, value FROM v QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""),
    "s2_dead_letter_scan": with_("event_log", _DECODED + ' SELECT topic, reason, count(*) AS n, max("offset") AS last_offset FROM g WHERE reason IS NOT NULL GROUP BY ALL'),
    "e1_sliding_windows": """WITH w AS (SELECT event_type, unnest(generate_series(date_trunc('hour', ts) + INTERVAL 1 HOUR, date_trunc('hour', ts) + INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS until FROM events)
SELECT event_type, until, count(*) AS n FROM w WHERE until <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY ALL""",
    "r5_once_in_stream": "SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY event_type",
    "e1_s3_stream_windows": "WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2) SELECT * FROM h WHERE hour + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)",
}
