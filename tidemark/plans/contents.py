"""Queries over contents, replies, transcripts and people, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import bindings as b
from tidemark.functions import identity
from tidemark.operators import entities as e
from tidemark.operators import quality, tables
from tidemark.scratch import written


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as posts and conversations as replies, in the shape of canonical events."""
    d, c = b.table(spark, sf, "documents"), b.table(spark, sf, "conversations")
    source = lambda n: F.element_at(F.array(*map(F.lit, b.SOURCES)), (n % 3 + 1).cast("int"))
    s = lambda x: F.col(x).cast("string")
    link = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("https://y.com/watch?v="), s("doc_id"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("https://x.com/i/status/"), s("doc_id"))).otherwise(F.concat(F.lit("https://r.com/r/"), F.col("source"), F.lit("/comments/"), s("doc_id"), F.lit("/some_title-of-it/")))
    posts = d.select(
        source(F.col("doc_id")).alias("source"), F.when(F.col("doc_id") % 4 != 0, s("doc_id")).alias("platform_event_id"), link.alias("url"), F.concat(F.lit("t"), s("doc_id")).alias("title"), F.col("text"), F.concat(F.lit("p"), (F.col("doc_id") % 97).cast("string")).alias("user_id"), F.col("lang").alias("language"),
        F.when(F.col("doc_id") % 3 == 2, "post").alias("relation_type"), F.lit(None).cast("string").alias("conversation_id"), F.when(F.col("doc_id") % 5 == 0, "success").otherwise("failed").alias("metadata_status"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("doc_id").cast("int"))).alias("event_ts"), (F.col("doc_id") * 2).alias("event_id"), F.lit(None).cast("long").alias("score"),
    )
    link = F.concat(F.lit("https://r.com/r/sub/comments/"), s("conv_id"), F.lit("/x/c"), s("turn"))
    replies = c.select(
        source(F.col("conv_id")).alias("source"), F.concat(s("conv_id"), F.lit("-"), s("turn")).alias("platform_event_id"), link.alias("url"), F.lit(None).cast("string").alias("title"), F.col("text"), F.concat(F.lit("p"), (F.col("conv_id") % 97).cast("string")).alias("user_id"), F.lit("en").alias("language"),
        F.when(F.col("conv_id") % 3 != 2, "reply").alias("relation_type"), s("conv_id").alias("conversation_id"), F.lit(None).cast("string").alias("metadata_status"), (F.lit("2024-01-02").cast("timestamp") + F.make_dt_interval(mins=F.col("conv_id").cast("int"))).alias("event_ts"), (F.col("conv_id") * 1000 + F.col("turn") * 2 + 1).alias("event_id"), F.length("text").cast("long").alias("score"),
    )
    return posts.unionByName(replies)


def normalised(spark: SparkSession, sf: str) -> DataFrame:
    return e.normalised(_events(spark, sf)).select("event_id", "source", "platform_content_id", "content_id", "parent_content_id", "interaction_id", "is_interaction", "content_type", "interaction_type", "subreddit", "title")


def contents(spark: SparkSession, sf: str) -> DataFrame:
    return e.contents(e.normalised(_events(spark, sf)))


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    return e.interactions(e.normalised(_events(spark, sf))).select("interaction_id", "source", "root_content_id", "interaction_type", "author_id_hash", "event_id", "score")


def stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = written(e.normalised(_events(spark, sf)), "canonical")  # three builders read it
    readings = rows.where("not is_interaction").select("content_id", F.col("event_ts").alias("observed_at"), "event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("view_count"), (F.col("event_id") % 5 != 0).alias("view_count_available"))
    made = e.content_stats(e.contents(rows), e.interactions(rows), readings, ("view_count",))
    return made.select("content_id", "source", "interaction_count", "unique_users", F.round("avg_length", 6).alias("avg_length"), "total_score", "latest_view_count", "latest_view_count_available")


def evolution(spark: SparkSession, sf: str) -> DataFrame:
    rows = written(e.normalised(_events(spark, sf)), "canonical")  # two builders read it
    return e.user_evolution(e.contents(rows), e.interactions(rows)).withColumn("avg_length", F.round("avg_length", 6))


def _attempts(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("event_id")
    words = F.element_at(F.array(*map(F.lit, ("success", "not_found", "Disabled", "rate_limited", "ip_blocked", "permanent_error", " pending ", "odd"))), (n % 8 + 1).cast("int"))
    text, told = F.when(n % 8 == 0, F.lit("some words")), F.when(n % 31 == 0, F.lit("unavailable"))
    rows = b.table(spark, sf, "events").select(
        F.col("user_id").alias("video_id"), n.alias("attempt_id"), e.lifecycle(text, told, words).alias("lifecycle_status"), e.language_code(F.when(n % 6 == 0, F.lit("fr")), F.when(n % 2 == 0, F.lit("vi-VN"))).alias("language_code"), F.when(n % 7 != 0, F.col("ts")).alias("last_attempt_at"), F.col("ts").alias("updated_at"), (n % 6).alias("attempt_count"), e.retry_seconds(n % 25).alias("retry_seconds")
    )
    return rows


def lifecycles(spark: SparkSession, sf: str) -> DataFrame:
    """F16: states by status word, error code, text and attempts, and the words of old for them."""
    n = F.col("event_id")
    word = F.element_at(F.array(*map(F.lit, ("success", "partial", " Not_Found", "age_restricted", "rate_limited", "unavailable", "odd", "pending"))), (n % 8 + 1).cast("int"))
    code = F.when(n % 5 == 0, "request_blocked").when(n % 7 == 0, "Invalid_Video_Id").when(n % 11 == 0, "other")
    rows = b.table(spark, sf, "events").select("event_id", e.lifecycle_state(F.when(n % 13 != 0, word), code, n % 17 == 0, n % 6, 4).alias("state"))
    return rows.withColumn("legacy", e.legacy_status(F.col("state")))


def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return e.best_transcripts(_attempts(spark, sf), ["video_id", "language_code"])


def retries(spark: SparkSession, sf: str) -> DataFrame:
    return e.retry_candidates(_attempts(spark, sf), F.lit("2024-01-20").cast("timestamp_ntz"), 4, 24, 200)


def refresh(spark: SparkSession, sf: str) -> DataFrame:
    ev = b.table(spark, sf, "events")
    rows = ev.select(F.col("event_id").alias("content_id"), F.col("event_type").alias("source"), F.col("ts").alias("event_ts"), F.when(F.col("event_id") % 5 != 0, F.col("ts") + F.expr("INTERVAL 36 HOURS")).alias("next_refresh_at"), e.refresh_minutes(F.col("event_id") % 1000, e.growth_multiplier(F.when(F.col("event_id") % 3 == 0, F.floor("value") * 40))).alias("minutes"))
    return e.refresh_targets(rows, F.lit("2024-01-20").cast("timestamp_ntz"), {"view": 7, "click": 14}, "source", 100)


def covered(spark: SparkSession, sf: str) -> DataFrame:
    ev = b.table(spark, sf, "events").select("user_id", (F.col("event_id") * 37 % 5000).alias("start"), (F.col("event_id") * 37 % 5000 + F.floor("value").cast("long")).alias("end"))
    return e.covered_seconds(ev, "user_id")


def tree(spark: SparkSession, sf: str) -> DataFrame:
    c = b.table(spark, sf, "conversations")
    node = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    rows = c.select(node(F.col("turn")).alias("id"), F.when(F.col("turn") > 0, node(F.floor(F.col("turn") / 2))).alias("parent_id"))
    return e.comment_tree(rows)


def optional_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Missing columns, availability flags, and texts read as times."""
    from pyspark.sql import types as T

    o = b.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("seen_at"), F.when(F.col("o_orderstatus") != "P", F.floor("o_totalprice").cast("long")).alias("views"))
    rows = tables.with_availability(tables.with_optional(o, {"likes": "long"}), ["views", "likes"])
    return tables.aligned(rows, T.StructType([T.StructField("seen_at", T.TimestampNTZType())]))


def orphans(spark: SparkSession, sf: str) -> DataFrame:
    p = b.table(spark, sf, "pages")
    listed = p.select(F.concat(F.lit("s3a://bucket//data/"), F.col("page_id").cast("string")).alias("path"))
    return quality.orphan_files(listed, p.where("page_id % 3 <> 0").select(F.concat(F.lit("s3:/bucket/data/"), F.col("page_id").cast("string")).alias("path")), "path")


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """how often each version of a transcript's words was collected."""
    d = b.table(spark, sf, "documents")
    code = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit(" "), F.upper("lang"), F.lit("_X"))).when(F.col("doc_id") % 4 == 1, F.col("lang"))
    rows = d.select("doc_id", identity.transcript_version(F.col("source"), code, F.col("text")).alias("version"))
    return rows.groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))


QUERIES = {
    "f18_transcript_versions": versions,
    "p6_f15_normalised": normalised, "b1_a1_contents": contents, "b2_interactions": interactions, "b5_a2_j8_content_stats": stats, "b6_a3_u1_user_evolution": evolution, "b4_f16_f17_w4_transcripts": transcripts, "f16_lifecycles": lifecycles, "p10_p23_b20_retries": retries, "p9_w8_f26_f53_refresh_targets": refresh,
    "w17_covered_seconds": covered, "s15_comment_tree": tree, "s12_p5_p20_optional_columns": optional_columns, "u5_orphan_files": orphans,
}

_SRC = lambda n: f"CASE {n} % 3 WHEN 0 THEN 'youtube' WHEN 1 THEN 'x' ELSE 'reddit' END"
_EVENTS = f"""WITH ev AS (
  SELECT {_SRC('doc_id')} AS source, CASE WHEN doc_id % 4 <> 0 THEN doc_id::VARCHAR END AS pid, CASE doc_id % 3 WHEN 0 THEN 'https://y.com/watch?v=' || doc_id WHEN 1 THEN 'https://x.com/i/status/' || doc_id ELSE 'https://r.com/r/' || source || '/comments/' || doc_id || '/some_title-of-it/' END AS url, 't' || doc_id AS title, text,
    'p' || doc_id % 97 AS user_id, lang AS language, CASE WHEN doc_id % 3 = 2 THEN 'post' END AS relation, NULL AS conv, CASE WHEN doc_id % 5 = 0 THEN 'success' ELSE 'failed' END AS metadata_status, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS event_ts, doc_id * 2 AS event_id, NULL::BIGINT AS score, doc_id::VARCHAR AS derived, source AS sub0 FROM documents
  UNION ALL SELECT {_SRC('conv_id')}, conv_id || '-' || turn, 'https://r.com/r/sub/comments/' || conv_id || '/x/c' || turn, NULL, text, 'p' || conv_id % 97, 'en', CASE WHEN conv_id % 3 <> 2 THEN 'reply' END, conv_id::VARCHAR, NULL, TIMESTAMP '2024-01-02' + to_minutes(conv_id), conv_id * 1000 + turn * 2 + 1, length(text)::BIGINT, CASE WHEN conv_id % 3 = 2 THEN conv_id::VARCHAR END, 'sub' FROM conversations
), o AS (SELECT *, coalesce(pid, derived, url) AS own, CASE WHEN source = 'reddit' THEN coalesce(conv, derived, pid, url) ELSE coalesce(pid, derived, url) END AS root FROM ev),
n AS (SELECT *, sha256(source || ':' || root) AS content_id, CASE WHEN source = 'reddit' THEN sha256(source || ':' || root) END AS parent_content_id, coalesce(relation IN ('comment', 'reply', 'interaction'), false) OR (source = 'reddit' AND relation IS NULL) AS is_interaction FROM o),
norm AS (SELECT *, CASE WHEN is_interaction THEN sha256(source || ':' || own) ELSE sha256(source || ':' || own || ':' || user_id) END AS interaction_id, CASE source WHEN 'reddit' THEN 'reddit_post' WHEN 'x' THEN 'x_post' ELSE 'youtube_video' END AS content_type, CASE source WHEN 'reddit' THEN 'reddit_comment' WHEN 'x' THEN 'x_reply' ELSE 'youtube_comment' END AS interaction_type,
  CASE WHEN source = 'reddit' THEN sub0 END AS subreddit, CASE WHEN source = 'reddit' THEN CASE WHEN conv IS NULL THEN 'some title of it' ELSE 'x' END ELSE title END AS t FROM n)"""
_F = lambda c, cond="true": f"arg_min({c}, (event_ts, event_id)) FILTER ({c} IS NOT NULL AND {cond})"
_CONTENTS = f""", contents AS (SELECT content_id, {_F('source')} AS source, {_F('root')} AS platform_content_id, {_F('content_type')} AS content_type, {_F('url')} AS url, {_F('t')} AS title, {_F('subreddit')} AS subreddit, {_F('language')} AS language, ({_F('event_ts')})::DATE AS event_date, {_F('parent_content_id')} AS parent_content_id, {_F('text', "source <> 'reddit'")} AS text, {_F('user_id', "source <> 'reddit'")} AS author_id_hash,
  CASE WHEN bool_or(metadata_status = 'success') THEN 'success' ELSE {_F('metadata_status')} END AS metadata_status, max(event_ts) AS last_event_at FROM norm WHERE NOT is_interaction OR source = 'reddit' GROUP BY content_id),
replies AS (SELECT * FROM norm WHERE is_interaction QUALIFY row_number() OVER (PARTITION BY interaction_id ORDER BY event_ts, event_id) = 1)"""
_WORDS = lambda c: f"avg(len(regexp_split_to_array(trim(coalesce({c}, '')), '\\s+')))"
_ATTEMPTS = """WITH w AS (SELECT *, ['success', 'not_found', 'Disabled', 'rate_limited', 'ip_blocked', 'permanent_error', ' pending ', 'odd'][event_id % 8 + 1] AS word FROM events),
a AS (SELECT user_id AS video_id, event_id AS attempt_id, CASE WHEN event_id % 8 = 0 THEN 'available' WHEN event_id % 31 = 0 THEN 'unavailable' ELSE CASE lower(trim(word)) WHEN 'not_found' THEN 'unavailable' WHEN 'ip_blocked' THEN 'blocked' WHEN 'odd' THEN 'retryable_error' ELSE lower(trim(word)) END END AS lifecycle_status,
  CASE WHEN event_id % 6 = 0 THEN 'fr' WHEN event_id % 2 = 0 THEN 'vi' ELSE 'en' END AS language_code, CASE WHEN event_id % 7 <> 0 THEN ts END AS last_attempt_at, ts AS updated_at, event_id % 6 AS attempt_count, least(86400, 60 * 2 ** least(event_id % 25, 20))::BIGINT AS retry_seconds FROM w)"""
SQL = {
    "f18_transcript_versions": """SELECT sha256(coalesce(source, '') || chr(31) || CASE doc_id % 4 WHEN 0 THEN coalesce(lower(lang) || '-x', '') WHEN 1 THEN coalesce(lang, '') ELSE '' END || chr(31) || coalesce(text, '')) AS version, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1""",
    "p6_f15_normalised": _EVENTS + " SELECT event_id, source, root AS platform_content_id, content_id, parent_content_id, interaction_id, is_interaction, content_type, interaction_type, subreddit, t AS title FROM norm",
    "b1_a1_contents": _EVENTS + _CONTENTS + " SELECT * FROM contents",
    "b2_interactions": _EVENTS + _CONTENTS + " SELECT interaction_id, source, content_id AS root_content_id, interaction_type, user_id AS author_id_hash, event_id, score FROM replies",
    "b5_a2_j8_content_stats": _EVENTS + _CONTENTS + f""", st AS (SELECT content_id, count(*) AS interaction_count, count(DISTINCT user_id) AS unique_users, {_WORDS('text')} AS avg_length, sum(score)::BIGINT AS total_score FROM replies GROUP BY content_id),
  k AS (SELECT content_id, arg_max(event_id, (event_ts, event_id)) FILTER (event_id % 3 <> 0 AND event_id % 5 <> 0) AS v FROM norm WHERE NOT is_interaction GROUP BY content_id)
SELECT c.content_id, source, interaction_count, unique_users, round(avg_length, 6) AS avg_length, total_score, v AS latest_view_count, CASE WHEN k.content_id IS NOT NULL THEN v IS NOT NULL END AS latest_view_count_available FROM contents c LEFT JOIN st USING (content_id) LEFT JOIN k USING (content_id)""",
    "b6_a3_u1_user_evolution": _EVENTS + _CONTENTS + f""", act AS (SELECT author_id_hash AS u, source, event_date, content_id, subreddit, NULL AS conv, text, 1 AS made FROM contents UNION ALL SELECT user_id, source, event_ts::DATE, content_id, NULL, conv, text, 0 FROM replies)
SELECT u AS user_id_hash, source, event_date, sum(made)::BIGINT AS contents_created, sum(1 - made)::BIGINT AS interactions_created, count(DISTINCT content_id) AS distinct_contents, count(DISTINCT subreddit) AS distinct_subreddits, count(DISTINCT conv) AS distinct_conversations, round({_WORDS('text')}, 6) AS avg_length, count(*) FILTER (contains(coalesce(text, ''), '?')) AS questions FROM act GROUP BY ALL""",
    "b4_f16_f17_w4_transcripts": _ATTEMPTS + " SELECT video_id, language_code, attempt_id, lifecycle_status, last_attempt_at, updated_at, attempt_count, retry_seconds FROM a QUALIFY row_number() OVER (PARTITION BY video_id, language_code ORDER BY (lifecycle_status = 'available') DESC, last_attempt_at DESC NULLS LAST, updated_at DESC, attempt_id DESC) = 1",
    "f16_lifecycles": """WITH w AS (SELECT event_id, event_id % 6 AS attempts, event_id % 17 = 0 AS has_text, CASE WHEN event_id % 13 <> 0 THEN ['success', 'partial', 'not_found', 'age_restricted', 'rate_limited', 'unavailable', 'odd', 'pending'][event_id % 8 + 1] ELSE 'pending' END AS s, CASE WHEN event_id % 5 = 0 THEN 'request_blocked' WHEN event_id % 7 = 0 THEN 'invalid_video_id' WHEN event_id % 11 = 0 THEN 'other' END AS c FROM events),
a AS (SELECT *, CASE WHEN has_text THEN 'available' WHEN c = 'request_blocked' THEN 'blocked' WHEN c = 'invalid_video_id' THEN 'permanent_error' WHEN s IN ('rate_limited', 'unavailable', 'pending') THEN s WHEN s = 'success' THEN 'available' WHEN s IN ('not_found', 'age_restricted') THEN 'unavailable' ELSE 'retryable_error' END AS st FROM w),
f AS (SELECT event_id, CASE WHEN st IN ('pending', 'rate_limited', 'blocked', 'retryable_error') AND attempts >= 4 THEN 'permanent_error' ELSE st END AS state FROM a)
SELECT *, CASE state WHEN 'available' THEN 'success' WHEN 'unavailable' THEN 'not_available' WHEN 'blocked' THEN 'rate_limited' WHEN 'retryable_error' THEN 'failed' WHEN 'permanent_error' THEN 'failed' ELSE state END AS legacy FROM f""",
    "p10_p23_b20_retries": _ATTEMPTS + " SELECT * FROM a WHERE lifecycle_status IN ('retryable_error', 'rate_limited', 'blocked', 'pending') AND attempt_count < 4 AND (last_attempt_at IS NULL OR last_attempt_at <= TIMESTAMP '2024-01-19') ORDER BY last_attempt_at NULLS FIRST, attempt_id LIMIT 200",
    "p9_w8_f26_f53_refresh_targets": """WITH r AS (SELECT event_id AS content_id, event_type AS source, ts AS event_ts, CASE WHEN event_id % 5 <> 0 THEN ts + INTERVAL 36 HOUR END AS next_refresh_at, round((CASE WHEN event_id % 1000 < 6 THEN 30 WHEN event_id % 1000 < 24 THEN 60 WHEN event_id % 1000 < 72 THEN 180 WHEN event_id % 1000 < 168 THEN 360 WHEN event_id % 1000 < 720 THEN 1440 ELSE 10080 END)
  * CASE WHEN event_id % 3 = 0 AND floor(value) * 40 >= 1000 THEN 0.5 ELSE 1.0 END)::BIGINT AS minutes FROM events)
SELECT *, row_number() OVER (PARTITION BY source ORDER BY next_refresh_at NULLS FIRST, content_id)::INTEGER AS turn FROM r WHERE ((source = 'view' AND event_ts >= TIMESTAMP '2024-01-13') OR (source = 'click' AND event_ts >= TIMESTAMP '2024-01-06')) AND (next_refresh_at IS NULL OR next_refresh_at <= TIMESTAMP '2024-01-20') QUALIFY turn <= 100""",
    "w17_covered_seconds": """WITH i AS (SELECT user_id, event_id * 37 % 5000 AS s, event_id * 37 % 5000 + floor(value)::BIGINT AS e FROM events), r AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i WHERE e > s)
SELECT user_id, sum(greatest(e - greatest(s, coalesce(reach, s)), 0))::BIGINT AS covered FROM r GROUP BY user_id""",
    "s15_comment_tree": """WITH RECURSIVE c AS (SELECT conv_id || '-' || turn AS id, CASE WHEN turn > 0 THEN conv_id || '-' || turn // 2 END AS parent_id FROM conversations), t AS (SELECT id, parent_id, id AS root_id, 0 AS depth FROM c WHERE parent_id IS NULL UNION ALL SELECT c.id, c.parent_id, t.root_id, t.depth + 1 FROM c JOIN t ON c.parent_id = t.id) SELECT * FROM t""",
    "s12_p5_p20_optional_columns": "SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS seen_at, CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice)::BIGINT END AS views, NULL::BIGINT AS likes, o_orderstatus <> 'P' AS views_available, false AS likes_available FROM orders",
    "u5_orphan_files": "SELECT 's3a://bucket//data/' || page_id AS path FROM pages WHERE page_id % 3 = 0",
}
