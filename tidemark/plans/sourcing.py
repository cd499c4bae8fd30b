"""Merged origins, envelopes, example contexts, shown rows with fallbacks and their overview, external score files; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import bindings as b
from tidemark.bindings import with_
from tidemark.functions import envelope as env
from tidemark.operators import labels as lab
from tidemark.operators import presentation as show
from tidemark.operators import sourcing as o
from tidemark.scratch import new_path

# words between blanks, points and commas: Java and RE2 disagree on what \b means beside accented letters
STRONG, CONTEXT, TOKEN = (rf"(?:^|[\s.,])(?:{words})(?:[\s.,]|$)" for words in ("thing|oui", "und|der|les|with", "ist|par|are"))
LIMIT, PUBLISHED = 40, 30


def merged_origins(spark: SparkSession, sf: str) -> DataFrame:
    """Posts of three languages as the data set; conversations as an archive of comments, all posts as search results, as a published set and as live posts.

    Origins overlap with the data set and with each other, so every later one brings little but what is new.
    """
    p = b.posts(spark, sf)
    community = F.when(F.col("lang") == "en", "User").otherwise("assistant")
    size = F.when(F.col("platform_event_id").cast("long") % 3 != 0, F.length("text"))
    base = p.select("source", "platform_event_id", F.col("text").alias("title"), "event_ts", community.alias("community"), size.cast("double").alias("member_count"), "lang", "author_hash")
    current = base.where("lang <> 'de'").drop("lang", "author_hash")
    current = o.with_sizes(current, o.community_sizes(current), F.col("source") == "reddit")
    c = b.table(spark, sf, "conversations")
    mark = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"))
    archive = c.select(
        F.concat(mark, F.col("turn").cast("string")).alias("platform_event_id"), F.concat(F.lit("t1_"), mark, (F.col("turn") - F.col("turn") % 2 - 1).cast("string")).alias("parent_id"), F.col("text").alias("title"),
        (F.lit("2024-02-01").cast("timestamp") + F.make_dt_interval(hours=F.col("conv_id").cast("int"), mins=F.col("turn").cast("int"))).alias("event_ts"), F.concat(F.lit("https://r.com/r/"), F.col("role"), F.lit("/1")).alias("url"),
    )
    key = F.col("platform_event_id").cast("long")
    found = base.where("source = 'x'").select("platform_event_id", "title", "event_ts", F.concat(F.lit("@A"), (key % 97).cast("string")).alias("screen_name"), F.lit("").alias("url"), F.when(key % 2 == 0, key).alias("follower_count"))
    n = F.col("o_custkey")
    profiles = b.table(spark, sf, "orders").select(F.concat(F.lit("a"), n.cast("string")).alias("screen_name"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status"), F.col("o_orderkey").alias("follower_count"), F.col("o_orderdate").alias("collected_at"))
    public = base.select(F.concat(F.lit("p"), "platform_event_id").alias("platform_event_id"), "title", "event_ts", F.col("author_hash").alias("author"), "lang")
    live = base.where("source = 'reddit'").select("platform_event_id", "title", "event_ts", "community", "member_count")
    rows = o.merged_origins(
        current, o.archived(archive, current, ["USER", "assistant"], LIMIT), o.searched(found, current, profiles, STRONG, CONTEXT, TOKEN),
        o.published(public, current, "fr", STRONG, CONTEXT, TOKEN, PUBLISHED), o.live(live, current, ["user", "Assistant"]),
    )
    return rows.select("source", "platform_event_id", F.sha2("title", 256).alias("text_sha256"), "event_ts", "community", "member_count", "member_count_available", "comment_count", "follower_count", "collection_method")


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    e = b.table(spark, sf, "events")
    n, seen = F.col("event_id"), F.col("event_type") != "error"
    return e.select(
        n.alias("number"), b._source(F.col("user_id")).alias("source"), F.when(n % 5 != 0, F.col("user_id").cast("string")).alias("platform_event_id"), F.concat(F.lit("https://example.com/"), n.cast("string")).alias("url"),
        F.unix_micros(F.col("ts").cast("timestamp")).cast("string").alias("observed_at"), "event_type", F.when(seen, F.floor("value").cast("long")).alias("view_count"), F.when(n % 7 == 0, seen).alias("view_count_available"), F.when(n % 3 == 0, F.lit(0).cast("long")).alias("like_count"),
        F.when(n % 4 == 0, " Success ").when(n % 4 == 1, "failed").alias("metadata_status"), F.when(n % 11 == 0, F.concat(F.lit("  "), F.upper(F.sha2(n.cast("string"), 256)))).when(n % 13 == 0, "broken").alias("observation_id"), F.when(n % 2 == 0, "api").alias("collection_method"), F.when(n % 9 == 0, "").when(n % 9 == 1, "worker").alias("producer_name"),
    )


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """F8: identities, coverage and provenance of every event."""
    rows = env.with_envelope(_messages(spark, sf), ["event_type", "like_count", "url", "view_count"], "collector", "run-1")
    return rows.select("number", "event_id", "observation_id", "payload_fingerprint", "coverage_json", "provenance_json")


def contexts(spark: SparkSession, sf: str) -> DataFrame:
    """the id and the context of an example of every reading."""
    rows = b.observations(spark, sf).select("source", "platform_event_id", F.col("event_id").cast("string").alias("observation_id"), F.when(F.col("event_id") % 3 != 0, "v2").alias("version"), "view_count", "like_count", "comment_count", "view_count_available")
    id_ = env.example_id(F.col("source"), F.col("platform_event_id"), F.col("observation_id"), "24h", F.col("version"))
    return rows.select("observation_id", id_.alias("example_id"), env.context_snapshot("observation_id", "view_count", "like_count", "comment_count", "view_count_available").alias("context"))


def _shown(spark: SparkSession, sf: str) -> DataFrame:
    c, e = b.table(spark, sf, "customer"), b.table(spark, sf, "events")
    k = F.col("c_custkey")
    rows = c.select(k.alias("id"), F.when(k % 4 != 0, F.col("c_name")).alias("title"), F.col("c_mktsegment").alias("channel"), F.when(k % 6 == 0, F.floor("c_acctbal").cast("long")).alias("latest_view_count"))
    stats = c.where("c_acctbal > 0").select(k.alias("id"), F.when(k % 2 == 0, F.floor("c_acctbal").cast("long") * 2).alias("latest_view_count"), F.when(k % 5 == 0, F.lit("page")).alias("thumbnail"))
    x = b.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").cast("timestamp").alias("observed_at"), F.floor("o_totalprice").cast("long").alias("view_count"), F.when(F.col("o_orderstatus") != "P", F.length("o_orderpriority").cast("long")).alias("like_count"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(0).cast("long")).alias("comment_count"), (F.col("o_orderkey") % 3 != 0).alias("comment_count_available"), env.canonical({"comment_count": F.col("o_orderkey") % 2 == 0}).alias("coverage_json"),
        env.canonical({"producer_name": F.col("o_orderstatus"), "collection_method": F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).otherwise("poll")}).alias("provenance_json"),
    )
    readings = show.last_readings(x, "id", ("view_count", "like_count", "comment_count"), ("coverage_json", "provenance_json"))
    spoken = b.table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.when(F.bool_or(F.col("role") == "assistant"), "available").otherwise("pending").alias("transcript"))
    late = show.last_events(e.select(F.col("user_id").alias("id"), "event_id", F.col("ts").cast("timestamp").alias("observed_at"), F.when(F.col("event_type") != "error", F.concat(F.lit("event "), "event_type")).alias("kind"), F.floor("value").cast("long").alias("view_count")), "id", {"kind": "title", "view_count": "latest_view_count", "observed_at": "latest_snapshot_at"})
    rows = show.display_rows(rows, "id", stats, readings, spoken, late)
    checks = {"thumbnail": F.col("thumbnail").isNotNull(), "metadata": F.col("title").isNotNull(), "transcript": F.col("transcript") == "available", "views": F.col("latest_view_count").isNotNull(), "comments": F.col("latest_comment_count_available")}
    labels = {"view_count": "views", "like_count": "likes", "comment_count": "comments"}
    return show.told(rows, labels, checks, F.lit("1998-09-01").cast("timestamp"), {"latest_snapshot_at": 24 * 90})


def shown(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as a video with what four other tables know of it."""
    return _shown(spark, sf).select("id", "title", "channel", "thumbnail", "transcript", "latest_view_count", "latest_like_count", "latest_comment_count", "latest_snapshot_at", "known", "lacking", "coverage", "provenance", "warnings")


def overview(spark: SparkSession, sf: str) -> DataFrame:
    """The shown rows by channel, completeness, transcript and freshness."""
    return show.overview(_shown(spark, sf), {"channel": F.col("channel"), "completeness": F.col("known"), "transcript": F.col("transcript"), "freshness": F.col("warnings")}, "title", ("latest_view_count", "latest_like_count", "latest_comment_count"))


def reference_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Thresholds by platform out of a score file that another job left (here written from ``lineitem``)."""
    rows = b.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("source"), F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice").cast("double") / 7).alias("engagement_score"))
    path = new_path(spark, "scores")
    rows.write.option("header", True).csv(path)
    reference = {"dataset_version": "v1", "dataset_fingerprint": "0" * 64, "source_snapshots": {"readings": 7}}
    out = lab.reference_contract(spark, path, reference, ("A", "N", "R"), horizon_hours=24, fewest=10)
    return out.select("source", "reference_count", F.round("threshold", 6).alias("threshold"), F.round("lowest", 6).alias("lowest"), F.round("highest", 6).alias("highest"), "quantile", "horizon_hours", "dataset_version")


QUERIES = {"b15_merged_origins": merged_origins, "f8_envelopes": envelopes, "f25_contexts": contexts, "j16_f45_f46_shown_rows": shown, "b22_overview": overview, "a40_reference_scores": reference_scores}
_TRIM = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
_HIT = rf"(regexp_matches(title, '(?i){STRONG}') OR (regexp_matches(title, '(?i){CONTEXT}') AND regexp_matches(title, '(?i){TOKEN}')))"
_METRIC_FLAGS = {m: "false" for m in env.METRICS} | {"view_count": "coalesce(view_count_available, view_count IS NOT NULL)", "like_count": "like_count IS NOT NULL", "metadata": "coalesce(lower(trim(metadata_status)) IN ('available', 'success'), false)", "transcript": "false", "comments": "false"}
_JSON = lambda fields: "json_object(" + ", ".join(f"'{k}', {fields[k]}" for k in sorted(fields)) + ")::VARCHAR"
_PROVENANCE = {n: "NULL" for n in env.PROVENANCE} | {"collection_method": "collection_method", "event_type": "event_type", "observed_at": "observed_at", "producer_name": "coalesce(nullif(trim(producer_name), ''), 'collector')", "producer_run_id": "'run-1'", "source": "source"}
_SHOWN = """, n AS (SELECT o_custkey AS id, o_orderkey AS event_id, o_orderdate::TIMESTAMP AS tm, floor(o_totalprice)::BIGINT AS v, CASE WHEN o_orderstatus <> 'P' THEN length(o_orderpriority)::BIGINT END AS l, CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey % 3 <> 0 THEN 0 END::BIGINT AS c, o_orderkey % 2 = 0 AS cc, o_orderstatus AS producer, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'poll' END AS method FROM orders),
snaps AS (SELECT id, arg_max(v, (tm, event_id)) AS v, arg_max(l, (tm, event_id)) FILTER (l IS NOT NULL) AS l, arg_max(c, (tm, event_id)) FILTER (c IS NOT NULL) AS c, max(tm) AS tm, arg_max(producer, (tm, event_id)) AS producer, arg_max(method, (tm, event_id)) AS method FROM n GROUP BY id),
spoken AS (SELECT conv_id AS id, CASE WHEN bool_or(role = 'assistant') THEN 'available' ELSE 'pending' END AS transcript FROM conversations GROUP BY 1),
late AS (SELECT user_id AS id, arg_max('event ' || event_type, (ts, event_id)) FILTER (event_type <> 'error') AS kind, arg_max(floor(value)::BIGINT, (ts, event_id)) AS v, max(ts) AS tm FROM events GROUP BY 1),
f AS (SELECT c_custkey AS id, c_mktsegment AS channel, coalesce(CASE WHEN c_custkey % 4 <> 0 THEN c_name END, kind) AS title, CASE WHEN c_acctbal > 0 AND c_custkey % 5 = 0 THEN 'page' END AS thumbnail, transcript,
  coalesce(CASE WHEN c_custkey % 6 = 0 THEN floor(c_acctbal)::BIGINT END, CASE WHEN c_acctbal > 0 AND c_custkey % 2 = 0 THEN floor(c_acctbal)::BIGINT * 2 END, s.v, late.v) AS latest_view_count, l AS latest_like_count, c AS latest_comment_count, coalesce(s.tm, late.tm) AS latest_snapshot_at, s.id IS NOT NULL AS read, s.v AS sv, producer, method FROM customer LEFT JOIN snaps s ON s.id = c_custkey LEFT JOIN spoken ON spoken.id = c_custkey LEFT JOIN late ON late.id = c_custkey),
k AS (SELECT *, list_filter([CASE WHEN thumbnail IS NULL THEN 'thumbnail' END, CASE WHEN title IS NULL THEN 'metadata' END, CASE WHEN transcript IS NULL OR transcript <> 'available' THEN 'transcript' END, CASE WHEN latest_view_count IS NULL THEN 'views' END, CASE WHEN latest_comment_count IS NULL THEN 'comments' END], lambda x: x IS NOT NULL) AS out,
  list_filter([CASE WHEN latest_view_count IS NULL OR (read AND sv IS NULL) THEN 'views' END, CASE WHEN latest_like_count IS NULL THEN 'likes' END, CASE WHEN latest_comment_count IS NULL THEN 'comments' END], lambda x: x IS NOT NULL) AS dark FROM f),
shown AS (SELECT id, title, channel, thumbnail, transcript, latest_view_count, latest_like_count, latest_comment_count, latest_snapshot_at, (5 - len(out))::INTEGER AS known, array_to_string(out, ', ') AS lacking, (3 - len(dark))::VARCHAR || '/3 snapshot metrics observed' || CASE WHEN len(dark) > 0 THEN '; N/A: ' || array_to_string(dark, ', ') ELSE '' END AS coverage,
  CASE WHEN NOT read THEN 'N/A' WHEN producer = method THEN producer ELSE producer || ' · ' || method END AS provenance, CASE WHEN latest_snapshot_at IS NULL THEN 'latest_snapshot_at never' WHEN epoch(TIMESTAMP '1998-09-01') - epoch(latest_snapshot_at) > 2160 * 3600 THEN 'latest_snapshot_at overdue' ELSE 'None' END AS warnings FROM k)"""
_SLICES = " UNION ALL ".join(f"SELECT '{n}' AS section, coalesce({c}::VARCHAR, 'unknown') AS slice, title, latest_view_count AS v, latest_like_count AS l, latest_comment_count AS c FROM shown" for n, c in {"channel": "channel", "completeness": "known", "transcript": "transcript", "freshness": "warnings"}.items())

SQL = {
    "j16_f45_f46_shown_rows": "WITH " + _SHOWN[2:] + " SELECT * FROM shown",
    "b22_overview": "WITH " + _SHOWN[2:] + f", d AS ({_SLICES}) SELECT section, slice, count(*) AS n, count(DISTINCT title) AS identifiers, count(*) FILTER (v IS NOT NULL OR l IS NOT NULL OR c IS NOT NULL) AS with_reading, sum(v)::BIGINT AS latest_view_count, sum(l)::BIGINT AS latest_like_count, sum(c)::BIGINT AS latest_comment_count, round(count(v) * 100.0 / count(*), 6) AS latest_view_count_pct, round(count(l) * 100.0 / count(*), 6) AS latest_like_count_pct, round(count(c) * 100.0 / count(*), 6) AS latest_comment_count_pct FROM d GROUP BY ALL",
    "f25_contexts": with_("observations", """, o AS (SELECT *, event_id::VARCHAR AS observation_id, json_object('observation_id', event_id::VARCHAR, 'view_count', view_count, 'like_count', like_count, 'comment_count', comment_count, 'view_count_available', view_count_available)::VARCHAR AS j FROM observations)
SELECT observation_id, sha256(source || chr(31) || platform_event_id || chr(31) || observation_id || chr(31) || '24h' || chr(31) || CASE WHEN event_id % 3 <> 0 THEN 'v2' ELSE 'unknown' END) AS example_id, regexp_replace(j, ',"[a-z_]+":null', '', 'g') AS context FROM o"""),
    "f8_envelopes": f"""WITH m AS (SELECT event_id AS number, CASE user_id % 3 WHEN 0 THEN 'youtube' WHEN 1 THEN 'x' ELSE 'reddit' END AS source, CASE WHEN event_id % 5 <> 0 THEN user_id::VARCHAR END AS platform_event_id, 'https://example.com/' || event_id AS url, epoch_us(ts)::VARCHAR AS observed_at, event_type,
  CASE WHEN event_type <> 'error' THEN floor(value)::BIGINT END AS view_count, CASE WHEN event_id % 7 = 0 THEN event_type <> 'error' END AS view_count_available, CASE WHEN event_id % 3 = 0 THEN 0::BIGINT END AS like_count, CASE event_id % 4 WHEN 0 THEN ' Success ' WHEN 1 THEN 'failed' END AS metadata_status,
  CASE WHEN event_id % 2 = 0 THEN 'api' END AS collection_method, CASE event_id % 9 WHEN 0 THEN '' WHEN 1 THEN 'worker' END AS producer_name FROM events),
j AS (SELECT *, {_JSON(_METRIC_FLAGS)} AS coverage_json, {_JSON(_PROVENANCE)} AS provenance_json,
  sha256('{{"event_type":"' || event_type || '"' || CASE WHEN like_count IS NOT NULL THEN ',"like_count":0' ELSE '' END || ',"url":"' || url || '"' || CASE WHEN view_count IS NOT NULL THEN ',"view_count":' || view_count ELSE '' END || '}}') AS payload_fingerprint,
  CASE WHEN number % 11 = 0 THEN sha256(number::VARCHAR) ELSE sha256(source || chr(31) || coalesce(platform_event_id, url) || chr(31) || observed_at) END AS observation_id FROM m)
SELECT number, sha256('event-v1' || chr(31) || observation_id || chr(31) || event_type || chr(31) || payload_fingerprint) AS event_id, observation_id, payload_fingerprint, coverage_json, provenance_json FROM j""",
    "a40_reference_scores": "SELECT l_returnflag AS source, count(x) AS reference_count, round(quantile_cont(x, 0.75), 6) AS threshold, round(min(x), 6) AS lowest, round(max(x), 6) AS highest, 0.75::DOUBLE AS quantile, 24 AS horizon_hours, 'v1' AS dataset_version FROM (SELECT l_returnflag, CASE WHEN l_linenumber <> 3 THEN l_extendedprice::DOUBLE / 7 END AS x FROM lineitem) WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY 1",
    "b15_merged_origins": with_("posts", rf""", base AS (SELECT source, platform_event_id, text AS title, event_ts, CASE WHEN lang = 'en' THEN 'User' ELSE 'assistant' END AS community, CASE WHEN platform_event_id::BIGINT % 3 <> 0 THEN length(text)::DOUBLE END AS member_count, lang, author_hash FROM posts),
kept AS (SELECT * FROM base WHERE lang <> 'de'),
sizes AS (SELECT lower(community) AS key, quantile_cont(member_count, 0.5) AS median FROM kept WHERE member_count IS NOT NULL GROUP BY 1),
current AS (SELECT source, platform_event_id, title, event_ts, community, coalesce(member_count, CASE WHEN source = 'reddit' THEN median END) AS member_count FROM kept LEFT JOIN sizes ON key = lower(community)),
sized AS (SELECT lower(community) AS key, quantile_cont(member_count, 0.5) AS median FROM current WHERE member_count IS NOT NULL GROUP BY 1),
arch AS (SELECT 'c' || conv_id || '-' || turn AS platform_event_id, 'c' || conv_id || '-' || (turn - turn % 2 - 1) AS parent, trim(text, {_TRIM}) AS title, TIMESTAMP '2024-02-01' + to_hours(conv_id) + to_minutes(turn) AS event_ts, lower(role) AS community FROM conversations WHERE text IS NOT NULL AND length(trim(text, {_TRIM})) >= {o.SHORTEST}),
answers AS (SELECT parent AS p, count(*) AS comment_count FROM arch GROUP BY 1),
listed AS (SELECT arch.*, coalesce(comment_count, 0) AS comment_count, sha256('42:' || platform_event_id) AS h FROM arch LEFT JOIN answers ON p = platform_event_id WHERE community IN ('user', 'assistant')),
share AS (SELECT greatest(1, {LIMIT} // count(DISTINCT community)) AS quota FROM listed),
archived AS (SELECT platform_event_id, title, event_ts, community, comment_count FROM (SELECT *, row_number() OVER (PARTITION BY community ORDER BY h) AS r FROM listed) CROSS JOIN share ORDER BY r > quota, h LIMIT {LIMIT}),
profile AS (SELECT 'a' || o_custkey AS key, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS followers FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
searched AS (SELECT platform_event_id, trim(title, {_TRIM}) AS title, event_ts, CASE WHEN platform_event_id::BIGINT % 2 = 0 THEN platform_event_id::BIGINT ELSE followers END AS follower_count FROM base b LEFT JOIN profile ON key = 'a' || (platform_event_id::BIGINT % 97) WHERE source = 'x' AND NOT EXISTS (FROM current c WHERE c.source = 'x' AND c.platform_event_id = b.platform_event_id) AND length(trim(title, {_TRIM})) >= {o.SHORTEST} AND {_HIT}),
published AS (SELECT 'p' || platform_event_id AS platform_event_id, trim(title, {_TRIM}) AS title, event_ts FROM (SELECT *, sha256('42:p' || platform_event_id) AS h FROM base WHERE lang = 'fr' AND length(trim(title, {_TRIM})) >= {o.SHORTEST} AND {_HIT} QUALIFY row_number() OVER (PARTITION BY author_hash ORDER BY sha256('42:p' || platform_event_id)) = 1) ORDER BY h LIMIT {PUBLISHED}),
live AS (SELECT platform_event_id, title, event_ts, lower(community) AS community, member_count FROM base b WHERE source = 'reddit' AND NOT EXISTS (FROM current c WHERE c.source = 'reddit' AND c.platform_event_id = b.platform_event_id)),
every AS (SELECT 0 AS k, source, platform_event_id, title, event_ts, community, member_count, member_count IS NOT NULL AS member_count_available, NULL::BIGINT AS comment_count, NULL::BIGINT AS follower_count, NULL AS collection_method FROM current
UNION ALL SELECT 1, 'reddit', platform_event_id, title, event_ts, community, median, median IS NOT NULL, comment_count, NULL, 'archive' FROM archived LEFT JOIN sized ON key = community
UNION ALL SELECT 2, 'x', platform_event_id, title, event_ts, NULL, NULL, NULL, NULL, follower_count, 'search' FROM searched
UNION ALL SELECT 3, 'x', platform_event_id, title, event_ts, NULL, NULL, NULL, NULL, NULL, 'published' FROM published
UNION ALL SELECT 4, 'reddit', platform_event_id, title, event_ts, community, member_count, NULL, NULL, NULL, 'live' FROM live),
ided AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY source, platform_event_id ORDER BY k, event_ts) = 1)
SELECT source, platform_event_id, sha256(title) AS text_sha256, event_ts, community, member_count, member_count_available, comment_count, follower_count, collection_method FROM ided QUALIFY row_number() OVER (PARTITION BY source, lower(trim(title, {_TRIM})) ORDER BY k, event_ts, length(platform_event_id), platform_event_id) = 1"""),
}
