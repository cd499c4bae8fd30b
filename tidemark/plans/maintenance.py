"""Queries of upkeep and imports, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import bindings as b
from tidemark.bindings import with_
from tidemark.functions import text as t
from tidemark.operators import annotate, tables
from tidemark.operators import upkeep as u
from tidemark.plans import texts
from tidemark.scratch import new_path
from tidemark.sources import imports


def protect(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.posts(spark, sf).select("source", "platform_event_id", F.lit("t").alias("title"), F.col("text").alias("raw_text"), F.concat(F.lit("https://e.com/"), "platform_event_id", F.lit("#frag")).alias("url"), F.col("author_hash").alias("user_id"), F.when(F.col("source") == "x", F.concat(F.lit("acc"), "platform_event_id")).alias("x_account"), F.concat(F.lit('{"x_account" : "acc'), "platform_event_id", F.lit('", "k": 1}')).alias("metadata_json"))
    return u.protected(rows, "salt", F.col("platform_event_id").cast("long") % 10 == 0).select("platform_event_id", "user_id", "url", F.sha2("text_for_model", 256).alias("model_sha"), "x_account", "metadata_json")


def audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.posts(spark, sf).select("platform_event_id", F.col("text").alias("raw_text"), t.clean_text(F.col("text")).alias("c"))
    n = F.col("platform_event_id").cast("long")
    kept = rows.select("platform_event_id", F.when(n % 50 == 0, F.concat("c", F.lit(" more"))).otherwise(F.col("c")).alias("clean_text")).where(n % 70 != 1)
    return u.audited(rows, kept.withColumn("text_for_model", t.for_model(F.col("clean_text"))), "platform_event_id").select(F.explode("violations").alias("violation")).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


def predicates(spark: SparkSession, sf: str) -> DataFrame:
    o = b.observations(spark, sf).withColumns({"event_type": F.when(F.col("event_id") % 40 == 0, "youtube.engagement.snapshot"), "content_type": F.when(F.col("event_id") % 3 == 0, "youtube_comment")})
    videos = u.root_videos(o).groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("root_videos"))
    read = o.where(u.snapshot_events(o, ["view_count", "like_count"])).groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("snapshots"))
    return videos.unionByName(read)


def thumbnails(spark: SparkSession, sf: str) -> DataFrame:
    e = b.table(spark, sf, "events")
    url = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("https://i.ytimg.com/vi/"), F.col("event_id").cast("string"))).when(F.col("event_id") % 3 == 1, F.lit("http://evil.test/x.jpg"))
    rows = e.select(F.col("user_id").alias("content_id"), F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("video_id"), F.col("ts").alias("event_ts"), url.alias("thumbnail_url"))
    return u.thumbnails(rows)


def explorer(spark: SparkSession, sf: str) -> DataFrame:
    rows = u.explored(b.posts(spark, sf), source="youtube", since="2024-01-01", until="2024-01-01", keyword="the", limit=100)
    return rows.select("platform_event_id", "event_ts")


def relevance(spark: SparkSession, sf: str) -> DataFrame:
    p = b.posts(spark, sf).withColumn("url", F.concat(F.lit("https://r.com/r/"), F.upper("community"), F.lit("/x")))
    hit = annotate.relevant(F.col("text"), r"\bthing\b", r"\bwith\b", r"\bare\b")
    rows = u.allowed(p.withColumn("community", F.when(F.col("platform_event_id").cast("long") % 2 == 0, F.col("community"))), ["src1", "SRC2", "src5"])
    return rows.where(hit & F.length("text").between(20, 3000)).select("platform_event_id", "community")


def health(spark: SparkSession, sf: str) -> DataFrame:
    e = b.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return u.health(e.select("event_id", F.col("ts").alias("ingested_at")), e.where("event_id % 1000 <> 0").select("event_id", F.col("ts").alias("applied_at")), F.lit("2024-01-31").cast("timestamp")).drop("health_id")


def quota(spark: SparkSession, sf: str) -> DataFrame:
    e = b.table(spark, sf, "events")
    names = F.element_at(F.array(*map(F.lit, ("recent_metrics", "comments", "search"))), (F.col("event_id") % 3 + 1).cast("int"))
    usage = imports.operations(e.select(F.col("event_type").alias("endpoint"), names.alias("workload"), F.col("ts").alias("at"), F.when(F.col("event_id") % 2 == 0, 1).alias("calls"), F.when(F.col("event_id") % 2 == 1, 2).alias("requests"), F.floor("value").cast("long").alias("cost")))
    return u.quota(usage, 4000, 2000).withColumn("pressure", F.round("pressure", 6))


def fallbacks(spark: SparkSession, sf: str) -> DataFrame:
    p = b.table(spark, sf, "part")
    base = p.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("p_brand"), F.when(F.col("p_partkey") % 7 == 0, F.col("p_size")).alias("p_size"))
    one = p.where("p_partkey % 3 = 0").select("p_partkey", F.lit("one").alias("p_brand"), F.lit(None).cast("int").alias("p_size"))
    return u.with_fallbacks(base, "p_partkey", one, p.where("p_partkey % 5 <> 0").select("p_partkey", F.lit("two").alias("p_brand"), F.lit(2).alias("p_size")))


def lineage(spark: SparkSession, sf: str) -> DataFrame:
    c, o = b.table(spark, sf, "customer").select("c_custkey", "c_name"), b.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    rows = u.layers(c, "c_custkey", customer=c, orders=o)
    return rows


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    p = b.posts(spark, sf)
    ready = p.withColumn("clean_text", t.clean_text(F.col("text"))).withColumn("text_for_model", t.for_model(F.col("clean_text")))
    made = t.text_counts()
    feats = ready.select("platform_event_id", *[made[c].cast("long").alias(c) for c in ("email_token_count", "phone_token_count", "ip_token_count")])
    return u.candidates(p, feats, p.where("source <> 'x'"), "platform_event_id", {"email_token_count": 5, "phone_token_count": 3, "ip_token_count": 2})


def available(spark: SparkSession, sf: str) -> DataFrame:
    return u.any_available(b.table(spark, sf, "lineitem"), "l_orderkey", F.col("l_returnflag") == "R")


def compaction(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots of a table: in many files, compacted, keyed anew, and what an ordered export's manifest tells of it."""
    path = new_path(spark, "upkeep")
    tables.snapshot(b.table(spark, sf, "orders").repartition(12), path, "1")
    tables.compacted(tables.pinned(spark, path), path, "2")
    tables.rekeyed(tables.pinned(spark, path), F.sha2(F.concat_ws("|", "o_custkey", "o_orderdate"), 256), ["o_orderkey"], path, "3")
    manifest = tables.exported(tables.pinned(spark, path), f"{path}-export", "o_orderkey")
    stored = tables.partitions(spark.read.option("mergeSchema", True).parquet(path), "snapshot").select(F.col("snapshot").cast("string").alias("part"), "rows")
    sums = [tables.pinned(spark, path, n).agg(F.lit(n).alias("part"), F.count_distinct("o_orderkey").alias("keys"), F.sum("o_orderkey").alias("total")) for n in "123"]
    found = stored.join(sums[0].unionByName(sums[1]).unionByName(sums[2]), "part")
    return found.unionByName(manifest.select(F.lit("export").alias("part"), "rows", F.lit(None).cast("long").alias("keys"), F.lit(None).cast("long").alias("total")))


def filtered_exports(spark: SparkSession, sf: str) -> DataFrame:
    """The same filtered rows as CSV, JSON lines and Parquet; manifests must agree."""
    o = b.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.array("o_orderstatus", "o_orderpriority").alias("tags"), "o_totalprice")
    path, made = new_path(spark, "exports"), []
    for form in ("csv", "json", "parquet"):
        made.append(tables.exported(o, f"{path}/{form}", "o_orderkey", form, F.col("o_totalprice") > 1000))
    return made[0].unionByName(made[1]).unionByName(made[2])


def exports(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as a platform's CSV and read back in canonical form."""
    e = b.table(spark, sf, "events")
    n = F.col("event_id")
    rows = e.select(n.cast("string").alias("status_id"), F.concat(F.lit("say "), "event_type").alias("tweet_text"), F.when(n % 9 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("screen_name"), F.concat(F.lit("https://x.com/s/"), n.cast("string")).alias("tweet_url"), F.col("ts").alias("tweet_time_iso"), F.concat(F.floor("value").cast("string"), F.lit("K")).alias("likes"), F.when(n % 2 == 0, "yes").otherwise("no").alias("is_reply"))
    path = new_path(spark, "export")
    tables.flat(rows).write.csv(path, header=True, escape='"')
    back = imports.canonical(imports.read_export(spark, path, "csv"), "salt")
    return back.select("source", "platform_event_id", "url", "clean_text", "author_hash", "event_ts", "like_count", "is_reply", "rejected")


def refresh_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a refresh file with planted faults, read with its full schema and judged; rows by broken rule."""
    e, n = b.table(spark, sf, "events"), F.col("event_id")
    e = e.unionByName(e.where("event_id % 50 = 0"))
    ident, at, seen = F.concat(F.lit("v"), n.cast("string")), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), n % 3 != 0
    flag = F.when(n % 37 == 0, ~seen).otherwise(seen)
    rows = e.select(
        F.when(n % 97 == 0, "reddit").otherwise("x").alias("source"), ident.alias("platform_event_id"), F.lit("u").alias("user_id"), F.lit("https://x.com/u").alias("url"), at.alias("event_ts"), F.when(n % 31 != 0, at).alias("metadata_refreshed_at"),
        F.when(n % 2 == 0, F.sha2(F.concat_ws("\u001f", F.lit("x"), ident, F.when(n % 43 == 0, F.lit("never")).otherwise(at)), 256)).alias("observation_id"), F.when(seen, F.floor("value").cast("long")).alias("view_count"), flag.alias("view_count_available"),
        F.when(n % 61 == 0, "no json").when(n % 5 == 0, F.concat(F.lit('{"view_count":'), F.when(n % 41 == 0, ~flag).otherwise(flag).cast("string"), F.lit("}"))).alias("coverage_json"), F.when(n % 53 == 0, "short").alias("event_id"),
    )
    path = new_path(spark, "refresh")
    rows.write.json(path)
    judged = imports.observation_violations(imports.refresh_file(spark, path), "x")
    return judged.select(F.explode("violations").alias("violation")).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


def audiences(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as accounts without a size of their own, orders as profile reads."""
    c, o = b.table(spark, sf, "customer"), b.table(spark, sf, "orders")
    k = F.col("c_custkey")
    rows = c.select("c_custkey", F.when(k % 2 == 0, F.concat(F.lit(" @Acc"), k.cast("string"))).alias("screen_name"), F.concat(F.lit("https://x.com/acc"), k.cast("string"), F.lit("/status/1")).alias("url"), F.when(k % 5 == 0, F.floor("c_acctbal").cast("long")).alias("follower_count"))
    reads = o.select(F.concat(F.lit("acc"), F.col("o_custkey").cast("string")).alias("screen_name"), F.col("o_orderdate").alias("collected_at"), F.floor("o_totalprice").cast("long").alias("follower_count"), F.when(F.col("o_orderstatus") == "F", "OK").otherwise("failed").alias("status"))
    return imports.with_audience(rows, reads).select("c_custkey", "follower_count", "audience_from")


def api_videos(spark: SparkSession, sf: str) -> DataFrame:
    """The videos' side of nested API answers."""
    c, k = b.table(spark, sf, "customer"), F.col("c_custkey")
    text = lambda x: x.cast("string")
    answers = c.select(
        text(k).alias("video_id"),
        F.struct(F.struct(F.col("c_name").alias("title"), F.col("c_mktsegment").alias("channelTitle"), F.lit("2024-01-01T00:00:00Z").alias("publishedAt")).alias("snippet"), F.struct(F.concat(text(k), F.lit("K")).alias("viewCount"), F.when(k % 3 != 0, text(k)).alias("likeCount")).alias("statistics"), F.struct(F.concat(F.lit("PT"), text(k % 60), F.lit("M"), text(k % 50), F.lit("S")).alias("duration")).alias("contentDetails")).alias("video_metadata"),
    )
    path = new_path(spark, "videos")
    answers.write.json(path)
    return imports.videos(spark.read.schema(imports.ANSWER).json(path)).select("video_id", "title", "channel", "published_at", "view_count", "like_count", "duration_seconds")


def search_queries(spark: SparkSession, sf: str) -> DataFrame:
    """a search query for each part from its brand and type."""
    return b.table(spark, sf, "part").select("p_partkey", t.search_query(F.array("p_brand", F.concat(F.lit('"'), "p_type")), "OR", "en", "-is:retweet").alias("query"))


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Journal rows and proofs made up for current rows that the journal never saw."""
    o, k = b.table(spark, sf, "orders"), F.col("o_orderkey")
    journal = o.where(k % 3 != 0).select(F.sha2(F.concat(F.lit("s:"), k.cast("string")), 256).alias("event_id"))
    missing, proofs = tables.backfill_journal(o.select("o_orderkey", "o_orderdate"), journal, F.sha2(F.concat(F.lit("s:"), k.cast("string")), 256), "o_orderdate")
    return missing.join(proofs, "event_id").select("o_orderkey", "event_id", "ingested_at", "synthetic", "applied_at")


def api(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as nested API answers, written as JSON and flattened again."""
    c = b.table(spark, sf, "conversations")
    comment = F.struct(F.concat_ws("-", "conv_id", "turn").alias("id"), F.struct(F.col("text").alias("textOriginal"), F.col("role").alias("authorDisplayName"), F.length("text").cast("long").alias("likeCount"), F.lit("2024-01-05T00:00:00Z").alias("publishedAt")).alias("snippet"))
    turns = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", comment.alias("c")))).alias("t"))
    item = F.struct(F.col("conv_id").cast("string").alias("id"), F.struct((F.size("t") - 1).cast("long").alias("totalReplyCount"), F.col("t")[0]["c"].alias("topLevelComment")).alias("snippet"), F.struct(F.transform(F.slice("t", F.lit(2), F.size("t")), lambda x: x["c"]).alias("comments")).alias("replies"))
    answers = turns.select(F.col("conv_id").cast("string").alias("video_id"), F.struct(F.struct(F.lit("2024-01-01T00:00:00Z").alias("publishedAt")).alias("snippet"), F.struct(F.lit("1.5K").alias("viewCount")).alias("statistics")).alias("video_metadata"), F.array(F.struct(F.array(item).alias("items"))).alias("comment_threads_pages"))
    path = new_path(spark, "api")
    answers.write.json(path)
    read = spark.read.schema(imports.ANSWER).json(path)
    return imports.comments(read, "salt").select("video_id", "comment_id", "is_reply", "author_hash", "like_count", "has_question", "video_age_days")


QUERIES = {
    "p4_protect": protect, "p22_audit": audit, "p7_p8_predicates": predicates, "p12_thumbnails": thumbnails, "p13_t3_explorer": explorer, "p14_p15_p17_relevance": relevance, "a26_b21_health": health, "a27_s14_quota": quota, "j16_fallbacks": fallbacks, "j3_j19_layers": lineage, "j20_t4_candidates": candidates,
    "a38_any_available": available, "k14_k16_s13_w16_upkeep": compaction, "k17_filtered_exports": filtered_exports, "k17_s10_export_import": exports, "s11_api_comments": api, "s9_p19_refresh_validation": refresh_validation, "j11_j12_audiences": audiences, "s11_api_videos": api_videos, "f50_search_queries": search_queries, "k18_history": history,
}

_SRC = "CASE user_id % 3 WHEN 0 THEN 'youtube' WHEN 1 THEN 'x' ELSE 'reddit' END"
SQL = {
    "s9_p19_refresh_validation": """WITH e AS (SELECT *, event_id AS n FROM events UNION ALL SELECT *, event_id FROM events WHERE event_id % 50 = 0), r AS (SELECT n, CASE WHEN n % 97 = 0 THEN 'reddit' ELSE 'x' END AS source, n % 3 <> 0 AS seen, CASE WHEN n % 37 = 0 THEN n % 3 = 0 ELSE n % 3 <> 0 END AS flag, n % 31 <> 0 AS has_at FROM e),
v AS (SELECT unnest(list_filter([CASE WHEN source <> 'x' THEN 'unexpected_source' END, CASE WHEN NOT has_at THEN 'missing_identity' END, CASE WHEN n % 2 = 0 AND has_at AND n % 43 = 0 THEN 'invalid_observation_id' END, CASE WHEN n % 53 = 0 THEN 'invalid_event_id' END, CASE WHEN n % 53 = 0 THEN 'invalid_payload_fingerprint' END, CASE WHEN n % 53 = 0 THEN 'missing_producer_name' END, CASE WHEN n % 53 = 0 THEN 'missing_producer_run_id' END,
  CASE WHEN n % 53 = 0 THEN 'missing_collection_method' END, CASE WHEN n % 53 = 0 THEN 'missing_provenance_json' END, CASE WHEN flag <> seen THEN 'view_count_flag_mismatch' END, CASE WHEN n % 61 = 0 THEN 'invalid_coverage' END, CASE WHEN n % 61 <> 0 AND n % 5 = 0 AND n % 41 = 0 THEN 'view_count_coverage_mismatch' END, CASE WHEN n % 50 = 0 THEN 'duplicate_observation' END], lambda x: x IS NOT NULL)) AS violation FROM r)
SELECT violation, count(*) AS n FROM v GROUP BY violation""",
    "j11_j12_audiences": """WITH p AS (SELECT o_custkey, arg_max(floor(o_totalprice)::BIGINT, (o_orderdate, floor(o_totalprice)::BIGINT)) AS r FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN floor(c_acctbal)::BIGINT ELSE r END AS follower_count, CASE WHEN c_custkey % 5 = 0 THEN 'own' WHEN r IS NOT NULL THEN 'profile' END AS audience_from FROM customer LEFT JOIN p ON o_custkey = c_custkey""",
    "s11_api_videos": "SELECT c_custkey::VARCHAR AS video_id, c_name AS title, c_mktsegment AS channel, TIMESTAMP '2024-01-01' AS published_at, c_custkey * 1000 AS view_count, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS like_count, c_custkey % 60 * 60 + c_custkey % 50 AS duration_seconds FROM customer",
    "f50_search_queries": """SELECT p_partkey, '("' || trim(p_brand) || '" OR "' || trim(p_type) || '") lang:en -is:retweet' AS query FROM part""",
    "k18_history": "SELECT o_orderkey, sha256('s:' || o_orderkey) AS event_id, o_orderdate AS ingested_at, true AS synthetic, o_orderdate AS applied_at FROM orders WHERE o_orderkey % 3 = 0",
    "p4_protect": with_("posts", texts._CLEAN + """ SELECT platform_event_id, CASE WHEN platform_event_id::BIGINT % 10 = 0 THEN author_hash ELSE sha256('salt:' || author_hash) END AS user_id, CASE WHEN source = 'x' THEN 'https://x.com/i/status/' || platform_event_id ELSE 'https://e.com/' || platform_event_id END AS url, sha256(m) AS model_sha, CASE WHEN source = 'x' THEN sha256('salt:acc' || platform_event_id) END AS x_account, '{"x_account" : "<USER>", "k": 1}' AS metadata_json FROM ready"""),
    "p22_audit": with_("posts", texts._CLEAN + r""", kept AS (SELECT platform_event_id, platform_event_id::BIGINT AS n, text, clean_text AS want, CASE WHEN platform_event_id::BIGINT % 70 <> 1 THEN clean_text || CASE WHEN platform_event_id::BIGINT % 50 = 0 THEN ' more' ELSE '' END END AS have,
  list_concat(list_concat(regexp_extract_all(text, '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+(?:\.[\p{L}\p{N}_-]+)+'), regexp_extract_all(text, '@[\p{L}\p{N}_]+')), regexp_extract_all(text, '\b(?:\d{1,3}\.){3}\d{1,3}\b')) AS vals FROM ready),
v AS (SELECT unnest(list_filter([CASE WHEN have IS NULL THEN 'row_absent' END, CASE WHEN have <> want THEN 'clean_text_differs' END, CASE WHEN len(list_filter(vals, lambda x: contains(have, x))) > 0 THEN 'sensitive_value_survived' END], lambda x: x IS NOT NULL)) AS violation FROM kept)
SELECT violation, count(*) AS n FROM v GROUP BY violation"""),
    "j20_t4_candidates": with_("posts", texts._CLEAN + """, k AS (SELECT platform_event_id, source, len(regexp_extract_all(m, '<EMAIL>'))::BIGINT AS email_token_count, len(regexp_extract_all(m, '<PHONE>'))::BIGINT AS phone_token_count, len(regexp_extract_all(m, '<IP>'))::BIGINT AS ip_token_count FROM ready WHERE source <> 'x')
SELECT platform_event_id, email_token_count, phone_token_count, ip_token_count, (email_token_count > 0)::INTEGER + (phone_token_count > 0)::INTEGER + (ip_token_count > 0)::INTEGER AS kinds, least(email_token_count, 3) * 5 + least(phone_token_count, 3) * 3 + least(ip_token_count, 3) * 2 AS score FROM k WHERE email_token_count + phone_token_count + ip_token_count > 0 ORDER BY score DESC, kinds DESC, platform_event_id LIMIT 20"""),
    "p7_p8_predicates": with_("observations", """, o AS (SELECT *, event_id % 40 = 0 AS snap, event_id % 3 = 0 AS comment FROM observations) SELECT source, count(*) AS n, 'root_videos' AS kind FROM o WHERE source = 'youtube' AND NOT comment GROUP BY source
UNION ALL SELECT source, count(*), 'snapshots' FROM o WHERE (source = 'youtube' AND snap) OR view_count IS NOT NULL GROUP BY source"""),
    "p12_thumbnails": "SELECT user_id AS content_id, arg_max('v' || event_id, (ts, 'v' || event_id)) AS video_id, 'https://img.youtube.com/vi/' || arg_max('v' || event_id, (ts, 'v' || event_id)) || '/default.jpg' AS thumbnail_url FROM events WHERE event_id % 3 <> 0 GROUP BY user_id",
    "p13_t3_explorer": with_("posts", "SELECT platform_event_id, event_ts FROM posts WHERE source = 'youtube' AND event_ts >= TIMESTAMP '2024-01-01' AND event_ts < TIMESTAMP '2024-01-02' AND contains(lower(text), 'the') ORDER BY event_ts DESC, platform_event_id LIMIT 100"),
    "p14_p15_p17_relevance": with_("posts", r"SELECT platform_event_id, lower(community) AS community FROM posts WHERE community IN ('src1', 'src2', 'src5') AND (regexp_matches(text, '(?i)\bthing\b') OR (regexp_matches(text, '(?i)\bwith\b') AND regexp_matches(text, '(?i)\bare\b'))) AND length(text) BETWEEN 20 AND 3000"),
    "a26_b21_health": "SELECT greatest(epoch(TIMESTAMP '2024-01-31')::BIGINT - floor(epoch(max(ts)))::BIGINT, 0) AS journal_lag, greatest(epoch(TIMESTAMP '2024-01-31')::BIGINT - floor(epoch(max(ts) FILTER (event_id % 1000 <> 0)))::BIGINT, 0) AS state_lag, count(*) FILTER (event_id % 1000 = 0) AS gap, 'error' AS status FROM events",
    "a27_s14_quota": """WITH x AS (SELECT ts::DATE AS day, ['recent_metrics', 'comments', 'search'][event_id % 3 + 1] AS workload, floor(value)::BIGINT AS units, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS calls FROM events), d AS (SELECT day, workload, sum(units)::BIGINT AS units, sum(calls)::BIGINT AS calls FROM x GROUP BY ALL),
t AS (SELECT day, sum(units)::BIGINT AS used, coalesce(sum(units) FILTER (workload = 'recent_metrics'), 0)::BIGINT AS recent FROM d GROUP BY day), r AS (SELECT *, least(1.0::DOUBLE, used / 4000) AS p FROM d JOIN t USING (day)), q AS (SELECT *, CASE WHEN p >= 0.95 AND workload <> 'recent_metrics' THEN 'critical_quota_pressure' WHEN p >= 0.8 AND workload = 'comments' THEN 'secondary_workload_suspended' END AS reason FROM r)
SELECT day, workload, units, calls, used, recent, round(p, 6) AS pressure, reason, CASE WHEN reason IS NOT NULL THEN 0 WHEN workload = 'recent_metrics' THEN greatest(4000 - used, 0) ELSE greatest(greatest(4000 - used, 0) - greatest(2000 - recent, 0), 0) END::BIGINT AS spendable FROM q""",
    "j16_fallbacks": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand WHEN p_partkey % 3 = 0 THEN 'one' WHEN p_partkey % 5 <> 0 THEN 'two' END AS p_brand, CASE WHEN p_partkey % 7 = 0 THEN p_size WHEN p_partkey % 5 <> 0 THEN 2 END AS p_size FROM part",
    "j3_j19_layers": """SELECT 'customer' AS layer, c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS row FROM customer UNION ALL SELECT 'orders', o_custkey, '{"c_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || '}'  FROM orders JOIN customer ON o_custkey = c_custkey""",
    "a38_any_available": "SELECT l_orderkey, bool_or(l_returnflag = 'R') AS available FROM lineitem GROUP BY l_orderkey",
    "k14_k16_s13_w16_upkeep": """WITH k AS (SELECT max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey, o_orderdate), s AS (SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS keys, sum(o_orderkey)::BIGINT AS total FROM orders), l AS (SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS keys, sum(o_orderkey)::BIGINT AS total FROM k)
SELECT unnest(['1', '2']) AS part, rows, keys, total FROM s UNION ALL SELECT '3', rows, keys, total FROM l UNION ALL SELECT 'export', rows, NULL, NULL FROM l""",
    "k17_filtered_exports": """SELECT unnest(['csv', 'json', 'parquet']) AS format, count(*) AS rows, sum(('0x' || substr(sha256(o_orderkey::VARCHAR), 1, 15))::HUGEINT)::VARCHAR AS fingerprint, 'o_orderkey,o_orderdate,tags,o_totalprice' AS columns FROM orders WHERE o_totalprice > 1000""",
    "k17_s10_export_import": """SELECT 'x' AS source, event_id::VARCHAR AS platform_event_id, 'https://x.com/s/' || event_id AS url, 'say ' || event_type AS clean_text, CASE WHEN event_id % 9 <> 0 THEN sha256('salt:u' || user_id) END AS author_hash, date_trunc('second', ts) AS event_ts, floor(value)::BIGINT * 1000 AS like_count, event_id % 2 = 0 AS is_reply, CASE WHEN event_id % 9 = 0 THEN 'missing: author_hash' END AS rejected FROM events""",
    "s11_api_comments": "SELECT conv_id::VARCHAR AS video_id, conv_id || '-' || turn AS comment_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 1 AS is_reply, sha256('salt:' || role) AS author_hash, length(text)::BIGINT AS like_count, contains(text, '?') AS has_question, 4::INTEGER AS video_age_days FROM conversations",
}
