"""Files of other shapes: platform exports, refresh files and nested API answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.functions.identity import salted

# The columns that tell a platform, and the aliases of each canonical field in order.
SIGNS = {"x": ("tweet_text", "status_id"), "reddit": ("comment_text", "post_url", "created_iso"), "youtube": ("video_id", "video_title", "comment_published_at")}
ALIASES = {
    "platform_event_id": ("platform_event_id", "comment_id", "thread_id", "status_id", "video_id"),
    "url": ("url", "comment_url", "video_url", "tweet_url", "post_url", "page_url"),
    "text": ("title", "text", "comment_text", "tweet_text", "video_title"),
    "author": ("user_id", "author", "screen_name", "display_name", "author_hash"),
    "timestamp": ("timestamp", "created_at", "event_ts", "comment_published_at", "video_published_at", "tweet_time_iso", "created_iso"),
    "language": ("language", "lang", "default_language"),
    "like_count": ("like_count", "comment_like_count", "video_like_count", "likes"),
    "view_count": ("view_count", "video_view_count", "views"),
    "reply_count": ("reply_count", "replies", "thread_total_reply_count"),
}
# The columns of a refresh file.
METRICS = ("like_count", "view_count", "comment_count", "reply_count", "retweet_count", "bookmark_count", "score", "follower_count", "subscriber_count", "subreddit_member_count")
ENVELOPE = ("event_id", "payload_fingerprint", "producer_name", "producer_run_id", "collection_method", "provenance_json")
_TEXTS = "user_id url event_ts source platform_event_id observation_id metadata_refreshed_at last_metrics_refresh_at next_metrics_refresh_at metrics_refresh_status metrics_error_code owner_channel_id api_endpoint coverage_json".split()
REFRESH = ", ".join([f"{c} string" for c in (*_TEXTS, *ENVELOPE)] + ["metrics_refresh_count int", "collaborator_channel_ids array<string>"] + [f"{m} long" for m in METRICS] + [f"{c}_available boolean" for c in (*METRICS, "metadata", "transcript", "comments")])


def refresh_file(spark: SparkSession, path: str) -> DataFrame:
    """Readings as typed JSON lines, all 45 columns."""
    return spark.read.schema(REFRESH).json(path)


def observation_violations(rows: DataFrame, source: str) -> DataFrame:
    """``rows`` of a refresh file with ``violations``, the names of the rules they break, in order of the rules."""
    identity, at = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("platform_event_id", "url")]), F.when(F.col("metadata_refreshed_at") != "", F.col("metadata_refreshed_at"))
    told = F.greatest(*[F.col(c).isNotNull() for c in ENVELOPE])
    hexes = lambda c: F.lower(F.coalesce(c, F.lit(""))).rlike("^[0-9a-f]{64}$")
    names = [
        F.when(~F.col("source").eqNullSafe(F.lit(source)), "unexpected_source"),
        F.when(identity.isNull() | at.isNull(), "missing_identity"),
        F.when(F.col("observation_id").isNotNull() & identity.isNotNull() & at.isNotNull() & (F.col("observation_id") != F.sha2(F.concat_ws("\u001f", F.lit(source), identity, at), 256)), "invalid_observation_id"),
        *[F.when(told & ~hexes(F.col(c)), f"invalid_{c}") for c in ENVELOPE[:2]],
        *[F.when(told & (F.coalesce(c, F.lit("")) == ""), f"missing_{c}") for c in ENVELOPE[2:]],
        *[F.when(F.col(f"{m}_available").isNotNull() & (F.col(f"{m}_available") != F.col(m).isNotNull()), f"{m}_flag_mismatch") for m in METRICS],
        F.when(F.col("coverage_json").isNotNull() & F.from_json("coverage_json", "map<string,string>").isNull(), "invalid_coverage"),
        *[F.when(F.col(f"{m}_available").isNotNull() & F.from_json("coverage_json", "map<string,string>").isNotNull() & ~F.get_json_object("coverage_json", f"$.{m}").eqNullSafe(F.col(f"{m}_available").cast("string")), f"{m}_coverage_mismatch") for m in METRICS],
    ]
    rows = rows.withColumns({"_identity": identity, "_at": at})
    doubled = rows.groupBy("source", "_identity", "_at").agg((F.count(F.lit(1)) > 1).alias("_twice"))
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in ("source", "_identity", "_at")]
    met = rows.join(doubled, same(rows, doubled)).drop(*[doubled[c] for c in ("source", "_identity", "_at")])
    return met.withColumn("violations", F.array_compact(F.array(*names, F.when(F.col("_twice"), "duplicate_observation")))).drop("_identity", "_at", "_twice")


def account_key(name: Column, url: Column) -> Column:
    """An account's name without its sign, in lower case, from a column or else from a post's URL."""
    own = F.lower(F.regexp_replace(F.trim(name), "^@+", ""))
    return F.coalesce(F.when(own != "", own), F.lower(t.path_part(url, r"(?:x|twitter)\.com/([A-Za-z0-9_]+)/status/")))


def with_audience(rows: DataFrame, profiles: DataFrame, name: str = "screen_name", url: str = "url", size: str = "follower_count") -> DataFrame:
    """A missing audience filled from the account's last profile that was read well; an own value stays. ``audience_from`` tells which."""
    good = profiles.where((F.lower("status") == "ok") & F.col(size).isNotNull()).withColumn("_key", account_key(F.col("screen_name"), F.lit(None).cast("string")))
    last = good.groupBy("_key").agg(F.max_by(size, F.struct("collected_at", size)).alias("_read"))
    met = rows.withColumn("_key", account_key(F.col(name), F.col(url))).join(last, "_key", "left")
    kind = F.when(F.col(size).isNotNull(), "own").when(F.col("_read").isNotNull(), "profile")
    return met.withColumns({"audience_from": kind, size: F.coalesce(size, "_read")}).drop("_key", "_read")


def _known(rows: DataFrame, names: tuple[str, ...]) -> Column:
    """The first of the columns that is there and neither null nor blank."""
    there = [F.when(F.trim(F.col(n).cast("string")) != "", F.col(n).cast("string")) for n in names if n in rows.columns]
    return F.coalesce(*there) if there else F.lit(None).cast("string")


def detected(rows: DataFrame) -> Column:
    """The platform a row says, or else that its columns tell."""
    by_columns = next((p for p, signs in SIGNS.items() if set(signs) & set(rows.columns)), None)
    said = F.when(F.lower("source").isin(*SIGNS), F.lower("source")) if "source" in rows.columns else F.lit(None).cast("string")
    return F.coalesce(said, F.lit(by_columns))


def canonical(rows: DataFrame, salt: str) -> DataFrame:
    """Rows of any export in the canonical event's columns, with the reason why one cannot be taken."""
    source = detected(rows)
    url = _known(rows, ALIASES["url"])
    video = F.concat(F.lit("https://www.youtube.com/watch?v="), F.col("video_id").cast("string")) if "video_id" in rows.columns else F.lit(None).cast("string")
    made = rows.select(
        source.alias("source"),
        _known(rows, ALIASES["platform_event_id"]).alias("platform_event_id"),
        F.coalesce(url, F.when(source == "youtube", video)).alias("url"),
        t.clean_text(_known(rows, ALIASES["text"])).alias("clean_text"),
        salted(salt, _known(rows, ALIASES["author"])).alias("author_hash"),
        t.parsed_time(_known(rows, ALIASES["timestamp"])).alias("event_ts"),
        _known(rows, ALIASES["language"]).alias("language"),
        *[t.parsed_count(_known(rows, ALIASES[c])).alias(c) for c in ("like_count", "view_count", "reply_count")],
        (t.parsed_flag(F.col("is_reply").cast("string")) if "is_reply" in rows.columns else F.lit(None).cast("boolean")).alias("is_reply"),
    )
    lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("source", "author_hash", "url", "event_ts")]))
    return made.withColumn("rejected", F.when(F.size(lacking) > 0, F.concat(F.lit("missing: "), F.array_join(lacking, ", "))))


def read_export(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """CSV with a header, or JSON lines; all CSV values are texts until they are parsed by meaning."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"') if kind == "csv" else spark.read.json(path)


# Fixed value: the part of an API answer that is used.
_COMMENT = "struct<id:string,snippet:struct<textOriginal:string,textDisplay:string,authorDisplayName:string,likeCount:long,publishedAt:string>>"
ANSWER = (
    "video_id string, video_metadata struct<snippet:struct<title:string,description:string,channelTitle:string,publishedAt:string>,statistics:struct<viewCount:string,likeCount:string>,contentDetails:struct<duration:string>>, "
    f"comment_threads_pages array<struct<items:array<struct<id:string,snippet:struct<totalReplyCount:long,topLevelComment:{_COMMENT}>,replies:struct<comments:array<{_COMMENT}>>>>>>"
)


def api_answers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANSWER).json(path, multiLine=True).where("video_id is not null")


def videos(answers: DataFrame) -> DataFrame:
    """One row a video."""
    m = F.col("video_metadata")
    return answers.select("video_id", m["snippet"]["title"].alias("title"), m["snippet"]["channelTitle"].alias("channel"), t.parsed_time(m["snippet"]["publishedAt"]).alias("published_at"), t.parsed_count(m["statistics"]["viewCount"]).alias("view_count"), t.parsed_count(m["statistics"]["likeCount"]).alias("like_count"), t.parsed_duration(m["contentDetails"]["duration"]).alias("duration_seconds"))


def comments(answers: DataFrame, salt: str) -> DataFrame:
    """Top comments and replies as rows, with the video's age when they were written."""
    items = answers.select("video_id", F.col("video_metadata.snippet.publishedAt").alias("_born"), F.explode_outer(F.flatten("comment_threads_pages.items")).alias("i")).where("i is not null")
    top = items.select("video_id", "_born", F.col("i.id").alias("thread_id"), F.lit(False).alias("is_reply"), F.col("i.snippet.topLevelComment").alias("c"))
    replies = items.select("video_id", "_born", F.col("i.id").alias("thread_id"), F.lit(True).alias("is_reply"), F.explode("i.replies.comments").alias("c"))
    both = top.unionByName(replies)
    text = F.coalesce("c.snippet.textOriginal", "c.snippet.textDisplay")
    rows = both.select("video_id", "thread_id", F.col("c.id").alias("comment_id"), "is_reply", salted(salt, F.col("c.snippet.authorDisplayName")).alias("author_hash"), text.alias("text"), F.coalesce("c.snippet.likeCount", F.lit(0)).alias("like_count"), t.parsed_time(F.col("c.snippet.publishedAt")).alias("published_at"), "_born")
    flags = t.keyword_flags(F.col("text"))
    return rows.withColumns({k: c for k, c in flags.items()} | {"video_age_days": F.datediff("published_at", t.parsed_time(F.col("_born")))}).drop("_born")


def operations(usage: DataFrame) -> DataFrame:
    """Usage rows of two generations in one form: old ones name units ``cost`` and calls ``requests``."""
    pick = lambda *names: F.coalesce(*[F.col(n) for n in names if n in usage.columns], F.lit(0))
    calls, units = pick("calls", "requests"), pick("units", "cost")
    return usage.select("endpoint", "workload", "at", F.greatest(calls, F.lit(0)).cast("long").alias("calls"), F.greatest(units, F.lit(0)).cast("long").alias("units"))
