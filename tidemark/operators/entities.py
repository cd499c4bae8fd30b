"""Contents, interactions, transcripts, content statistics and user evolution out of one event history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import written

from tidemark.functions.identity import content_id
from tidemark.functions.text import path_part, slug_title, video_id
from tidemark.operators.snapshots import latest_known

OPTIONAL = {"content_id": "string", "root_content_id": "string", "parent_content_id": "string", "conversation_id": "string", "relation_type": "string", "content_type": "string", "event_type": "string", "subreddit": "string", "title": "string", "metadata_status": "string", "score": "long"}


def normalised(events: DataFrame) -> DataFrame:
    """Each event's platform id, content, root, parent, whether it is an interaction and its types.

    A reply on reddit belongs to its thread (the conversation, or the post in its URL); elsewhere an event is its own content
    unless it says it is a comment, reply or interaction.
    """
    rows = events.withColumns({c: F.lit(None).cast(k) for c, k in OPTIONAL.items() if c not in events.columns})
    source, url = F.col("source"), F.col("url")
    derived = F.when(source == "reddit", path_part(url, r"/comments/([^/?#]+)")).when(source == "x", path_part(url, r"/status/(\d+)")).when(source == "youtube", video_id(url))
    own = F.coalesce(F.col("platform_event_id"), derived, url)
    root = F.when(source == "reddit", F.coalesce("conversation_id", derived, own)).otherwise(own)
    rows = rows.withColumns({"_own": own, "_root": root})
    relation, kind = F.lower(F.coalesce("relation_type", F.lit(""))), F.lower(F.coalesce("content_type", F.lit("")))
    is_reply = relation.isin("comment", "reply", "interaction") | kind.rlike("(comment|reply|interaction)$") | ((source == "reddit") & F.col("relation_type").isNull())
    event_content = F.coalesce("content_id", content_id(source, F.col("_own")))
    root_content = F.when(source == "youtube", content_id(source, F.col("_root"))).otherwise(F.coalesce("root_content_id", content_id(source, F.col("_root"))))
    rows = rows.withColumns({"_event_content": event_content, "_root_content": root_content, "is_interaction": is_reply})
    return rows.withColumns(
        {
            "interaction_id": F.when(F.col("is_interaction"), F.col("_event_content")).otherwise(F.sha2(F.concat_ws(":", source, "_own", F.coalesce("user_id", F.lit(""))), 256)),
            "content_id": F.col("_root_content"),
            "root_content_id": F.col("_root_content"),
            "parent_content_id": F.coalesce("parent_content_id", F.when(source == "reddit", F.col("_root_content"))),
            "platform_content_id": F.col("_root"),
            "subreddit": F.coalesce("subreddit", F.when(source == "reddit", path_part(url, r"/r/([^/?#]+)"))),
            "title": F.when(source == "reddit", slug_title(url)).otherwise(F.col("title")),
            "interaction_type": F.when(source == "reddit", "reddit_comment").when(source == "youtube", F.coalesce("content_type", F.lit("youtube_comment"))).when(source == "x", "x_reply").otherwise(F.coalesce("content_type", F.lit("interaction"))),
            "content_type": F.when(source == "reddit", "reddit_post").when(source == "x", "x_post").when(source == "youtube", "youtube_video").otherwise(F.coalesce("content_type", F.lit("unknown"))),
            "event_date": F.to_date("event_ts"),
        }
    ).drop("_own", "_root", "_event_content", "_root_content")


def _first(c: str, keep: Column | None = None) -> Column:
    """The earliest known value, in an order that is total (A1: not whichever row comes first)."""
    value = F.col(c) if keep is None else F.when(keep, F.col(c))
    return F.min_by(value, F.when(value.isNotNull(), F.struct("event_ts", "event_id"))).alias(c)


def contents(rows: DataFrame) -> DataFrame:
    """A1, B1: one row a content, each field's earliest known value; metadata succeeded if it ever did."""
    other = F.col("source") != "reddit"  # a thread's replies do not speak for its post
    return rows.where(~F.col("is_interaction") | (F.col("source") == "reddit")).groupBy("content_id").agg(
        *[_first(c) for c in ("source", "platform_content_id", "content_type", "url", "title", "subreddit", "language", "event_date", "parent_content_id")],
        _first("text", other),
        _first("user_id", other).alias("author_id_hash"),
        F.when(F.bool_or(F.col("metadata_status") == "success"), "success").otherwise(F.min_by("metadata_status", F.when(F.col("metadata_status").isNotNull(), F.struct("event_ts", "event_id")))).alias("metadata_status"),
        F.max("event_ts").alias("last_event_at"),
    )


def interactions(rows: DataFrame) -> DataFrame:
    """B2: one row an interaction, the earliest."""
    own = ["source", "parent_content_id", "root_content_id", "conversation_id", "interaction_type", "user_id", "text", "event_ts", "event_date", "event_id", "score"]
    first = F.min_by(F.struct(*own), F.struct("event_ts", "event_id"))
    return rows.where("is_interaction").groupBy("interaction_id").agg(first.alias("_f")).select("interaction_id", "_f.*").withColumnRenamed("user_id", "author_id_hash")


def _mean_words(c: str) -> Column:
    # the empty text counts as one word here, as in the tables this replaces
    return F.avg(F.size(F.split(F.trim(F.coalesce(c, F.lit(""))), r"\s+")))


def interaction_stats(rows: DataFrame) -> DataFrame:
    """A2."""
    return rows.groupBy("root_content_id").agg(F.count(F.lit(1)).alias("interaction_count"), F.count_distinct("author_id_hash").alias("unique_users"), _mean_words("text").alias("avg_length"), F.sum("score").alias("total_score"))


def content_stats(content: DataFrame, replies: DataFrame, readings: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """Contents with their replies' figures and latest known counters."""
    stats = interaction_stats(replies).withColumnRenamed("root_content_id", "content_id")
    known = latest_known(readings, metrics, keys=("content_id",))
    return content.join(stats, "content_id", "left").join(known, "content_id", "left")


def user_evolution(content: DataFrame, replies: DataFrame) -> DataFrame:
    """What each person made and touched on each day and source."""
    made = content.select(F.col("author_id_hash").alias("user_id_hash"), "source", "event_date", "content_id", "subreddit", F.lit(None).cast("string").alias("conversation_id"), "text", F.lit(1).alias("made"))
    said = replies.select(F.col("author_id_hash").alias("user_id_hash"), "source", "event_date", F.col("root_content_id").alias("content_id"), F.lit(None).cast("string").alias("subreddit"), "conversation_id", "text", F.lit(0).alias("made"))
    return made.unionByName(said).groupBy("user_id_hash", "source", "event_date").agg(
        F.sum("made").alias("contents_created"), F.sum(1 - F.col("made")).alias("interactions_created"), *[F.count_distinct(c).alias(f"distinct_{n}") for c, n in (("content_id", "contents"), ("subreddit", "subreddits"), ("conversation_id", "conversations"))],
        _mean_words("text").alias("avg_length"), F.count_if(F.contains(F.coalesce("text", F.lit("")), F.lit("?"))).alias("questions"),
    )


# Error codes that decide a transcript's state, states that may change yet, and the words of old for states.
BLOCKED_CODES = ("ip_blocked", "request_blocked")
PERMANENT_CODES = ("dependency_missing", "invalid_video_id", "missing_video_id")
RETRYABLE = ("pending", "rate_limited", "blocked", "retryable_error")
TERMINAL_STATES = ("available", "unavailable", "disabled", "permanent_error")
LEGACY = {"pending": "pending", "available": "success", "unavailable": "not_available", "disabled": "disabled", "rate_limited": "rate_limited", "blocked": "rate_limited", "retryable_error": "failed", "permanent_error": "failed"}


def lifecycle_state(status: Column, error: Column, has_text: Column, attempts: Column, most: int | None = None) -> Column:
    """F16: a transcript's state by its text, its error code or its status word; states that may change end after ``most`` attempts."""
    s, e = F.lower(F.trim(F.coalesce(status, F.lit("pending")))), F.lower(F.trim(F.coalesce(error, F.lit(""))))
    state = F.when(has_text, "available").when(e.isin(*BLOCKED_CODES), "blocked").when(e.isin(*PERMANENT_CODES), "permanent_error").when(s.isin(*RETRYABLE, *TERMINAL_STATES), s)
    state = state.when(s == "success", "available").when(s.isin("not_available", "age_restricted", "not_found"), "unavailable").when(s == "ip_blocked", "blocked").otherwise("retryable_error")
    if most is None:
        return state
    return F.when(state.isin(*RETRYABLE) & (F.coalesce(attempts, F.lit(0)) >= max(1, most)), "permanent_error").otherwise(state)


def legacy_status(state: Column) -> Column:
    """F16: the word of old for a state."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in LEGACY.items() for x in kv]), state)


def lifecycle(text: Column, told: Column, status: Column) -> Column:
    """F16: a transcript's state from its text, a state already given, or a status word of old."""
    s = F.lower(F.trim(status))
    return (
        F.when(F.length(F.trim(text)) > 0, "available").when(told.isNotNull(), told).when(s == "success", "available").when(s.isin("not_available", "not_found", "age_restricted"), "unavailable")
        .when(s.isin("disabled", "rate_limited", "permanent_error", "pending"), s).when(s == "ip_blocked", "blocked").otherwise("retryable_error")
    )


def language_code(given: Column, language: Column) -> Column:
    """the language asked for: as given, else Vietnamese for Vietnamese and English for all others."""
    return F.coalesce(given, F.when(F.lower(F.regexp_extract(F.coalesce(language, F.lit("")), "^([A-Za-z]+)", 1)) == "vi", "vi").otherwise("en"))


def best_transcripts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key an available transcript before others, then the newest attempt."""
    order = F.struct((F.col("lifecycle_status") == "available").cast("int"), F.col("last_attempt_at"), F.col("updated_at"), F.col("attempt_id"))
    own = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*own), order).alias("_b")).select(*keys, "_b.*")


def retry_candidates(rows: DataFrame, now: Column, attempts: int, hours: int, limit: int) -> DataFrame:
    """Transcripts worth another try, the longest waiting first."""
    due = F.col("last_attempt_at").isNull() | (F.col("last_attempt_at") <= now - F.expr(f"INTERVAL {hours} HOURS"))
    open_ = F.col("lifecycle_status").isin("retryable_error", "rate_limited", "blocked", "pending")
    return rows.where(open_ & (F.col("attempt_count") < attempts) & due).orderBy(F.col("last_attempt_at").asc_nulls_first(), "attempt_id").limit(limit)


def refresh_targets(rows: DataFrame, now: Column, days: dict[str, int], group: str, per_group: int) -> DataFrame:
    """Contents within their source's look-back whose next refresh is due, the longest due first, so many a group."""
    from pyspark.sql import Window

    since = F.create_map(*[x for s, d in days.items() for x in (F.lit(s), F.lit(d))])
    ok = (F.col("event_ts") >= now - F.make_dt_interval(days=F.try_element_at(since, F.col("source")))) & (F.col("next_refresh_at").isNull() | (F.col("next_refresh_at") <= now))
    turn = F.row_number().over(Window.partitionBy(group).orderBy(F.col("next_refresh_at").asc_nulls_first(), "content_id"))
    return rows.where(ok).withColumn("turn", turn).where(F.col("turn") <= per_group)


def refresh_minutes(age_hours: Column, multiplier: Column) -> Column:
    """how long until the next reading: longer with age, times a multiplier of 0.25 to 1."""
    base = F.when(age_hours < 6, 30).when(age_hours < 24, 60).when(age_hours < 72, 180).when(age_hours < 168, 360).when(age_hours < 720, 1440).otherwise(10080)
    return F.round(base * F.greatest(F.lit(0.25), F.least(F.lit(1.0), F.coalesce(multiplier, F.lit(1.0))))).cast("long")


def growth_multiplier(views_per_hour: Column, threshold: float = 1000.0, fast: float = 0.5) -> Column:
    """fast growers are read again sooner; unknown growth changes nothing."""
    return F.when(views_per_hour >= threshold, max(0.25, min(1.0, fast))).otherwise(1.0)


def retry_seconds(attempt: Column, first: int = 60, most: int = 86400) -> Column:
    """doubling delays."""
    return F.least(F.lit(most), F.lit(first) * F.pow(F.lit(2.0), F.least(attempt, F.lit(20)))).cast("long")


def covered_seconds(rows: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """The length of the union of each key's intervals."""
    from pyspark.sql import Window

    turn = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(turn.rowsBetween(Window.unboundedPreceding, -1))
    added = F.greatest(F.col(end) - F.greatest(F.col(start), F.coalesce(reach, F.col(start))), F.lit(0))
    return rows.where(F.col(end) > F.col(start)).withColumn("_a", added).groupBy(key).agg(F.sum("_a").alias("covered"))


def comment_tree(rows: DataFrame) -> DataFrame:
    """Depth and root of each comment from (id, parent_id), at any depth.

    Each comment points at an ancestor, at first its parent; in each round it points at what that one points at, so a depth of n takes
    about log2(n) rounds of one join. Comments whose ancestors are missing, or go round in a circle, have no root and are left out.
    """
    top = F.col("parent_id").isNull()
    now = written(rows.select("id", "parent_id", F.coalesce("parent_id", "id").alias("root_id"), F.when(top, 0).otherwise(1).alias("depth"), top.alias("at_root")), "tree")
    before = None
    while (left := now.where("not at_root").count()) not in (0, before):
        up = now.select(F.col("id").alias("root_id"), F.col("root_id").alias("up"), F.col("depth").alias("more"), F.col("at_root").alias("done"))
        moved = now.where("not at_root").drop("at_root").join(up, "root_id").select("id", "parent_id", F.col("up").alias("root_id"), (F.col("depth") + F.col("more")).alias("depth"), F.col("done").alias("at_root"))
        now, before = written(now.where("at_root").unionByName(moved), "tree"), left
    return now.where("at_root").drop("at_root")
