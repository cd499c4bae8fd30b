"""Health, quotas, repair candidates, fallbacks, audits and lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.functions.identity import row_id, salted
from tidemark.operators.quality import missing

# Fixed value: the order of what a quota serves last.
SECONDARY = ("comments", "transcripts", "channels")


def protected(rows: DataFrame, salt: str, snapshot: Column | None = None) -> DataFrame:
    """Hashed people and accounts, plain URLs, cleaned texts, metadata without accounts; a snapshot's id is a hash already and stays."""
    user = salted(salt, F.col("user_id"))
    user = user if snapshot is None else F.when(snapshot, F.col("user_id")).otherwise(user)
    url = F.when((F.col("source") == "x") & F.col("platform_event_id").isNotNull(), F.concat(F.lit("https://x.com/i/status/"), "platform_event_id")).otherwise(F.col("url"))
    clean = t.clean_text(F.coalesce("raw_text", "title"))
    own = {"user_id": user, "url": t.without_fragment(url), "clean_text": clean, "title": t.clean_text(F.col("title"))}
    if "x_account" in rows.columns:
        own["x_account"] = salted(salt, F.col("x_account"))
    if "metadata_json" in rows.columns:
        own["metadata_json"] = t.redacted_field(F.col("metadata_json"), "x_account")
    rows = rows.withColumns(own)
    return rows.withColumns({"raw_text": F.col("clean_text"), "text_for_model": t.for_model(F.col("clean_text"))})


def snapshot_events(rows: DataFrame, metrics: list[str]) -> Column:
    """Whether an event holds a reading: any metric observed, or a YouTube engagement event."""
    seen = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"{m}_available"), F.col(m).isNotNull()) & F.col(m).isNotNull() for m in metrics])
    return ((F.col("source") == "youtube") & (F.col("event_type") == "youtube.engagement.snapshot")) | seen


def root_videos(rows: DataFrame) -> DataFrame:
    """Videos themselves among mixed events."""
    kind = F.lower(F.coalesce("content_type", F.lit("")))
    return rows.where((F.col("source") == "youtube") & ~kind.rlike("comment|reply") & (t.video_id(F.col("url")).isNotNull() | F.col("platform_event_id").isNotNull()))


def thumbnails(rows: DataFrame, safe: str = r"^https://(?!\.|[^/]*\.\.)[a-z0-9.-]*(?<![a-z0-9-])(?:ytimg|ggpht|youtube)\.com/") -> DataFrame:
    """Contents whose thumbnail is missing or unsafe, with one made from the video's id, once a content."""
    bad = F.col("thumbnail_url").isNull() | (F.trim("thumbnail_url") == "") | ~F.lower(F.trim("thumbnail_url")).rlike(safe)
    found = rows.where(bad & F.col("video_id").rlike("^[A-Za-z0-9_-]{1,64}$"))
    once = found.groupBy("content_id").agg(F.max_by("video_id", F.struct("event_ts", "video_id")).alias("video_id"))
    return once.withColumn("thumbnail_url", F.concat(F.lit("https://img.youtube.com/vi/"), "video_id", F.lit("/default.jpg")))


def explored(rows: DataFrame, source: str | None = None, since: str | None = None, until: str | None = None, user: str | None = None, keyword: str | None = None, limit: int | None = None) -> DataFrame:
    """The explorer's filters; newest first where there is a limit."""
    if source:
        rows = rows.where(F.col("source") == source)
    if since:
        rows = rows.where(F.col("event_ts") >= F.lit(since).cast("timestamp"))
    if until:
        rows = rows.where(F.col("event_ts") < F.lit(until).cast("timestamp") + F.expr("INTERVAL 1 DAY"))
    if user:
        rows = rows.where(F.contains("author_hash", F.lit(user)))
    if keyword:
        rows = rows.where(reduce(lambda a, b: a | b, [F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(keyword.lower())) for c in ("text", "url") if c in rows.columns]))
    return rows.orderBy(F.desc_nulls_last("event_ts"), "platform_event_id").limit(limit) if limit else rows


def allowed(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows of listed communities, the community read from the URL where it is missing."""
    community = F.lower(F.coalesce("community", t.path_part(F.col("url"), r"/r/([^/?#]+)")))
    return rows.withColumn("community", community).where(F.col("community").isin(*[n.lower() for n in names]))


def audited(raw: DataFrame, protected_rows: DataFrame, key: str) -> DataFrame:
    """Rows whose protected text is other than the policy gives, lost a token, or still holds a value of the raw text."""
    wanted = t.clean_text(F.col("raw_text"))
    values = F.flatten(F.array(*[F.regexp_extract_all("raw_text", F.lit(f"({p})"), 1) for p in (t.EMAIL, t.MENTION, t.IP)]))
    joined = raw.select(key, wanted.alias("_want"), values.alias("_values"), F.length("raw_text").alias("_n")).join(protected_rows.select(key, "clean_text", "text_for_model"), key, "left")
    lost = reduce(lambda a, b: a | b, [F.contains("clean_text", F.lit(f"<{x}>")) & ~F.contains("text_for_model", F.lit(f"<{x}>")) for x in t.TOKENS])
    names = F.array(F.when(F.col("clean_text").isNull(), "row_absent"), F.when(~F.col("clean_text").eqNullSafe(F.col("_want")) & F.col("clean_text").isNotNull(), "clean_text_differs"), F.when(lost, "model_text_lost_token"), F.when(F.exists("_values", lambda v: F.contains("clean_text", v)), "sensitive_value_survived"))
    return joined.select(key, F.array_compact(names).alias("violations")).where(F.size("violations") > 0)


def health(journal: DataFrame, proofs: DataFrame, now: Column, warn_journal: int = 600, warn_state: int = 900, key: str = "event_id") -> DataFrame:
    """Lags of both sides, the gap between them and a status, as one row."""
    lag = lambda df, at, name: df.agg(F.greatest(F.unix_timestamp(now) - F.unix_timestamp(F.max(at)), F.lit(0)).alias(name))
    gap = missing(journal, proofs, key).agg(F.count(F.lit(1)).alias("gap"))
    one = lag(journal, "ingested_at", "journal_lag").crossJoin(lag(proofs, "applied_at", "state_lag")).crossJoin(gap)  # one row each
    late = (F.col("journal_lag").isNull() & F.col("state_lag").isNull()) | F.coalesce(F.col("journal_lag") > warn_journal, F.lit(False)) | F.coalesce(F.col("state_lag") > warn_state, F.lit(False))
    return one.withColumns({"status": F.when(F.col("gap") > 0, "error").when(late, "warning").otherwise("success"), "health_id": row_id(F.lit("boundary"), now)})


def quota(usage: DataFrame, budget: int, reserve: int, pressure: float = 0.8, critical: float = 0.95) -> DataFrame:
    """Units used a day by workload, pressure, and whether each workload may go on: secondary work stops first, then all but recent metrics."""
    day = usage.groupBy(F.to_date("at").alias("day"), "workload").agg(F.sum("units").alias("units"), F.sum("calls").alias("calls"))
    total = day.groupBy("day").agg(F.sum("units").alias("used"), F.coalesce(F.sum(F.when(F.col("workload") == "recent_metrics", F.col("units"))), F.lit(0)).alias("recent"))
    rows = day.join(total, "day").withColumn("pressure", F.least(F.lit(1.0), F.col("used") / budget))
    left = F.greatest(F.lit(budget) - F.col("used"), F.lit(0))
    kept = F.greatest(F.lit(reserve) - F.col("recent"), F.lit(0))
    own = F.col("workload") == "recent_metrics"
    reason = F.when((F.col("pressure") >= critical) & ~own, "critical_quota_pressure").when((F.col("pressure") >= pressure) & F.col("workload").isin(*SECONDARY), "secondary_workload_suspended")
    rows = rows.withColumn("reason", reason)
    return rows.withColumn("spendable", F.when(F.col("reason").isNotNull(), 0).when(own, left).otherwise(F.greatest(left - kept, F.lit(0))))


def with_fallbacks(rows: DataFrame, key: str, *sources: DataFrame) -> DataFrame:
    """Each column from the first source, in order, that knows it."""
    out = rows
    for s in sources:
        shared = [c for c in s.columns if c in rows.columns and c != key]
        renamed = s.select(key, *[F.col(c).alias(f"_f_{c}") for c in shared])
        out = out.join(renamed, key, "left").withColumns({c: F.coalesce(c, f"_f_{c}") for c in shared}).drop(*[f"_f_{c}" for c in shared])
    return out


def layers(ids: DataFrame, key: str, **tables: DataFrame) -> DataFrame:
    """All rows of some contents in every layer, as JSON with the layer's name."""
    parts = [df.join(ids.select(key), key, "left_semi").select(F.lit(name).alias("layer"), key, F.to_json(F.struct(*df.columns)).alias("row")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def candidates(raw: DataFrame, features: DataFrame, journal: DataFrame, key: str, weights: dict[str, int], limit: int = 20) -> DataFrame:
    """Rows present in all layers, by the weight of the redactions their texts needed; ties by kinds, then id."""
    kinds = reduce(lambda a, b: a + b, [(F.col(c) > 0).cast("int") for c in weights])
    score = reduce(lambda a, b: a + b, [F.least(F.col(c), F.lit(3)) * w for c, w in weights.items()])
    both = raw.select(key).join(features, key).join(journal.select(key).distinct(), key, "left_semi")
    return both.withColumns({"kinds": kinds, "score": score}).where("score > 0").orderBy(F.desc("score"), F.desc("kinds"), key).limit(limit)


def any_available(rows: DataFrame, key: str, flag: Column) -> DataFrame:
    """A38."""
    return rows.groupBy(key).agg(F.bool_or(F.coalesce(flag, F.lit(False))).alias("available"))
