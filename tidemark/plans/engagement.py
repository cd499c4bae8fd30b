"""Queries over engagement readings, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import bindings as b
from tidemark.bindings import with_
from tidemark.operators import snapshots as s

_RATES = """, turns AS (
  SELECT *, lag(observed_at) OVER w AS was_at, lag(view_count) OVER w AS was_views, lag(like_count) OVER w AS was_likes, lag(comment_count) OVER w AS was_comments,
    lag(view_count_available) OVER w AS was_seen FROM observations WINDOW w AS (PARTITION BY source, platform_event_id ORDER BY observed_at, event_id)
), steps AS (
  SELECT *, trunc((floor(epoch(observed_at)) - floor(epoch(created_at))) / 60)::BIGINT AS age_minutes,
    CASE WHEN observed_at > was_at THEN (floor(epoch(observed_at)) - floor(epoch(was_at))) / 3600.0 END AS hours_since_previous,
    CASE WHEN view_count_available AND was_seen AND view_count >= was_views THEN view_count - was_views END AS views_delta,
    CASE WHEN like_count_available AND was_seen AND like_count >= was_likes THEN like_count - was_likes END AS likes_delta,
    CASE WHEN comment_count_available AND was_seen AND comment_count >= was_comments THEN comment_count - was_comments END AS comments_delta FROM turns
), rates AS (
  SELECT *, CASE WHEN hours_since_previous > 0 THEN views_delta / hours_since_previous END AS views_per_hour,
    CASE WHEN hours_since_previous > 0 THEN likes_delta / hours_since_previous END AS likes_per_hour,
    CASE WHEN hours_since_previous > 0 THEN comments_delta / hours_since_previous END AS comments_per_hour,
    CASE WHEN view_count_available AND view_count > 0 THEN like_count / view_count END AS like_rate,
    CASE WHEN view_count_available AND view_count > 0 THEN comment_count / view_count END AS comment_rate,
    CASE WHEN view_count_available AND view_count > 0 THEN (like_count + comment_count) / view_count END AS engagement_rate FROM steps
), full_rates AS (
  SELECT *, CASE WHEN hours_since_previous > 0 THEN (views_per_hour - lag(views_per_hour) OVER w) / hours_since_previous END AS views_acceleration
  FROM rates WINDOW w AS (PARTITION BY source, platform_event_id ORDER BY observed_at, event_id)
)"""
_NUMBERS = ["views_per_hour", "likes_per_hour", "comments_per_hour", "like_rate", "comment_rate", "engagement_rate", "views_acceleration"]


def _rounded(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


def deltas(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.with_rates(b.observations(spark, sf))
    return rows.select("source", "platform_event_id", "event_id", "age_minutes", *_rounded("hours_since_previous"), "views_delta", "likes_delta", "comments_delta", *_rounded(*_NUMBERS))


def velocity(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.velocity(b.observations(spark, sf), 2.0)
    return rows.select("source", "platform_event_id", "observed_at", "view_count", "like_count", "comment_count", "views_delta", *_rounded(*_NUMBERS, "virality_score"), "is_viral")


def known(spark: SparkSession, sf: str) -> DataFrame:
    return s.latest_known(b.observations(spark, sf), ("view_count", "like_count", "comment_count"))


def _born(spark: SparkSession, sf: str) -> DataFrame:
    return b.observations(spark, sf).groupBy(*s.KEYS).agg(F.min("created_at").alias("event_ts"))


def horizon(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.at_horizon(_born(spark, sf), b.observations(spark, sf), 24, 48)
    return rows.select(*s.KEYS, "event_ts", "observed_at", "event_id", "view_count", "like_count", "comment_count")


def as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Each purchase with its customer's last view or click before."""
    e = b.table(spark, sf, "events")
    bought = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase_id"))
    seen = e.where("event_type in ('view', 'click')").select("user_id", F.col("ts").alias("seen_at"), "event_id", F.floor("value").cast("long").alias("amount"))
    return s.as_of(bought, seen, "user_id", "ts", "seen_at", ["event_id", "amount"], "event_id")


def trajectory(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import labels

    rows = labels.early_trajectory(s.with_rates(b.observations(spark, sf)), 48, 120, 2)
    return rows.select("source", "platform_event_id", "status", "n", *_rounded("first_age_hours", "last_age_hours", "span_hours", "log_view_count", "views_per_hour_last", "views_per_hour_mean", "views_per_hour_max", "engagement_rate_last"), "outcome_view_count")


def bands(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import labels

    rows = labels.engagement_bands(s.latest(b.observations(spark, sf)))
    return rows.select(*s.KEYS, "engagement_total", "observed_metrics", *_rounded("engagement_coverage"), "engagement_band", "comment_type")


QUERIES = {"w11_f19_f21_deltas": deltas, "b8_velocity": velocity, "w3_latest_known": known, "j6_w5_at_horizon": horizon, "j7_as_of": as_of, "a19_a20_b13_trajectory": trajectory, "f23_bands": bands}

_ROUND = ", ".join(f"round({n}, 6) AS {n}" for n in _NUMBERS)
SQL = {
    "w11_f19_f21_deltas": with_("observations", _RATES + f" SELECT source, platform_event_id, event_id, age_minutes, round(hours_since_previous, 6) AS hours_since_previous, views_delta, likes_delta, comments_delta, {_ROUND} FROM full_rates"),
    "b8_velocity": with_("observations", _RATES + f""", last AS (SELECT * FROM full_rates QUALIFY row_number() OVER (PARTITION BY source, platform_event_id ORDER BY observed_at DESC, event_id DESC) = 1),
  scored AS (SELECT *, ln(1 + views_per_hour) + engagement_rate * 10 + views_acceleration / 1000 AS score FROM last)
SELECT source, platform_event_id, observed_at, view_count, like_count, comment_count, views_delta, {_ROUND}, round(score, 6) AS virality_score, score >= 2.0 AS is_viral FROM scored"""),
    "w3_latest_known": with_("observations", """SELECT source, platform_event_id, arg_max(view_count, (observed_at, event_id)) FILTER (view_count IS NOT NULL) AS latest_view_count,
  arg_max(like_count, (observed_at, event_id)) FILTER (like_count IS NOT NULL) AS latest_like_count, arg_max(comment_count, (observed_at, event_id)) FILTER (comment_count IS NOT NULL) AS latest_comment_count,
  max(observed_at) AS latest_at, arg_max(event_id, (observed_at, event_id)) AS latest_id, count(view_count) > 0 AS latest_view_count_available, count(like_count) > 0 AS latest_like_count_available, count(comment_count) > 0 AS latest_comment_count_available
FROM observations GROUP BY source, platform_event_id"""),
    "j6_w5_at_horizon": with_("observations", """SELECT source, platform_event_id, created_at AS event_ts, observed_at, event_id, view_count, like_count, comment_count FROM observations
WHERE observed_at >= created_at + INTERVAL 24 HOUR AND observed_at <= created_at + INTERVAL 72 HOUR QUALIFY row_number() OVER (PARTITION BY source, platform_event_id ORDER BY observed_at, event_id) = 1"""),
    "j7_as_of": """SELECT p.user_id, p.ts, p.event_id AS purchase_id, v.ts AS seen_at_found, v.event_id, floor(v.value)::BIGINT AS amount FROM (SELECT * FROM events WHERE event_type = 'purchase') p
LEFT JOIN LATERAL (SELECT * FROM events e WHERE e.user_id = p.user_id AND e.ts <= p.ts AND e.event_type IN ('view', 'click') ORDER BY e.ts DESC, e.event_id DESC LIMIT 1) v ON true""",
    "a19_a20_b13_trajectory": with_("observations", _RATES + """, aged AS (SELECT *, age_minutes / 60.0 AS age_hours FROM full_rates), marked AS (
  SELECT source, platform_event_id, count(*) FILTER (age_hours <= 48) AS n, min(age_hours) FILTER (age_hours <= 48) AS f, max(age_hours) FILTER (age_hours <= 48) AS l,
    (array_agg(view_count ORDER BY observed_at DESC, event_id DESC) FILTER (age_hours <= 48))[1] AS v, (array_agg(views_per_hour ORDER BY observed_at DESC, event_id DESC) FILTER (age_hours <= 48))[1] AS vl,
    avg(views_per_hour) FILTER (age_hours <= 48) AS vm, max(views_per_hour) FILTER (age_hours <= 48) AS vx, (array_agg(engagement_rate ORDER BY observed_at DESC, event_id DESC) FILTER (age_hours <= 48))[1] AS er,
    count(*) FILTER (age_hours >= 120) AS later, (array_agg(view_count ORDER BY observed_at, event_id) FILTER (age_hours >= 120))[1] AS o FROM aged GROUP BY source, platform_event_id)
SELECT source, platform_event_id, CASE WHEN n = 0 THEN 'no_window' WHEN n < 2 THEN 'too_few' WHEN later = 0 THEN 'no_outcome' ELSE 'kept' END AS status, n, round(f, 6) AS first_age_hours, round(l, 6) AS last_age_hours, round(l - f, 6) AS span_hours,
  round(ln(1 + v), 6) AS log_view_count, round(vl, 6) AS views_per_hour_last, round(vm, 6) AS views_per_hour_mean, round(vx, 6) AS views_per_hour_max, round(er, 6) AS engagement_rate_last, o AS outcome_view_count FROM marked"""),
    "f23_bands": with_("observations", """, last AS (SELECT * FROM observations QUALIFY row_number() OVER (PARTITION BY source, platform_event_id ORDER BY observed_at DESC, event_id DESC) = 1),
  t AS (SELECT *, coalesce(view_count, 0) + coalesce(like_count, 0) + coalesce(comment_count, 0) AS total, (view_count IS NOT NULL)::INT + (like_count IS NOT NULL)::INT + (comment_count IS NOT NULL)::INT AS n FROM last)
SELECT source, platform_event_id, total AS engagement_total, n AS observed_metrics, round(n / 3.0, 6) AS engagement_coverage, CASE WHEN n = 0 THEN 'unknown' WHEN total = 0 THEN 'none' WHEN total < 10 THEN 'low' WHEN total < 100 THEN 'medium' ELSE 'high' END AS engagement_band,
  CASE WHEN comment_count IS NULL THEN 'unknown' WHEN comment_count > 0 THEN 'has_replies' ELSE 'no_replies' END AS comment_type FROM t"""),
}
