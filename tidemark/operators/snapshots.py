"""Engagement time series: differences, rates and picks over repeated readings of a post.

A counter is observed if its ``_available`` flag is true (or absent) and its value is not null. Whatever is derived
is null unless all it is derived from is observed; a falling counter gives a null difference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("source", "platform_event_id")
COUNTERS = {"views": "view_count", "likes": "like_count", "comments": "comment_count"}


def observed(metric: str, columns: list[str] | None = None) -> Column:
    """Whether a counter was read."""
    flag = f"{metric}_available"
    there = F.col(metric).isNotNull()
    return there if columns is not None and flag not in columns else F.coalesce(F.col(flag), there) & there


def growth(now: Column, before: Column, known: Column) -> Column:
    """what a counter gained since the reading before, null if unknown or negative."""
    return F.when(known & (now >= before), now - before)


def age_minutes(at: Column, born: Column) -> Column:
    """whole minutes, towards zero."""
    return ((F.unix_timestamp(at) - F.unix_timestamp(born)) / 60).cast("long")


def share(part: Column, of: str, *metrics: str) -> Column:
    """a rate of a counter that was read and is above zero."""
    known = observed(of)
    for m in metrics:
        known = known & observed(m)
    return F.when(known & (F.col(of) > 0), part / F.col(of))


def with_rates(readings: DataFrame, time: str = "observed_at", tie: str = "event_id") -> DataFrame:
    """Each reading with differences, hourly rates and acceleration against the one before."""
    turn = Window.partitionBy(*KEYS).orderBy(time, tie)
    before = lambda c: F.lag(c).over(turn)
    hours = (F.unix_timestamp(time) - F.unix_timestamp(before(time))) / 3600.0
    rows = readings.withColumns(
        {"age_minutes": age_minutes(F.col(time), F.col("created_at")), "hours_since_previous": F.when(F.col(time) > before(time), hours)}
        | {f"_known_{k}": observed(m) & before(observed(m)) for k, m in COUNTERS.items()}
        | {f"_was_{k}": before(F.col(m)) for k, m in COUNTERS.items()}
    )
    rows = rows.withColumns({f"{k}_delta": growth(F.col(m), F.col(f"_was_{k}"), F.col(f"_known_{k}")) for k, m in COUNTERS.items()})
    rows = rows.withColumns({f"{k}_per_hour": F.when(F.col("hours_since_previous") > 0, F.col(f"{k}_delta") / F.col("hours_since_previous")) for k in COUNTERS})
    faster = F.col("views_per_hour") - before(F.col("views_per_hour"))
    return rows.withColumns(
        {
            "like_rate": share(F.col("like_count"), "view_count", "like_count"),
            "comment_rate": share(F.col("comment_count"), "view_count", "comment_count"),
            "engagement_rate": share(F.col("like_count") + F.col("comment_count"), "view_count", "like_count", "comment_count"),
            "views_acceleration": F.when(F.col("hours_since_previous") > 0, faster / F.col("hours_since_previous")),
        }
    ).drop(*[f"_{a}_{k}" for a in ("known", "was") for k in COUNTERS])


def latest(readings: DataFrame, keys: tuple[str, ...] = KEYS, time: str = "observed_at", tie: str = "event_id") -> DataFrame:
    """The last reading of each key, as one aggregation."""
    own = [c for c in readings.columns if c not in keys]
    top = F.max_by(F.struct(*own), F.struct(F.col(time), F.col(tie)))
    return readings.where(F.col(time).isNotNull()).groupBy(*keys).agg(top.alias("_top")).select(*keys, "_top.*")


def virality(rows: DataFrame, threshold: float = 8.0) -> DataFrame:
    """log of hourly views, ten times the engagement rate and a thousandth of the acceleration; null unless all are known."""
    known = F.col("views_per_hour").isNotNull() & F.col("engagement_rate").isNotNull() & F.col("views_acceleration").isNotNull()
    score = F.log1p("views_per_hour") + F.col("engagement_rate") * 10 + F.col("views_acceleration") / 1000
    return rows.withColumns({"virality_score": F.when(known, score), "is_viral": F.when(known, score >= threshold)})


def velocity(readings: DataFrame, threshold: float = 8.0) -> DataFrame:
    """The latest reading of each post with its virality."""
    return virality(latest(with_rates(readings)), threshold)


def latest_known(readings: DataFrame, metrics: tuple[str, ...], keys: tuple[str, ...] = KEYS, time: str = "observed_at", tie: str = "event_id") -> DataFrame:
    """For each key the last observed value of each metric, whether there is one, and the last reading's time and id."""
    order = F.struct(F.col(time), F.col(tie))
    values = [F.max_by(F.when(observed(m), F.col(m)), F.when(observed(m), order)).alias(f"latest_{m}") for m in metrics]
    rows = readings.groupBy(*keys).agg(*values, F.max(time).alias("latest_at"), F.max_by(tie, order).alias("latest_id"))
    return rows.withColumns({f"latest_{m}_available": F.col(f"latest_{m}").isNotNull() for m in metrics})


def at_horizon(posts: DataFrame, readings: DataFrame, hours: int, tolerance: int, time: str = "observed_at", tie: str = "event_id") -> DataFrame:
    """Each post's first reading from ``hours`` after publication on, no later than ``tolerance`` hours more."""
    born = posts.select(*KEYS, F.col("event_ts").alias("_born"))
    due = F.col("_born") + F.expr(f"INTERVAL {hours} HOURS")
    inside = readings.join(born, list(KEYS)).where((F.col(time) >= due) & (F.col(time) <= due + F.expr(f"INTERVAL {tolerance} HOURS")))
    own = [c for c in readings.columns if c not in KEYS]
    first = F.min_by(F.struct(*own), F.struct(F.col(time), F.col(tie)))
    return inside.groupBy(*KEYS, "_born").agg(first.alias("_first")).select(*KEYS, F.col("_born").alias("event_ts"), "_first.*")


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str], tie: str) -> DataFrame:
    """The last row of ``right`` at or before each row of ``left``, by one shuffle and a running pick.

    Of readings at the same moment the one with the greater ``tie`` counts.
    """
    a = left.withColumns({"_at": F.col(left_time), "_side": F.lit(1), "_tie": F.lit(None).cast(right.schema[tie].dataType)})
    pick = F.struct(F.col(right_time).alias("_found"), *values)
    b = right.select(F.col(key), F.col(right_time).alias("_at"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), pick.alias("_pick"))
    both = a.unionByName(b, allowMissingColumns=True)
    before = Window.partitionBy(key).orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    rows = both.withColumn("_pick", F.last("_pick", ignorenulls=True).over(before)).where("_side = 1")
    return rows.select(*left.columns, F.col("_pick._found").alias(f"{right_time}_found"), *[F.col(f"_pick.{v}").alias(v) for v in values])
