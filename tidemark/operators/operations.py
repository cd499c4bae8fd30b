"""Operations: refresh calendars and requests, row contracts, usage and worker health."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identity import row_id

# Hours after a content was first seen at which its metadata are read, and quota units by endpoint.
OFFSETS = (6.0, 24.0, 72.0, 168.0, 720.0)
ENDPOINT_UNITS = {"search.list": 100, "videos.list": 1, "channels.list": 1, "commentThreads.list": 1, "comments.list": 1, "captions.list": 50}


def _slot(age_hours: Column, offsets: Sequence[float]) -> Column:
    """How many of the offsets an age has reached."""
    return sum((F.when(age_hours >= o, 1).otherwise(0) for o in offsets), F.lit(0)).cast("int")


def refresh_requests(contents: DataFrame, readings: DataFrame, now: Column, offsets: Sequence[float] = OFFSETS, key: str = "content_id", seen: str = "first_seen_at", read: str = "observed_at") -> DataFrame:
    """A request row for each scheduled reading of each content that is due and was not made.

    A content's calendar are its offsets after it was first seen; a reading serves the last offset before it. So readings become
    (content, offset) by arithmetic and the calendar loses them by one equi-join, whatever the number of readings. Late ones that a later reading has
    overtaken are marked: their moment cannot be read any more.
    """
    if not offsets or min(offsets) <= 0 or list(offsets) != sorted(set(offsets)):
        raise ValueError("offsets must be positive and rise")
    hours = lambda a, b: (F.unix_timestamp(a) - F.unix_timestamp(b)) / 3600.0
    born = contents.groupBy(key).agg(F.min(seen).alias("_born"))
    calendar = born.select(key, "_born", F.posexplode(F.array(*[F.lit(float(o)) for o in offsets])).alias("_slot", "offset_hours"))
    calendar = calendar.withColumns({"_slot": F.col("_slot") + 1, "due_at": F.timestamp_seconds(F.unix_timestamp("_born") + F.col("offset_hours") * 3600)}).where(F.col("due_at") <= now)
    made = readings.where(F.col(read) <= now).join(born, key).select(key, _slot(hours(F.col(read), F.col("_born")), offsets).alias("_slot"))
    made = made.where("_slot > 0").groupBy(key, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    last = made.groupBy(key).agg(F.max("_slot").alias("_last"))
    open_ = calendar.join(made, [key, "_slot"], "left_anti").join(last, key, "left")
    return open_.select(
        row_id(F.lit("metadata.refresh"), F.col(key), F.col("_slot")).alias("request_id"), F.lit("metadata.refresh.requested").alias("event_type"), key, F.col("_slot").cast("long").alias("refresh_count"), "offset_hours", "due_at",
        F.floor((F.unix_timestamp(now) - F.unix_timestamp("due_at")) / 60).cast("long").alias("late_minutes"), F.coalesce(F.col("_slot") < F.col("_last"), F.lit(False)).alias("is_overtaken"), F.lit("pending").alias("collection_status"),
    )


def transcript_requests(candidates: DataFrame, default: str = "en") -> DataFrame:
    """A provider-neutral request a candidate; candidates without a video have none."""
    video, code = F.trim(F.coalesce("root_content_id", F.lit(""))), F.trim(F.coalesce("requested_language_code", F.lit("")))
    code = F.when(code == "", default).otherwise(code)
    rows = candidates.where(video != "")
    return rows.select(
        row_id(F.lit("transcript"), video, code).alias("request_id"), F.lit("youtube.transcript.requested").alias("event_type"), video.alias("video_id"), F.coalesce("content_id", video).alias("correlation_id"), F.col("created_at").alias("published_at"), "language",
        F.coalesce("requested_language", code).alias("transcript_requested_language"), code.alias("transcript_requested_language_code"), F.lit("pending").alias("collection_status"),
    )


# Row contracts


@dataclass(frozen=True)
class Field:
    """A column that rows must have: its type, whether it may be null, its range, its values and its pattern.

    ``when`` is a SQL condition under which the field's checks hold.
    """

    name: str
    kind: str
    nullable: bool = False
    low: float | None = None
    high: float | None = None
    values: tuple[str, ...] = ()
    pattern: str | None = None
    when: str | None = None


_KEYS = (Field("source", "string", values=("youtube", "x", "reddit")), Field("platform_event_id", "string"))
_RATE = dict(nullable=True, low=-1.0)
#: Contracts of predictions, training examples and context rows.
CONTRACTS: dict[str, tuple[Field, ...]] = {
    "prediction": (*_KEYS, Field("prediction_ts", "timestamp"), Field("model_version", "string"), Field("predicted_class", "string"), Field("confidence", "double", low=0.0, high=1.0)),
    "training_example": (
        *_KEYS, Field("text_for_model", "string"), Field("label_value", "string"), Field("label_horizon", "string", values=("1h", "6h", "24h", "72h", "7d")), Field("schema_version", "string", nullable=True),
        Field("split_name", "string", values=("train", "holdout"), when="schema_version = 'v2'"), Field("virality_policy", "string", values=("platform_reference_quantile", "training_reference_quantile"), when="schema_version = 'v2'"),
        Field("virality_contract_fingerprint", "string", pattern="^[a-f0-9]{64}$", when="schema_version = 'v2'"),
    ),
    "context": (*_KEYS, Field("topic", "string"), Field("recent_posts_1h", "bigint", low=0), Field("trend_growth_1h", "double", **_RATE), Field("trend_growth_24h", "double", **_RATE), Field("topic_freshness_hours", "double", nullable=True, low=0.0)),
}


def compiled(contract: Sequence[Field], schema: T.StructType) -> list[tuple[str, str, Column]]:
    """(field, rule, condition that breaks it) for every check of a contract; columns that are missing or of another type break theirs in every row.

    Texts that may not be null may not be empty either, and numbers with a range may not be NaN.
    """
    have, out = {f.name: f.dataType.simpleString() for f in schema}, []
    for f in contract:
        applies = F.coalesce(F.expr(f.when), F.lit(False)) if f.when else F.lit(True)
        if f.name not in have or have[f.name] != f.kind:
            out.append((f.name, "missing" if f.name not in have else f"type:{have[f.name]}", applies))
            continue
        c = F.col(f.name)
        if not f.nullable:
            out.append((f.name, "required", applies & (c.isNull() | (c == "" if f.kind == "string" else F.lit(False)))))
        known = applies & c.isNotNull() & (c != "" if f.kind == "string" else F.lit(True))
        if f.low is not None or f.high is not None:
            odd = F.isnan(c.cast("double"))
            inside = (c >= f.low if f.low is not None else F.lit(True)) & (c <= f.high if f.high is not None else F.lit(True))
            out.append((f.name, "range", known & (odd | ~inside)))
        if f.values:
            out.append((f.name, "values", known & ~c.isin(*f.values)))
        if f.pattern:
            out.append((f.name, "pattern", known & ~c.rlike(f.pattern)))
    return out


def broken(rows: DataFrame, contract: Sequence[Field], keys: list[str]) -> DataFrame:
    """A row for each check that a row breaks: the keys, field, rule and the value as text."""
    checks = [F.when(bad, F.struct(F.lit(name).alias("field"), F.lit(rule).alias("rule"), (F.col(name).cast("string") if name in rows.columns else F.lit(None).cast("string")).alias("value"))) for name, rule, bad in compiled(contract, rows.schema)]
    found = rows.select(*keys, F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("_b"))
    return found.select(*keys, "_b.field", "_b.rule", "_b.value")


# Usage and worker health


def usage_rows(rows: DataFrame) -> DataFrame:
    """Usage rows of this and of earlier forms: absent columns, absent costs by endpoint, counts never below zero, status from errors."""
    have = set(rows.columns)
    opt = lambda name, kind="long": F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)
    count = lambda name: F.greatest(F.lit(0), F.coalesce(opt(name), F.lit(0)))
    endpoint = F.coalesce(F.nullif(opt("operation", "string"), F.lit("")), F.nullif(opt("endpoint", "string"), F.lit("")), F.lit("unknown"))
    units = F.create_map(*[F.lit(x) for pair in ENDPOINT_UNITS.items() for x in pair])
    cost = F.greatest(F.lit(0), F.coalesce(opt("quota_cost_per_request"), F.try_element_at(units, endpoint).cast("long"), F.lit(0)))
    status = F.coalesce(F.nullif(opt("status", "string"), F.lit("")), F.when(count("error_count") > 0, "error").otherwise("success"))
    at = opt("observed_at", "timestamp")
    return rows.select(
        row_id(F.lit("external-api-usage"), opt("usage_id"), F.coalesce(opt("provider", "string"), F.lit("youtube")), endpoint, at).alias("external_usage_id"), F.coalesce(opt("usage_date", "date"), F.to_date(at)).alias("usage_date"),
        F.coalesce(opt("provider", "string"), F.lit("youtube")).alias("provider"), endpoint.alias("operation"), count("request_count").alias("request_count"), count("error_count").alias("error_count"), cost.alias("quota_cost_per_request"),
        F.greatest(F.lit(0), F.coalesce(opt("quota_units"), count("request_count") * cost)).alias("quota_units"), F.coalesce(opt("quota_bucket", "string"), F.lit("legacy")).alias("quota_bucket"), status.alias("status"), at.alias("observed_at"),
    )


def liveness(beats: DataFrame, worker: str, at: str, silence: int) -> DataFrame:
    """A worker's runs of heartbeats with no gap beyond ``silence`` seconds: start, end, beats.

    Gaps and islands in two steps: runs inside a day first, then the days' runs that touch are joined, so that no task sorts all of a worker's beats.
    """
    second = F.unix_timestamp(at)
    rows = beats.where(F.col(at).isNotNull()).select(worker, second.alias("_s"), F.floor(second / 86400).alias("_d"))

    def runs(df: DataFrame, parts: list[str], start: str, end: str, n: Column) -> DataFrame:
        order = Window.partitionBy(*parts).orderBy(start, end)
        gap = F.coalesce(F.col(start) - F.lag(end).over(order) > silence, F.lit(True)).cast("int")
        run = F.sum("_g").over(order.rowsBetween(Window.unboundedPreceding, 0))
        return df.withColumn("_g", gap).withColumn("_r", run).groupBy(*parts, "_r").agg(F.min(start).alias("_a"), F.max(end).alias("_b"), F.sum(n).alias("_n")).drop("_r")

    daily = runs(rows, [worker, "_d"], "_s", "_s", F.lit(1)).drop("_d").withColumnsRenamed({"_a": "_x", "_b": "_y", "_n": "_m"})
    whole = runs(daily, [worker], "_x", "_y", F.col("_m"))
    return whole.select(worker, F.timestamp_seconds("_a").alias("start"), F.timestamp_seconds("_b").alias("end"), F.col("_n").cast("long").alias("beats"))


def worker_health(beats: DataFrame, worker: str, at: str, now: Column, silence: int) -> DataFrame:
    """A row a worker: runs, beats, seconds alive, the longest silence (the present one included) and its state now."""
    runs = liveness(beats.where(F.col(at) <= now), worker, at, silence)
    order = Window.partitionBy(worker).orderBy("start")  # a row a run
    s = F.unix_timestamp
    runs = runs.withColumn("_gap", s(F.coalesce(F.lead("start").over(order), now)) - s("end"))
    out = runs.groupBy(worker).agg(F.count(F.lit(1)).alias("runs"), F.sum("beats").alias("beats"), F.sum(s("end") - s("start")).alias("alive_seconds"), F.max("_gap").alias("longest_silence"), F.max("end").alias("last_seen_at"), (s(now) - s(F.max("end"))).alias("silent_seconds"))
    return out.withColumn("state", F.when(F.col("silent_seconds") <= silence, "alive").when(F.col("silent_seconds") <= 10 * silence, "late").otherwise("dead"))
