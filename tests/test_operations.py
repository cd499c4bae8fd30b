"""Calendars, contracts and health on literal rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import operations as o


def at(x):
    return F.col(x).cast("timestamp")


def test_calendar_of_requests(spark):
    contents = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-02 00:00:00"), ("b", "2024-01-03 00:00:00"), ("c", None)], "content_id string, t string").select("content_id", at("t").alias("first_seen_at"))
    readings = spark.createDataFrame([("a", "2024-01-02 01:00:00"), ("a", "2024-01-01 01:00:00"), ("b", "2025-01-01 00:00:00"), ("z", "2024-01-02 00:00:00")], "content_id string, t string").select("content_id", at("t").alias("observed_at"))
    now = F.lit("2024-01-04 00:00:00").cast("timestamp")
    rows = o.refresh_requests(contents, readings, now).collect()
    got = sorted((r.content_id, r.offset_hours, r.late_minutes, r.is_overtaken) for r in rows)
    assert got == [("a", 6.0, 66 * 60, True), ("a", 72.0, 0, False), ("b", 6.0, 18 * 60, False), ("b", 24.0, 0, False)]
    again = o.refresh_requests(contents, readings, now).collect()
    assert sorted(r.request_id for r in rows) == sorted(r.request_id for r in again) and len({r.request_id for r in rows}) == 4
    for bad in ((), (0.0, 6.0), (24.0, 6.0)):
        with pytest.raises(ValueError, match="rise"):
            o.refresh_requests(contents, readings, now, bad)


def test_contract_checks(spark):
    good = ("x", "1", "2024", "m", "viral", 0.5)
    rows = [good, ("", *good[1:]), ("blog", *good[1:]), (None, "", None, "m", "viral", None), (*good[:5], float("nan")), (*good[:5], 1.1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k int, source string, platform_event_id string, t string, model_version string, predicted_class string, confidence double").withColumn("prediction_ts", F.to_timestamp("t", "yyyy"))
    got = sorted((r.k, r.field, r.rule) for r in o.broken(df, o.CONTRACTS["prediction"], ["k"]).collect())
    assert got == [(1, "source", "required"), (2, "source", "values"), (3, "confidence", "required"), (3, "platform_event_id", "required"), (3, "prediction_ts", "required"), (3, "source", "required"), (4, "confidence", "range"), (5, "confidence", "range")]
    other = df.drop("confidence").withColumn("model_version", F.lit(1))
    assert {(r.field, r.rule) for r in o.broken(other.where("k = 0"), o.CONTRACTS["prediction"], ["k"]).collect()} == {("confidence", "missing"), ("model_version", "type:int")}
    assert o.broken(df.limit(0), o.CONTRACTS["prediction"], ["k"]).count() == 0


def test_runs_over_midnight_and_states(spark):
    beats = [("a", "2024-01-01 23:50:00"), ("a", "2024-01-02 00:10:00"), ("a", "2024-01-02 00:10:00"), ("a", "2024-01-02 05:00:00"), ("b", "2024-01-01 00:00:00"), ("c", "2024-01-02 05:55:00"), ("c", "2024-01-02 09:00:00"), ("d", None)]
    df = spark.createDataFrame(beats, "w string, t string").select("w", at("t").alias("t"))
    got = sorted((r.w, str(r.start)[5:16], str(r.end)[5:16], r.beats) for r in o.liveness(df, "w", "t", 1800).collect())
    assert got == [("a", "01-01 23:50", "01-02 00:10", 3), ("a", "01-02 05:00", "01-02 05:00", 1), ("b", "01-01 00:00", "01-01 00:00", 1), ("c", "01-02 05:55", "01-02 05:55", 1), ("c", "01-02 09:00", "01-02 09:00", 1)]
    health = {r.w: (r.runs, r.beats, r.alive_seconds, r.longest_silence, r.state) for r in o.worker_health(df, "w", "t", F.lit("2024-01-02 06:00:00").cast("timestamp"), 1800).collect()}
    assert health == {"a": (2, 4, 1200, 17400, "late"), "b": (1, 1, 0, 108000, "dead"), "c": (1, 1, 0, 300, "alive")}


def test_usage_of_earlier_forms(spark):
    rows = spark.createDataFrame([(1, "search.list", -3, 2), (2, None, 4, None)], "usage_id int, endpoint string, request_count int, error_count int")
    got = sorted((r.operation, r.request_count, r.quota_units, r.status, r.provider) for r in o.usage_rows(rows).collect())
    assert got == [("search.list", 0, 0, "error", "youtube"), ("unknown", 4, 0, "success", "youtube")]
