"""Edges of merged origins, envelopes, shown rows and external score files."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import envelope as env
from tidemark.operators import labels, presentation, sourcing

SHAPE = "source string, platform_event_id string, title string, event_ts timestamp"


def rows(spark, *values, shape=SHAPE):
    return spark.createDataFrame([(*v, None)[: len(shape.split(","))] for v in values], shape)


def test_earlier_origins_win_ids_then_texts(spark):
    current = rows(spark, ("x", "1", "Hello "), ("x", None, "no id"), ("x", None, "other"), ("reddit", "1", "hello"), ("x", "9", None), ("x", "8", None))
    more = rows(spark, ("X", "1", "changed"), ("x", "2", "\thELLO"), ("x", "3", "new"), ("x", "3", "new"), ("x", None, "NO ID"), extra := ("x", "4", ""))
    got = {(r.source, r.platform_event_id, r.title) for r in sourcing.merged_origins(current, more.withColumn("score", F.lit(1)), more.limit(0)).collect()}
    untold = {r for r in got if r[2] is None}
    assert got - untold == {("x", "1", "Hello "), ("x", None, "no id"), ("x", None, "other"), ("reddit", "1", "hello"), ("x", "3", "new"), extra}
    assert len(untold) == 1  # rows without a text are one text
    assert sourcing.merged_origins(current.limit(0)).count() == 0


def test_archive_counts_replies_before_it_caps_and_gives_every_community_a_share(spark):
    shape = "platform_event_id string, parent_id string, title string, event_ts timestamp, url string"
    many = [(f"a{i}", "t1_b1", f"text {i}", None, "https://r.com/r/Big/1") for i in range(50)]
    few = [("b1", "t1_zz", "small one", None, "https://r.com/r/small/2"), ("b1", "t1_zz", "small one", None, "https://r.com/r/small/2"), ("b2", None, "  x ", None, "https://r.com/r/small/2"), ("b3", None, "not listed", None, "https://r.com/r/none/2"), ("b4", None, None, None, "https://r.com/r/small/1"), ("k1", None, "known", None, "https://r.com/r/small/1")]
    current = spark.createDataFrame([("reddit", "k1", "SMALL", 10.0), ("reddit", "k2", "small", 20.0), ("x", "b1", "small", None)], "source string, platform_event_id string, community string, member_count double")
    got = sourcing.archived(spark.createDataFrame(many + few, shape), current, ["big", "SMALL"], 10).collect()
    small = [r for r in got if r.community == "small"]
    assert len(got) == 10 and [r.platform_event_id for r in small] == ["b1"]
    assert small[0].comment_count == 50 and small[0].member_count == 15.0 and small[0].member_count_available
    assert all(r.member_count is None and not r.member_count_available for r in got if r.community == "big")
    assert sourcing.archived(spark.createDataFrame(many + few, shape), current, ["big", "SMALL"], 0).count() == 51
    assert sourcing.archived(spark.createDataFrame([], shape), current, ["big"], 5).count() == 0


def test_ids_are_kept_where_valid_and_a_known_zero_is_observed(spark):
    df = spark.createDataFrame([("x", "7", "t", 0, None, "AB" * 32), ("x", "", "t", None, True, "ab"), (None, None, None, None, None, None)], "source string, platform_event_id string, observed_at string, view_count long, like_count_available boolean, observation_id string")
    a, b, c = env.with_envelope(df, ["view_count"], "p", "r").collect()
    assert a.observation_id == "ab" * 32 and len(b.observation_id) == 64 and b.observation_id != a.observation_id
    seen = json.loads(a.coverage_json)
    assert seen["view_count"] and not seen["like_count"] and list(seen) == sorted(seen) and len(seen) == 13
    assert json.loads(b.coverage_json)["like_count"] and not json.loads(b.coverage_json)["view_count"]
    assert json.loads(c.provenance_json) == {n: None for n in env.PROVENANCE} | {"producer_name": "p", "producer_run_id": "r"}
    again = env.with_envelope(df.withColumn("later", F.lit(None).cast("string")), ["view_count", "later"], "p", "r").collect()
    assert [r.event_id for r in again] == [a.event_id, b.event_id, c.event_id]


def test_summaries_in_words(spark):
    df = spark.createDataFrame([(5, None, '{"likes":true}', '{"producer_name":" api ","collection_method":"api","producer_run_id":"r"}'), (None, True, "broken", None)], "v long, f boolean, c string, p string")
    cover = env.coverage_summary(F.col("c"), {"views": ("views", F.col("v"), F.col("f")), "likes": ("likes", F.lit(1), F.lit(None).cast("boolean"))})
    got = df.select(cover, env.provenance_summary(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("2/2 snapshot metrics observed", "api · r"), ("1/2 snapshot metrics observed; N/A: views", "N/A")]


def test_each_metric_comes_from_its_own_last_reading(spark):
    r = spark.createDataFrame([(1, 1, 10, 5, True, "a"), (1, 2, None, 6, False, "b"), (2, 1, None, None, None, "c")], "id int, event_id int, view_count int, like_count int, like_count_available boolean, j string").withColumn("observed_at", F.col("event_id"))
    last = presentation.last_readings(r, "id", ("view_count", "like_count"), ("j",))
    base = spark.createDataFrame([(1, None), (2, 7), (3, None)], "id int, latest_view_count int")
    got = {x.id: x for x in presentation.display_rows(base, "id", last).collect()}
    assert (got[1].latest_view_count, got[1].latest_like_count, got[1].j) == (10, 5, "b")
    assert (got[2].latest_view_count, got[2].latest_like_count, got[3].latest_view_count) == (7, None, None)


def test_score_files_are_refused_unless_whole(spark, tmp_path):
    ref = {"dataset_version": "v", "dataset_fingerprint": "0" * 64, "source_snapshots": {"a": 1}}
    path = str(tmp_path / "s")
    spark.createDataFrame([("x", "1"), ("x", "3"), ("x", "NaN"), ("x", "Infinity"), ("x", "bad"), ("y", "2")], "source string, engagement_score string").write.option("header", True).csv(path)
    (got,) = labels.reference_contract(spark, path, ref, ("x",), 24, 0.5).collect()
    assert (got.reference_count, got.threshold) == (2, 2.0)
    for bad, platforms in (({}, ("x",)), (ref | {"dataset_fingerprint": "0"}, ("x",)), (ref, ("x", "z"))):
        with pytest.raises(ValueError):
            labels.reference_contract(spark, path, bad, platforms, 24)
    spark.createDataFrame([("x", 1)], "source string, n int").write.parquet(str(tmp_path / "s.parquet"))
    with pytest.raises(ValueError, match="engagement_score"):
        labels.reference_contract(spark, str(tmp_path / "s.parquet"), ref, ("x",), 24)
