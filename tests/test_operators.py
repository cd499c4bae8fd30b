"""Edges of the operators on literal rows: unknown against zero, ties, late news, repeats."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.functions.identity import content_id, overall_status, row_id
from tidemark.operators import annotate, entities, labels, quality, reports, roles, snapshots, tables, upkeep
from tidemark.sources import imports, topics

READ = "source string, platform_event_id string, event_id long, created_at timestamp, observed_at timestamp, view_count long, like_count long, comment_count long, view_count_available boolean, like_count_available boolean, comment_count_available boolean"


def readings(spark, *rows):
    base = "2024-01-01 00:00:00"
    made = [("youtube", p, i, base, f"2024-01-01 {h:02d}:00:00", v, k, c, *(flags or (None, None, None))) for p, i, h, v, k, c, flags in rows]
    return spark.createDataFrame(made, READ.replace("timestamp", "string")).withColumns({c: F.col(c).cast("timestamp") for c in ("created_at", "observed_at")})


def test_deltas_know_unknown_from_zero(spark):
    df = readings(spark, ("a", 1, 1, 100, 10, 0, None), ("a", 2, 2, 160, 10, 0, None), ("a", 3, 3, 150, None, 5, None), ("a", 4, 4, 0, 1, 5, (False, True, True)), ("b", 5, 1, 0, 0, 0, None))
    rows = {r.event_id: r for r in snapshots.with_rates(df).collect()}
    assert rows[1].age_minutes == 60 and rows[1].views_delta is None and rows[1].like_rate == 0.1
    assert (rows[2].views_delta, rows[2].views_per_hour, rows[2].likes_delta) == (60, 60.0, 0)
    assert rows[3].views_delta is None and rows[3].likes_delta is None and rows[3].comments_delta == 5  # a fall and a gap
    assert rows[4].views_delta is None and rows[4].like_rate is None and rows[4].engagement_rate is None  # not observed
    assert rows[5].like_rate is None  # of no views


def test_velocity_and_latest_known(spark):
    df = readings(spark, ("a", 1, 1, 100, 10, 0, None), ("a", 2, 2, 200, 20, 0, None), ("a", 3, 3, 400, 40, 0, None), ("b", 4, 1, 5, 1, 1, None), ("a", 9, 3, None, 41, None, None))
    v = {r.platform_event_id: r for r in snapshots.velocity(df.where("event_id < 9"), 2.0).collect()}
    assert v["a"].virality_score == pytest.approx(math.log1p(200) + 0.1 * 10 + 100 / 1000) and v["a"].is_viral
    assert v["b"].virality_score is None and v["b"].is_viral is None
    k = {r.platform_event_id: r for r in snapshots.latest_known(df, ("view_count", "like_count")).collect()}
    assert (k["a"].latest_view_count, k["a"].latest_like_count, k["a"].latest_id) == (400, 41, 9)


def test_horizon_and_as_of(spark):
    df = readings(spark, ("a", 1, 5, 1, 1, 1, None), ("a", 3, 7, 3, 1, 1, None), ("a", 2, 7, 2, 1, 1, None), ("a", 4, 9, 4, 1, 1, None))
    born = df.groupBy(*snapshots.KEYS).agg(F.min("created_at").alias("event_ts"))
    assert snapshots.at_horizon(born, df, 6, 2).first().event_id == 2
    assert snapshots.at_horizon(born, df, 10, 2).count() == 0
    left = spark.createDataFrame([("k", 5), ("k", 0), ("z", 3)], "key string, at int")
    right = spark.createDataFrame([("k", 1, 10, 7), ("k", 5, 11, 8), ("k", 5, 12, 9), ("k", 6, 13, 1)], "key string, seen int, id int, value int")
    got = {(r.key, r.at): (r.seen_found, r.value) for r in snapshots.as_of(left, right, "key", "at", "seen", ["id", "value"], "id").collect()}
    assert got == {("k", 5): (5, 9), ("k", 0): (None, None), ("z", 3): (None, None)}


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first().y


def test_cleaning(spark):
    raw = "Hi <b>@nguyễn</b>  write a.b@c.org , see https://x.y/z?q=1. or call +1 (555) 123-4567 from 10.0.0.1 !​ <USER>"
    want = "Hi <USER> write <EMAIL>, see <URL>. or call <PHONE> from <IP>! <USER>"
    assert one(spark, raw, t.clean_text) == want and one(spark, want, t.clean_text) == want
    assert one(spark, want, t.for_model) == want.lower().replace("<user>", "<USER>").replace("<email>", "<EMAIL>").replace("<url>", "<URL>").replace("<phone>", "<PHONE>").replace("<ip>", "<IP>")
    assert one(spark, "a@b.c+x@d.e", t.clean_text) == "<EMAIL> <EMAIL>"
    assert one(spark, "", t.invalid_reason) == one(spark, None, t.invalid_reason) == "empty_after_clean" and one(spark, "x" * 10001, t.invalid_reason) == "text_too_long" and one(spark, "x", t.invalid_reason) is None
    assert one(spark, "ﬁ①", t.folded) == "fi1"


def test_counts(spark):
    rows = [("#a #b @x @y http://u.v www.w.x 😀😀 Wow!? a b", None), ("", ""), (None, None)]
    df = spark.createDataFrame(rows, "text_for_model string, clean_text string").select(*[c.alias(k) for k, c in t.text_counts().items()]).collect()
    assert (df[0].hashtag_count, df[0].mention_count, df[0].url_count, df[0].emoji_count, df[0].question_mark_count, df[0].word_count) == (2, 2, 2, 2, 1, 10)
    assert (df[1].word_count, df[1].line_count, df[1].uppercase_ratio, df[1].lexical_diversity) == (0, 0, None, None)
    assert df[2].word_count is None and df[2].hashtag_count is None


def test_reading_effort(spark):
    rows = [("easy", "This EV is fun. It drives well. We love it."), ("hard", "Notwithstanding the regenerative drivetrain, 77.4 kWh lithium architecture, which optimises aerodynamic efficiency because thermal coefficients matter!!! WOW"), ("vi", "Xe điện này rất tốt và tiết kiệm."), ("empty", " "), ("null", None)]
    got = {r.k: r for r in t.with_reading_effort(spark.createDataFrame(rows, "k string, x string"), "x").collect()}
    assert got["easy"].reading_effort < got["hard"].reading_effort and got["hard"].f_info == 1.0
    assert got["vi"].language == "vi" and got["vi"].f_word is None and got["empty"].reading_effort == got["null"].reading_effort == 0.0


@pytest.mark.parametrize(("raw", "want"), [("1.7K", 1700), ("2.3M", 2300000), ("1,234", 1234), ("1B", 10**9), ("", None), ("x", None), (None, None), ("12 k", 12000), ("-5", None)])
def test_count_parser(spark, raw, want):
    assert one(spark, raw, t.parsed_count) == want


def test_other_parsers(spark):
    assert [one(spark, x, t.parsed_duration) for x in ("PT1H2M3S", "PT45S", "P1DT1H", "P", "x", None)] == [3723, 45, 90000, None, None, None]
    assert [one(spark, x, t.parsed_flag) for x in ("Yes", " 0 ", "maybe", None)] == [True, False, None, None]
    assert one(spark, '["a","b"]', t.parsed_list) == ["a", "b"] and one(spark, "a; b,c", t.parsed_list) == ["a", "b", "c"] and one(spark, " ", t.parsed_list) is None
    assert str(one(spark, "1700000000", t.parsed_time)) == str(one(spark, "1700000000000", t.parsed_time)) and one(spark, "never", t.parsed_time) is None
    assert one(spark, "https://youtu.be/abc?t=1", t.video_id) == "abc" and one(spark, "https://y.com/shorts/xyz", t.video_id) == "xyz"
    assert one(spark, '{"x_account" : "joe"}', lambda c: t.redacted_field(c, "x_account")) == '{"x_account" : "<USER>"}'
    assert one(spark, "boom token=abc123 at a@b.co", t.sanitised) == "boom token=<REDACTED> at <EMAIL>"


def test_identities(spark):
    a, b = (spark.createDataFrame([(x,)], "x string").select(row_id(F.col("x"), F.lit("y")).alias("i"), content_id(F.lit("s"), F.col("x")).alias("c")).first() for x in ("k", None))
    assert len(a.i) == 64 and a.i != b.i and a == spark.createDataFrame([("k",)], "x string").select(row_id(F.col("x"), F.lit("y")).alias("i"), content_id(F.lit("s"), F.col("x")).alias("c")).first()
    df = spark.createDataFrame([(["failed", "success"],), (["failed"],), (["success"],), ([],)], "s array<string>")
    assert [r.s for r in df.select(overall_status(F.col("s")).alias("s")).collect()] == ["partial", "failed", "success", None]


def test_segments_and_noise(spark):
    text = "First sentence here. The car is really fast and the charger is also cheap!\nFirst sentence here. no"
    df = spark.createDataFrame([("p", text), ("q", ""), ("r", None)], "k string, x string")
    got = [(r.position, r.segment) for r in annotate.segments(df, "k", "x").orderBy("position").collect()]
    assert got == [(1, "First sentence here."), (2, "The car is really fast."), (3, "the charger is also cheap!")]
    noise = lambda s: one(spark, s, annotate.noise_reason)
    assert [noise(s) for s in ("short", "12:34 intro part", "#one #two #three", "a.b@example.org", "Subscribe :", "see http://a.b/c", "a proper segment here")] == ["too_short", "chapter_timestamp", "hashtag_only", "email_only", "label_only", "url_only", None]


def test_roles(spark):
    rows = [
        (1, "Why does nobody talk about this truth?"), (2, "Subscribe and click the link in bio"), (2, "The range is 500 km at 120 mph"), (2, "I bought it and my experience is long"), (2, "plain words only here with nothing"),
        (2, "but hurry, a better guide"), (2, "credit: the people who made it all"), (2, "too short"), (2, "Every problem is one we build for"),
    ]
    got = [(r.role, r.tier, r.sure, r.confidence) for r in roles.with_role(spark.createDataFrame(rows, "position int, segment string")).collect()]
    assert [g[0] for g in got[:4]] == ["hook", "cta", "proof", "storytelling"] and got[1][1] == "gold" and got[1][3] == 1.0
    assert got[4][:2] == ("uncertain", "uncertain")
    assert got[5] == ("objection_handling", "silver", round((0.68 + 0.65) / 2, 4), 0.6667)  # the third reader takes "better"
    assert got[6] == ("uncertain", "uncertain", round((0.5 + 0.85 + 0.5) / 3, 4), 1.0)  # the second knows a credit line
    assert got[7] == ("uncertain", "uncertain", round((0.75 + 0.7 + 0.7) / 3, 4), 1.0)
    assert got[8][:2] == ("pain_point", "silver")
    # three different roles: the higher priority wins, and the first reader's among equals
    ties = [(2, "i decided our feature is due today"), (2, "over 5 clients, a trusted limited time")]
    got = [(r.role, r.confidence, r.tier) for r in roles.with_role(spark.createDataFrame(ties, "position int, segment string")).collect()]
    assert got[0] == ("urgency", 0.3333, "silver")
    for rules in roles.READERS:
        for _, _, patterns, more in rules:
            for p in [*patterns, *more.get("and", []), *more.get("not", [])]:
                assert roles.literal(p) in p.replace("\\", "")


def test_role_features(spark):
    df = spark.createDataFrame([("a", "Subscribe now. It has 5 km\nplain words only here with nothing • no"), ("b", ""), ("c", None)], "k string, x string")
    got = roles.role_features(df, "k", "x").collect()
    assert [r.k for r in got] == ["a"] and got[0].role_n_segments == 3 and got[0].role_n_cta == 1 and got[0].role_n_proof == 1 and got[0].role_diversity == 3 and abs(got[0].role_ratio_uncertain - 1 / 3) < 1e-6


def test_exact_quantiles(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [(str(k), float(x)) for k in range(3) for x in np.round(rng.normal(0, 50, 101 + k), 1)] + [(None, 3.0), (None, None), ("e", None)]
    got = {r.k: r for r in reports.quantiles(spark.createDataFrame(rows, "k string, v double"), "v", {"a": 0.25, "b": 0.9, "c": 1.0}, ("k",)).collect()}
    assert set(got) == {"0", "1", "2", None} and got[None].a == 3.0
    for k in "012":
        assert np.allclose([got[k].a, got[k].b, got[k].c], np.quantile([v for x, v in rows if x == k], [0.25, 0.9, 1.0]))


def test_folds(spark):
    rows = spark.range(2000).select((F.col("id") % 97).alias("g"), (F.col("id") % 97 % 5 == 0).cast("int").alias("y"))
    dealt = labels.stratified_folds(rows, "g", "y", 5)
    assert dealt.count() == 2000 and labels.straddling(dealt, "fold", "g").count() == 0 and labels.uncovered(dealt, 5, "fold", "y").count() == 0
    sizes = [r["count"] for r in dealt.where("y = 1").groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) <= 2 * min(sizes)
    assert labels.uncovered(dealt.where("fold <> 3"), 5, "fold", "y").first().fold == 3
    assert labels.straddling(spark.createDataFrame([(1, "a"), (2, "a"), (1, "b")], "fold int, g string"), "fold", "g").first().g == "a"


def test_sentiment_by_hand(spark):
    compound = lambda x: x / math.sqrt(x * x + 15)
    cases = {
        "xe rất tốt": 1.8 + 0.293 * 4, "xe không tốt": -1.8 - 0.74, "xe hơi tốt": 1.8 - 0.25 * 4, "tuyệt vời và đẹp": 3.0 + 1.6, "lo lắng quãng đường": -2.2, "tốt không a b xấu": 1.8 + 1.6 + 0.74,
        "Range anxiety is not battery fire": -2.4 + 3.3 + 0.74, "nothing known": 0.0, "": 0.0,
    }
    df = annotate.with_sentiment(spark.createDataFrame([(k,) for k in cases], "x string"), "x")
    got = {r.x: r for r in df.collect()}
    for text, total in cases.items():
        assert got[text].compound == pytest.approx(compound(total), abs=1e-9), text
    assert got["xe rất tốt"].sentiment == "positive" and got["nothing known"].sentiment == "neutral" and got["xe rất tốt"].language == "vi"
    rows = spark.createDataFrame([("what a scam", "en", "positive"), ("i doubt it", "en", "positive"), ("fine", "en", "negative"), ("chuẩn", "vi", "neutral"), ("x", "en", "neutral")], "x string, l string, s string")
    assert [r.y for r in rows.select(annotate.stance(F.col("x"), F.col("l"), F.col("s")).alias("y")).collect()] == ["hostile", "sceptique", "sceptique", "adhère", "neutre"]
    c, flag = annotate.for_role(F.lit(-0.5), F.col("r"))
    assert [tuple(r) for r in spark.createDataFrame([("urgency",), ("pain_point",), ("cta",)], "r string").select(c, flag).collect()] == [(-0.35, "adjusted_for_role:urgency"), (-0.5, "intentional_negative_rhetoric"), (-0.5, None)]


def test_scores_splits_and_thresholds(spark):
    df = spark.createDataFrame([("x", float(v), f"a{v}") for v in (1, 2, 3, 4)] + [("youtube", float(v), f"a{v}") for v in (10, 20, 30, 40)] + [("r", float("nan"), "a9")], "source string, engagement_score double, author string")
    limits = {r.source: r.threshold for r in labels.thresholds(df).collect()}
    assert limits == {"x": 3.25, "youtube": 32.5}
    assert {r.engagement_score for r in labels.labelled(df, labels.thresholds(df)).where("label_value = 'viral'").collect()} == {4.0, 40.0}
    many = spark.range(1000).withColumn("g", (F.col("id") % 101).cast("string"))
    split = labels.group_split(many, F.col("g"), 0.2, 1)
    held = split.where("split_name = 'holdout'").select("g").distinct()
    assert held.count() == 21 and split.count() == 1000 and held.join(split.where("split_name = 'train'"), "g").count() == 0
    n, coverage, score = labels.engagement_score()
    got = readings(spark, ("a", 1, 1, 10, None, 0, None), ("b", 2, 1, None, None, None, None)).select(n.alias("n"), coverage.alias("c"), score.alias("s")).collect()
    assert (got[0].n, got[0].s) == (2, pytest.approx(math.log1p(10) / math.sqrt(2))) and got[1].s is None


def test_trajectory_sees_nothing_late(spark):
    df = readings(spark, ("a", 1, 1, 10, 1, 0, None), ("a", 2, 2, 30, 1, 0, None), ("a", 3, 12, 999, 9, 9, None), ("b", 4, 1, 1, 1, 1, None), ("c", 5, 12, 1, 1, 1, None), ("d", 6, 1, 1, 1, 1, None), ("d", 7, 2, 1, 1, 1, None))
    got = {r.platform_event_id: r for r in labels.early_trajectory(snapshots.with_rates(df), 6, 10, 2).collect()}
    assert {k: r.status for k, r in got.items()} == {"a": "kept", "b": "too_few", "c": "no_window", "d": "no_outcome"}
    assert got["a"].log_view_count == pytest.approx(math.log1p(30)) and got["a"].outcome_view_count == 999 and got["a"].views_per_hour_max == 20.0


def test_merges(spark, tmp_path):
    shape = "user_id string, url string, event_ts string, source string, platform_event_id string, metadata_status string, attempt_count int, note string, updated_at int"
    old = spark.createDataFrame([("u", "l", "t", "x", "1", "success", 3, "old", 5), ("u2", "l", "t", "x", None, "failed", 1, "keep", 5), ("u3", "l", "t", "x", "3", None, None, None, 5)], shape)
    new = spark.createDataFrame([("u", "l", "t", "x", "1", "failed", 2, None, 9), ("u2", "l", "t", "x", None, None, 4, "changed", 1), ("u4", "l", "t", "x", "4", "pending", 0, "n", 1)], shape)
    key = tables.identity()
    got = {r.user_id: r for r in tables.merged(old, new, key).collect()}
    assert len(got) == 4 and (got["u"].metadata_status, got["u"].attempt_count, got["u"].note, got["u"].updated_at) == ("success", 3, "old", 9)
    assert (got["u2"].note, got["u2"].attempt_count, got["u2"].metadata_status) == ("changed", 4, "failed")
    safe = {r.user_id: r for r in tables.merged(old, new, key, order="updated_at").collect()}
    assert safe["u2"].note == "keep" and safe["u2"].attempt_count == 4  # late news fills gaps only
    again = tables.merged(tables.merged(old, new, key), new, key)
    assert sorted(map(str, again.collect())) == sorted(map(str, tables.merged(old, new, key).collect()))
    path = f"{tmp_path}/t"
    tables.upsert(old, path, key)
    tables.upsert(new, path, key)
    kept = {r.user_id: r for r in tables.stored(spark, path).collect()}
    assert len(kept) == 4 and (kept["u"].attempt_count, kept["u2"].note, kept["u3"].platform_event_id) == (3, "changed", "3")
    for _ in range(2):
        tables.append_new(spark.createDataFrame([(1, "a", 7), (1, "a", 7), (2, "b", 8)], "event_id int, v string, part int"), f"{tmp_path}/j", "event_id", "part")
    tables.append_new(spark.createDataFrame([(3, "c", 1, 7), (2, "z", 1, 8)], "event_id int, v string, extra int, part int"), f"{tmp_path}/j", "event_id", "part")
    assert sorted((r.event_id, r.v, r.extra) for r in tables.stored(spark, f"{tmp_path}/j").collect()) == [(1, "a", None), (2, "b", None), (3, "c", 1)]
    assert tables.stored(spark, f"{tmp_path}/none") is None


def test_snapshots(spark, tmp_path):
    path = f"{tmp_path}/s"
    rows = spark.range(40).select("id", (F.col("id") % 4).alias("k"))
    tables.snapshot(rows.repartition(5), path, "1")
    report = {r.when: r for r in tables.compacted(tables.pinned(spark, path), path, "2").collect()}
    assert (report["before"].files, report["after"].files, report["before"].rows, report["after"].rows) == (5, 1, 40, 40)
    tables.rekeyed(tables.pinned(spark, path), F.col("k").cast("string"), ["id"], path, "3")
    assert sorted((r.row_key, r.id) for r in tables.pinned(spark, path).collect()) == [("0", 36), ("1", 37), ("2", 38), ("3", 39)]
    with pytest.raises(ValueError):
        tables.rekeyed(tables.pinned(spark, path, "2"), F.when(F.col("k") > 0, F.col("k")).cast("string"), ["id"], path, "4")
    assert tables.pinned(spark, path, "2").count() == 40 and tables.pinned(spark, path).count() == 4  # the backup is there, what failed is not
    manifest = tables.exported(rows, f"{tmp_path}/e", "id", "csv", F.col("k") == 1).first()
    assert (manifest.rows, manifest.format, manifest.columns) == (10, "csv", "id,k")
    journal = spark.createDataFrame([(1, "2024")], "event_id int, ingested_at string")
    missing, proofs = tables.backfill_journal(spark.createDataFrame([(1, "2023"), (2, "2022")], "n int, seen string"), journal, F.col("n"), "seen")
    assert [(r.event_id, r.ingested_at, r.synthetic) for r in missing.collect()] == [(2, "2022", True)] and [tuple(r) for r in proofs.collect()] == [(2, "2022")]


def test_collapse_keeps_the_last_known(spark):
    df = spark.createDataFrame([("k", 1, "a", None), ("k", 2, None, "x"), ("k", 3, None, None)], "k string, at int, v string, w string")
    assert tables.collapsed(df, ["k"], ["at"]).first().asDict() == {"k": "k", "at": 3, "v": "a", "w": "x"}


def test_transcripts(spark):
    rows = [("some text", None, "failed"), (None, "disabled", "success"), (None, None, "Success"), (None, None, "not_found"), (None, None, "ip_blocked"), (None, None, "odd"), (" ", None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string").select(entities.lifecycle(F.col("a"), F.col("b"), F.col("c")).alias("s"))
    assert [r.s for r in df.collect()] == ["available", "disabled", "available", "unavailable", "blocked", "retryable_error", "retryable_error"]
    spans = spark.createDataFrame([("v", 0, 10), ("v", 5, 12), ("v", 20, 25), ("v", 21, 22), ("v", 9, 3)], "k string, start int, end int")
    assert entities.covered_seconds(spans, "k").first().covered == 17
    tree = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", None)], "id string, parent_id string")
    assert {r.id: (r.root_id, r.depth) for r in entities.comment_tree(tree).collect()} == {"a": ("a", 0), "b": ("a", 1), "c": ("a", 2), "d": ("d", 0)}
    deep = spark.createDataFrame([("0", None)] + [(str(i), str(i - 1)) for i in range(1, 70)] + [("x", "y"), ("y", "x"), ("o", "gone"), ("p", "o")], "id string, parent_id string")
    assert {r.id: (r.root_id, r.depth) for r in entities.comment_tree(deep).collect()} == {str(i): ("0", i) for i in range(70)}  # no depth is too great; rings and orphans have no root


def test_decoding_and_letters(spark):
    good = '{"event_id":1,"user_id":2,"event_type":"view","value":3}'
    rows = [("t", 0, 1, good), ("t", 0, 2, '{"event_id":2,"user_id":2,"secret":"hush'), ("t", 0, 3, '{"event_id":3,"event_type":"view"}'), ("t", 0, 4, None), ("t", 0, 5, "[]")]
    df = topics.tagged(topics.decoded(spark.createDataFrame(rows, "topic string, partition int, offset long, value string").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))))
    reasons = {r.offset: r.reason for r in df.collect()}
    assert reasons[1] is None and reasons[2] == "malformed_json" and reasons[3] == "missing_user_id" and reasons[4] is not None and reasons[5] is not None
    kept, dead = topics.split(df)
    assert kept.count() == 1 and all("hush" not in r.payload for r in dead.where("payload is not null").collect()) and "raw" not in kept.columns


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "id int, v string")
    now = F.lit("2024-01-02").cast("timestamp")
    rules = [{"id": "u", "kind": "unique_key", "table": "t", "columns": ["id"]}, {"id": "c", "kind": "completeness", "table": "t", "columns": ["v"], "threshold": 0.5}, {"id": "e", "kind": "table_empty", "table": "none"}, {"id": "s", "kind": "schema", "table": "t", "columns": ["zz"], "severity": "warning"}]
    got = {r.rule_id: r for r in quality.run_rules(rules, {"t": df, "none": df.limit(0)}, now, "run").collect()}
    assert {k: (r.passed, r.fails_run) for k, r in got.items()} == {"u": (False, True), "c": (True, False), "e": (False, True), "s": (False, False)}
    with pytest.raises(ValueError):
        quality.check({"id": "x", "kind": "odd"}, df, now)
    events = spark.createDataFrame([(1, "x"), (2, "x")], "event_id int, source string").withColumn("ingested_at", now)
    for proofs, bad in (([1, 2], None), ([1], "missing"), ([1, 2, 3], "orphans"), ([1, 2, 2], "proof_duplicates")):
        row = quality.reconciliation(events, spark.createDataFrame([(p,) for p in proofs], "event_id int"), now).first()
        assert row.is_clean == (bad is None) and (bad is None or row[bad] == 1)


def test_metrics(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.3), (0, 0.1)], "y int, p double")
    m = reports.binary_metrics(df, "y", "p", 0.5).first()
    assert (m.tp, m.fp, m.fn, m.tn, m.accuracy, m.f1) == (1, 1, 1, 1, 0.5, 0.5)
    r = reports.ranking_metrics(df, "y", "p").first()
    assert r.roc_auc == pytest.approx((0.5 + 1 + 0 + 1) / 4) and r.average_precision == pytest.approx((0.5 * 1 + 2 / 3) / 2)
    assert reports.ranking_metrics(df.where("y = 1"), "y", "p").first().roc_auc is None
    assert reports.calibration_error(df, "y", "p").first().ece == pytest.approx((2 * 0.4 + 0.7 + 0.1) / 4)
    b = reports.bootstrap(df.withColumn("g", F.col("p").cast("string")), "y", "p", "g", 100).first()
    assert b.low <= m.brier <= b.high
    ranks = reports.average_ranks(spark.createDataFrame([(1.0,), (2.0,), (2.0,), (-5.0,), (None,)], "v double"), ("v",)).collect()
    assert sorted((r.v, r.v_rank) for r in ranks if r.v is not None) == [(-5.0, 0.25), (1.0, 0.5), (2.0, 0.875), (2.0, 0.875)]


def test_imports_and_upkeep(spark):
    df = spark.createDataFrame([("9", "hello @joe", "joe", "2024-01-01T00:00:00Z", "1.2K"), (None, "x", None, "bad", "")], "status_id string, tweet_text string, screen_name string, tweet_time_iso string, likes string").withColumn("page_url", F.lit("https://x.com/a"))
    a, b = imports.canonical(df, "s").collect()
    assert (a.source, a.platform_event_id, a.clean_text, a.like_count, a.rejected) == ("x", "9", "hello <USER>", 1200, None) and b.rejected == "missing: author_hash, event_ts"
    raw = spark.createDataFrame([(1, "mail a@b.co"), (2, "hi"), (3, "ok")], "k int, raw_text string")
    kept = spark.createDataFrame([(1, "mail a@b.co", "x"), (2, "hi", "hi")], "k int, clean_text string, text_for_model string")
    assert {r.k: r.violations for r in upkeep.audited(raw, kept, "k").collect()} == {1: ["clean_text_differs", "sensitive_value_survived"], 3: ["row_absent"]}


def test_sentiment_query_scores_whole_texts(spark, tmp_path):
    from tidemark.plans import texts

    filler = "w " * 60  # what follows stands after character 40
    rows = [(6, filler + "range anxiety", "en", "a", 1), (14, filler, "en", "a", 1)]  # ids whose probe is empty
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {int(r.platform_event_id): (r.hits, r.sentiment) for r in texts.sentiment(spark, str(tmp_path)).collect()}
    assert got[6][0] >= 1 and got[6][1] == "negative" and got[14] == (0, "neutral")
