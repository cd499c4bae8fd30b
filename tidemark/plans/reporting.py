"""Reporting and labelling queries, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import bindings as b
from tidemark.bindings import with_
from tidemark.functions import text
from tidemark.operators import labels as lab
from tidemark.operators import reports as r
from tidemark.operators import snapshots as s
from tidemark.plans.texts import _CLEAN
from tidemark.scratch import written

_METRICS = ("view_count", "like_count")


def engagement(spark: SparkSession, sf: str) -> DataFrame:
    return r.by_source(b.observations(spark, sf), ("view_count", "like_count"), ("comment_count",), "observed_at", "event_id")


def people(spark: SparkSession, sf: str) -> DataFrame:
    rows = r.identifier_activity(b.activity(spark, sf), "identifier", _METRICS, "event_ts", "text", "is_reply")
    return rows.withColumns({c: F.round(c, 6) for c in ("avg_words", "reply_rate_pct", "avg_view_count", "avg_like_count", "avg_engagement")})


def top_people(spark: SparkSession, sf: str) -> DataFrame:
    rows = r.identifier_activity(b.activity(spark, sf), "identifier", _METRICS, "event_ts", "text", "is_reply")
    return r.top(rows, "total_engagement").select("identifier", "events", "total_engagement")


def progress(spark: SparkSession, sf: str) -> DataFrame:
    return r.progress(b.activity(spark, sf), "identifier", "event_ts", {"events": F.lit(1), "views": F.col("view_count"), "likes": F.col("like_count")})


def counts(spark: SparkSession, sf: str) -> DataFrame:
    """Records by day and source with subtotals."""
    return b.activity(spark, sf).rollup("source", F.to_date("event_ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("long").alias("level"))


def shares(spark: SparkSession, sf: str) -> DataFrame:
    """Quality percentages, identifiers and text length by source; identifiers by role."""
    rows = b.activity(spark, sf)
    pct = lambda c: F.round(F.avg(c.cast("double")) * 100, 6)
    one = rows.groupBy(F.concat(F.lit("source:"), "source").alias("slice")).agg(F.count_distinct("identifier").alias("identifiers"), F.round(F.avg(F.length("text")), 6).alias("avg_text"), pct(F.col("like_count").isNotNull()).alias("likes_pct"), pct(F.col("is_reply")).alias("replies_pct"))
    two = rows.groupBy(F.concat(F.lit("role:"), "role").alias("slice")).agg(F.count_distinct("identifier").alias("identifiers"), F.round(F.avg(F.length("text")), 6).alias("avg_text"), pct(F.col("like_count").isNotNull()).alias("likes_pct"), pct(F.col("is_reply")).alias("replies_pct"))
    return one.unionByName(two)


def communities(spark: SparkSession, sf: str) -> DataFrame:
    """Posts by community with its first post, and the distribution of lengths."""
    p = b.posts(spark, sf)
    found = p.groupBy("community").agg(F.count(F.lit(1)).alias("posts"), F.min_by(F.struct("platform_event_id", "source", "author_hash"), F.struct("event_ts", "platform_event_id")).alias("first"), F.max("event_ts").alias("latest"))
    lengths = r.quantiles(p.select("community", F.length("text").alias("length")), "length", {"median_length": 0.5, "p90_length": 0.9}, ("community",))
    return found.join(lengths, "community").select("community", "posts", F.col("first.platform_event_id").alias("first_post"), F.col("first.source").alias("first_source"), F.col("first.author_hash").alias("first_author"), "latest", "median_length", F.round("p90_length", 6).alias("p90_length"))


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of the latest readings by source, in long form, and the median age."""
    last = s.latest(s.with_rates(b.observations(spark, sf)))
    wide = last.groupBy("source").agg(F.sum("view_count").alias("views"), F.sum("like_count").alias("likes"), F.count(F.lit(1)).alias("posts"))
    ages = r.quantiles(last, "age_minutes", {"median_age": 0.5}, ("source",))
    wide = wide.join(ages, "source").withColumn("median_age", F.col("median_age").cast("long"))
    return wide.unpivot("source", ["views", "likes", "posts", "median_age"], "metric", "value")


def videos(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as videos and orders as comments: aggregates, average-tie ranks, blend and class."""
    o, c = b.table(spark, sf, "orders"), b.table(spark, sf, "customer")
    mood = F.when(F.col("o_orderpriority") == "1-URGENT", -0.5).when(F.col("o_orderpriority") == "5-LOW", 0.4).otherwise(0.0)
    agg = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_comments"), F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("reply_ratio"), F.sum(F.floor("o_totalprice")).cast("long").alias("likes"), F.round(F.avg(mood), 9).alias("mean_sentiment"), F.avg((mood > 0).cast("double")).alias("pos_ratio"), F.avg((mood < 0).cast("double")).alias("neg_ratio")).where("n_comments >= 5")
    rows = agg.join(c.select("c_custkey", F.floor("c_acctbal").cast("long").alias("reach")), "c_custkey").withColumns({"like_rate": F.col("likes") / F.greatest("reach", F.lit(1)), "comment_rate": F.col("n_comments") / F.greatest("reach", F.lit(1))})
    ranked = r.average_ranks(rows, ("reach", "like_rate", "comment_rate", "reply_ratio"))
    blend = ranked.withColumn("score", F.round((F.col("reach_rank") + F.col("like_rate_rank") + F.col("comment_rate_rank") + F.col("reply_ratio_rank")) / 4, 9))
    # reception: the mean mood, in classes of its own
    both = r.classes(r.classes(blend, "score"), "mean_sentiment")
    return both.select("c_custkey", "n_comments", "likes", "reach", "mean_sentiment", F.round("pos_ratio", 9).alias("pos_ratio"), F.round("neg_ratio", 9).alias("neg_ratio"), "mean_sentiment_class", F.round("comment_rate_rank", 9).alias("comment_rate_rank"), F.round("reach_rank", 9).alias("reach_rank"), F.round("like_rate_rank", 9).alias("like_rate_rank"), F.round("reply_ratio_rank", 9).alias("reply_ratio_rank"), "score", "score_class")


def legacy_score(spark: SparkSession, sf: str) -> DataFrame:
    rows = r.zscored(s.latest(b.observations(spark, sf)), ("view_count", "like_count", "comment_count"))
    return rows.select("source", "platform_event_id", F.round("engagement_score", 6).alias("engagement_score"), "viral")


def repeats(spark: SparkSession, sf: str) -> DataFrame:
    rows = r.repetitions(b.table(spark, sf, "lineitem"), "l_linenumber", "l_quantity")
    return rows.withColumns({c: F.round(c, 6) for c in ("mean", "stddev", "ratio_to_previous")})


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    d, l = b.table(spark, sf, "documents"), b.table(spark, sf, "labels")
    return l.join(d, "doc_id").select("doc_id", "source", F.col("quality").alias("label"), (F.pmod(F.length("text") * 7 + F.col("doc_id") % 3 * 100, F.lit(1000)) / 1000.0).alias("score"))


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = _scored(spark, sf)
    a = r.binary_metrics(rows, "label", "score", 0.4, "source")
    out = a.join(r.calibration_error(rows, "label", "score", 10, "source"), "source").join(r.ranking_metrics(rows, "label", "score", "source"), "source")
    return out.withColumns({c: F.round(c, 6) for c in ("brier", "accuracy", "precision", "recall", "f1", "ece", "roc_auc", "average_precision")})


def bins(spark: SparkSession, sf: str) -> DataFrame:
    rows = r.reliability(_scored(spark, sf), "label", "score")
    return rows.withColumns({c: F.round(c, 6) for c in ("confidence", "accuracy")})


def interval(spark: SparkSession, sf: str) -> DataFrame:
    """By author; a second score beside the first, and their paired difference."""
    rows = _scored(spark, sf).withColumns({"author": F.col("doc_id") % 97, "shrunk": F.col("score") / 2 + 0.25})
    return r.bootstrap(rows, "label", ("score", "shrunk"), "author", 200).withColumns({c: F.round(c, 6) for c in ("low", "high")})


def examples(spark: SparkSession, sf: str) -> DataFrame:
    """Readings at the horizon scored, authors split, thresholds from train, labels."""
    return _examples(spark, sf).select("source", "platform_event_id", "split_name", F.round("engagement_score", 6).alias("engagement_score"), F.round("engagement_coverage", 6).alias("engagement_coverage"), F.round("threshold", 6).alias("threshold"), "label_value", "example_id")


def _examples(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.functions.identity import row_id

    readings = b.observations(spark, sf)
    born = readings.groupBy(*s.KEYS).agg(F.min("created_at").alias("event_ts"))
    n, coverage, score = lab.engagement_score()
    rows = s.at_horizon(born, readings, 24, 48).withColumns({"observed_metrics": n, "engagement_coverage": coverage, "engagement_score": score}).where("observed_metrics > 0")
    rows = rows.withColumns({"author": F.col("platform_event_id").cast("long") % 40, "example_id": row_id(F.col("source"), F.col("platform_event_id"), F.col("event_id"), F.lit("24h"))})
    split = lab.group_split(rows, F.col("author").cast("string"), 0.2, 42)
    limits = lab.thresholds(split.where("split_name = 'train'"))
    return lab.labelled(split, limits)


def training_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The dataset as one job: posts' first feature rows, those eligible, labelled readings, stored, its hold-out found again, and its manifest."""
    p = b.posts(spark, sf)
    again = p.where(F.col("platform_event_id").cast("long") % 4 == 0).withColumn("event_ts", F.col("event_ts") + F.expr("INTERVAL 1 DAY"))  # posts that were read twice
    ready = p.unionByName(again).withColumn("text_for_model", text.for_model(text.clean_text(F.col("text")))).drop("text")
    feats = lab.eligible(lab.one_feature_row(ready), b.SOURCES)
    rows = _examples(spark, sf).join(feats.drop("event_ts"), list(s.KEYS))
    stored = written(rows.select("example_id", *s.KEYS, "event_ts", "label_value", "split_name", "author_hash", F.col("like_count").alias("likes"), "text_for_model"), "dataset")
    manifest = lab.dataset_manifest(stored, "v1", {"events": 1, "documents": 1}, {"horizon": "24h", "least": "20"}, ("author_hash", "likes", "text_for_model"))
    held = lab.persisted_holdout(stored, stored.where("split_name = 'holdout'").select("example_id"), "example_id")
    return manifest.crossJoin(held.agg(F.count(F.lit(1)).alias("holdout")))  # one row each


def label_report(spark: SparkSession, sf: str) -> DataFrame:
    """Labels by split and source, with the period and the share of missing likes."""
    rows = _examples(spark, sf)
    return rows.groupBy("split_name", "source", "label_value").agg(F.count(F.lit(1)).alias("n"), F.min("observed_at").alias("first"), F.max("observed_at").alias("last"), F.round(F.avg(F.col("like_count").isNull().cast("double")), 6).alias("missing_likes"))


def balanced(spark: SparkSession, sf: str) -> DataFrame:
    """B11, W7."""
    rows = lab.balanced(b.posts(spark, sf), ["source", "lang"], F.col("platform_event_id"))
    return rows.select("source", "lang", "platform_event_id", F.col("balance_rank").cast("long").alias("balance_rank"), "balance_group")


def nested(spark: SparkSession, sf: str) -> DataFrame:
    return lab.nested_balanced(b.posts(spark, sf), "lang", "source", F.col("platform_event_id")).select("lang", "source", "platform_event_id")


def quota(spark: SparkSession, sf: str) -> DataFrame:
    return lab.capped(b.posts(spark, sf), "community", F.col("platform_event_id"), 5, 150).select("community", "platform_event_id")


def diverse(spark: SparkSession, sf: str) -> DataFrame:
    return lab.one_per_author(b.posts(spark, sf), "author_hash", F.col("platform_event_id"), 60).select("author_hash", "platform_event_id")


def folds(spark: SparkSession, sf: str) -> DataFrame:
    rows = _scored(spark, sf).withColumn("group", F.col("doc_id") % 50).withColumn("fold", lab.fold_of(F.col("group").cast("string"), 5, 7))
    return lab.fold_check(rows, "fold", "group", "label")


def stratified(spark: SparkSession, sf: str) -> DataFrame:
    """Stratified folds by group, with the folds that lack a label and the groups that straddle folds (none, if all is sound)."""
    rows = _scored(spark, sf).withColumn("group", F.col("doc_id") % 50)
    dealt = written(lab.stratified_folds(rows, "group", "label", 5), "folds")
    lacking, torn = lab.uncovered(dealt, 5, "fold", "label"), lab.straddling(dealt, "fold", "group")
    found = lab.fold_check(dealt, "fold", "group", "label")
    return found.crossJoin(lacking.agg(F.count(F.lit(1)).alias("uncovered_folds"))).crossJoin(torn.agg(F.count(F.lit(1)).alias("torn_groups")))  # one row each


def people_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Authors, owners and collaborators as one list of identifiers, counted by role."""
    e = b.table(spark, sf, "events").select(F.when(F.col("event_id") % 4 != 0, F.col("user_id")).alias("author"), F.when(F.col("event_type") == "view", F.col("user_id") % 20).alias("owner"), F.when(F.col("event_id") % 10 == 0, F.array(F.lit("a"), F.col("event_type"))).otherwise(F.array().cast("array<string>")).alias("collaborators"))
    return r.fan_out(e, "author", "owner", "collaborators").groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("identifier").alias("identifiers"))


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    e = b.table(spark, sf, "events").select(F.when(F.col("event_type") == "view", F.col("user_id")).alias("owner"), F.when(F.col("event_id") % 10 == 0, F.array(F.lit("a"), F.col("event_type"))).otherwise(F.array().cast("array<string>")).alias("collaborators"))
    return r.collaborator_coverage(e, "owner", "collaborators")


def row_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Completeness, staleness, audience and calibration by row."""
    rows = s.latest(b.observations(spark, sf))
    known, lacking = r.completeness_of_row({"views": F.col("view_count"), "likes": F.col("like_count"), "comments": F.col("comment_count")})
    aud = r.audience("view_count", "view_count_available")
    p = F.coalesce(F.col("like_count"), F.lit(0)) / (F.coalesce(F.col("view_count"), F.lit(0)) + 20)
    return rows.select(*s.KEYS, known.alias("known"), lacking.alias("lacking"), r.staleness(F.col("observed_at"), F.lit("2024-01-31").cast("timestamp"), 24).alias("state"), F.round(aud["audience_log"], 6).alias("audience_log"), aud["audience_known"].alias("audience_known"), aud["audience_zero"].alias("audience_zero"), F.round(r.logit(p), 6).alias("logit"), F.round(r.platt(r.logit(p), 1.5, 0.1), 6).alias("calibrated"))


def prepublication(spark: SparkSession, sf: str) -> DataFrame:
    """What is known of a post before it is out, with how often its community posts."""
    p = b.posts(spark, sf)
    freq = p.groupBy("community").agg(F.count(F.lit(1)).alias("community_posts"))
    low = F.lower("text")
    return p.join(freq, "community").select("platform_event_id", F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).cast("long").alias("words"), F.contains("text", F.lit("?")).cast("int").alias("has_question"), low.rlike(r"price|cost|\$|cheap|expensive").cast("int").alias("kw_price"), low.rlike("charg|battery|kwh").cast("int").alias("kw_charging"), F.hour("event_ts").alias("pub_hour"), F.weekday("event_ts").alias("pub_dow"), F.month("event_ts").alias("pub_month"), "community_posts")


def lookups(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes filled from the group's median, the latest known value by key, reply counts by parent."""
    c, o = b.table(spark, sf, "customer"), b.table(spark, sf, "orders")
    size = F.when(F.col("c_custkey") % 3 != 0, F.floor("c_acctbal").cast("long"))
    rows = c.select("c_custkey", "c_nationkey", size.alias("own_size"))
    medians = r.quantiles(rows, "own_size", {"median_size": 0.5}, ("c_nationkey",))
    last = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")), F.when(F.col("o_orderstatus") == "F", F.struct("o_orderdate", "o_orderkey"))).alias("last_order"), F.count(F.lit(1)).alias("orders"))
    joined = rows.join(medians, "c_nationkey").join(last, "c_custkey", "left")
    return joined.select("c_custkey", F.coalesce(F.col("own_size").cast("double"), "median_size").alias("size"), "last_order", F.coalesce("orders", F.lit(0)).alias("orders"))


def keep_and_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Texts once by language and source, and all other rows."""
    p = b.posts(spark, sf).select("platform_event_id", "source", "lang", F.lower("text").alias("t"), F.length("text").alias("n"))
    short, long = p.where("n < 600"), p.where("n >= 600")
    once = short.groupBy("source", "lang", "t").agg(F.min_by("platform_event_id", F.struct(F.length("platform_event_id"), "platform_event_id")).alias("platform_event_id"))
    return once.select("platform_event_id", F.lit("once").alias("kind")).unionByName(long.select("platform_event_id", F.lit("kept").alias("kind")))


def activity_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Events by type and hour, and those of the 24 hours before."""
    from pyspark.sql import Window

    e = b.table(spark, sf, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    e = e.withColumn("_h", F.unix_timestamp(F.col("hour").cast("timestamp")))
    day = Window.partitionBy("event_type").orderBy("_h").rangeBetween(-23 * 3600, 0)
    return e.select("event_type", "hour", "n", F.sum("n").over(day).alias("n_24h"))


def context(spark: SparkSession, sf: str) -> DataFrame:
    """An event's topic at its time: events of the hour before, growth by hour and by day, and how long the topic is known."""
    e = b.table(spark, sf, "events").select("event_id", F.col("event_type").alias("topic"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"))
    return r.topic_context(e, "event_id", "topic", "at").withColumns({c: F.round(c, 6) for c in ("trend_growth_1h", "trend_growth_24h", "topic_freshness_hours")})


def overview(spark: SparkSession, sf: str) -> DataFrame:
    """Every community's posts, by the labels where they have some."""
    posts = b.posts(spark, sf).withColumn("doc_id", F.col("platform_event_id").cast("long"))
    rows = posts.join(b.table(spark, sf, "labels").groupBy("doc_id").agg((F.max("toxic") == 1).alias("viral")), "doc_id", "left")
    return r.dataset_overview(rows, "community", "lang", "text", F.col("viral")).withColumns({c: F.round(c, 6) for c in ("viral_rate", "mean_length")})


QUERIES = {
    "b24_context": context, "a29_overview": overview,
    "a9_engagement_by_source": engagement, "a12_identifier_activity": people, "t1_top_identifiers": top_people, "w12_progress": progress, "a11_rollup_counts": counts, "a10_a13_a14_shares": shares, "a15_a25_communities": communities, "a16_snapshot_totals": snapshots, "a24_w13_w14_b23_videos": videos,
    "a21_zscore_label": legacy_score, "a35_repetitions": repeats, "a30_a32_metrics": metrics, "a31_reliability": bins, "a33_bootstrap": interval, "b12_a22_a23_f24_t8_examples": examples, "a8_a17_a29_label_report": label_report, "b12_training_dataset": training_dataset, "b11_w7_balanced": balanced, "t5_nested_balanced": nested, "t6_capped": quota,
    "t7_one_per_author": diverse, "t9_t10_folds": folds, "t9_t10_stratified_folds": stratified, "u4_fan_out": people_roles, "a18_collaborators": coverage, "f44_f47_row_quality": row_quality, "b25_prepublication": prepublication, "j10_j14_j21_lookups": lookups, "u2_u3_u6_union_dedupe": keep_and_dedupe, "e1_activity_windows": activity_windows,
}

_SHARES = "count(DISTINCT identifier) AS identifiers, round(avg(length(text)), 6) AS avg_text, round(avg((like_count IS NOT NULL)::INT) * 100, 6) AS likes_pct, round(avg(is_reply::INT) * 100, 6) AS replies_pct"
_PEOPLE = """, a AS (SELECT identifier, count(*) AS events, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources, string_agg(DISTINCT role, ', ' ORDER BY role) AS roles, min(event_ts) AS first_activity, max(event_ts) AS last_activity, count(DISTINCT event_ts::DATE) AS active_days, avg(len(regexp_split_to_array(trim(text), '\\s+'))) AS avg_words,
  count(*) FILTER (is_reply) * 100.0 / nullif(count(is_reply), 0) AS reply_rate_pct, sum(view_count)::BIGINT AS total_view_count, sum(like_count)::BIGINT AS total_like_count, avg(view_count) AS avg_view_count, avg(like_count) AS avg_like_count FROM activity GROUP BY identifier),
p AS (SELECT *, coalesce(total_view_count, 0) + coalesce(total_like_count, 0) AS total_engagement FROM a)"""
_SCORED = "sc AS (SELECT doc_id, source, quality AS label, (length(text) * 7 + doc_id % 3 * 100) % 1000 / 1000.0::DOUBLE AS score FROM labels JOIN documents USING (doc_id))"
_LAST = ", last AS (SELECT * FROM observations QUALIFY row_number() OVER (PARTITION BY source, platform_event_id ORDER BY observed_at DESC, event_id DESC) = 1)"
_RANK = lambda c: f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2) / count(*) OVER ()"
_EXAMPLES = """, h AS (SELECT * FROM observations WHERE observed_at >= created_at + INTERVAL 24 HOUR AND observed_at <= created_at + INTERVAL 72 HOUR QUALIFY row_number() OVER (PARTITION BY source, platform_event_id ORDER BY observed_at, event_id) = 1),
x AS (SELECT *, (view_count IS NOT NULL)::INT + (like_count IS NOT NULL)::INT + (comment_count IS NOT NULL)::INT AS n, coalesce(ln(1 + view_count), 0) + coalesce(ln(1 + like_count), 0) + coalesce(ln(1 + comment_count), 0) AS total, sha256('42:' || platform_event_id::BIGINT % 40) AS gh FROM h),
y AS (SELECT *, total / sqrt(n) AS score FROM x WHERE n > 0), g AS (SELECT gh, row_number() OVER (ORDER BY gh) AS k, count(*) OVER () AS m FROM (SELECT DISTINCT gh FROM y)), z AS (SELECT y.*, CASE WHEN k <= ceil(m * 0.2) THEN 'holdout' ELSE 'train' END AS split_name FROM y JOIN g USING (gh)),
t AS (SELECT source, quantile_cont(score, 0.75) AS threshold FROM z WHERE split_name = 'train' GROUP BY source), ex AS (SELECT z.*, threshold, CASE WHEN score >= threshold THEN 'viral' ELSE 'not_viral' END AS label_value FROM z JOIN t USING (source))"""
SQL = {
    "a29_overview": with_("posts", """, l AS (SELECT doc_id, max(toxic) = 1 AS viral FROM labels GROUP BY 1), p AS (SELECT community, coalesce(lang, 'unknown') AS lang, text, viral FROM posts LEFT JOIN l ON l.doc_id = platform_event_id::BIGINT),
t AS (SELECT community, count(*) AS n, round(avg(viral::INT), 6) AS viral_rate, round(avg(length(text)), 6) AS mean_length FROM p GROUP BY 1), m AS (SELECT community, lang, count(*) AS k FROM p GROUP BY 1, 2)
SELECT t.community AS community, n, viral_rate, mean_length, (SELECT string_agg(lang || ':' || printf('%.1f', 100.0 * k / n), ', ' ORDER BY k DESC, lang) FROM m WHERE m.community IS NOT DISTINCT FROM t.community) AS language_mix FROM t"""),
    "b24_context": """WITH e AS (SELECT event_id, event_type AS topic, floor(epoch(ts))::BIGINT AS sec FROM events), n AS (SELECT *, count(*) OVER (PARTITION BY topic ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING) AS recent, (sec - min(sec) OVER (PARTITION BY topic)) / 3600 AS fresh FROM e),
h AS (SELECT topic, sec // 3600 AS h, count(*) AS n FROM e GROUP BY ALL), d AS (SELECT topic, sec // 86400 AS d, count(*) AS n FROM e GROUP BY ALL)
SELECT event_id, n.topic AS topic, recent AS recent_posts_1h, round((h1.n - h0.n) / h0.n, 6) AS trend_growth_1h, round((d1.n - d0.n) / d0.n, 6) AS trend_growth_24h, round(fresh, 6) AS topic_freshness_hours FROM n
  JOIN h h1 ON h1.topic = n.topic AND h1.h = sec // 3600 LEFT JOIN h h0 ON h0.topic = n.topic AND h0.h = sec // 3600 - 1 JOIN d d1 ON d1.topic = n.topic AND d1.d = sec // 86400 LEFT JOIN d d0 ON d0.topic = n.topic AND d0.d = sec // 86400 - 1""",
    "a33_bootstrap": f"""WITH {_SCORED}, g AS (SELECT doc_id % 97 AS author, sum((score - label) ** 2) AS e0, sum((score / 2 + 0.25 - label) ** 2) AS e1, count(*) AS n FROM sc GROUP BY 1),
u AS (SELECT *, (('0x' || substr(sha256('42:' || round || ':' || author), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM g, range(1, 201) x(round)), w AS (SELECT *, {" + ".join(f"(u >= {x!r})::INT" for x in r.POISSON)} AS w FROM u),
v AS (SELECT round, sum(e0 * w) / sum(n * w) AS a, sum(e1 * w) / sum(n * w) AS b FROM w GROUP BY round), l AS (SELECT 'score' AS metric, a AS value FROM v UNION ALL SELECT 'shrunk', b FROM v UNION ALL SELECT 'shrunk - score', b - a FROM v)
SELECT metric, count(value) AS rounds, round(quantile_cont(value, 0.025), 6) AS low, round(quantile_cont(value, 0.975), 6) AS high FROM l GROUP BY metric""",
    "b12_training_dataset": with_("observations posts", _EXAMPLES + _CLEAN + """, m AS (SELECT z.*, r.author_hash, r.m AS txt FROM ex z JOIN ready r ON r.source = z.source AND r.platform_event_id = z.platform_event_id WHERE length(trim(r.m)) >= 20),
i AS (SELECT *, sha256(source || chr(31) || platform_event_id || chr(31) || event_id || chr(31) || '24h') AS example_id FROM m), c AS (SELECT source || ':' || label_value || ':' || count(*) AS cell FROM i GROUP BY source, label_value)
SELECT count(*) AS example_count, min(created_at) AS period_start, max(created_at) AS period_end, sum(('0x' || substr(example_id, 1, 15))::HUGEINT)::VARCHAR AS fingerprint, 0.0::DOUBLE AS missing_author_hash, round(avg((like_count IS NULL)::INT), 6) AS missing_likes, 0.0::DOUBLE AS missing_text_for_model, (SELECT string_agg(cell, ',' ORDER BY cell) FROM c) AS distribution,
  'dataset-v1-' || substr(sha256('{"filters":{"horizon":"24h","least":"20"},"schema_version":"v1","source_snapshots":{"documents":1,"events":1}}'), 1, 20) AS dataset_version, count(*) FILTER (split_name = 'holdout') AS holdout FROM i"""),
    "a9_engagement_by_source": with_("observations", "SELECT source, count(*) AS events, sum(view_count)::BIGINT AS view_count, sum(like_count)::BIGINT AS like_count, arg_max(comment_count, (observed_at, event_id)) FILTER (comment_count IS NOT NULL) AS latest_comment_count, count(view_count) AS view_count_rows, count(like_count) AS like_count_rows, max(observed_at) AS latest FROM observations GROUP BY source"),
    "a12_identifier_activity": with_("activity", _PEOPLE + " SELECT * REPLACE (round(avg_words, 6) AS avg_words, round(reply_rate_pct, 6) AS reply_rate_pct, round(avg_view_count, 6) AS avg_view_count, round(avg_like_count, 6) AS avg_like_count), round(total_engagement / events, 6) AS avg_engagement FROM p"),
    "t1_top_identifiers": with_("activity", _PEOPLE + " SELECT identifier, events, total_engagement FROM p ORDER BY total_engagement DESC NULLS LAST, events DESC, identifier LIMIT 25"),
    "w12_progress": with_("activity", """, d AS (SELECT identifier, event_ts::DATE AS date, count(*) AS e, coalesce(sum(view_count), 0) AS v, coalesce(sum(like_count), 0) AS l FROM activity GROUP BY ALL), c AS (SELECT identifier, date, sum(e) OVER w AS e, sum(v) OVER w AS v, sum(l) OVER w AS l FROM d WINDOW w AS (PARTITION BY identifier ORDER BY date ROWS UNBOUNDED PRECEDING))
SELECT identifier, date, 'events' AS metric, e::BIGINT AS value FROM c UNION ALL SELECT identifier, date, 'views', v::BIGINT FROM c UNION ALL SELECT identifier, date, 'likes', l::BIGINT FROM c"""),
    "a11_rollup_counts": with_("activity", "SELECT source, event_ts::DATE AS day, count(*) AS n, grouping_id(source, event_ts::DATE)::BIGINT AS level FROM activity GROUP BY ROLLUP (source, event_ts::DATE)"),
    "a10_a13_a14_shares": with_("activity", f"SELECT 'source:' || source AS slice, {_SHARES} FROM activity GROUP BY source UNION ALL SELECT 'role:' || role, {_SHARES} FROM activity GROUP BY role"),
    "a15_a25_communities": with_("posts", "SELECT community, count(*) AS posts, arg_min(platform_event_id, (event_ts, platform_event_id)) AS first_post, arg_min(source, (event_ts, platform_event_id)) AS first_source, arg_min(author_hash, (event_ts, platform_event_id)) AS first_author, max(event_ts) AS latest, median(length(text))::DOUBLE AS median_length, round(quantile_cont(length(text), 0.9)::DOUBLE, 6) AS p90_length FROM posts GROUP BY community"),
    "a16_snapshot_totals": with_("observations", _LAST + ", w AS (SELECT source, sum(view_count)::BIGINT AS views, sum(like_count)::BIGINT AS likes, count(*) AS posts, floor(median(trunc((floor(epoch(observed_at)) - floor(epoch(created_at))) / 60)))::BIGINT AS median_age FROM last GROUP BY source) UNPIVOT w ON views, likes, posts, median_age INTO NAME metric VALUE value"),
    "a24_w13_w14_b23_videos": f"""WITH a AS (SELECT o_custkey AS c_custkey, count(*) AS n_comments, avg((o_orderstatus = 'F')::INT) AS reply_ratio, sum(floor(o_totalprice))::BIGINT AS likes, round(avg(CASE o_orderpriority WHEN '1-URGENT' THEN -0.5 WHEN '5-LOW' THEN 0.4 ELSE 0.0 END), 9) AS mean_sentiment, avg((o_orderpriority = '5-LOW')::INT) AS pos_ratio, avg((o_orderpriority = '1-URGENT')::INT) AS neg_ratio FROM orders GROUP BY 1 HAVING count(*) >= 5), r AS (SELECT a.*, floor(c_acctbal)::BIGINT AS reach, likes / greatest(floor(c_acctbal), 1) AS like_rate, n_comments / greatest(floor(c_acctbal), 1) AS comment_rate FROM a JOIN customer USING (c_custkey)),
k AS (SELECT *, {_RANK('reach')} AS reach_rank, {_RANK('like_rate')} AS like_rate_rank, {_RANK('comment_rate')} AS comment_rate_rank, {_RANK('reply_ratio')} AS reply_ratio_rank FROM r), s AS (SELECT *, round((reach_rank + like_rate_rank + comment_rate_rank + reply_ratio_rank) / 4, 9) AS score FROM k), q AS (SELECT quantile_cont(score, 1.0 / 3) AS a, quantile_cont(score, 2.0 / 3) AS b, quantile_cont(mean_sentiment, 1.0 / 3) AS ma, quantile_cont(mean_sentiment, 2.0 / 3) AS mb FROM s)
SELECT c_custkey, n_comments, likes, reach, mean_sentiment, round(pos_ratio, 9) AS pos_ratio, round(neg_ratio, 9) AS neg_ratio, CASE WHEN mean_sentiment > q.mb THEN 'high' WHEN mean_sentiment > q.ma THEN 'medium' ELSE 'low' END AS mean_sentiment_class, round(comment_rate_rank, 9) AS comment_rate_rank, round(reach_rank, 9) AS reach_rank, round(like_rate_rank, 9) AS like_rate_rank, round(reply_ratio_rank, 9) AS reply_ratio_rank, score, CASE WHEN score > q.b THEN 'high' WHEN score > q.a THEN 'medium' ELSE 'low' END AS score_class FROM s, q""",
    "a21_zscore_label": with_("observations", _LAST + """, l AS (SELECT *, ln(1 + view_count) AS v, ln(1 + like_count) AS k, ln(1 + comment_count) AS c FROM last), st AS (SELECT source, avg(v) AS mv, avg(k) AS mk, avg(c) AS mc, stddev_pop(v) AS sv, stddev_pop(k) AS sk, stddev_pop(c) AS sc FROM l GROUP BY source),
z AS (SELECT source, platform_event_id, CASE WHEN view_count IS NOT NULL THEN (coalesce((v - mv) / coalesce(nullif(sv, 0), 1), 0) + coalesce((k - mk) / coalesce(nullif(sk, 0), 1), 0) + coalesce((c - mc) / coalesce(nullif(sc, 0), 1), 0)) / sqrt(3) END AS score FROM l JOIN st USING (source)), q AS (SELECT source, quantile_cont(score, 0.75) AS cut FROM z GROUP BY source)
SELECT z.source, platform_event_id, round(score, 6) AS engagement_score, (score >= cut)::INTEGER AS viral FROM z JOIN q USING (source)"""),
    "a35_repetitions": "WITH a AS (SELECT l_linenumber, count(l_quantity) AS runs, median(l_quantity) AS median, min(l_quantity) AS least, max(l_quantity) AS most, avg(l_quantity) AS mean, stddev_pop(l_quantity) AS stddev FROM lineitem GROUP BY 1) SELECT * REPLACE (round(mean, 6) AS mean, round(stddev, 6) AS stddev), round(median / lag(median) OVER (ORDER BY l_linenumber), 6) AS ratio_to_previous FROM a",
    "a30_a32_metrics": f"""WITH {_SCORED}, c AS (SELECT source, count(*) AS n, count(*) FILTER (label = 1 AND score >= 0.4) AS tp, count(*) FILTER (label = 0 AND score >= 0.4) AS fp, count(*) FILTER (label = 1 AND score < 0.4) AS fn, count(*) FILTER (label = 0 AND score < 0.4) AS tn, avg((score - label) ** 2) AS brier FROM sc GROUP BY source),
e AS (SELECT source, sum(n * abs(a - s)) / sum(n) AS ece FROM (SELECT source, least(floor(score * 10), 9) AS bin, count(*) AS n, avg(label) AS a, avg(score) AS s FROM sc GROUP BY ALL) GROUP BY source),
pairs AS (SELECT p.source, avg(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0.0 END) AS roc_auc FROM sc p JOIN sc q ON p.source = q.source AND p.label = 1 AND q.label = 0 GROUP BY p.source),
cum AS (SELECT source, score, sum(sum(label)) OVER w AS tp, sum(count(*)) OVER w AS k, sum(label) AS p FROM sc GROUP BY source, score WINDOW w AS (PARTITION BY source ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), ap AS (SELECT source, sum(p * tp / k) / sum(p) AS average_precision FROM cum GROUP BY source)
SELECT c.source, n, tp, fp, fn, tn, round(brier, 6) AS brier, round((tp + tn) / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(ece, 6) AS ece, round(roc_auc, 6) AS roc_auc,
  round(CASE WHEN roc_auc IS NOT NULL THEN average_precision END, 6) AS average_precision FROM c JOIN e USING (source) LEFT JOIN pairs USING (source) LEFT JOIN ap USING (source)""",
    "a31_reliability": f"WITH {_SCORED} SELECT least(floor(score * 10), 9)::INTEGER AS bin, count(*) AS n, round(avg(score), 6) AS confidence, round(avg(label), 6) AS accuracy FROM sc GROUP BY 1",
    "b12_a22_a23_f24_t8_examples": with_("observations", _EXAMPLES + " SELECT source, platform_event_id, split_name, round(score, 6) AS engagement_score, round(n / 3, 6) AS engagement_coverage, round(threshold, 6) AS threshold, label_value, sha256(source || chr(31) || platform_event_id || chr(31) || event_id || chr(31) || '24h') AS example_id FROM ex"),
    "a8_a17_a29_label_report": with_("observations", _EXAMPLES + " SELECT split_name, source, label_value, count(*) AS n, min(observed_at) AS first, max(observed_at) AS last, round(avg((like_count IS NULL)::INT), 6) AS missing_likes FROM ex GROUP BY ALL"),
    "b11_w7_balanced": with_("posts", ", k AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY sha256('42:' || platform_event_id)) AS balance_rank FROM posts), m AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM posts GROUP BY source, lang)) SELECT source, lang, platform_event_id, balance_rank, source || '|' || lang AS balance_group FROM k, m WHERE balance_rank <= m.n"),
    "t5_nested_balanced": with_("posts", ", k AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY sha256('42:' || platform_event_id)) AS r FROM posts), m AS (SELECT lang, min(n) AS n FROM (SELECT lang, source, count(*) AS n FROM posts GROUP BY lang, source) GROUP BY lang) SELECT k.lang, source, platform_event_id FROM k JOIN m USING (lang) WHERE r <= m.n"),
    "t6_capped": with_("posts", ", k AS (SELECT *, sha256('42:' || platform_event_id) AS h, row_number() OVER (PARTITION BY community ORDER BY sha256('42:' || platform_event_id)) > 5 AS extra FROM posts) SELECT community, platform_event_id FROM k ORDER BY extra, h LIMIT 150"),
    "t7_one_per_author": with_("posts", ", k AS (SELECT *, sha256('42:' || platform_event_id) AS h FROM posts QUALIFY row_number() OVER (PARTITION BY author_hash ORDER BY sha256('42:' || platform_event_id)) = 1) SELECT author_hash, platform_event_id FROM k ORDER BY h LIMIT 60"),
    "t9_t10_folds": f"WITH {_SCORED}, f AS (SELECT *, doc_id % 50 AS g, (('0x' || substr(sha256('7:' || doc_id % 50), 1, 8))::BIGINT % 5)::INTEGER AS fold FROM sc) SELECT fold, count(*) AS n, count(DISTINCT g) AS groups, count(*) FILTER (label = 1) AS positives, (SELECT sum(('0x' || substr(sha256(x.g::VARCHAR), 1, 15))::HUGEINT) FROM (SELECT DISTINCT g, fold FROM f) x WHERE x.fold = f.fold)::VARCHAR AS fingerprint FROM f GROUP BY fold",
    "t9_t10_stratified_folds": f"""WITH {_SCORED}, g AS (SELECT doc_id % 50 AS g, floor(avg(label) * 10)::INTEGER AS share, floor(log2(count(*)))::INTEGER AS size FROM sc GROUP BY 1),
d AS (SELECT g, ((row_number() OVER (PARTITION BY share, size ORDER BY sha256('42:' || g)) - 1 + ('0x' || substr(sha256('42:' || share || ':' || size), 1, 8))::BIGINT) % 5)::INTEGER AS fold FROM g), f AS (SELECT sc.*, g, fold FROM sc JOIN d ON g = doc_id % 50),
c AS (SELECT fold, count(*) AS n, count(*) FILTER (label = 1) AS positives, count(DISTINCT g) AS groups FROM f GROUP BY fold)
SELECT c.*, (SELECT sum(('0x' || substr(sha256(d.g::VARCHAR), 1, 15))::HUGEINT) FROM d WHERE d.fold = c.fold)::VARCHAR AS fingerprint, (SELECT count(*) FROM range(5) r(k) LEFT JOIN c x ON x.fold = r.k WHERE coalesce(x.positives, 0) = 0 OR coalesce(x.n - x.positives, 0) = 0) AS uncovered_folds, 0::BIGINT AS torn_groups FROM c""",
    "u4_fan_out": "WITH u AS (SELECT 'author' AS role, user_id::VARCHAR AS i FROM events WHERE event_id % 4 <> 0 UNION ALL SELECT 'owner', (user_id % 20)::VARCHAR FROM events WHERE event_type = 'view' UNION ALL SELECT 'collaborator', unnest(['a', event_type]) FROM events WHERE event_id % 10 = 0) SELECT role, count(*) AS n, count(DISTINCT i) AS identifiers FROM u GROUP BY role",
    "a18_collaborators": "SELECT count(*) FILTER (event_type = 'view') AS known_owners, count(*) FILTER (event_id % 10 = 0) AS with_collaborators, (SELECT count(DISTINCT event_type) + 1 FROM events WHERE event_id % 10 = 0) AS collaborators FROM events",
    "f44_f47_row_quality": with_("observations", _LAST + """, p AS (SELECT *, greatest(1e-6, least(1 - 1e-6, coalesce(like_count, 0) / (coalesce(view_count, 0) + 20))) AS q FROM last)
SELECT source, platform_event_id, CASE WHEN view_count IS NULL THEN 0 ELSE 3 END AS known, CASE WHEN view_count IS NULL THEN 'views, likes, comments' ELSE '' END AS lacking, CASE WHEN (epoch(TIMESTAMP '2024-01-31') - floor(epoch(observed_at))) / 3600 > 24 THEN 'overdue' ELSE 'fresh' END AS state, round(coalesce(ln(1 + view_count), 0), 6) AS audience_log, (view_count IS NOT NULL)::INTEGER AS audience_known,
  coalesce(view_count = 0, false)::INTEGER AS audience_zero, round(ln(q / (1 - q)), 6) AS logit, round(1 / (1 + exp(-(1.5 * ln(q / (1 - q)) + 0.1))), 6) AS calibrated FROM p"""),
    "b25_prepublication": with_("posts", """SELECT platform_event_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> ''))::BIGINT AS words, contains(text, '?')::INTEGER AS has_question, regexp_matches(lower(text), 'price|cost|\\$|cheap|expensive')::INTEGER AS kw_price, regexp_matches(lower(text), 'charg|battery|kwh')::INTEGER AS kw_charging, hour(event_ts)::INTEGER AS pub_hour,
  (isodow(event_ts) - 1)::INTEGER AS pub_dow, month(event_ts)::INTEGER AS pub_month, count(*) OVER (PARTITION BY community) AS community_posts FROM posts"""),
    "j10_j14_j21_lookups": """WITH r AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 <> 0 THEN floor(c_acctbal)::BIGINT END AS own FROM customer), m AS (SELECT c_nationkey, median(own) AS md FROM r GROUP BY 1), o AS (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) FILTER (o_orderstatus = 'F') AS last_order, count(*) AS orders FROM orders GROUP BY 1)
SELECT c_custkey, coalesce(own::DOUBLE, md) AS size, last_order, coalesce(orders, 0) AS orders FROM r JOIN m USING (c_nationkey) LEFT JOIN o ON c_custkey = o_custkey""",
    "u2_u3_u6_union_dedupe": with_("posts", "SELECT arg_min(platform_event_id, (length(platform_event_id), platform_event_id)) AS platform_event_id, 'once' AS kind FROM posts WHERE length(text) < 600 GROUP BY source, lang, lower(text) UNION ALL SELECT platform_event_id, 'kept' FROM posts WHERE length(text) >= 600"),
    "e1_activity_windows": "WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY ALL) SELECT *, (sum(n) OVER (PARTITION BY event_type ORDER BY hour RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW))::BIGINT AS n_24h FROM h",
}
