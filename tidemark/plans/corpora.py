"""Composite jobs: readings out of events, merged sources, annotation corpora and model features; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import bindings as b
from tidemark.bindings import with_
from tidemark.functions import text as t
from tidemark.operators import annotate, entities, labels, reports, tables, upkeep
from tidemark.operators import roles as role_rules
from tidemark.operators import snapshots as s
from tidemark.plans import texts
from tidemark.scratch import spread, written


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Events that hold a reading, one a content and moment (the first by id)."""
    o = b.observations(spark, sf).withColumns({"event_type": F.lit(None).cast("string"), "hour": F.date_trunc("hour", "observed_at")})
    seen = o.where(u_snapshot(o)).withColumn("age_minutes", s.age_minutes(F.col("hour"), F.date_trunc("hour", "created_at")))
    own = ["age_minutes", "view_count", "like_count", "comment_count", "event_id"]
    once = seen.groupBy("source", "platform_event_id", "hour").agg(F.min_by(F.struct(*own), "event_id").alias("_f"))
    return once.select("source", "platform_event_id", "hour", "_f.*")


def u_snapshot(rows: DataFrame):
    return upkeep.snapshot_events(rows, ["view_count", "like_count", "comment_count"])


def merged_sources(spark: SparkSession, sf: str) -> DataFrame:
    """New rows of one source beside those of another with other columns, once by id, then once by text."""
    p = b.posts(spark, sf).select("platform_event_id", "source", F.lower("text").alias("text"), F.length("text").alias("n"))
    old, new = p.where("platform_event_id % 2 = 0").drop("n"), p.where("platform_event_id % 2 <> 0 or platform_event_id % 3 = 0")
    both = tables.aligned_union(old, tables.new_rows(old, new, ["platform_event_id"]))
    order = F.struct(F.length("platform_event_id"), "platform_event_id")
    return both.groupBy("text").agg(F.min_by(F.struct("platform_event_id", "source", "n"), order).alias("_r")).select("_r.*")


def annotation(spark: SparkSession, sf: str) -> DataFrame:
    """A balanced sample of posts, cut into segments, noise out, with roles and role-aware sentiment."""
    first = F.struct(F.length("platform_event_id"), "platform_event_id")
    posts = b.posts(spark, sf).where(F.length("text").between(20, 3000)).groupBy("source", "lang", "text").agg(F.min_by("platform_event_id", first).alias("platform_event_id"))
    sample = written(labels.nested_balanced(posts, "lang", "source", F.col("platform_event_id")), "sample")
    rows = annotate.segments(spread(sample), "platform_event_id", "text").where(annotate.noise_reason(F.col("segment")).isNull())
    rows = annotate.with_sentiment(role_rules.with_role(rows), "segment")
    compound, flag = annotate.for_role(F.col("compound"), F.col("role"))
    rows = rows.withColumns({"compound": compound, "role_flag": flag})
    return rows.select("platform_event_id", "position", "role", "tier", F.round("compound", 3).alias("compound"), annotate.ternary(F.col("compound")).alias("sentiment"), "role_flag")


def reactions(spark: SparkSession, sf: str) -> DataFrame:
    """Sentiment and stance of replies, counted by source and label."""
    rows = annotate.with_sentiment(spread(b.interactions(spark, sf)), "text")
    rows = rows.withColumn("stance", annotate.stance(F.col("text"), F.col("language"), F.col("sentiment")))
    return rows.groupBy("source", "sentiment", "stance").agg(F.count(F.lit(1)).alias("n"))


def features(spark: SparkSession, sf: str) -> DataFrame:
    """Reading effort of the model's text, role mix, audience (here the posts of the author's community, unknown for some) and one-hot languages of each post."""
    posts = spread(b.posts(spark, sf))
    effort = t.with_reading_effort(posts.withColumn("model_text", t.model_text(t.folded(F.col("text")))), "model_text")
    mix = role_rules.role_features(posts, "platform_event_id", "text").select("platform_event_id", "role_n_segments", "role_diversity", "role_n_proof", "role_ratio_uncertain")
    sizes = posts.groupBy("community").agg(F.count(F.lit(1)).alias("size"))
    known = F.col("platform_event_id").cast("long") % 7 != 0
    rows = effort.join(mix, "platform_event_id", "left").join(sizes, "community").withColumns({"audience": F.when(known, F.col("size")), "audience_flag": known})
    aud = reports.audience("audience", "audience_flag")
    return rows.select(
        "platform_event_id", F.round("reading_effort", 3).alias("reading_effort"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("role_n_segments", "role_diversity", "role_n_proof", "role_ratio_uncertain")],
        F.round(aud["audience_log"], 6).alias("audience_log"), aud["audience_known"].alias("audience_known"), aud["audience_zero"].alias("audience_zero"), *[(F.col("lang") == x).cast("int").alias(f"lang_{x}") for x in ("en", "fr", "de", "es")],
    )


def due_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Contents without an available transcript, joined to what was tried before, once a content."""
    from tidemark.plans.contents import _attempts

    tried = entities.best_transcripts(_attempts(spark, sf), ["video_id"]).select("video_id", "lifecycle_status", "attempt_count")
    wanted = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("video_id"))
    joined = wanted.join(tried, "video_id", "left")
    return joined.where(F.col("lifecycle_status").isNull() | (F.col("lifecycle_status") != "available")).select("video_id", F.coalesce("lifecycle_status", F.lit("never")).alias("state"), F.coalesce("attempt_count", F.lit(0)).alias("attempts"))


QUERIES = {"b3_readings": readings, "b15_j15_w15_merged_sources": merged_sources, "b16_f42_annotation": annotation, "b17_a37_reactions": reactions, "b14_features": features, "j9_w9_due_transcripts": due_transcripts}
_CUT = texts._SEGMENTS.replace("FROM posts)", "FROM sample)")  # the same segments, of a sample
def _features_sql() -> str:
    """The parts of the SQL for reading effort and role mix, put together for B14."""
    effort, mix = texts.SQL["f36_f37_reading_effort"], texts.SQL["a28_role_mix"]
    last = lambda q: q.rindex("SELECT platform_event_id, ")
    effort_from, mix_from = effort.index(", c AS (SELECT"), mix.index(", flat AS (SELECT")
    model = r"""trim(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '(?i)(https?://)\s+', '\1', 'g'), '(?i)https?://\S+|www\.\S+', ' ', 'g'), '<[A-Z_]+>', ' ', 'g'), '@[\p{L}\p{N}_]+', ' ', 'g'), '#', ' '), '\s+', ' ', 'g'))"""
    return with_("posts", f", mt AS (SELECT platform_event_id, {model} AS text FROM posts)" + effort[effort_from : last(effort)].replace("FROM posts)", "FROM mt)") + ", eff AS (" + effort[last(effort) :] + ")" + mix[mix_from : last(mix)] + ", mix AS (" + mix[last(mix) :] + """),
n AS (SELECT community, count(*) AS size FROM posts GROUP BY 1)
SELECT p.platform_event_id, reading_effort, coalesce(role_n_segments, 0) AS role_n_segments, coalesce(role_diversity, 0) AS role_diversity, coalesce(role_n_proof, 0) AS role_n_proof, coalesce(role_ratio_uncertain, 0) AS role_ratio_uncertain, CASE WHEN p.platform_event_id::BIGINT % 7 <> 0 THEN round(ln(1 + size), 6) ELSE 0.0 END AS audience_log,
  (p.platform_event_id::BIGINT % 7 <> 0)::INTEGER AS audience_known, 0 AS audience_zero, (lang = 'en')::INTEGER AS lang_en, (lang = 'fr')::INTEGER AS lang_fr, (lang = 'de')::INTEGER AS lang_de, (lang = 'es')::INTEGER AS lang_es FROM posts p JOIN eff ON eff.platform_event_id = p.platform_event_id JOIN n ON n.community = p.community LEFT JOIN mix ON mix.platform_event_id = p.platform_event_id""")


SQL = {
    "b14_features": _features_sql(),
    "b17_a37_reactions": with_("interactions", texts.sentiment_sql("interactions", "source", "text") + " SELECT source, sentiment, stance, count(*) AS n FROM felt GROUP BY ALL"),
    "b16_f42_annotation": with_("posts", ", uniq AS (SELECT source, lang, text, arg_min(platform_event_id, (length(platform_event_id), platform_event_id)) AS platform_event_id FROM posts WHERE length(text) BETWEEN 20 AND 3000 GROUP BY ALL), numbered AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY sha256('42:' || platform_event_id)) AS r FROM uniq), least AS (SELECT lang, min(n) AS n FROM (SELECT lang, source, count(*) AS n FROM uniq GROUP BY ALL) GROUP BY lang), sample AS (SELECT platform_event_id, text FROM numbered JOIN least USING (lang) WHERE r <= n)"
      + _CUT + f", told AS (SELECT * FROM segments WHERE {texts._NOISE} IS NULL)" + texts._role_sql("told") + texts.sentiment_sql("told", "platform_event_id, position", "segment")
      + f""", j AS (SELECT f.platform_event_id, f.position, role, tier, compound, CASE WHEN compound < 0 THEN CASE role {" ".join(f"WHEN '{k}' THEN {v}" for k, v in annotate.ROLE_FACTOR.items())} END END AS factor FROM felt f JOIN roled r ON f.platform_event_id = r.platform_event_id AND f.position = r.position),
c AS (SELECT *, round(compound * coalesce(factor, 1.0), 4) AS k FROM j)
SELECT platform_event_id, position, role, tier, round(k, 3) AS compound, CASE WHEN k >= {annotate.NEUTRAL} THEN 'positive' WHEN k <= -{annotate.NEUTRAL} THEN 'negative' ELSE 'neutral' END AS sentiment, CASE WHEN role = 'pain_point' THEN 'intentional_negative_rhetoric' WHEN factor IS NOT NULL THEN 'adjusted_for_role:' || role END AS role_flag FROM c"""),
    "b3_readings": with_("observations", """, o AS (SELECT *, date_trunc('hour', observed_at) AS hour FROM observations WHERE view_count IS NOT NULL)
SELECT source, platform_event_id, hour, (epoch(hour) - epoch(date_trunc('hour', created_at)))::BIGINT // 60 AS age_minutes, view_count, like_count, comment_count, event_id FROM o QUALIFY row_number() OVER (PARTITION BY source, platform_event_id, hour ORDER BY event_id) = 1"""),
    "b15_j15_w15_merged_sources": with_("posts", """, u AS (SELECT platform_event_id, source, lower(text) AS text, CASE WHEN platform_event_id::BIGINT % 2 <> 0 THEN length(text) END AS n FROM posts)
SELECT platform_event_id, source, n::INTEGER AS n FROM u QUALIFY row_number() OVER (PARTITION BY text ORDER BY length(platform_event_id), platform_event_id) = 1"""),
    "j9_w9_due_transcripts": """WITH w AS (SELECT *, ['success', 'not_found', 'Disabled', 'rate_limited', 'ip_blocked', 'permanent_error', ' pending ', 'odd'][event_id % 8 + 1] AS word FROM events),
a AS (SELECT user_id, event_id, ts, event_id % 6 AS attempts, CASE WHEN event_id % 8 = 0 THEN 'available' WHEN event_id % 31 = 0 THEN 'unavailable' ELSE CASE lower(trim(word)) WHEN 'not_found' THEN 'unavailable' WHEN 'ip_blocked' THEN 'blocked' WHEN 'odd' THEN 'retryable_error' ELSE lower(trim(word)) END END AS state FROM w),
k AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (state = 'available') DESC, (CASE WHEN event_id % 7 <> 0 THEN ts END) DESC NULLS LAST, ts DESC, event_id DESC) = 1)
SELECT c_custkey AS video_id, coalesce(state, 'never') AS state, coalesce(attempts, 0) AS attempts FROM customer LEFT JOIN k ON user_id = c_custkey WHERE state IS NULL OR state <> 'available'""",
}
