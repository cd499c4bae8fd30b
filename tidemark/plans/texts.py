"""Queries over texts, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import bindings as b
from tidemark.bindings import with_
from tidemark.functions import identity as i
from tidemark.functions import text as t
from tidemark.operators import annotate as a
from tidemark.operators import roles as role_rules
from tidemark.scratch import spread


def _posts(spark: SparkSession, sf: str) -> DataFrame:
    return spread(b.posts(spark, sf))


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return _posts(spark, sf).withColumn("clean_text", t.clean_text(F.col("text"))).withColumn("text_for_model", t.for_model(F.col("clean_text")))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return _cleaned(spark, sf).select("platform_event_id", "clean_text", "text_for_model", t.invalid_reason(F.col("clean_text")).alias("invalid_reason"))


def features(spark: SparkSession, sf: str) -> DataFrame:
    made = t.text_counts()
    rows = _cleaned(spark, sf).where("text is not null")  # as good as the cleaned text's, and no cleaning runs twice for it
    ratio = lambda k, c: F.round(c, 6) if k.endswith("ratio") or k == "lexical_diversity" else c.cast("long")
    return rows.select("source", "platform_event_id", "author_hash", "event_ts", *[ratio(k, c).alias(k) for k, c in made.items()])


def effort(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.with_reading_effort(_posts(spark, sf), "text")
    return rows.select("platform_event_id", *[F.round(k, 3).alias(k) for k in ("f_word", "f_sent", "f_clause", "f_info", "f_visual", "reading_effort")], "language")


def ids(spark: SparkSession, sf: str) -> DataFrame:
    e = b.table(spark, sf, "events")
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    return e.select("event_id", i.salted("salt", user).alias("author_hash"), i.content_id(kind, user).alias("content_id"), i.row_id(kind, F.when(F.col("event_id") % 5 != 0, user), F.col("event_id")).alias("observation_id"), i.rejected(F.col("props")).alias("rejected"), t.redacted_field(F.concat(F.lit('{"x_account": "u'), user, F.lit('", "y": 1}')), "x_account").alias("metadata"))


def urls(spark: SparkSession, sf: str) -> DataFrame:
    p = b.table(spark, sf, "pages").withColumn("link", F.concat(F.col("url"), F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/r/sub/comments/p"), F.col("page_id"), F.lit("/a_slug-of/x"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("/i/status/"), F.col("page_id"))).otherwise(F.concat(F.lit("/watch?a=1&v=V"), F.col("page_id"), F.lit("&t=2#c")))))
    link = F.col("link")
    return p.select("page_id", t.without_fragment(link).alias("canonical"), t.video_id(link).alias("video_id"), t.path_part(link, r"/status/(\d+)").alias("status_id"), t.path_part(link, r"/comments/([^/?#]+)").alias("post_id"), t.path_part(link, r"/r/([^/?#]+)").alias("community"), t.slug_title(link).alias("title"))


def parsers(spark: SparkSession, sf: str) -> DataFrame:
    e = b.table(spark, sf, "events")
    n, m = F.col("event_id"), F.col("event_id") % 7
    s = lambda x: x.cast("string")
    count = F.when(m == 0, F.concat(s(n), F.lit(".5K"))).when(m == 1, F.concat(s(n), F.lit(",000"))).when(m == 2, F.concat(s(n), F.lit("M"))).when(m == 3, F.lit("")).when(m == 4, F.concat(F.lit("x"), s(n))).otherwise(F.concat(F.lit(" "), s(n)))
    time = F.when(m < 3, s(n + 1_700_000_000)).when(m < 5, F.concat(F.lit("2024-01-0"), s(m), F.lit(" 10:00:00"))).otherwise("never")
    flag = F.element_at(F.array(*map(F.lit, ("Yes", "no", "1", "0", "maybe", " TRUE ", "f"))), (m + 1).cast("int"))
    listed = F.when(m < 3, F.concat(F.lit("a, b|c"), s(n))).when(m < 5, F.concat(F.lit('["x","'), s(n), F.lit('"]'))).otherwise(" ")
    long = F.concat(F.lit("PT"), F.when(m > 2, F.concat(s(m), F.lit("H"))).otherwise(""), s(n % 60), F.lit("M"), s(n % 50), F.lit("S"))
    return e.select("event_id", t.parsed_count(count).alias("count"), t.parsed_time(time).alias("at"), t.parsed_flag(flag).alias("flag"), t.parsed_list(listed).alias("parts"), t.parsed_duration(long).alias("seconds"), t.sanitised(F.concat(F.lit("failed token="), s(n), F.lit("  for a@b.com"))).alias("message"))


def keywords(spark: SparkSession, sf: str) -> DataFrame:
    ratio = F.floor(t.upper_ratio(F.col("text")) * 1e6 + 0.5) / 1e6  # as SQL rounds; round() goes by the digits that are printed, so 41 of 640 differed
    return _posts(spark, sf).select("platform_event_id", *[c.alias(k) for k, c in t.keyword_flags(F.col("text")).items()], ratio.alias("upper_ratio"), t.model_text(t.folded(F.col("text"))).alias("model_text"))


def segments(spark: SparkSession, sf: str) -> DataFrame:
    rows = a.segments(_posts(spark, sf), "platform_event_id", "text")
    return rows.select("platform_event_id", "position", "segment", a.noise_reason(F.col("segment")).alias("noise_reason"))


def roles(spark: SparkSession, sf: str) -> DataFrame:
    rows = a.segments(_posts(spark, sf), "platform_event_id", "text").where(a.noise_reason(F.col("segment")).isNull())
    return role_rules.with_role(rows).groupBy("role", "tier").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("platform_event_id").alias("posts"), F.round(F.avg("sure"), 4).alias("sure"))


def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    rows = _posts(spark, sf).withColumn("probe", F.concat(F.element_at(F.array(*[F.lit(x) for x in a.PROBES]), (F.col("platform_event_id").cast("long") % len(a.PROBES) + 1).cast("int")), F.lit(" "), F.col("text")))
    scored = a.with_sentiment(rows, "probe")
    return scored.select("platform_event_id", "language", "hits", F.round("compound", 4).alias("compound"), "sentiment", a.stance(F.col("probe"), F.col("language"), F.col("sentiment")).alias("stance"))


def role_mix(spark: SparkSession, sf: str) -> DataFrame:
    return role_rules.role_features(_posts(spark, sf), "platform_event_id", "text")


QUERIES = {"f1_f4_clean_text": clean, "f9_f12_b9_text_features": features, "f36_f37_reading_effort": effort, "f5_f7_f8_f14_ids": ids, "f6_f13_urls": urls, "f29_f33_f51_parsers": parsers, "f34_f35_keywords": keywords, "f38_w18_p16_segments": segments, "f39_roles": roles, "f40_f43_sentiment": sentiment, "a28_role_mix": role_mix}

_CLEAN = r""", scrubbed AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '</?[A-Za-z][^>]*>', ' ', 'g'),
  '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+(?:\.[\p{L}\p{N}_-]+)+', ' <EMAIL> ', 'g'), '(?:https?://|www\.)[^\s<>"'']*[^\s<>"''.,;:!?)}\]]', ' <URL> ', 'g'), '@[\p{L}\p{N}_]+', ' <USER> ', 'g'), '\b(?:\d{1,3}\.){3}\d{1,3}\b', ' <IP> ', 'g'), '\+?\d[\d\s\-.()]{6,}\d', ' <PHONE> ', 'g') AS s FROM posts),
cleaned AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(s, '[\x{00}-\x{1F}\x{7F}\x{200B}-\x{200D}\x{FEFF}]', '', 'g'), '\s+', ' ', 'g'), '\s+([,.;:!?])', '\1', 'g')) AS clean_text FROM scrubbed),
ready AS (SELECT *, replace(replace(replace(replace(replace(lower(clean_text), '<user>', '<USER>'), '<email>', '<EMAIL>'), '<phone>', '<PHONE>'), '<ip>', '<IP>'), '<url>', '<URL>') AS m FROM cleaned)"""
_N = lambda c, p: f"len(regexp_extract_all({c}, '{p}'))::BIGINT"
_SCALE = lambda x, lo, hi: f"least(1.0, greatest(0.0, (({x}) - {lo}) / ({hi} - {lo})))"
_SEGMENTS = r""", pieces AS (SELECT platform_event_id, unnest(list_filter(list_transform(regexp_split_to_array(regexp_replace(trim(text, chr(32) || chr(9) || chr(10) || chr(13)), '([.!?])\s+', '\1' || chr(10), 'g'), '\n+'), lambda x: trim(x)), lambda x: x <> '')) AS s,
  generate_subscripts(list_filter(list_transform(regexp_split_to_array(regexp_replace(trim(text, chr(32) || chr(9) || chr(10) || chr(13)), '([.!?])\s+', '\1' || chr(10), 'g'), '\n+'), lambda x: trim(x)), lambda x: x <> ''), 1) AS k FROM posts),
halves AS (SELECT *, trim(regexp_extract(s, '(?is)^(|.*?[^\p{L}\p{N}_])(et|and|mais|but)($|[^\p{L}\p{N}_].*)$', 1), ' ,.;') AS l, trim(regexp_extract(s, '(?is)^(|.*?[^\p{L}\p{N}_])(et|and|mais|but)($|[^\p{L}\p{N}_].*)$', 3), ' ,.;') AS r FROM pieces),
parts AS (SELECT platform_event_id, k, CASE WHEN len(list_filter(regexp_split_to_array(l, '\s+'), lambda x: x <> '')) >= 4 AND len(list_filter(regexp_split_to_array(r, '\s+'), lambda x: x <> '')) >= 4
  THEN [l || CASE WHEN regexp_matches(l, '[.!?]$') THEN '' ELSE '.' END, r || CASE WHEN regexp_matches(r, '[.!?]$') THEN '' ELSE '.' END] ELSE [s] END AS p FROM halves),
flat AS (SELECT platform_event_id, k, generate_subscripts(p, 1) AS j, unnest(p) AS segment FROM parts),
once AS (SELECT platform_event_id, segment, min(k * 10 + j) AS o FROM flat WHERE length(segment) >= 3 GROUP BY ALL),
segments AS (SELECT platform_event_id, row_number() OVER (PARTITION BY platform_event_id ORDER BY o) AS position, segment FROM once)"""

_NOISE = r"""CASE WHEN length(trim(segment)) < 8 THEN 'too_short' WHEN regexp_matches(segment, '^\s*\d{1,2}:\d{2}(:\d{2})?\s') THEN 'chapter_timestamp' WHEN regexp_matches(segment, '^(?:\s*#\S+\s*)+$') THEN 'hashtag_only'
  WHEN regexp_matches(segment, '^\s*[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+\s*$') THEN 'email_only' WHEN regexp_matches(segment, '__LABEL__') THEN 'label_only'
  WHEN regexp_matches(segment, 'https?://\S+|\bwww\.\S+') AND length(trim(regexp_replace(segment, 'https?://\S+|\bwww\.\S+', '', 'g'), ' :|-–—.,')) < 15 THEN 'url_only' END""".replace("__LABEL__", a.NOISE[-1][1])


def _re2(pattern: str) -> str:
    """A role pattern for DuckDB, whose word boundaries know ASCII only: they are spelled out, but for one after a sign."""
    w, n = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
    if pattern == r"\b#1\b":
        return f"{w}#1(?:$|{n})"
    p = pattern.replace(r"\b.*\b", f"(?:{n}|{n}.*{n})").replace(r"\b.*", f"{n}.*")
    p = f"(?:^|{n})" + p[2:] if p.startswith(r"\b") else p
    return p[:-2] + f"(?:$|{n})" if p.endswith(r"\b") and "%" not in p else p


def _role_sql(segments: str, key: str = "platform_event_id") -> str:
    """CTEs from ``segments`` (key, position, segment) to ``roled`` with role, sure, confidence and tier."""
    q = lambda x: "'" + x.replace("'", "''") + "'"
    some = lambda patterns: "(" + " OR ".join(f"regexp_matches(t, {q(_re2(p))})" for p in patterns) + ")"
    votes = []
    for k, (rules, (few, credit, else_)) in enumerate(zip(role_rules.READERS, role_rules.UNSURE, strict=True)):
        cases = []
        for role, sure, patterns, more in rules:
            test = some(patterns) + (f" AND {some(more['and'])}" if "and" in more else "") + (f" AND NOT {some(more['not'])}" if "not" in more else "") + (" AND position = 1" if more.get("first") else "")
            cases.append(f"WHEN {test} THEN {{'r': {q(role)}, 's': {sure}::DOUBLE}}")
        cases.append(f"WHEN len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '')) <= 4 THEN {{'r': 'uncertain', 's': {few}::DOUBLE}}")
        if credit:
            cases.append("WHEN " + " OR ".join(f"starts_with(t, {q(c)})" for c in role_rules.CREDIT) + f" THEN {{'r': 'uncertain', 's': {credit}::DOUBLE}}")
        votes.append(f"CASE {' '.join(cases)} ELSE {{'r': 'uncertain', 's': {else_}::DOUBLE}} END AS v{k}")
    rank = lambda r: f"CASE {r} " + " ".join(f"WHEN {q(x)} THEN {p}" for x, p in role_rules.PRIORITY.items()) + " END"
    return f""", low AS (SELECT {key}, position, segment, lower(trim(segment, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))) AS t FROM {segments}),
voted AS (SELECT {key}, position, {", ".join(votes)} FROM low),
ballots AS (SELECT {key}, position, unnest([v0, v1, v2]) AS v, unnest([0, 1, 2]) AS k FROM voted),
tally AS (SELECT {key}, position, v.r AS role, count(*) AS n, avg(v.s) AS sure, min(k) AS k FROM ballots GROUP BY ALL),
roled AS (SELECT {key}, position, role, round(sure, 4) AS sure, round(n / 3, 4) AS confidence, CASE WHEN role = 'uncertain' THEN 'uncertain' WHEN n = 3 THEN 'gold' ELSE 'silver' END AS tier
  FROM tally QUALIFY row_number() OVER (PARTITION BY {key}, position ORDER BY n DESC, {rank("role")} DESC, k) = 1)"""


def sentiment_sql(source: str, key: str, text: str) -> str:
    """CTEs from ``source`` (key columns and text) to ``felt`` with language, hits, compound, sentiment and stance."""
    q = lambda x: "'" + x.replace("'", "''") + "'"
    lexicon = ", ".join(f"({q(p)}, {q(p.split()[0])}, {len(p.split())}, {v}::DOUBLE)" for p, v in (a.LEXICON_VI | a.LEXICON_EN).items())
    boosters = ", ".join(f"({q(w)}, {v}::DOUBLE)" for w, v in (a.STRONGER | {k: -v for k, v in a.WEAKER.items()}).items())
    negators = ", ".join(map(q, a.NEGATORS))
    some = lambda marks: "CASE WHEN language = 'vi' THEN " + " OR ".join(f"contains(low, {q(m)})" for m in marks["vi"]) + " ELSE " + " OR ".join(f"contains(low, {q(m)})" for m in marks["en"]) + " END"
    return f""", lexicon(p, first, n, v) AS (VALUES {lexicon}), boosters(w, push) AS (VALUES {boosters}),
tok AS (SELECT row_number() OVER () AS rid, {key}, lower(coalesce({text}, '')) AS low, regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}_]+') AS t FROM {source}),
word AS (SELECT rid, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM tok),
near AS (SELECT rid, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lag(w, 1) OVER o AS b1, lag(w, 2) OVER o AS b2, lag(w, 3) OVER o AS b3 FROM word WINDOW o AS (PARTITION BY rid ORDER BY i)),
hit AS (SELECT near.*, l.n, v FROM near JOIN lexicon l ON l.p = CASE l.n WHEN 1 THEN w WHEN 2 THEN w || ' ' || w1 WHEN 3 THEN w || ' ' || w1 || ' ' || w2 ELSE w || ' ' || w1 || ' ' || w2 || ' ' || w3 END AND l.first = w),
kept AS (SELECT * FROM hit h WHERE NOT EXISTS (SELECT 1 FROM hit g WHERE g.rid = h.rid AND g.n > h.n AND g.i <= h.i + h.n - 1 AND g.i + g.n - 1 >= h.i)),
moved AS (SELECT rid, v + sign(v) * 4 * coalesce(push, 0) AS m, coalesce(b1 IN ({negators}), false) OR coalesce(b2 IN ({negators}), false) OR coalesce(b3 IN ({negators}), false) AS turned FROM kept LEFT JOIN boosters b ON b.w = b1),
total AS (SELECT rid, count(*) AS hits, sum(CASE WHEN turned THEN -m - sign(m) * {a.NEGATION} ELSE m END) AS s FROM moved GROUP BY rid),
felt0 AS (SELECT tok.*, coalesce(hits, 0) AS hits, coalesce(s / sqrt(s * s + {a.ALPHA}), 0.0) AS compound, CASE WHEN regexp_matches(low, '[{t.VIETNAMESE}]') THEN 'vi' ELSE 'en' END AS language FROM tok LEFT JOIN total USING (rid)),
felt1 AS (SELECT *, CASE WHEN compound >= {a.NEUTRAL} THEN 'positive' WHEN compound <= -{a.NEUTRAL} THEN 'negative' ELSE 'neutral' END AS sentiment FROM felt0),
felt AS (SELECT *, CASE WHEN {some(a.HOSTILE)} THEN 'hostile' WHEN {some(a.SCEPTIC)} THEN 'sceptique' WHEN {some(a.ADHERE)} THEN 'adhère' WHEN sentiment = 'positive' THEN 'adhère' WHEN sentiment = 'negative' THEN 'sceptique' ELSE 'neutre' END AS stance FROM felt1)"""


_PROBES = "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in a.PROBES) + "]"
SQL = {
    "f40_f43_sentiment": with_("posts", f", probed AS (SELECT platform_event_id, {_PROBES}[platform_event_id::BIGINT % {len(a.PROBES)} + 1] || ' ' || text AS probe FROM posts)" + sentiment_sql("probed", "platform_event_id", "probe") + " SELECT platform_event_id, language, hits, round(compound, 4) AS compound, sentiment, stance FROM felt"),
    "f39_roles": with_("posts", _SEGMENTS + f", kept AS (SELECT * FROM segments WHERE {_NOISE} IS NULL)" + _role_sql("kept") + " SELECT role, tier, count(*) AS n, count(DISTINCT platform_event_id) AS posts, round(avg(sure), 4) AS sure FROM roled GROUP BY ALL"),
    "a28_role_mix": with_("posts", r""", flat AS (SELECT platform_event_id, unnest(list_filter(list_transform(regexp_split_to_array(regexp_replace(trim(text, chr(32) || chr(9) || chr(10) || chr(13)), '([.!?])\s+', '\1' || chr(10), 'g'), '\n+|\s+•\s+'), lambda s: trim(s, chr(32) || chr(9) || chr(10) || chr(13))), lambda s: length(s) >= 3)) AS segment,
  generate_subscripts(list_filter(list_transform(regexp_split_to_array(regexp_replace(trim(text, chr(32) || chr(9) || chr(10) || chr(13)), '([.!?])\s+', '\1' || chr(10), 'g'), '\n+|\s+•\s+'), lambda s: trim(s, chr(32) || chr(9) || chr(10) || chr(13))), lambda s: length(s) >= 3), 1) AS position FROM posts)""" + _role_sql("flat")
      + " SELECT platform_event_id, " + ", ".join(f"count(*) FILTER (role = '{r}') AS role_n_{r}, round(count(*) FILTER (role = '{r}') / count(*), 6) AS role_ratio_{r}" for r in role_rules.ROLES) + ", count(*) AS role_n_segments, count(DISTINCT role) AS role_diversity FROM roled GROUP BY platform_event_id"),
    "f1_f4_clean_text": with_("posts", _CLEAN + " SELECT platform_event_id, clean_text, m AS text_for_model, CASE WHEN clean_text IS NULL OR clean_text = '' THEN 'empty_after_clean' WHEN length(clean_text) > 10000 THEN 'text_too_long' END AS invalid_reason FROM ready"),
    "f9_f12_b9_text_features": with_("posts", _CLEAN + rf""" SELECT source, platform_event_id, author_hash, event_ts, length(m)::BIGINT AS character_count, len(list_filter(regexp_split_to_array(trim(m), '\s+'), lambda x: x <> ''))::BIGINT AS word_count,
  len(list_filter(regexp_split_to_array(trim(m), '[.!?]+'), lambda x: trim(x) <> ''))::BIGINT AS sentence_count, CASE WHEN m = '' THEN 0 ELSE len(regexp_split_to_array(m, '\r\n|\r|\n')) END::BIGINT AS line_count,
  {_N("clean_text", r"#[\p{L}\p{N}_]+")} AS hashtag_count, {_N("clean_text", r"@[\p{L}\p{N}_]+")} AS mention_count, {_N("clean_text", r"https?://\S+|www\.\S+")} AS url_count, {_N("clean_text", r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{FE00}-\x{FE0F}]")} AS emoji_count,
  {_N("clean_text", r"\?")} AS question_mark_count, {_N("clean_text", "!")} AS exclamation_mark_count, {_N("m", "<USER>")} AS mention_token_count, {_N("m", "<EMAIL>")} AS email_token_count, {_N("m", "<PHONE>")} AS phone_token_count, {_N("m", "<IP>")} AS ip_token_count, {_N("m", "<URL>")} AS url_token_count,
  round({_N("clean_text", "[A-ZÀ-ÖØ-Þ]")} / nullif({_N("clean_text", "[A-Za-zÀ-ÖØ-öø-ÿ]")}, 0), 6) AS uppercase_ratio, round({_N("clean_text", "[0-9]")} / nullif(length(clean_text), 0), 6) AS digit_ratio,
  round(list_unique(list_filter(regexp_split_to_array(trim(m), '\s+'), lambda x: x <> '')) / nullif(len(list_filter(regexp_split_to_array(trim(m), '\s+'), lambda x: x <> '')), 0), 6) AS lexical_diversity FROM ready WHERE m IS NOT NULL"""),
    "f36_f37_reading_effort": with_("posts", rf""", c AS (SELECT platform_event_id, trim(coalesce(text, '')) AS c FROM posts),
w AS (SELECT *, regexp_extract_all(c, '\p{{L}}+') AS words, greatest(len(regexp_extract_all(c, '\p{{L}}+')), 1) AS n, greatest(len(list_filter(regexp_split_to_array(c, '[.!?]+(\s|$)'), lambda x: trim(x) <> '')), 1) AS sent,
  CASE WHEN {_N("lower(c)", f"[{t.VIETNAMESE}]")} / nullif({_N("c", "[[:alpha:]]|" + chr(92) + "p{L}")}, 0) > 0.03 THEN 'vi' ELSE 'en' END AS language FROM c),
f AS (SELECT *, CASE WHEN language = 'en' THEN {_SCALE("len(list_filter(words, lambda x: len(regexp_extract_all(lower(x), '[aeiouy]+')) - ends_with(lower(x), 'e')::INT >= 3)) / n", 0.0, 0.30)} END AS f_word, {_SCALE("n / sent", 8.0, 30.0)} AS f_sent,
  {_SCALE(f"(CASE WHEN language = 'vi' THEN {_N('c', t.CONJUNCTIONS_VI)} ELSE {_N('c', t.CONJUNCTIONS)} END + {_N('c', ',')}) / sent", 0.0, 3.0)} AS f_clause, {_SCALE(f"({_N('c', t.UNITS)} + {_N('c', t.JARGON)} + {_N('c', t.JARGON_VI)}) / n", 0.0, 0.12)} AS f_info,
  ({_SCALE("len(list_filter(words, lambda x: length(x) >= 3 AND x = upper(x) AND x <> lower(x))) / n", 0.0, 0.30)} + {_SCALE(_N("c", "[!?]{2,}"), 0, 5.0)} + {_SCALE(_N("c", t.FRICTION_EMOJI) + " + " + _N("c", "#"), 0, 10.0)}) / 3 AS f_visual FROM w)
SELECT platform_event_id, CASE WHEN c = '' THEN 0.0 ELSE round(f_word, 3) END::DOUBLE AS f_word, CASE WHEN c = '' THEN 0.0 ELSE round(f_sent, 3) END::DOUBLE AS f_sent, CASE WHEN c = '' THEN 0.0 ELSE round(f_clause, 3) END::DOUBLE AS f_clause, CASE WHEN c = '' THEN 0.0 ELSE round(f_info, 3) END::DOUBLE AS f_info,
  CASE WHEN c = '' THEN 0.0 ELSE round(f_visual, 3) END::DOUBLE AS f_visual, CASE WHEN c = '' THEN 0.0 ELSE round(round((coalesce(f_word, 0) + f_sent + f_clause + f_info + f_visual) / CASE language WHEN 'vi' THEN 4 ELSE 5 END, 4), 3) END::DOUBLE AS reading_effort, language FROM f"""),
    "f5_f7_f8_f14_ids": """SELECT event_id, sha256('salt:' || user_id) AS author_hash, sha256(event_type || ':' || user_id) AS content_id, sha256(event_type || chr(31) || CASE WHEN event_id % 5 <> 0 THEN user_id::VARCHAR ELSE '' END || chr(31) || event_id) AS observation_id,
  '{"redacted":true,"byte_length":' || octet_length(encode(props)) || ',"sha256":"' || sha256(props) || '"}' AS rejected, '{"x_account": "<USER>", "y": 1}' AS metadata FROM events""",
    "f6_f13_urls": r"""WITH p AS (SELECT page_id, url || CASE page_id % 3 WHEN 0 THEN '/r/sub/comments/p' || page_id || '/a_slug-of/x' WHEN 1 THEN '/i/status/' || page_id ELSE '/watch?a=1&v=V' || page_id || '&t=2#c' END AS link FROM pages)
SELECT page_id, regexp_replace(link, '#.*$', '') AS canonical, nullif(regexp_extract(link, '[?&]v=([^&#]+)', 1), '') AS video_id, nullif(regexp_extract(link, '/status/(\d+)', 1), '') AS status_id, nullif(regexp_extract(link, '/comments/([^/?#]+)', 1), '') AS post_id,
  nullif(regexp_extract(link, '/r/([^/?#]+)', 1), '') AS community, nullif(trim(regexp_replace(regexp_extract(link, '/comments/[^/]+/([^/?#]+)', 1), '[_-]+', ' ', 'g')), '') AS title FROM p""",
    "f29_f33_f51_parsers": r"""SELECT event_id, CASE event_id % 7 WHEN 0 THEN event_id * 1000 + 500 WHEN 1 THEN event_id * 1000 WHEN 2 THEN event_id * 1000000 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE event_id END AS count,
  CASE WHEN event_id % 7 < 3 THEN make_timestamp((event_id + 1700000000) * 1000000) WHEN event_id % 7 < 5 THEN ('2024-01-0' || event_id % 7 || ' 10:00:00')::TIMESTAMP END AS at, [true, false, true, false, NULL, true, false][event_id % 7 + 1] AS flag,
  CASE WHEN event_id % 7 < 3 THEN ['a', 'b', 'c' || event_id] WHEN event_id % 7 < 5 THEN ['x', event_id::VARCHAR] END AS parts, (CASE WHEN event_id % 7 > 2 THEN event_id % 7 ELSE 0 END) * 3600 + event_id % 60 * 60 + event_id % 50 AS seconds, 'failed token=<REDACTED> for <EMAIL>' AS message FROM events""",
    "f34_f35_keywords": with_("posts", r"""SELECT platform_event_id, contains(text, '?') AS has_question, regexp_matches(lower(text), '\b(?:price|cost|cheap|expensive|\$)') AS mentions_price, regexp_matches(lower(text), '\b(?:range|km|miles|mileage)\b') AS mentions_range, regexp_matches(lower(text), '\b(?:charg|battery|plug)') AS mentions_charging,
  round(coalesce(len(regexp_extract_all(text, '[A-Z]')) / nullif(len(regexp_extract_all(text, '[A-Za-z]')), 0), 0), 6) AS upper_ratio,
  trim(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '(?i)(https?://)\s+', '\1', 'g'), '(?i)https?://\S+|www\.\S+', ' ', 'g'), '<[A-Z_]+>', ' ', 'g'), '@[\p{L}\p{N}_]+', ' ', 'g'), '#', ' '), '\s+', ' ', 'g')) AS model_text FROM posts"""),
    "f38_w18_p16_segments": with_("posts", _SEGMENTS + f" SELECT platform_event_id, position, segment, {_NOISE} AS noise_reason FROM segments"),
}
