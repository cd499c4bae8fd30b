"""Queries over the event log: decoding, tags, dead letters, merges, reconciliation, rules; and their SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import bindings as b
from tidemark.bindings import with_
from tidemark.functions import identity as i
from tidemark.operators import quality as q
from tidemark.operators import rulebook
from tidemark.operators import tables as t
from tidemark.scratch import new_path
from tidemark.sources import topics


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return topics.tagged(topics.decoded(b.event_log(spark, sf)))


def decode(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).select("topic", "partition", "offset", "decode_error", "event_id", "user_id", "event_type", "value", "reason")


def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    return topics.split(_events(spark, sf))[1]


def dead_letter_report(spark: SparkSession, sf: str) -> DataFrame:
    return topics.split(_events(spark, sf))[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason")


def framed(spark: SparkSession, sf: str) -> DataFrame:
    e = b.table(spark, sf, "events")
    body = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(',"k":"'), F.col("event_type"), F.lit('"}'))
    frame = F.concat(F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(F.col("event_id") % 3 + 1), 8, "0"))), body.cast("binary"))
    row, error = topics.framed(frame, {1: "event_id long", 2: "event_id long, k string"})
    return e.select(F.col("event_id").alias("n"), row["event_id"].alias("event_id"), row["k"].alias("k"), error.alias("decode_error"))


def _updates(spark: SparkSession, sf: str) -> DataFrame:
    e = b.table(spark, sf, "events")
    status = F.element_at(F.array(*map(F.lit, ("pending", "success", "failed", "disabled", "failed"))), (F.col("event_id") % 5 + 1).cast("int"))
    return e.select(
        F.lit("x").alias("source"), F.when(F.col("user_id") % 10 != 0, F.col("user_id").cast("string")).alias("platform_event_id"), F.col("user_id"), F.concat(F.lit("u"), F.col("user_id")).alias("url"), F.lit("2024").alias("event_ts"), "event_id", F.col("ts").alias("updated_at"),
        F.when(F.col("event_id") % 3 != 0, F.floor("value").cast("long")).alias("amount"), F.when(F.col("event_id") % 4 == 0, F.col("props")).alias("props"), F.when(F.col("event_id") % 2 == 0, status).alias("metadata_status"), (F.col("event_id") % 13).alias("attempt_count"),
    )


def _state(rows: DataFrame) -> DataFrame:
    return t.collapsed(rows.withColumn("_id", t.identity()), ["_id"], ["updated_at", "event_id"]).drop("_id")


def collapse(spark: SparkSession, sf: str) -> DataFrame:
    return _state(_updates(spark, sf))


def upsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = _updates(spark, sf)
    early = F.when(F.col("user_id") % 3 == 0, F.col("event_id") % 7 < 4).otherwise(F.col("user_id") % 3 == 2)  # a third of the users is new, a third has no news
    return t.merged(_state(rows.where(early)), _state(rows.where(~early)), t.identity())


def upsert_observed(spark: SparkSession, sf: str) -> DataFrame:
    rows = _updates(spark, sf)
    return t.merged(_state(rows.where("event_id % 7 < 4")), _state(rows.where("event_id % 7 >= 4")), t.identity(), order="updated_at").select("platform_event_id", "user_id", "amount", "updated_at", "attempt_count", "metadata_status")


def insert_new(spark: SparkSession, sf: str) -> DataFrame:
    e = b.table(spark, sf, "events").select("event_id", "user_id")
    old, rows = e.where("event_id % 2 = 0"), e.where("event_id % 2 <> 0 or event_id % 3 = 0").withColumn("note", F.lit("new"))
    return t.aligned_union(old, t.new_rows(old, rows, ["event_id"]))


def update_only(spark: SparkSession, sf: str) -> DataFrame:
    c = b.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    o = b.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("c_acctbal"))
    return t.updated(c, o, ["c_custkey"], ["c_acctbal"])


def replace_latest(spark: SparkSession, sf: str) -> DataFrame:
    p = b.table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    return t.replaced(p, p.where("p_partkey % 5 = 0").withColumn("p_retailprice", F.col("p_retailprice") * 2), ["p_partkey"])


def null_safe(spark: SparkSession, sf: str) -> DataFrame:
    p = b.table(spark, sf, "part").where("p_partkey % 3 <> 1").select(F.when(F.col("p_partkey") > 0, F.col("p_partkey")).alias("key"), "p_brand")
    new = b.table(spark, sf, "part").where("p_partkey % 3 = 1 or p_partkey % 2 = 0").select(F.when(F.col("p_partkey") > 0, F.col("p_partkey")).alias("key"), F.when(F.col("p_partkey") % 4 == 0, F.lit("new")).alias("p_brand"))
    return t.null_safe_merged(p, new, ["key"])


def backfill_delete(spark: SparkSession, sf: str) -> DataFrame:
    o = b.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), "o_orderpriority")
    return t.without(t.backfilled(o, status=F.lower("o_orderpriority")), F.col("o_orderpriority") == "5-LOW")


def _journal(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = b.table(spark, sf, "events")
    journal = e.select("event_id", F.col("event_type").alias("source"), F.col("ts").cast("timestamp").alias("ingested_at"))
    return journal, e.where("event_id % 9 <> 0").select(F.when(F.col("event_id") % 50 == 1, -F.col("event_id")).otherwise(F.col("event_id")).alias("event_id"))


def _now():
    return F.lit("2024-02-01").cast("timestamp")


def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    rows = q.reconciliation(*_journal(spark, sf), _now())
    return rows.withColumn("missing_views", F.element_at("missing_by_source", "view")).drop("missing_by_source")


def repair(spark: SparkSession, sf: str) -> DataFrame:
    return q.repair_set(*_journal(spark, sf), 50)


def theta(spark: SparkSession, sf: str) -> DataFrame:
    """Events matched to current rows by platform id or, where that is missing, by the fallback key: two equi-joins."""
    rows = _updates(spark, sf)
    state = _state(rows).select("platform_event_id", "user_id", "url", F.col("event_id").alias("state_event_id"))
    by_id = rows.join(state.drop("user_id", "url"), "platform_event_id").select("event_id", "state_event_id")
    other = rows.where("platform_event_id is null").drop("platform_event_id").join(state.where("platform_event_id is null").drop("platform_event_id"), ["user_id", "url"]).select("event_id", "state_event_id")
    return by_id.unionByName(other)


def rules(spark: SparkSession, sf: str) -> DataFrame:
    o, e = b.table(spark, sf, "orders"), b.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    made = [
        {"id": "r1", "kind": "schema", "table": "orders", "columns": ["o_orderkey", "o_nope"]}, {"id": "r2", "kind": "unique_key", "table": "orders", "columns": ["o_orderkey"]}, {"id": "r3", "kind": "completeness", "table": "events", "columns": ["props", "value"], "threshold": 0.99},
        {"id": "r4", "kind": "volume_ratio", "table": "orders", "baseline": "events", "threshold": 0.5, "severity": "warning"}, {"id": "r5", "kind": "freshness", "table": "events", "columns": ["ts"], "threshold": 86400.0}, {"id": "r6", "kind": "partitions", "table": "events", "columns": ["event_type"], "threshold": 6.0}, {"id": "r7", "kind": "table_empty", "table": "events"},
        {"id": "r8", "kind": "orphan_files", "table": "events", "files": "orders", "columns": ["path"], "threshold": 0.0},
    ]
    tables = {"orders": o.withColumn("path", F.concat(F.lit("s3://b//"), F.col("o_orderkey") % 50)), "events": e.withColumn("path", F.concat(F.lit("s3:/b/"), F.col("event_id") % 40))}
    return q.run_rules(made, tables, _now(), "run").select("rule_id", "kind", "severity", "table_name", F.round("value", 6).alias("value"), "threshold", "passed", "fails_run", "result_id")


def complete(spark: SparkSession, sf: str) -> DataFrame:
    return q.completeness(_updates(spark, sf), ["amount", "props", "metadata_status"])


def audits(spark: SparkSession, sf: str) -> DataFrame:
    rows = _updates(spark, sf)
    bad = q.violations(has_id=F.col("platform_event_id").isNotNull(), amount_positive=F.col("amount") >= 10, status_known=F.col("metadata_status").isin("success", "failed", "pending", "disabled"), attempts=F.col("attempt_count") < 12)
    return rows.select(F.explode_outer(bad).alias("violation")).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


def lineage(spark: SparkSession, sf: str) -> DataFrame:
    rows = _updates(spark, sf)
    return q.one_lineage(rows, ["source", "event_ts"])


def replay(spark: SparkSession, sf: str) -> DataFrame:
    a = b.table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    other = a.where("c_custkey % 100 <> 7").withColumn("c_acctbal", F.col("c_acctbal") + F.when(F.col("c_custkey") == 3, 0.5).otherwise(0.0))
    return q.replay_difference(a, other, "c_custkey", "c_acctbal", "c_mktsegment").withColumn("largest_difference", F.round("largest_difference", 6))


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """A version of a user's metadata where it differs from the one before, by a hash of its canonical form, and what changed."""
    from pyspark.sql import Window

    e = b.table(spark, sf, "events").withColumn("k", (F.get_json_object("props", "$.k").cast("long") / 25).cast("long"))
    fields = {"k": F.col("k"), "kind": F.when(F.col("event_type") == "error", "error").otherwise("fine"), "tags": i.normalised_list(F.array(F.when(F.col("k") > 1, F.lit(" b  c")), F.lit("a"), F.when(F.col("k") > 2, F.lit("a")), F.lit(" ")))}
    e = e.withColumns(fields).withColumn("metadata_hash", i.fingerprint(k=F.col("k"), kind=F.col("kind"), tags=F.col("tags")))
    before = F.lag(F.struct(*fields, "metadata_hash")).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    e = e.withColumn("_b", before)
    changed = i.changed_fields({n: F.col(f"_b.{n}") for n in fields}, {n: F.col(n) for n in fields})
    return e.where("_b is null or _b.metadata_hash <> metadata_hash").select("user_id", F.col("ts").alias("valid_from"), "event_id", "k", "tags", "metadata_hash", F.col("_b.metadata_hash").alias("previous_hash"), changed.alias("changed"))


def latest_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Of each user's messages the last one by offset, then partition."""
    rows = _events(spark, sf).where("user_id is not null")
    return rows.groupBy("user_id").agg(F.max_by(F.struct("topic", "partition", "offset", "event_id"), F.struct("offset", "partition")).alias("_r")).select("user_id", "_r.*")


#: A rule document over the driver's tables, with a strict and a lenient profile.
RULES = {
    "schema_version": "v1",
    "profiles": {
        "strict": {"allow_empty": False, "empty_severity": "error", "fail_severities": ["error"]},
        "lenient": {"allow_empty": True, "empty_severity": "warning", "fail_severities": ["error"], "overrides": {"orders_keys": {"max_duplicates": 10**9}, "orders_age": {"severity": "warning"}}},
    },
    "rules": [
        {"id": "orders_schema", "kind": "schema", "table": "orders", "required_columns": {"o_orderkey": "*", "o_totalprice": "double", "o_missing": "*"}, "severity": "warning"},
        {"id": "orders_keys", "kind": "unique_key", "table": "orders", "columns": ["o_custkey"], "max_duplicates": 0},
        {"id": "orders_states", "kind": "partitions", "table": "orders", "columns": ["o_orderstatus"], "min_partitions": 2},
        {"id": "orders_there", "kind": "table_empty", "table": "orders", "min_rows": 1},
        {"id": "nothing_there", "kind": "table_empty", "table": "nothing", "min_rows": 1},
        {"id": "orders_known", "kind": "completeness", "table": "orders", "columns": ["o_custkey", "status"], "min_rate": 0.9},
        {"id": "lines_per_order", "kind": "volume_ratio", "upstream_table": "orders", "downstream_table": "lineitem", "min_ratio": 1.0, "max_ratio": 7.0},
        {"id": "orders_grow", "kind": "volume_history", "table": "orders", "runs": 3, "min_ratio": 0.8, "max_ratio": 1.2},
        {"id": "orders_age", "kind": "freshness", "table": "orders", "timestamp_column": "o_orderdate", "max_age_minutes": 60},
        {"id": "absent", "kind": "table_empty", "table": "absent", "min_rows": 1, "severity": "warning"},
    ],
}


def rule_history(spark: SparkSession, sf: str) -> DataFrame:
    """The rules over half of the orders and then, twice, over all of them; the history has each run once."""
    path = new_path(spark, "quality")
    orders = b.table(spark, sf, "orders").withColumn("status", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    frames = {"orders": orders.where("o_orderkey % 2 = 0"), "lineitem": b.table(spark, sf, "lineitem"), "nothing": orders.limit(0)}
    at = lambda hour: F.lit(f"1999-01-01 0{hour}:00:00").cast("timestamp")
    rulebook.run_and_store(spark, rulebook.parsed(RULES, "strict"), frames, at(1), "first", path)
    for _ in range(2):
        rulebook.run_and_store(spark, rulebook.parsed(json.dumps(RULES), "lenient"), {**frames, "orders": orders}, at(2), "second", path)
    return t.stored(spark, path).select("result_id", "run_id", "rule_id", "severity", "table_name", F.round("metric_value", 6).alias("metric_value"), "row_count", "status", "message", "fails_run")


QUERIES = {
    "s5_s6_p1_p2_decode": decode, "p3_k1_dead_letters": dead_letters, "a6_dead_letter_report": dead_letter_report, "s7_framed": framed, "w1_collapse": collapse, "k4_k5_upsert": upsert, "r8_upsert_observed": upsert_observed, "k3_k10_k13_insert_new": insert_new, "k6_update_only": update_only, "k7_replace_latest": replace_latest,
    "k8_null_safe_merge": null_safe, "k11_k12_backfill_delete": backfill_delete, "a4_a5_j1_j2_b19_reconcile": reconcile, "t2_repair_set": repair, "j5_k18_theta_join": theta, "b18_f49_u5_quality_rules": rules, "b18_rule_history": rule_history, "a7_completeness": complete, "p19_p21_violations": audits, "p24_one_lineage": lineage, "a39_replay": replay, "b10_p11_f27_f28_versions": versions, "w10_latest_raw": latest_raw,
}

_DECODED = """, d AS (SELECT topic, "partition", "offset", value AS raw, json_valid(value) AS ok, CASE WHEN json_valid(value) THEN value END AS j FROM event_log),
f AS (SELECT *, CASE WHEN NOT ok THEN 'malformed_json' END AS decode_error, (j ->> '$.event_id')::BIGINT AS event_id, (j ->> '$.user_id')::BIGINT AS user_id, j ->> '$.event_type' AS event_type, (j ->> '$.value')::BIGINT AS value FROM d),
g AS (SELECT *, CASE WHEN NOT ok THEN 'malformed_json' WHEN user_id IS NULL THEN 'missing_user_id' WHEN event_type IS NULL THEN 'missing_event_type' WHEN event_type = 'error' THEN 'collector_error' WHEN value < 0 THEN 'negative_value' END AS reason FROM f)"""
_UPDATES = """u AS (SELECT 'x' AS source, CASE WHEN user_id % 10 <> 0 THEN user_id::VARCHAR END AS platform_event_id, user_id, 'u' || user_id AS url, '2024' AS event_ts, event_id, ts AS updated_at, CASE WHEN event_id % 3 <> 0 THEN floor(value)::BIGINT END AS amount, CASE WHEN event_id % 4 = 0 THEN props END AS props,
  CASE WHEN event_id % 2 = 0 THEN ['pending', 'success', 'failed', 'disabled', 'failed'][event_id % 5 + 1] END AS metadata_status, event_id % 13 AS attempt_count FROM events)"""
_COLLAPSE = lambda where: f"""SELECT any_value(source) AS source, any_value(platform_event_id) AS platform_event_id, user_id, any_value(url) AS url, any_value(event_ts) AS event_ts, max(CASE WHEN r = 1 THEN event_id END) AS event_id, max(updated_at) AS updated_at, arg_max(amount, r2) FILTER (amount IS NOT NULL) AS amount, arg_max(props, r2) FILTER (props IS NOT NULL) AS props,
  arg_max(metadata_status, r2) FILTER (metadata_status IS NOT NULL) AS metadata_status, arg_max(attempt_count, r2) AS attempt_count FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, event_id DESC) AS r, row_number() OVER (PARTITION BY user_id ORDER BY updated_at, event_id) AS r2 FROM u WHERE {where}) GROUP BY user_id"""  # noqa: E731
_STATUS = "CASE WHEN s.metadata_status = 'success' THEN 'success' WHEN t.metadata_status IN ('success', 'not_available', 'disabled') THEN t.metadata_status ELSE coalesce(s.metadata_status, t.metadata_status) END"
_JOURNAL = "journal AS (SELECT event_id, event_type AS source, ts AS ingested_at FROM events), proofs AS (SELECT CASE WHEN event_id % 50 = 1 THEN -event_id ELSE event_id END AS event_id FROM events WHERE event_id % 9 <> 0)"
SQL = {
    "s5_s6_p1_p2_decode": with_("event_log", _DECODED + ' SELECT topic, "partition", "offset", decode_error, event_id, user_id, event_type, value, reason FROM g'),
    "p3_k1_dead_letters": with_("event_log", _DECODED + """ SELECT topic, "partition", "offset", reason, '{"redacted":true,"byte_length":' || octet_length(encode(raw)) || ',"sha256":"' || sha256(raw) || '"}' AS payload FROM g WHERE reason IS NOT NULL"""),
    "a6_dead_letter_report": with_("event_log", _DECODED + " SELECT reason, count(*) AS n FROM g WHERE reason IS NOT NULL GROUP BY reason"),
    "s7_framed": "SELECT event_id AS n, CASE WHEN event_id % 3 < 2 THEN event_id::VARCHAR END AS event_id, CASE WHEN event_id % 3 = 1 THEN event_type END AS k, CASE WHEN event_id % 3 = 2 THEN 'unregistered_writer_schema' END AS decode_error FROM events",
    "w1_collapse": f"WITH {_UPDATES} {_COLLAPSE('true')}",
    "k4_k5_upsert": f"""WITH {_UPDATES}, t AS ({_COLLAPSE('user_id % 3 = 2 OR (user_id % 3 = 0 AND event_id % 7 < 4)')}), s AS ({_COLLAPSE('user_id % 3 = 1 OR (user_id % 3 = 0 AND event_id % 7 >= 4)')})
SELECT coalesce(s.source, t.source) AS source, coalesce(s.platform_event_id, t.platform_event_id) AS platform_event_id, coalesce(s.user_id, t.user_id) AS user_id, coalesce(s.url, t.url) AS url, coalesce(s.event_ts, t.event_ts) AS event_ts, coalesce(s.event_id, t.event_id) AS event_id, greatest(s.updated_at, t.updated_at) AS updated_at,
  coalesce(s.amount, t.amount) AS amount, coalesce(s.props, t.props) AS props, {_STATUS} AS metadata_status, greatest(s.attempt_count, t.attempt_count) AS attempt_count FROM t FULL JOIN s ON t.user_id = s.user_id""",
    "r8_upsert_observed": f"""WITH {_UPDATES}, t AS ({_COLLAPSE('event_id % 7 < 4')}), s AS ({_COLLAPSE('event_id % 7 >= 4')})
SELECT coalesce(s.platform_event_id, t.platform_event_id) AS platform_event_id, coalesce(s.user_id, t.user_id) AS user_id, CASE WHEN s.updated_at < t.updated_at THEN coalesce(t.amount, s.amount) ELSE coalesce(s.amount, t.amount) END AS amount, greatest(s.updated_at, t.updated_at) AS updated_at, greatest(s.attempt_count, t.attempt_count) AS attempt_count, {_STATUS} AS metadata_status FROM t FULL JOIN s ON t.user_id = s.user_id""",
    "k3_k10_k13_insert_new": "SELECT event_id, user_id, CASE WHEN event_id % 2 <> 0 THEN 'new' END AS note FROM events",
    "k6_update_only": "SELECT c_custkey, c_name, coalesce(m, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) FILTER (o_orderstatus = 'F') AS m FROM orders GROUP BY 1) ON c_custkey = o_custkey",
    "k7_replace_latest": "SELECT p_partkey, p_brand, CASE WHEN p_partkey % 5 = 0 THEN p_retailprice * 2 ELSE p_retailprice END AS p_retailprice FROM part",
    "k8_null_safe_merge": "SELECT nullif(p_partkey, 0) AS key, CASE WHEN p_partkey % 4 = 0 THEN 'new' WHEN p_partkey % 3 <> 1 THEN p_brand END AS p_brand FROM part",
    "k11_k12_backfill_delete": "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus ELSE lower(o_orderpriority) END AS status, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'",
    "a4_a5_j1_j2_b19_reconcile": f"""WITH {_JOURNAL}, lost AS (SELECT * FROM journal ANTI JOIN proofs USING (event_id)), orphan AS (SELECT * FROM proofs ANTI JOIN journal USING (event_id))
SELECT (SELECT count(*) FROM journal) AS journal_events, (SELECT count(*) FROM proofs) AS proofs, (SELECT count(*) FROM lost) AS missing, (SELECT max(epoch(TIMESTAMP '2024-02-01')::BIGINT - floor(epoch(ingested_at))::BIGINT) FROM lost) AS oldest_missing_seconds, (SELECT count(*) FROM orphan) AS orphans,
  (SELECT count(*) - count(DISTINCT event_id) FROM journal) AS journal_duplicates, (SELECT count(*) - count(DISTINCT event_id) FROM proofs) AS proof_duplicates, false AS is_clean, (SELECT count(*) FROM lost WHERE source = 'view') AS missing_views""",
    "t2_repair_set": f"WITH {_JOURNAL} SELECT * FROM journal ANTI JOIN proofs USING (event_id) ORDER BY ingested_at, event_id LIMIT 50",
    "j5_k18_theta_join": f"WITH {_UPDATES}, s AS ({_COLLAPSE('true')}) SELECT u.event_id, s.event_id AS state_event_id FROM u JOIN s ON u.platform_event_id = s.platform_event_id OR (u.platform_event_id IS NULL AND s.platform_event_id IS NULL AND u.user_id = s.user_id AND u.url = s.url)",
    "b18_rule_history": r"""WITH o AS (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders), runs(run_id, profile, lenient, half, seen) AS (VALUES ('first', 'strict', false, true, TIMESTAMP '1999-01-01 01:00:00'), ('second', 'lenient', true, false, TIMESTAMP '1999-01-01 02:00:00')),
m AS (SELECT run_id, profile, lenient, seen, count(*) AS n, count(DISTINCT o_custkey) AS custs, count(DISTINCT o_orderstatus) AS states, count(status) AS known, max(o_orderdate) AS newest FROM runs JOIN o ON NOT half OR o_orderkey % 2 = 0 GROUP BY ALL),
v AS (SELECT run_id, profile, lenient, r.* FROM m, LATERAL (SELECT unnest([
  {'rule_id': 'orders_schema', 'severity': 'warning', 'table_name': 'orders', 'metric_value': 1.0::DOUBLE, 'row_count': n, 'ok': false, 'message': NULL::VARCHAR},
  {'rule_id': 'orders_keys', 'severity': 'error', 'table_name': 'orders', 'metric_value': (n - custs)::DOUBLE, 'row_count': n, 'ok': lenient OR n = custs, 'message': NULL},
  {'rule_id': 'orders_states', 'severity': 'error', 'table_name': 'orders', 'metric_value': states::DOUBLE, 'row_count': n, 'ok': states >= 2, 'message': NULL},
  {'rule_id': 'orders_there', 'severity': 'error', 'table_name': 'orders', 'metric_value': n::DOUBLE, 'row_count': n, 'ok': true, 'message': NULL},
  {'rule_id': 'nothing_there', 'severity': CASE WHEN lenient THEN 'warning' ELSE 'error' END, 'table_name': 'nothing', 'metric_value': 0.0, 'row_count': 0, 'ok': false, 'message': 'nothing to measure'},
  {'rule_id': 'orders_known', 'severity': 'error', 'table_name': 'orders', 'metric_value': known / n, 'row_count': n, 'ok': known / n >= 0.9, 'message': NULL},
  {'rule_id': 'lines_per_order', 'severity': 'error', 'table_name': 'orders->lineitem', 'metric_value': (SELECT count(*) FROM lineitem) / n, 'row_count': n, 'ok': (SELECT count(*) FROM lineitem) / n BETWEEN 1 AND 7, 'message': NULL},
  {'rule_id': 'orders_grow', 'severity': 'error', 'table_name': 'orders', 'metric_value': CASE WHEN lenient THEN n / (SELECT n FROM m WHERE NOT lenient) ELSE 1.0 END, 'row_count': n, 'ok': NOT lenient OR n / (SELECT n FROM m WHERE NOT lenient) BETWEEN 0.8 AND 1.2, 'message': NULL},
  {'rule_id': 'orders_age', 'severity': CASE WHEN lenient THEN 'warning' ELSE 'error' END, 'table_name': 'orders', 'metric_value': greatest(0, (floor(epoch(seen)) - floor(epoch(newest))) / 60), 'row_count': n, 'ok': greatest(0, (floor(epoch(seen)) - floor(epoch(newest))) / 60) <= 60, 'message': NULL},
  {'rule_id': 'absent', 'severity': 'warning', 'table_name': 'absent', 'metric_value': NULL, 'row_count': NULL, 'ok': false, 'message': 'no table absent'}], recursive := true)) r)
SELECT sha256(run_id || chr(31) || profile || chr(31) || rule_id) AS result_id, run_id, rule_id, severity, table_name, round(metric_value, 6) AS metric_value, row_count,
  CASE WHEN ok THEN 'passed' WHEN rule_id = 'nothing_there' AND lenient THEN 'anomaly' ELSE 'failed' END AS status, message, NOT ok AND severity = 'error' AS fails_run FROM v""",
    "b18_f49_u5_quality_rules": """WITH v AS (SELECT * FROM (VALUES ('r1', 'schema', 'error', 'orders', 1.0::DOUBLE, 0.0::DOUBLE), ('r2', 'unique_key', 'error', 'orders', (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders)::DOUBLE, 0.0), ('r3', 'completeness', 'error', 'events', (SELECT least(avg((props IS NOT NULL)::INT), avg((value IS NOT NULL)::INT)) FROM events), 0.99),
  ('r4', 'volume_ratio', 'warning', 'orders', (SELECT (SELECT count(*) FROM orders) / (SELECT count(*) FROM events)), 0.5), ('r5', 'freshness', 'error', 'events', (SELECT epoch(TIMESTAMP '2024-02-01') - floor(epoch(max(ts))) FROM events), 86400.0), ('r6', 'partitions', 'error', 'events', (SELECT count(DISTINCT event_type) FROM events)::DOUBLE, 6.0), ('r7', 'table_empty', 'error', 'events', 1.0, 1.0),
  ('r8', 'orphan_files', 'error', 'events', (SELECT count(*) FROM orders WHERE o_orderkey % 50 >= 40)::DOUBLE, 0.0)) x(rule_id, kind, severity, table_name, value, threshold)),
p AS (SELECT *, CASE WHEN kind IN ('partitions', 'table_empty', 'completeness', 'volume_ratio') THEN value >= threshold ELSE value <= threshold END AS passed FROM v)
SELECT rule_id, kind, severity, table_name, round(value, 6) AS value, threshold, passed, NOT passed AND severity = 'error' AS fails_run, sha256('run' || chr(31) || rule_id || chr(31) || table_name) AS result_id FROM p""",
    "a7_completeness": f"WITH {_UPDATES} SELECT count(*) AS n, avg((amount IS NOT NULL)::INT) AS amount_rate, avg((props IS NOT NULL)::INT) AS props_rate, avg((metadata_status IS NOT NULL)::INT) AS metadata_status_rate, least(avg((amount IS NOT NULL)::INT), avg((props IS NOT NULL)::INT), avg((metadata_status IS NOT NULL)::INT)) AS least_rate FROM u",
    "p19_p21_violations": f"""WITH {_UPDATES}, v AS (SELECT list_filter([CASE WHEN platform_event_id IS NULL THEN 'has_id' END, CASE WHEN NOT coalesce(amount >= 10, false) THEN 'amount_positive' END, CASE WHEN metadata_status IS NULL THEN 'status_known' END, CASE WHEN attempt_count >= 12 THEN 'attempts' END], lambda x: x IS NOT NULL) AS l FROM u)
SELECT violation, count(*) AS n FROM (SELECT unnest(CASE WHEN len(l) = 0 THEN [NULL] ELSE l END) AS violation FROM v) GROUP BY violation""",
    "p24_one_lineage": f"WITH {_UPDATES} SELECT count(DISTINCT source) AS source_values, count(DISTINCT event_ts) AS event_ts_values, count(*) AS n, 0::BIGINT AS source_missing, 0::BIGINT AS event_ts_missing, true AS is_one FROM u",
    "a39_replay": "SELECT count(*) AS n, count(*) FILTER (c_custkey % 100 = 7) AS unmatched, 0.5::DOUBLE AS largest_difference, count(*) FILTER (c_custkey % 100 = 7) AS label_changes, false AS agrees FROM customer",
    "b10_p11_f27_f28_versions": """WITH k AS (SELECT *, floor((props ->> '$.k')::BIGINT / 25)::BIGINT AS k FROM events), g AS (SELECT *, CASE WHEN event_type = 'error' THEN 'error' ELSE 'fine' END AS kind, CASE WHEN k > 1 THEN ['a', 'b c'] ELSE ['a'] END AS tags FROM k),
  h AS (SELECT *, sha256('{"k":' || k || ',"kind":"' || kind || '","tags":[' || CASE WHEN k > 1 THEN '"a","b c"' ELSE '"a"' END || ']}') AS metadata_hash FROM g),
  l AS (SELECT *, lag(metadata_hash) OVER w AS previous_hash, lag(k) OVER w AS pk, lag(kind) OVER w AS pkind, lag(tags) OVER w AS ptags FROM h WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, ts AS valid_from, event_id, k, tags, metadata_hash, previous_hash, list_filter([CASE WHEN k IS DISTINCT FROM pk THEN 'k' END, CASE WHEN kind IS DISTINCT FROM pkind THEN 'kind' END, CASE WHEN tags IS DISTINCT FROM ptags THEN 'tags' END], lambda x: x IS NOT NULL) AS changed FROM l WHERE previous_hash IS NULL OR previous_hash <> metadata_hash""",
    "w10_latest_raw": with_("event_log", _DECODED + ' SELECT user_id, topic, "partition", "offset", event_id FROM g WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY "offset" DESC, "partition" DESC) = 1'),
}
