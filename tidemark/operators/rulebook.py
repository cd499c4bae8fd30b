"""Quality rules as a document with profiles, run over tables and kept as a history.

A document is JSON: ``schema_version``, ``profiles`` by name (``allow_empty``, ``empty_severity``, ``fail_severities`` and, by rule id,
``overrides`` of rules' options) and ``rules``. All rules of a table that are totals over it are measured in one aggregation, its row count among
them; unique keys and files need one of their own. Results carry an id of run, profile and rule, so a run that is stored again adds nothing, and the
row counts they carry are what ``volume_history`` compares the next run with.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.identity import result_id
from tidemark.operators import tables
from tidemark.operators.quality import duplicates, orphan_files

VERSION = "v1"
SEVERITIES = ("info", "warning", "error")
#: Each kind's metric and the options it must have.
KINDS = {
    "schema": ("schema_errors", ("table", "required_columns")),
    "unique_key": ("duplicate_rows", ("table", "columns", "max_duplicates")),
    "partitions": ("partition_count", ("table", "columns", "min_partitions")),
    "table_empty": ("row_count", ("table", "min_rows")),
    "completeness": ("minimum_completeness_rate", ("table", "columns", "min_rate")),
    "volume_ratio": ("downstream_upstream_ratio", ("upstream_table", "downstream_table", "min_ratio", "max_ratio")),
    "volume_history": ("rows_to_history_ratio", ("table", "runs", "min_ratio", "max_ratio")),
    "freshness": ("freshness_age_minutes", ("table", "timestamp_column", "max_age_minutes")),
    "orphan_files": ("orphan_count", ("table", "files_table", "path_column", "max_orphans")),
}
RESULT = "result_id string, run_id string, profile string, rule_id string, kind string, severity string, table_name string, metric_name string, metric_value double, row_count long, status string, message string, fails_run boolean, observed_at timestamp, day date"


@dataclass(frozen=True)
class RuleBook:
    profile: str
    allow_empty: bool
    empty_severity: str
    fail_severities: tuple[str, ...]
    rules: tuple[dict, ...]


def parsed(document: str | Mapping, profile: str) -> RuleBook:
    """The rules of a document under one of its profiles; the first fault of the document is an error that names it."""
    doc = json.loads(document) if isinstance(document, str) else dict(document)
    if doc.get("schema_version") != VERSION:
        raise ValueError(f"schema_version must be {VERSION}")
    if profile not in doc.get("profiles", {}):
        raise ValueError(f"no profile {profile}")
    p = doc["profiles"][profile]
    severities = [p.get("empty_severity", "error"), *p.get("fail_severities", ["error"])]
    seen, rules, overrides = set(), [], p.get("overrides", {})
    for r in doc.get("rules", []):
        r = {"severity": "error", **r, **overrides.get(r.get("id"), {})}
        if not r.get("id") or r["id"] in seen:
            raise ValueError(f"rule id {r.get('id')!r} is missing or repeated")
        seen.add(r["id"])
        if r.get("kind") not in KINDS:
            raise ValueError(f"{r['id']}: no kind {r.get('kind')!r}")
        lacking = [o for o in KINDS[r["kind"]][1] if o not in r]
        if lacking:
            raise ValueError(f"{r['id']}: {', '.join(lacking)} missing")
        if r.get("min_ratio", 0) > r.get("max_ratio", float("inf")) or any(r.get(k, 0) < 0 for k in r if k.startswith(("min_", "max_"))):
            raise ValueError(f"{r['id']}: limits must not be negative or crossed")
        severities.append(r["severity"])
        rules.append(r)
    unknown = set(overrides) - seen
    if unknown or set(severities) - set(SEVERITIES):
        raise ValueError(f"unknown: {sorted(unknown | (set(severities) - set(SEVERITIES)))}")
    return RuleBook(profile, bool(p.get("allow_empty", False)), severities[0], tuple(p.get("fail_severities", ["error"])), tuple(rules))


def _table(rule: dict) -> str:
    return rule.get("table") or rule["upstream_table"]


def _needed(rule: dict) -> list[str]:
    one = [rule[k] for k in ("timestamp_column", "path_column") if k in rule]
    return [*rule.get("columns", []), *one]


def _total(rule: dict, rows: DataFrame, now: Column) -> Column | None:
    """A rule's metric as an aggregate over its table, where it is one."""
    kind, n = rule["kind"], F.count(F.lit(1))
    if kind == "schema":
        have = {f.name: f.dataType.simpleString() for f in rows.schema}
        return F.lit(float(sum(c not in have or t not in ("*", have[c]) for c, t in rule["required_columns"].items())))
    if kind == "partitions":
        return F.count_distinct(F.struct(*rule["columns"])).cast("double")
    if kind == "completeness":
        rates = [F.count(c) / F.when(n > 0, n) for c in rule["columns"]]
        return reduce(lambda a, b: F.when(b < a, b).otherwise(a), rates)
    if kind == "freshness":
        last = F.unix_timestamp(F.max(F.col(rule["timestamp_column"]).cast("timestamp")))
        return F.when(last.isNotNull(), F.greatest(F.lit(0.0), (F.unix_timestamp(now) - last) / 60.0))
    return n.cast("double") if kind in ("table_empty", "volume_ratio", "volume_history") else None


def _held(rule: dict, value: Column) -> Column:
    limits = {"schema": (0, 0), "unique_key": (0, rule.get("max_duplicates")), "orphan_files": (0, rule.get("max_orphans")), "freshness": (0, rule.get("max_age_minutes"))}
    low, high = limits.get(rule["kind"], (next((rule[k] for k in ("min_partitions", "min_rows", "min_rate", "min_ratio") if k in rule), 0), rule.get("max_ratio")))
    return (value >= low) & (value <= high if high is not None else F.lit(True))


def _seen_before(history: DataFrame | None, run_id: str, tables_of: dict[str, int], spark: SparkSession) -> dict[str, float]:
    """The mean row count of each table over its last runs, for tables that have some: a figure a table."""
    if history is None or not tables_of:
        return {}
    runs = history.where((F.col("run_id") != run_id) & F.col("table_name").isin(*tables_of) & (F.col("row_count") > 0)).groupBy("table_name", "run_id").agg(F.max("observed_at").alias("at"), F.max("row_count").alias("n"))
    return {t: sum(r["n"] for r in last) / len(last) for t, k in tables_of.items() if (last := runs.where(F.col("table_name") == t).orderBy(F.desc("at"), "run_id").limit(k).collect())}


def evaluated(spark: SparkSession, book: RuleBook, frames: Mapping[str, DataFrame], now: Column, run_id: str, history: DataFrame | None = None) -> DataFrame:
    """A row a rule (``RESULT``): passed, failed, or, where there is nothing to measure, what the profile says of empty tables.

    A table or column that is missing fails its rules with a message and stops nothing.
    """
    past = _seen_before(history, run_id, {r["table"]: r["runs"] for r in book.rules if r["kind"] == "volume_history"}, spark)
    parts = []
    for name in dict.fromkeys(_table(r) for r in book.rules):
        mine = [r for r in book.rules if _table(r) == name]
        rows = frames.get(name)
        measured, values, wrong = spark.range(1).select(F.lit(None).cast("long").alias("_n")), {}, {}
        for k, r in enumerate(mine):
            others = [r[o] for o in ("downstream_table", "files_table") if o in r]
            lost = [t for t in (name, *others) if t not in frames]
            lacking = [c for c in _needed(r) if rows is not None and c not in rows.columns]
            if lost or lacking:
                wrong[k] = f"no table {lost[0]}" if lost else f"no column {lacking[0]}"
            elif (total := _total(r, rows, now)) is not None:
                values[k] = total
        if rows is not None:
            measured = rows.agg(F.count(F.lit(1)).alias("_n"), *[v.alias(f"_v{k}") for k, v in values.items()])
        for k, r in enumerate(mine):  # one row each, beside the totals
            if k in wrong:
                measured = measured.withColumn(f"_v{k}", F.lit(None).cast("double"))
            elif r["kind"] == "unique_key":
                measured = measured.crossJoin(duplicates(rows, r["columns"]).select(F.col("duplicates").cast("double").alias(f"_v{k}")))
            elif r["kind"] == "orphan_files":
                measured = measured.crossJoin(orphan_files(frames[r["files_table"]], rows, r["path_column"]).agg(F.count(F.lit(1)).cast("double").alias(f"_v{k}")))
            elif r["kind"] == "volume_ratio":
                other = frames[r["downstream_table"]].agg(F.count(F.lit(1)).alias("_m"))
                measured = measured.crossJoin(other).withColumn(f"_v{k}", F.try_divide(F.col("_m").cast("double"), f"_v{k}")).drop("_m")
            elif r["kind"] == "volume_history":
                measured = measured.withColumn(f"_v{k}", F.when(F.col(f"_v{k}") > 0, F.col(f"_v{k}") / past[name] if name in past else F.lit(1.0)))
        results = []
        for k, r in enumerate(mine):
            value, label = F.col(f"_v{k}"), f"{name}->{r['downstream_table']}" if "downstream_table" in r else name
            empty = value.isNull() | ((F.col("_n") == 0) & F.lit(r["kind"] in ("partitions", "table_empty", "volume_history")))
            nothing = F.lit("anomaly" if book.allow_empty and k not in wrong else "failed")
            status = F.when(empty, nothing).when(_held(r, value), "passed").otherwise("failed")
            severity = F.when(empty & F.lit(k not in wrong), book.empty_severity).otherwise(r["severity"])
            message = F.lit(wrong.get(k)) if k in wrong else F.when(empty, "nothing to measure")
            results.append(F.struct(F.lit(r["id"]).alias("rule_id"), F.lit(r["kind"]).alias("kind"), severity.alias("severity"), F.lit(label).alias("table_name"), F.lit(KINDS[r["kind"]][0]).alias("metric_name"), value.alias("metric_value"), F.col("_n").alias("row_count"), status.alias("status"), message.cast("string").alias("message")))
        parts.append(measured.select(F.explode(F.array(*results)).alias("r")).select("r.*"))
    if not parts:
        return spark.createDataFrame([], RESULT)
    rows = reduce(DataFrame.unionByName, parts)
    rows = rows.withColumns({"run_id": F.lit(run_id), "profile": F.lit(book.profile), "observed_at": now, "day": F.to_date(now), "result_id": result_id(F.lit(run_id), F.lit(book.profile), F.col("rule_id"))})
    rows = rows.withColumn("fails_run", F.col("status").isin("failed", "anomaly") & F.col("severity").isin(*book.fail_severities))
    return rows.select(*[c.split()[0] for c in RESULT.split(", ")])


def run_and_store(spark: SparkSession, book: RuleBook, frames: Mapping[str, DataFrame], now: Column, run_id: str, path: str) -> DataFrame:
    """The results of one run, added to the history once; volumes are compared with what the history has of other runs."""
    results = tables.written(evaluated(spark, book, frames, now, run_id, tables.stored(spark, path)), "results")
    tables.append_new(results, path, "result_id", "day")
    return results
