"""Rules over tables: schema, keys, completeness, freshness, volume, files; reconciliation and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.identity import result_id

KINDS = ("schema", "unique_key", "partitions", "table_empty", "completeness", "volume_ratio", "freshness", "orphan_files")


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A4: rows beyond the first of each key, as one number."""
    return rows.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates"))


def completeness(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Each column's share of known values, and the least."""
    rates = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(c).isNotNull().cast("double")).alias(f"{c}_rate") for c in columns])
    return rates.withColumn("least_rate", F.least(*[F.col(f"{c}_rate") for c in columns]) if len(columns) > 1 else F.col(f"{columns[0]}_rate"))


def missing(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` without a partner in ``b``."""
    return a.join(b.select(key), key, "left_anti")


def reconciliation(journal: DataFrame, proofs: DataFrame, now: Column, key: str = "event_id", source: str = "source", at: str = "ingested_at") -> DataFrame:
    """One row of totals: missing and orphan proofs, duplicates, the oldest gap's age, missing by source, whether all is clean."""
    lost, orphans = missing(journal, proofs, key), missing(proofs, journal, key)
    by = lost.groupBy(source).count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(source, "count")))).alias("missing_by_source"))
    totals = (
        journal.agg(F.count(F.lit(1)).alias("journal_events"))
        .crossJoin(proofs.agg(F.count(F.lit(1)).alias("proofs")))  # rows of totals, one each
        .crossJoin(lost.agg(F.count(F.lit(1)).alias("missing"), F.max(F.unix_timestamp(now) - F.unix_timestamp(at)).alias("oldest_missing_seconds")))
        .crossJoin(orphans.agg(F.count(F.lit(1)).alias("orphans")))
        .crossJoin(duplicates(journal, [key]).withColumnRenamed("duplicates", "journal_duplicates"))
        .crossJoin(duplicates(proofs, [key]).withColumnRenamed("duplicates", "proof_duplicates"))
        .crossJoin(by)
    )
    clean = reduce(lambda x, y: x & y, [F.col(c) == 0 for c in ("missing", "orphans", "journal_duplicates", "proof_duplicates")])
    return totals.withColumn("is_clean", clean)


def repair_set(journal: DataFrame, proofs: DataFrame, limit: int, key: str = "event_id", at: str = "ingested_at") -> DataFrame:
    """The oldest unproved events."""
    return missing(journal, proofs, key).orderBy(at, key).limit(limit)


def check(rule: dict, rows: DataFrame, now: Column, baseline: DataFrame | None = None, files: DataFrame | None = None) -> DataFrame:
    """One rule's measured value against its limit, as a row of rule_id, kind, severity, value, threshold, passed."""
    kind, limit = rule["kind"], rule.get("threshold")
    if kind not in KINDS:
        raise ValueError(f"no such kind of rule: {kind}")
    if kind == "schema":
        lacking = [c for c in rule["columns"] if c not in rows.columns]
        value, limit = rows.sparkSession.range(1).select(F.lit(float(len(lacking))).alias("value")), 0.0
    elif kind == "unique_key":
        value, limit = duplicates(rows, rule["columns"]).select(F.col("duplicates").cast("double").alias("value")), limit or 0.0
    elif kind == "partitions":
        value = rows.agg(F.count_distinct(*rule["columns"]).cast("double").alias("value"))
    elif kind == "table_empty":
        value, limit = rows.limit(1).agg(F.count(F.lit(1)).cast("double").alias("value")), 1.0
    elif kind == "completeness":
        value = completeness(rows, rule["columns"]).select(F.col("least_rate").alias("value"))
    elif kind == "volume_ratio":
        n = lambda df, name: df.agg(F.count(F.lit(1)).cast("double").alias(name))
        value = n(rows, "a").crossJoin(n(baseline, "b")).select(F.try_divide("a", "b").alias("value"))  # rows of totals, one each
    elif kind == "freshness":
        value = rows.agg((F.unix_timestamp(now) - F.unix_timestamp(F.max(rule["columns"][0]))).cast("double").alias("value"))
    else:
        value, limit = orphan_files(files, rows, rule["columns"][0]).agg(F.count(F.lit(1)).cast("double").alias("value")), limit or 0.0
    low = kind in ("partitions", "table_empty", "completeness", "volume_ratio")
    passed = F.coalesce(F.col("value") >= limit if low else F.col("value") <= limit, F.lit(bool(rule.get("allow_empty"))))
    return value.select(F.lit(rule["id"]).alias("rule_id"), F.lit(kind).alias("kind"), F.lit(rule.get("severity", "error")).alias("severity"), "value", F.lit(float(limit)).alias("threshold"), passed.alias("passed"))


def run_rules(rules: list[dict], tables: dict[str, DataFrame], now: Column, run_id: str, fail_on: tuple[str, ...] = ("error",)) -> DataFrame:
    """All rules' results with an id each, and whether a failure counts."""
    rows = [check(r, tables[r["table"]], now, tables.get(r.get("baseline")), tables.get(r.get("files"))).withColumn("table_name", F.lit(r["table"])) for r in rules]
    both = reduce(DataFrame.unionByName, rows)
    return both.withColumns({"result_id": result_id(F.lit(run_id), F.col("rule_id"), F.col("table_name")), "fails_run": ~F.col("passed") & F.col("severity").isin(*fail_on)})


def orphan_files(listed: DataFrame, referenced: DataFrame, path: str) -> DataFrame:
    """Listed files that nothing refers to, paths compared without scheme or doubled slashes."""
    plain = lambda c: F.regexp_replace(F.regexp_replace(c, r"^[a-z0-9]+:/*", "/"), "/+", "/")
    return listed.withColumn("_p", plain(F.col(path))).join(referenced.select(plain(F.col(path)).alias("_p")).distinct(), "_p", "left_anti").drop("_p")


def violations(**checks: Column) -> Column:
    """The names of the checks that do not hold; a check that cannot be decided does not hold."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]), lambda x: x.isNotNull())


def one_lineage(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Whether all rows share one value in each column, none missing."""
    return rows.agg(*[F.count_distinct(c).alias(f"{c}_values") for c in columns], F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in columns]).withColumn("is_one", reduce(lambda x, y: x & y, [(F.col(f"{c}_values") == 1) & (F.col(f"{c}_missing") == 0) for c in columns]))


def replay_difference(a: DataFrame, b: DataFrame, key: str, score: str, label: str, tolerance: float = 1e-9) -> DataFrame:
    """Whether two runs agree: equal ids, scores within ``tolerance``, equal labels."""
    x, y = a.select(key, F.col(score).alias("_a"), F.col(label).alias("_la")), b.select(key, F.col(score).alias("_b"), F.col(label).alias("_lb"))
    joined = x.withColumn("_in_a", F.lit(True)).join(y.withColumn("_in_b", F.lit(True)), key, "full_outer")
    sums = joined.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_in_a").isNull() | F.col("_in_b").isNull()).alias("unmatched"), F.max(F.abs(F.col("_a") - F.col("_b"))).alias("largest_difference"), F.count_if(~F.col("_la").eqNullSafe(F.col("_lb"))).alias("label_changes"))
    return sums.withColumn("agrees", (F.col("unmatched") == 0) & (F.col("label_changes") == 0) & (F.coalesce(F.col("largest_difference"), F.lit(0.0)) <= tolerance))
