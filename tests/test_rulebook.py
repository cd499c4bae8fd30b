"""Rule documents, profiles and the history of their results."""

import copy

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rulebook, tables

DOC = {
    "schema_version": "v1",
    "profiles": {"standard": {"allow_empty": False, "empty_severity": "error", "fail_severities": ["error"]}, "open": {"allow_empty": True, "empty_severity": "warning", "fail_severities": ["error"], "overrides": {"grow": {"max_ratio": 9.0}}}},
    "rules": [{"id": "keys", "kind": "unique_key", "table": "t", "columns": ["id"], "max_duplicates": 1}, {"id": "grow", "kind": "volume_history", "table": "t", "runs": 2, "min_ratio": 0.5, "max_ratio": 1.5}, {"id": "files", "kind": "orphan_files", "table": "t", "files_table": "f", "path_column": "p", "max_orphans": 0}, {"id": "seen", "kind": "freshness", "table": "t", "timestamp_column": "at", "max_age_minutes": 90}],
}
NOW = lambda: F.lit("2024-01-01 02:00:00").cast("timestamp")


def results(df):
    return {r.rule_id: r for r in df.collect()}


@pytest.mark.parametrize(
    ("change", "message"),
    [({"schema_version": "v2"}, "schema_version"), ({"rules": [{"id": "a", "kind": "guess"}]}, "no kind"), ({"rules": [{"id": "a", "kind": "freshness", "table": "t"}]}, "timestamp_column"), ({"rules": [DOC["rules"][0]] * 2}, "repeated"), ({"rules": [{**DOC["rules"][1], "min_ratio": 2.0}]}, "crossed"), ({"rules": [{**DOC["rules"][0], "severity": "dire"}]}, "dire")],
)
def test_faulty_documents(change, message):
    with pytest.raises(ValueError, match=message):
        rulebook.parsed({**copy.deepcopy(DOC), **change}, "standard")


def test_profiles_and_history(spark, tmp_path):
    path = str(tmp_path / "h")
    t = lambda n: spark.range(n).select((F.col("id") % 8).alias("id"), F.lit("2024-01-01 01:00:00").alias("at"), F.lit("s3://b//x").alias("p"))
    f = spark.createDataFrame([("s3a://b/x",), ("/b/y",)], "p string")
    run = lambda n, name, profile="standard": results(rulebook.run_and_store(spark, rulebook.parsed(DOC, profile), {"t": t(n), "f": f}, NOW(), name, path))
    a = run(8, "r1")
    assert (a["keys"].status, a["keys"].metric_value, a["grow"].metric_value, a["files"].metric_value, a["files"].fails_run, a["seen"].metric_value) == ("passed", 0.0, 1.0, 1.0, True, 60.0)
    b = run(16, "r2")
    assert (b["keys"].status, b["keys"].metric_value, b["grow"].metric_value, b["grow"].status) == ("failed", 8.0, 2.0, "failed")
    c = run(24, "r3", "open")
    assert (c["grow"].metric_value, c["grow"].status) == (2.0, "passed")
    run(24, "r3", "open")
    assert tables.stored(spark, path).count() == 12


def test_nothing_to_measure_and_missing_parts(spark):
    empty = spark.createDataFrame([], "id long, at string")
    for profile, status, severity in (("standard", "failed", "error"), ("open", "anomaly", "warning")):
        got = results(rulebook.evaluated(spark, rulebook.parsed(DOC, profile), {"t": empty, "f": empty}, NOW(), "r"))
        assert (got["seen"].status, got["seen"].severity, got["seen"].fails_run) == (status, severity, severity == "error")
        assert got["files"].message == "no column p" and got["files"].status == "failed"
    got = results(rulebook.evaluated(spark, rulebook.parsed(DOC, "open"), {}, NOW(), "r"))
    assert all(r.status == "failed" and r.message == "no table t" and r.row_count is None for r in got.values())
