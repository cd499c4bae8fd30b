"""Sums over ranges: the same as in one window, whatever the values, and no range holds much of a key."""

import math
import random

from pyspark.sql import functions as F

from tidemark.operators import reports


def _brute(values, down):
    out, kinds = {}, sorted(set(values), reverse=down)
    for v in kinds:
        out[v] = (sum(1 for x in values if (x > v if down else x < v)), len(values))
    return out


def test_sums_equal_those_of_one_window(spark):
    draw = random.Random(5)
    keys = {None: [draw.random() / 1000 for _ in range(700)], "a": [0.0] * 50 + [draw.gauss(0, 1e6) for _ in range(300)], "b": [3.5], "c": [float(draw.randint(-3, 3)) for _ in range(40)]}
    rows = spark.createDataFrame([(k, v) for k, vs in keys.items() for v in vs] + [("c", None)], "k string, v double")
    counts = rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    for down in (False, True):
        got = {(r.k, r.v): (r.n_before, r.n_all) for r in reports.running_sums(counts, ["k"], "v", ("n",), down).collect()}
        assert got == {(k, v): x for k, vs in keys.items() for v, x in _brute(vs, down).items()}
    whole = counts.where("k = 'a'").select("v", "n")
    assert {r.v: r.n_before for r in reports.running_sums(whole, [], "v", ("n",)).collect()} == {v: x[0] for v, x in _brute(keys["a"], False).items()}
    assert reports.running_sums(whole.limit(0), [], "v", ("n",)).count() == 0
    ends = spark.createDataFrame([(math.inf, 1), (math.nan, 2), (-math.inf, 4), (0.0, 8)], "v double, n int")
    assert {str(r.v): r.n_before for r in reports.running_sums(ends, [], "v", ("n",)).collect()} == {"-inf": 0, "0.0": 4, "inf": 12, "nan": 13}


def test_rates_fall_in_many_ranges(spark):
    rates = spark.range(50_000).select((F.rand(1) * 0.001).alias("v"))
    cuts = rates.agg(F.percentile_approx("v", [i / reports.RANGES for i in range(1, reports.RANGES)], 4 * reports.RANGES).alias("_cuts"))
    sizes = [r["count"] for r in rates.crossJoin(cuts).groupBy(reports._range_of(F.col("v"), F.col("_cuts"))).count().collect()]
    assert len(sizes) > 200 and max(sizes) < 50_000 / 64


def test_ranks_of_several_columns_in_one_pass(spark):
    rows = spark.createDataFrame([("p", 1, 0.5, 9), ("p", 2, 0.5, None), ("p", 3, 0.25, 7), ("q", 1, None, 7)], "k string, a int, b double, c long")
    got = {(r.k, r.a): (r.a_rank, r.b_rank, r.c_rank) for r in reports.average_ranks(rows, ("a", "b", "c"), "k").collect()}
    third = 1 / 3
    assert got == {("p", 1): (third, 2.5 / 3, 1.0), ("p", 2): (2 * third, 2.5 / 3, None), ("p", 3): (1.0, third, 0.5), ("q", 1): (1.0, None, 1.0)}
    assert reports.average_ranks(rows, ("a",)).columns == ["k", "a", "b", "c", "a_rank"]
