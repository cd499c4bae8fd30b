import re
import time

from pyspark.sql import functions as F

from tidemark.llm import pii

N = 1_000_000


def test_long_repeats_end_and_are_searched_whole(spark):
    texts = {"mail": "x@" + "a." * (N // 2) + "com", "labels": "x@" + "a.bc1." * (N // 6) + "1", "ip": "1.1." * (N // 4), "brackets": "(" * N, "tags": "#ab " * (N // 4), "dash": "a-" * (N // 2) + "@", "open": "<a " * (N // 3)}
    rows = spark.createDataFrame(list(texts.items()), "name string, text string").repartition(7)
    began = time.perf_counter()
    got = {r.name: r for r in pii.pseudonymised(rows, key="k").select("name", "pii_kinds", F.length("text").alias("n"), F.substring("text", 1, 40).alias("head")).collect()}
    assert time.perf_counter() - began < 35
    assert got["mail"].pii_kinds == ["email"] and got["labels"].pii_kinds == ["email"]
    for name, t in texts.items():
        assert got[name].n == len(t)
        assert name in ("mail", "labels") or (not got[name].pii_kinds and got[name].head == t[:40])


def test_addresses_end_as_before(spark):
    """The pattern with possessive groups finds what the plain one says."""
    plain = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
    texts = ["x@a.com", "x@a.com1", "x@a.b.c", "x@a.com.1 z", "x@a.1.com.2.org-x", "x@a..com", "x@a.com-x.b.net9.9", "x@-.co", "a@b@c.de", "x@a.c1.d2", "x@a.co.", "x@1.1.uk.", "no@where", "x@a.bc.d.ef.g"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.regexp_extract_all("t", F.lit(pii.PATTERNS["email"]), 0).alias("m")).collect()
    for r in found:
        assert r.m == re.findall(plain, r.t), r.t
