"""Texts of 1 MB that repeat what patterns repeat: no stack grows with them, and no search is quadratic."""

import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import annotate, upkeep

N = 1_000_000
TEXTS = {
    "mail": "x@" + "a." * (N // 2) + "com", "mails": "x@" + "com." * (N // 4), "tags": "#ab " * (N // 4), "joined": "#ab" * (N // 3), "open": "<a " * (N // 3), "ip": "1.1." * (N // 4), "brackets": "(" * N, "digits": "1 " * (N // 2),
    "words": "ab " * (N // 3), "at": "@" * N, "x@": "x@a." * (N // 4), "dash": "a-" * (N // 2) + "@", "www": "www." * (N // 4) + ")", "host": "https://" + "a." * (N // 2) + "ytimg.com/", "lines": "\n" * N, "dots": "." * N,
}
JOBS = {
    "clean_text": lambda d: d.select("name", F.col("t"), text.clean_text(F.col("t")).alias("out")),
    "model_text": lambda d: d.select("name", text.model_text(F.col("t")).alias("out")),
    "sanitised": lambda d: d.select("name", text.sanitised(F.col("t")).alias("out")),
    "noise_reason": lambda d: d.select("name", annotate.noise_reason(F.col("t")).alias("out")),
    "segments": lambda d: annotate.segments(d, "name", "t").groupBy("name").agg(F.count(F.lit(1)).alias("out")),
    "reading_effort": lambda d: text.with_reading_effort(d, "t").select("name", F.col("reading_effort").alias("out")),
    "text_counts": lambda d: d.select("name", text.text_counts("t", "t")["word_count"].alias("out")),
    "thumbnails": lambda d: upkeep.thumbnails(d.select(F.col("name").alias("content_id"), F.col("t").alias("thumbnail_url"), F.lit("v1").alias("video_id"), F.lit(1).alias("event_ts"))).select(F.col("content_id").alias("name"), F.lit(1).alias("out")),
}
WANT = {
    "clean_text": {"mail": "<EMAIL>", "at": "@" * N, "tags": ("#ab " * (N // 4)).strip(), "lines": "", "mails": "<EMAIL>."},
    "noise_reason": {"tags": "hashtag_only", "joined": "hashtag_only", "words": None},
    "text_counts": {"words": N // 3, "joined": 1, "lines": 0},
    "thumbnails": {"mail": 1},
}


@pytest.mark.parametrize("job", JOBS)
def test_long_texts(spark, job):
    rows = spark.createDataFrame(list(TEXTS.items()), "name string, t string").repartition(8).cache()
    rows.count()
    began = time.perf_counter()
    got = {r.name: r.out for r in JOBS[job](rows).select("name", "out").collect()}
    took = time.perf_counter() - began
    rows.unpersist()
    assert took < 5 * len(TEXTS) / 8 + 5
    for name, want in WANT.get(job, {}).items():
        assert got[name] == want, (name, str(got[name])[:50])


@pytest.mark.parametrize(
    ("segment", "noise"),
    [("#one #two #three", True), ("  #one#two\t#three  ", True), ("#one two #three", False), ("# one #two", False), ("#one # #two", False), ("##one ##", True)],
)
def test_hashtags(spark, segment, noise):
    got = spark.createDataFrame([(segment,)], "s string").select(annotate.noise_reason(F.col("s"))).first()[0]
    assert (got == "hashtag_only") == noise


def test_thumbnail_hosts_and_units(spark):
    hosts = {"https://i.ytimg.com/x": True, "https://ytimg.com/": True, "https://a.b-c.ggpht.com/": True, "https://evilytimg.com/": False, "https://a..ytimg.com/": False, "https://.ytimg.com/": False, "https://x.com/ytimg.com/": False, "http://i.ytimg.com/": False}
    rows = spark.createDataFrame([(h, h, "v", 1) for h in hosts], "content_id string, thumbnail_url string, video_id string, event_ts int")
    assert {r.content_id for r in upkeep.thumbnails(rows).collect()} == {h for h, safe in hosts.items() if not safe}
    units = ["5 kWh", "1.5.km", ".5kw", "5%.5%", "1,000 -  km 3", "12 12 v", "5 kwhx", "3..w 3w3w", "٣ km 7", "5-%"]
    got = spark.createDataFrame([(u,) for u in units], "u string").select("u", F.regexp_count("u", F.lit(text.UNITS)).alias("a"), F.regexp_count("u", F.lit(text.UNITS_ONCE)).alias("b")).collect()
    assert all(r.a == r.b for r in got) and sum(r.a for r in got) > 8
