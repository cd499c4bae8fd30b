"""Crash and replay of the streaming stages."""

import json

import pytest
from pyspark.sql.utils import StreamingQueryException

from tidemark.functions.identity import salted
from tidemark.operators import tables
from tidemark.sources import topics
from tidemark.streaming import pipeline


def put(folder, name, *messages):
    folder.mkdir(exist_ok=True)
    rows = [{"topic": "t", "partition": 0, "offset": o, "timestamp": f"2024-01-01T00:00:{o:02d}", "value": v} for o, v in messages]
    (folder / name).write_text("\n".join(map(json.dumps, rows)))


def event(i, user, value):
    return json.dumps({"event_id": i, "user_id": user, "event_type": "view", "value": value})


def state(spark, base):
    return sorted((r.event_id, r.value) for r in tables.stored(spark, f"{base}/state").collect())


def run(spark, folder, base, version="v1"):
    pipeline.journal(topics.topic_stream(spark, str(folder)), base, pipeline.checkpoint_name(base, "journal", "t", version), "salt").awaitTermination()


def test_crash_replay_and_versions(spark, tmp_path, monkeypatch):
    folder, base = tmp_path / "topic", str(tmp_path / "lake")
    put(folder, "a.json", (1, event(1, 7, 1)), (2, event(2, 7, 2)), (3, event(1, 7, 1)), (4, '{"event_id":9,"secret":"hush'), (5, event(3, 8, 5)))
    monkeypatch.setenv("TIDEMARK_TEST_MODE", "1")
    for point in ("after_dead_letters", "after_journal"):
        monkeypatch.setenv("TIDEMARK_FAULT", point)
        with pytest.raises(StreamingQueryException):
            run(spark, folder, base)
    monkeypatch.delenv("TIDEMARK_FAULT")
    run(spark, folder, base)
    journal, dead = (lambda name=name: tables.stored(spark, f"{base}/{name}") for name in ("journal", "dead"))
    assert sorted(r.event_id for r in journal().collect()) == [1, 2, 3] and dead().count() == 1
    # people are hashed before anything is stored, and of a broken message only size and hash remain
    from pyspark.sql import functions as F

    assert {r.user_id for r in journal().collect()} == {spark.range(1).select(salted("salt", F.lit(x))).first()[0] for x in ("7", "8")}
    assert "hush" not in str(dead().collect())
    monkeypatch.setenv("TIDEMARK_FAULT", "after_state")
    with pytest.raises(pipeline.CrashForTest):
        pipeline.apply_events(spark, base)
    monkeypatch.delenv("TIDEMARK_FAULT")
    assert pipeline.apply_events(spark, base) == 3 and pipeline.apply_events(spark, base) == 0
    assert state(spark, base) == [(2, 2), (3, 5)]
    put(folder, "b.json", (6, event(4, 8, None)), (7, event(0, 7, 0)))
    run(spark, folder, base)
    run(spark, folder, base, version="v2")  # a full replay adds nothing
    assert journal().count() == 5 and dead().count() == 1
    assert pipeline.apply_events(spark, base, since="2025-01-01") == 0  # older parts are left unread
    assert pipeline.apply_events(spark, base) == 2
    assert (4, 5) in state(spark, base)  # an unknown value leaves the known one
    assert sorted((r.event_id, r.value) for r in pipeline.rebuilt(spark, base).collect()) == state(spark, base)


def test_late_rows_are_dropped_beyond_the_watermark(spark, tmp_path):
    folder = str(tmp_path / "e")
    shape = "author string, source string, ts timestamp"
    out = tmp_path / "out"
    for k, rows in enumerate(([("a", "x", "2024-01-01 00:10:00"), ("a", "x", "2024-01-01 00:20:00"), ("a", "x", "2024-01-01 02:00:00")], [("a", "x", "2024-01-01 06:00:00")], [("a", "x", "2024-01-01 00:30:00"), ("a", "x", "2024-01-01 12:00:00")])):
        spark.createDataFrame(rows, shape.replace("timestamp", "string")).selectExpr("author", "source", "cast(ts as timestamp) ts").write.mode("append").parquet(folder)
        pipeline.to_table(pipeline.hourly(topics.table_stream(spark, folder), "ts", "source"), f"{out}/h", f"{out}/ch{0 * k}").awaitTermination()
        pipeline.to_table(pipeline.sessions(topics.table_stream(spark, folder), "ts", "author"), f"{out}/s", f"{out}/cs").awaitTermination()
    assert sorted((str(r.hour), r.n) for r in spark.read.parquet(f"{out}/h").collect()) == [("2024-01-01 00:00:00", 2), ("2024-01-01 02:00:00", 1), ("2024-01-01 06:00:00", 1)]
    assert sorted(r.n for r in spark.read.parquet(f"{out}/s").collect()) == [1, 1, 2]


def lines(folder, name, topic, *messages):
    """Messages of (offset, day of January, fields)."""
    folder.mkdir(exist_ok=True)
    rows = [{"topic": topic, "partition": 0, "offset": o, "timestamp": f"2024-01-{d:02d}T00:00:00", "value": v if isinstance(v, str) else json.dumps(v)} for o, d, v in messages]
    (folder / name).write_text("\n".join(map(json.dumps, rows)))


def test_an_id_is_once_in_all_days(spark, tmp_path, monkeypatch):
    folder, base = tmp_path / "topic", str(tmp_path / "lake")
    one = lambda i: {"event_id": i, "user_id": 7, "event_type": "view", "value": 1}
    lines(folder, "a.json", "t", (1, 2, one(1)), (2, 1, one(1)), (3, 1, one(2)), (4, 3, one(None)))
    monkeypatch.setenv("TIDEMARK_TEST_MODE", "1")
    monkeypatch.setenv("TIDEMARK_FAULT", "after_journal")
    with pytest.raises(StreamingQueryException):
        run(spark, folder, base)
    monkeypatch.delenv("TIDEMARK_FAULT")
    run(spark, folder, base)
    found = lambda: sorted((r.event_id, r.day.day, r.offset) for r in tables.stored(spark, f"{base}/journal").collect())
    assert found() == [(1, 1, 2), (2, 1, 3)]
    lines(folder, "b.json", "t", (5, 9, one(1)), (6, 4, one(2)), (7, 4, one(3)))
    run(spark, folder, base)
    run(spark, folder, base, version="v2")
    assert found() == [(1, 1, 2), (2, 1, 3), (3, 4, 7)]
    assert pipeline.apply_events(spark, base) == 3 and pipeline.apply_events(spark, base) == 0
    tables.compacted_keys(spark, f"{base}/journal", "event_id")
    run(spark, folder, base, version="v3")
    assert len(found()) == 3


def test_a_key_that_was_claimed_but_not_written_is_written_by_any_replay(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "j")
    rows = lambda *x: spark.createDataFrame(list(x), "id long, day int, v string")
    real = tables.append_new
    monkeypatch.setattr(tables, "append_new", lambda *a: (_ for _ in ()).throw(pipeline.CrashForTest()))
    with pytest.raises(pipeline.CrashForTest):
        tables.append_once(rows((1, 1, "a"), (1, 2, "b")), path, "id", "day")
    monkeypatch.setattr(tables, "append_new", real)
    tables.append_once(rows((1, 2, "b"), (2, 2, "c")), path, "id", "day")  # another batch after a restart: not this row's part
    tables.append_once(rows((1, 1, "a")), path, "id", "day")
    tables.append_once(rows((1, 1, "a"), (1, 2, "b"), (2, 5, "c"), (None, 1, "x")), path, "id", "day")
    assert sorted((r.id, r.day, r.v) for r in tables.stored(spark, path).collect()) == [(1, 1, "a"), (2, 2, "c")]


def test_state_survives_a_write_that_stops(spark, tmp_path):
    from pyspark.sql import functions as F

    path, shape = str(tmp_path / "s"), "source string, platform_event_id string, user_id string, url string, event_ts string, n int"
    first = spark.createDataFrame([("x", str(i), "u", "l", "t", i) for i in range(20)], shape)
    for k in range(3):
        tables.upsert(first.withColumn("n", F.col("n") + k), path, tables.identity(), buckets=4)
    assert sorted(r.n for r in tables.stored(spark, path).collect()) == list(range(2, 22))
    import shutil

    live = {(r.bucket, r.slot) for r in tables._live(tables._files(spark, path)).collect()}
    bucket, slot = min(live)
    shutil.rmtree(f"{path}/bucket={bucket}/slot={1 - slot}")  # a write into the idle slots that was stopped
    assert sorted(r.n for r in tables.stored(spark, path).collect()) == list(range(2, 22))


def test_stored_tells_a_missing_table_from_a_broken_one(spark, tmp_path):
    assert tables.stored(spark, str(tmp_path / "none")) is None
    (tmp_path / "empty").mkdir()
    assert tables.stored(spark, str(tmp_path / "empty")) is None
    spark.range(3).selectExpr("id", "1 as a").write.parquet(f"{tmp_path}/clash/p=1")
    spark.range(3).selectExpr("cast(id as string) as id", "array(1) as a").write.parquet(f"{tmp_path}/clash/p=2")
    with pytest.raises(Exception, match="CANNOT_MERGE"):
        tables.stored(spark, f"{tmp_path}/clash")


def test_snapshots_stand_by_number(spark, tmp_path):
    path = str(tmp_path / "n")
    for n in (9, 10):
        tables.snapshot(spark.range(n), path, str(n))
    assert tables.pinned(spark, path).count() == 10 and tables.pinned(spark, path, "9").count() == 9
    times = str(tmp_path / "t")
    for n, at in enumerate(("2024-01-02T00-00", "2024-01-10T00-00")):
        tables.snapshot(spark.range(n + 1), times, at)
    assert tables.pinned(spark, times).count() == 2


PERSON = {"mail": "jane.roe@example.org", "phone": "+1 (555) 010-9999", "name": "Jane Roe-Smithers", "handle": "@janeroe99"}


def test_nothing_personal_is_stored(spark, tmp_path):
    """The canonical event, with personal data in every text it has, nested ones and unknown ones among them."""
    folder, base = tmp_path / "topic", str(tmp_path / "lake")
    said = f"call {PERSON['phone']} or mail {PERSON['mail']} {PERSON['handle']}"
    event = {
        "event_id": "e1", "source": "x", "platform_event_id": "9", "user_id": PERSON["name"], "event_type": "post", "title": said, "raw_text": f"<b>{said}</b>", "clean_text": said, "url": f"https://x.com/{PERSON['handle'][1:]}/status/9#f", "view_count": 0, "like_count": None,
        "author": {"id": PERSON["mail"], "name": PERSON["name"], "biography": said}, "mentions": [PERSON["handle"]], "comments": [{"id": "c1", "author": PERSON["name"], "text": said}, {"id": "c2", "author": None, "text": None}], "extra": {"note": said}, "transcript_text": said,
        "metadata_json": json.dumps({"x_account": PERSON["handle"][1:], "said": said}), "unknown_field": {"deep": [said]},
    }
    lines(folder, "a.json", "posts", (1, 1, event), (2, 1, {**event, "event_id": "e2", "comments": None, "author": None}), (3, 1, json.dumps(event)[:-9]), (4, 1, {"event_id": "e3", "user_id": 5, "event_type": "post"}))
    lines(folder, "b.json", "counts", (1, 1, {"event_id": 7, "user_id": 8, "event_type": "view", "value": 2}))
    lines(folder, "c.json", "strange", (1, 1, event))
    schemas = {"posts": topics.POST, "counts": "event_id string, user_id string, event_type string, value long"}
    pipeline.journal(topics.topic_stream(spark, str(folder)), base, str(tmp_path / "ch"), "salt", schemas=schemas).awaitTermination()
    got = {r.event_id: r for r in tables.stored(spark, f"{base}/journal").collect()}
    assert set(got) == {"e1", "e2", "e3", "7"} and got["7"].value == 2 and got["7"].raw_text is None
    e = got["e1"]
    assert e.title == "call <PHONE> or mail <EMAIL> <USER>" == e.comments[0].text == e.author.biography == e.extra["note"] and (e.view_count, e.like_count) == (0, None)
    assert e.url == "https://x.com/i/status/9" and e.comments[1].text is None and got["e2"].comments is None and got["e2"].author is None
    assert e.author.name == e.user_id == e.comments[0].author and len(e.user_id) == 64
    assert sorted((r.topic, r.reason) for r in tables.stored(spark, f"{base}/dead").collect()) == [("posts", "malformed_json"), ("strange", "unregistered_topic")]
    whole = "".join(spark.read.parquet(str(f)).toPandas().to_json() for f in (tmp_path / "lake").iterdir())
    for secret in (*PERSON.values(), "janeroe99", "555"):
        assert secret not in whole


def test_growth_waits_for_closed_windows_and_drops_late_rows(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidemark.operators import reports

    source, base = str(tmp_path / "in"), str(tmp_path / "lake")
    shape = "event_id long, topic string, ts string"
    put_rows = lambda *rows: spark.createDataFrame(list(rows), shape).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
    grow = lambda: pipeline.growth(spark, source, base, "event_id", "topic", "ts")
    first = [(1, "a", "2024-01-01 01:10:00"), (2, "a", "2024-01-01 02:00:00"), (3, "a", "2024-01-01 02:30:00"), (4, "b", "2024-01-02 05:00:00"), (5, "a", "2024-01-02 00:30:00"), (6, "a", "2024-01-02 23:59:59")]
    put_rows(*first)
    grow()
    assert {r.event_id for r in pipeline.grown(spark, base).collect()} == {1, 2, 3}
    put_rows((7, "a", "2024-01-04 02:00:00"), (1, "a", "2024-01-01 01:10:00"))
    grow()
    put_rows((8, "a", "2024-01-01 02:10:00"), (9, "b", "2024-01-05 03:00:00"))  # the first is late
    grow()
    grow()
    got = {r.event_id: (r.trend_growth_1h, r.trend_growth_24h) for r in pipeline.grown(spark, base).collect()}
    assert got == {1: (None, None), 2: (1.0, None), 3: (1.0, None), 4: (None, None), 5: (None, -1 / 3), 6: (None, -1 / 3), 7: (None, None)}
    batch = spark.createDataFrame([r for r in [*first, (7, "a", "2024-01-04 02:00:00")]], shape).withColumn("at", F.unix_timestamp(F.col("ts").cast("timestamp")))
    want = {r.event_id: (r.trend_growth_1h, r.trend_growth_24h) for r in reports.topic_context(batch, "event_id", "topic", "at").collect()}
    assert got == want


def test_each_beat_reads_the_table_again(spark, tmp_path):
    table, news, out, mark = (str(tmp_path / x) for x in ("t", "n", "o", "c"))
    tables.snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), table, "9")
    spark.createDataFrame([(1, 10), (3, 30)], "id long, n long").write.parquet(news)
    pipeline.reread(spark, table, news, ["id"], out, mark)
    assert sorted((r.id, r.n, r.v) for r in tables.pinned(spark, out).collect()) == [(1, 10, "a"), (3, 30, None)]
    tables.snapshot(spark.createDataFrame([(1, "A"), (3, "c")], "id long, v string"), table, "10")
    pipeline.reread(spark, table, news, ["id"], out, mark)
    assert sorted((r.id, r.n, r.v) for r in tables.pinned(spark, out).collect()) == [(1, 10, "A"), (3, 30, "c")]
