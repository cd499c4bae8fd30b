"""Streams: clean, journal and apply a topic's events, each replay-safe; event-time windows.

Every stage is one streaming query with one ``foreachBatch``, so what belongs together is written together and a batch that is
run again, after a crash anywhere, adds nothing twice: ids are deterministic, journals take each id once, and the state's merge
gives the same rows when repeated. The order is fixed: dead letters, journal; state, then the proof that it was applied.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import privacy
from tidemark.functions.identity import row_id
from tidemark.operators import tables
from tidemark.operators.tables import collapsed
from tidemark.scratch import written
from tidemark.sources import topics


#: One schema for all topics.
EVENTS: Mapping[str | None, str] = {None: topics.EVENT}


class CrashForTest(RuntimeError):
    """Raised by the fault hook only."""


def fault(point: str) -> None:
    """Stops at a named point, if a test asks for it."""
    if os.environ.get("TIDEMARK_TEST_MODE") == "1" and os.environ.get("TIDEMARK_FAULT") == point:
        raise CrashForTest(point)


def checkpoint_name(base: str, stage: str, topic: str, version: str) -> str:
    """A new version or topic replays from the start."""
    return f"{base}/{stage}-{version}-{re.sub(r'[^A-Za-z0-9._-]+', '_', topic)}"


def started(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "available_now", interval: str = "10 seconds") -> StreamingQuery:
    """A query that ends when all is read, or one that goes on."""
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if mode == "available_now" else writer.trigger(processingTime=interval)
    return writer.start()


def journal(stream: DataFrame, path: str, checkpoint: str, salt: str, mode: str = "available_now", schemas: Mapping[str | None, str] = EVENTS, rules: Mapping[str, str] = privacy.RULES) -> StreamingQuery:
    """Decode by each topic's schema, tag, protect (P4), and write dead letters and journal in this order, by day of the message.

    Every text of a message, however deep, is hashed or cleaned by the path of its schema before anything is stored; what cannot be decoded is
    stored as its size and hash only, and fields outside the schema are not read at all.
    """
    fields = list(topics.fields_of(schemas))

    def batch(rows: DataFrame, _: int) -> None:
        # messages with all their fields are several times what was read, so only what is broken and the ids are kept from the first pass for the next
        rows = topics.tagged(topics.decoded_by_topic(rows, schemas)).withColumn("day", F.to_date("timestamp"))
        few = rows.select("topic", "partition", "offset", "day", "reason", "decode_error", "event_id", F.when(F.col("reason").isNotNull(), F.col("raw")).alias("raw")).persist()
        try:
            ids, dead = topics.split(few)
            dead = dead.withColumn("letter_id", row_id(F.col("topic"), F.col("partition"), F.col("offset")))
            tables.append_new(dead, f"{path}/dead", "letter_id", "day")
            fault("after_dead_letters")
            safe = privacy.protected_rows(topics.split(rows)[0], salt, fields, rules)
            ids = privacy.protected_rows(ids, salt, ["event_id"], rules).select("event_id", "day")
            tables.append_once(safe, f"{path}/journal", "event_id", "day", order=("timestamp", "partition", "offset"), keys=ids)
            fault("after_journal")
        finally:
            few.unpersist()

    return started(stream, batch, checkpoint, mode)


def applicable(spark: SparkSession, path: str, since: str | None = None) -> DataFrame | None:
    """The journal's events without a proof that they were applied, in the form that is handed on: projected, with their stage.

    ``since`` (a day) leaves older parts of journal and proofs unread.
    """
    events, proofs = tables.stored(spark, f"{path}/journal"), tables.stored(spark, f"{path}/applied")
    if events is None:
        return None
    events = events.select("event_id", "user_id", "event_type", "value", "timestamp", "day", F.lit("silver").alias("stage"))
    late = F.lit(True) if since is None else F.col("day") >= F.lit(since).cast("date")
    events = events.where(late)
    return events if proofs is None else events.join(proofs.where(late).select("event_id", "day"), ["event_id", "day"], "left_anti")


def apply_events(spark: SparkSession, path: str, keys: tuple[str, ...] = ("user_id",), order: tuple[str, ...] = ("timestamp", "event_id"), since: str | None = None) -> int:
    """Merges the journal's unapplied events into the state, then records them; returns how many there were."""
    events = applicable(spark, path, since)
    if events is None:
        return 0
    events = events.persist()
    try:
        n = events.count()
        if n:
            news = collapsed(events.drop("day", "stage"), list(keys), list(order))
            tables.upsert(news, f"{path}/state", F.concat_ws("\u001f", *[F.col(k).cast("string") for k in keys]), order=order[0])
            fault("after_state")
            tables.append_new(events.select("event_id", "day"), f"{path}/applied", "event_id", "day")
        return n
    finally:
        events.unpersist()


def rebuilt(spark: SparkSession, path: str, keys: tuple[str, ...] = ("user_id",), order: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    """The state as the whole journal gives it."""
    events = tables.stored(spark, f"{path}/journal").select("event_id", "user_id", "event_type", "value", "timestamp")
    return collapsed(events, list(keys), list(order))


def deduplicated(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Repeats dropped within a delay, with state that a watermark bounds."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def hourly(stream: DataFrame, time: str, source: str, delay: str = "1 hour") -> DataFrame:
    """Events by source and hour, late ones beyond the watermark dropped."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, "1 hour").alias("w"), source).agg(F.count(F.lit(1)).alias("n")).select(source, F.col("w.start").alias("hour"), "n")


def daily_sliding(stream: DataFrame, time: str, source: str, delay: str = "1 hour") -> DataFrame:
    """Events of 24 hours, by the hour."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, "24 hours", "1 hour").alias("w"), source).agg(F.count(F.lit(1)).alias("n")).select(source, F.col("w.end").alias("until"), "n")


def sessions(stream: DataFrame, time: str, author: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """An author's runs of events with no gap beyond ``gap``."""
    return stream.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), author).agg(F.count(F.lit(1)).alias("n")).select(author, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def to_table(stream: DataFrame, path: str, checkpoint: str, *parts: str) -> StreamingQuery:
    return stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*parts).trigger(availableNow=True).start()


def period_counts(stream: DataFrame, topic: str, time: str, seconds: int, delay: str = "1 hour") -> DataFrame:
    """Topic, start, n and before: the rows of each closed period and of the period before it.

    A row counts for its own period and, as one before, for the next, so one windowed aggregation has both. The watermark
    is that of the later times, so it stands as far behind the newest row as ``delay`` says.
    """
    at = F.explode(F.array(F.col(time), F.timestamp_seconds(F.unix_micros(time) / 1_000_000 + seconds)))
    both = stream.select(topic, F.col(time).alias("_time"), at.alias("_at")).withWatermark("_at", f"{seconds} seconds {delay}")
    counted = both.groupBy(F.window("_at", f"{seconds} seconds").alias("w"), topic).agg(F.count_if(F.col("_at") == F.col("_time")).alias("n"), F.count_if(F.col("_at") != F.col("_time")).alias("before"))
    return counted.where("n > 0").select(topic, F.col("w.start").alias("start"), "n", "before")


GROWTH = {"trend_growth_1h": 3600, "trend_growth_24h": 86400}


def growth(spark: SparkSession, source: str, base: str, key: str, topic: str, time: str, delay: str = "1 hour") -> None:
    """How a topic grows from hour to hour and from day to day, for each row of a table that is added to, as its day is closed.

    Rows are admitted once (repeats and rows behind the watermark are dropped for good) and lie by day; closed hours and days are counted from
    what was admitted; and closed hours meet their closed day in a stream-stream join on topic and interval, whose states the watermarks
    bound and hold counts only. A closed day gets no more rows, so its rows are read then, once, and never wait in a state. Each step is
    a query of its own over the table that the one before appends to. ``grown`` reads the result.
    """
    spread = F.pmod(F.xxhash64(key), F.lit(16))  # a day's rows are more than a task's
    admitted = deduplicated(topics.table_stream(spark, source).select(key, topic, time), key, time, delay).withColumn("_day", F.date_from_unix_date(period(time, 86400)))
    to_table(admitted.repartition("_day", spread), f"{base}/rows", f"{base}/rows-mark", "_day").awaitTermination()
    kind = {f.name: f.dataType.simpleString() for f in admitted.schema}
    counts = {}
    for name, seconds in sorted(GROWTH.items(), key=lambda x: -x[1]):  # days first, so that no day is closed before its hours
        rows = spark.readStream.schema(admitted.schema).parquet(f"{base}/rows")
        to_table(period_counts(rows, topic, time, seconds, delay), f"{base}/{name}", f"{base}/{name}-mark").awaitTermination()
        closed = spark.readStream.schema(f"{topic} {kind[topic]}, start timestamp, n long, before long").parquet(f"{base}/{name}")
        change = (F.col("n") - F.col("before")) / F.when(F.col("before") > 0, F.col("before"))
        counts[seconds] = closed.withWatermark("start", "0 seconds").select(F.col(topic).alias(f"_t{seconds}"), F.col("start").alias(f"_s{seconds}"), change.alias(name))
    within = F.expr("_s3600 >= _s86400 AND _s3600 < _s86400 + INTERVAL 1 DAY")
    met = counts[3600].join(counts[86400], (F.col("_t3600") == F.col("_t86400")) & (period("_s3600", 86400) == period("_s86400", 86400)) & within)

    def batch(closed: DataFrame, number: int) -> None:
        closed = written(closed, "closed")  # a row an hour and topic
        first, last = closed.agg(*[F.date_from_unix_date(f(period("_s86400", 86400))) for f in (F.min, F.max)]).first()
        if first is not None:
            rows = closed.sparkSession.read.schema(admitted.schema).parquet(f"{base}/rows").where(F.col("_day").between(first, last))
            tables.snapshot(rows.join(closed, (F.col(topic) == F.col("_t3600")) & (period(time, 3600) == period("_s3600", 3600))).select(key, topic, time, *GROWTH), f"{base}/grown", str(number))

    started(met, batch, f"{base}/grown-mark").awaitTermination()


def period(time: str, seconds: int) -> Column:
    """The number of the period since 1970 that a time is in, whatever the session's time zone; its start is that of its ``window``."""
    second = F.unix_seconds(F.col(time))
    return ((second - F.pmod(second, F.lit(seconds))) / seconds).cast("int")


def grown(spark: SparkSession, base: str) -> DataFrame:
    """The rows of each batch of closed days; a batch that is repeated writes its own anew."""
    rows = tables.stored(spark, f"{base}/grown")
    if rows is None:
        known = spark.read.parquet(f"{base}/rows").drop("_day")
        return known.where("false").select("*", *[F.lit(None).cast("double").alias(c) for c in GROWTH])
    return rows.drop("snapshot")


def reread(spark: SparkSession, table: str, news: str, keys: list[str], out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """At every beat the newest snapshot of a table that changes is read again and the news joined to it, as the next snapshot of ``out``.

    A stream over the table's files would see what was added and miss what was replaced. A beat that is repeated writes its own snapshot anew. Without
    ``interval`` there is one beat, which has ended when this returns.
    """

    def batch(_: DataFrame, beat: int) -> None:
        found = tables.stored(spark, news)
        if found is not None:
            tables.snapshot(found.join(tables.pinned(spark, table), keys, "left"), out, str(beat))

    writer = topics.heartbeat(spark).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if interval:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
