"""Collected rows of several origins added to a data set, each prepared in its own way, then once by id and once by text.

Every origin becomes a ``DataFrame`` with the columns of ``BASE`` that it knows; ``merged_origins`` aligns them. Rows that the data set has already
are left out before anything else is done with them, so a cap or a choice by author is made among new rows only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import annotate, labels, reports, upkeep
from tidemark.sources.imports import with_audience

BASE = ("source", "platform_event_id", "title", "event_ts", "community", "member_count", "member_count_available", "comment_count", "follower_count", "collection_method")
BLANKS = " \t\n\r\f\v"
SHORTEST = 3


def plain_text(text: Column) -> Column:
    """A text without white space around it."""
    return F.btrim(text, F.lit(BLANKS))


def once(rows: DataFrame, *keys: str) -> DataFrame:
    """The earliest row of each key; of rows of one time that with the least hash. Ties of whole rows give one of them."""
    own = [c for c in rows.columns if c not in keys]
    first = F.struct(*[F.col(c) for c in ("event_ts",) if c in own], F.xxhash64(*own))
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*own), first).alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def unseen(rows: DataFrame, current: DataFrame, source: str) -> DataFrame:
    """Rows whose id the data set does not have yet for this source."""
    known = current.where(F.lower(F.trim("source")) == source).select("platform_event_id").where(F.col("platform_event_id").isNotNull())
    return rows.join(known, "platform_event_id", "left_anti")


def usable(rows: DataFrame, on_topic: Column | None = None) -> DataFrame:
    """Rows with an id and a text of at least ``SHORTEST`` characters (that is on topic), once by id; what is not usable is left out before any text is shuffled."""
    rows = rows.where(F.col("platform_event_id").isNotNull()).withColumn("title", plain_text(F.col("title"))).where(F.length("title") >= SHORTEST)
    return once(rows if on_topic is None else rows.where(on_topic), "platform_event_id")


def community_sizes(current: DataFrame) -> DataFrame:
    """The exact median of the known sizes of each community, names in lower case; a row a community."""
    sized = current.select(F.lower("community").alias("community"), F.col("member_count").cast("double").alias("_size")).where(F.col("community").isNotNull())
    return reports.quantiles(sized, "_size", {"_median": 0.5}, ("community",))


def with_sizes(rows: DataFrame, sizes: DataFrame, only: Column | None = None) -> DataFrame:
    """A missing size filled from the community's median (of rows ``only`` holds for), and whether one is known."""
    met = rows.withColumn("_key", F.lower("community")).join(sizes.withColumnRenamed("community", "_key"), "_key", "left")
    own = F.col("member_count").cast("double")
    filled = F.coalesce(own, F.when(only, F.col("_median")) if only is not None else F.col("_median"))
    return met.withColumn("member_count", filled).withColumn("member_count_available", F.col("member_count").isNotNull()).drop("_key", "_median")


def replies(rows: DataFrame, key: str, parent: str) -> DataFrame:
    """How many rows name each row as their parent; the kind mark before an id (``t1_``) does not count."""
    counts = rows.groupBy(F.regexp_replace(parent, "^t1_", "").alias(key)).agg(F.count(F.lit(1)).alias("comment_count"))
    return rows.join(counts.where(F.col(key).isNotNull()), key, "left").withColumn("comment_count", F.coalesce("comment_count", F.lit(0)))


def archived(archive: DataFrame, current: DataFrame, communities: list[str], limit: int, seed: int = 42, source: str = "reddit") -> DataFrame:
    """Comments of an archive (``platform_event_id``, ``parent_id``, ``title``, ``event_ts``, ``url``): usable and new ones of listed communities, with
    reply counts (over the whole archive) and community sizes. Over ``limit`` rows each community gives its equal share first and the rest is drawn
    from all; 0 takes every row. The limit is the data set's own balance, not a bound on work."""
    rows = replies(unseen(usable(archive), current, source), "platform_event_id", "parent_id")
    rows = upkeep.allowed(rows.withColumn("community", F.lit(None).cast("string")), communities)
    if limit > 0:
        found = max(rows.select("community").distinct().count(), 1)  # at most as many as are listed
        rows = labels.capped(rows, "community", F.col("platform_event_id"), max(1, limit // found), limit, seed)
    rows = with_sizes(rows.withColumn("member_count", F.lit(None).cast("double")), community_sizes(current))
    return rows.drop("parent_id", "url").withColumns({"source": F.lit(source), "collection_method": F.lit("archive")})


def searched(found: DataFrame, current: DataFrame, profiles: DataFrame, strong: str, context: str, token: str, source: str = "x") -> DataFrame:
    """Rows that a search gave (``platform_event_id``, ``title``, ``event_ts``, ``screen_name``, ``url``, ``follower_count``): usable, new and on topic (P14), a missing audience from the account's last profile."""
    rows = unseen(usable(found, annotate.relevant(F.col("title"), strong, context, token)), current, source)
    rows = with_audience(rows, profiles)
    return rows.drop("screen_name", "url", "audience_from").withColumns({"source": F.lit(source), "collection_method": F.lit("search")})


def published(public: DataFrame, current: DataFrame, language: str, strong: str, context: str, token: str, limit: int, seed: int = 42, source: str = "x") -> DataFrame:
    """Rows of a published data set (``platform_event_id``, ``title``, ``event_ts``, ``author``, ``lang``): usable, new, on topic, of one language, one an author (T7), at most ``limit``."""
    rows = usable(public.where((F.col("lang") == language) & F.col("author").isNotNull()), annotate.relevant(F.col("title"), strong, context, token))
    rows = unseen(rows, current, source).withColumn("author", F.lower("author"))
    one = labels.one_per_author(rows, "author", F.col("platform_event_id"), limit, seed)
    return one.drop("author", "lang").withColumns({"source": F.lit(source), "collection_method": F.lit("published")})


def live(rows: DataFrame, current: DataFrame, communities: list[str], source: str = "reddit") -> DataFrame:
    """Newly collected posts (``platform_event_id``, ``title``, ``event_ts``, ``community``, ``member_count``) of listed communities that are new; their texts are not looked at."""
    kept = upkeep.allowed(rows.withColumn("url", F.lit(None).cast("string")), communities).drop("url")
    once_each = once(unseen(kept.where(F.col("platform_event_id").isNotNull()), current, source), "platform_event_id")
    return once_each.withColumns({"member_count": F.col("member_count").cast("double"), "source": F.lit(source), "collection_method": F.lit("live")})


def merged_origins(current: DataFrame, *additions: DataFrame) -> DataFrame:
    """All origins with the columns of all, earlier origins first: once by source and id (rows without an id are kept), then once by source and text.

    Texts are compared, by SHA-256, in lower case without white space around them. Rows that have no source or no text count as one text, so one of them stays.
    Each step is one aggregation that is begun before the shuffle, so a text that a third of the rows share is no hot key.
    """
    ranked = [df.withColumn("_rank", F.lit(i)) for i, df in enumerate((current, *additions))]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    columns = [c for c in rows.columns if c != "_rank"]
    first = F.struct("_rank", "event_ts", F.length("platform_event_id"), "platform_event_id", F.xxhash64(*columns))

    def least(df: DataFrame, key: Column) -> DataFrame:
        return df.groupBy(key.alias("_key")).agg(F.min_by(F.struct("_rank", *columns), first).alias("_r")).select("_r.*")

    named = least(rows.where(F.col("platform_event_id").isNotNull()), F.struct(F.lower("source"), "platform_event_id"))
    both = named.unionByName(rows.where(F.col("platform_event_id").isNull()))
    text = F.sha2(F.concat_ws("|", F.lower("source"), F.lower(plain_text(F.col("title")))), 256)  # so a text is shuffled once, not as key and row
    return least(both, F.when(F.col("source").isNotNull() & F.col("title").isNotNull(), text)).select(*columns)
