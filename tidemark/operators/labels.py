"""Labels and training sets: scores, thresholds, splits, balanced samples and early trajectories, without look-ahead."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.snapshots import KEYS, observed

METRICS = ("view_count", "like_count", "comment_count")


def _sum(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def engagement_score(metrics: tuple[str, ...] = METRICS) -> tuple[Column, Column, Column]:
    """The number of observed metrics, their share of those expected, and the sum of logs over the root of the number."""
    n = _sum([F.when(observed(m), 1).otherwise(0) for m in metrics])
    logs = _sum([F.when(observed(m), F.log1p(F.greatest(F.col(m), F.lit(0)).cast("double"))).otherwise(0.0) for m in metrics])
    return n, n / len(metrics), F.when(n > 0, logs / F.sqrt(n.cast("double")))


def engagement_bands(rows: DataFrame, metrics: tuple[str, ...] = METRICS, replies: str = "comment_count") -> DataFrame:
    """total of the observed metrics, coverage, band and whether there are replies."""
    n = _sum([F.when(observed(m), 1).otherwise(0) for m in metrics])
    total = _sum([F.when(observed(m), F.greatest(F.col(m), F.lit(0))).otherwise(0) for m in metrics])
    rows = rows.withColumns({"engagement_total": total.cast("long"), "observed_metrics": n.cast("int"), "engagement_coverage": n / len(metrics)})
    band = F.when(F.col("observed_metrics") == 0, "unknown").when(F.col("engagement_total") == 0, "none").when(F.col("engagement_total") < 10, "low").when(F.col("engagement_total") < 100, "medium").otherwise("high")
    kind = F.when(~observed(replies), "unknown").when(F.col(replies) > 0, "has_replies").otherwise("no_replies")
    return rows.withColumns({"engagement_band": band, "comment_type": kind})


def early_trajectory(rates: DataFrame, horizon_hours: float, label_hours: float, fewest: int, time: str = "observed_at", tie: str = "event_id") -> DataFrame:
    """What readings up to the horizon tell, and the first reading from the label's hour on.

    ``status`` says why a post cannot be used: no_window, too_few or no_outcome; features never see later readings.
    """
    age = F.col("age_minutes") / 60.0
    early, later = age <= horizon_hours, age >= label_hours
    order = F.struct(F.col(time), F.col(tie))
    last = lambda c: F.max_by(F.col(c), F.when(early, order))
    n, after = F.count_if(early), F.count_if(later)
    rows = rates.where(age >= 0).groupBy(*KEYS).agg(
        F.when(n == 0, "no_window").when(n < fewest, "too_few").when(after == 0, "no_outcome").otherwise("kept").alias("status"),
        n.alias("n"),
        F.min(F.when(early, age)).alias("first_age_hours"),
        F.max(F.when(early, age)).alias("last_age_hours"),
        *[F.log1p(last(m).cast("double")).alias(f"log_{m}") for m in METRICS],
        *[last(r).alias(f"{r}_last") for r in ("views_per_hour", "likes_per_hour", "comments_per_hour", "views_acceleration", "like_rate", "comment_rate", "engagement_rate")],
        *[F.avg(F.when(early, F.col(r))).alias(f"{r}_mean") for r in ("views_per_hour", "likes_per_hour", "comments_per_hour", "views_acceleration")],
        *[F.max(F.when(early, F.col(r))).alias(f"{r}_max") for r in ("views_per_hour", "likes_per_hour", "comments_per_hour")],
        *[F.min_by(F.col(m), F.when(later, order)).alias(f"outcome_{m}") for m in METRICS],
    )
    return rows.withColumn("span_hours", F.col("last_age_hours") - F.col("first_age_hours"))


def hash_ranked(rows: DataFrame, groups: list[str], hashed: Column, most: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``_rank``, their place by ``hashed`` (hex digits) within their group, from 1.

    Hashes are uniform: counts by their first digits tell how many rows come before each part of a group, and rows are numbered
    inside those parts only, so no task numbers a whole group. With ``most`` (groups and ``_most``, or ``_most`` alone in one row) parts
    that lie beyond that many rows of their group are left out before anything is sorted, and so are later rows.
    """
    rows = rows.withColumns({"_hash": hashed, "_head": F.substring(hashed, 1, 3)})
    heads = rows.groupBy(*groups, "_head").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    same = lambda a, b, keys: reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_of_{k}"]) for k in keys])
    own = lambda df, keys: df.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in df.columns if c not in keys])
    if most is not None and len(most.columns) == 1:
        heads = heads.crossJoin(F.broadcast(most)).where("_ahead < _most")  # one row is broadcast
    elif most is not None:
        limits = own(most, groups)
        heads = heads.join(limits, same(heads, limits, groups)).where("_ahead < _most").drop(*[c for c in limits.columns if c != "_most"])
    parts = own(heads.drop("_n"), [*groups, "_head"])
    met = rows.join(parts, same(rows, parts, [*groups, "_head"])).drop(*[c for c in parts.columns if c.startswith("_of_")])
    ranked = met.withColumn("_rank", F.col("_ahead") + F.row_number().over(Window.partitionBy(*groups, "_head").orderBy("_hash")))
    return (ranked.where("_rank <= _most").drop("_most") if most is not None else ranked).drop("_head", "_ahead")


def balanced(rows: DataFrame, groups: list[str], key: Column, seed: int = 42, target: int = 0) -> DataFrame:
    """As many rows of each group as the smallest has (or ``target``, if less), by order of a seeded hash."""
    least = rows.groupBy(*groups).count().agg(F.min("count").alias("_most"))
    if target:
        least = least.select(F.least("_most", F.lit(target)).alias("_most"))
    ranked = hash_ranked(rows, groups, F.sha2(F.concat_ws(":", F.lit(str(seed)), key), 256), least)
    return ranked.withColumnRenamed("_rank", "balance_rank").drop("_hash").withColumn("balance_group", F.concat_ws("|", *groups))


def nested_balanced(rows: DataFrame, outer: str, inner: str, key: Column, seed: int = 42) -> DataFrame:
    """T5: in each outer group, as many rows of each inner group as its smallest has."""
    sizes = rows.groupBy(outer, inner).count()
    most = sizes.withColumn("_most", F.min("count").over(Window.partitionBy(outer))).drop("count")  # a row a group
    ranked = hash_ranked(rows, [outer, inner], F.sha2(F.concat_ws(":", F.lit(str(seed)), key), 256), most)
    return ranked.withColumnRenamed("_rank", "balance_rank").drop("_hash")


def capped(rows: DataFrame, stratum: str, key: Column, quota: int, limit: int, seed: int = 42) -> DataFrame:
    """Up to ``quota`` rows a stratum by hash order, then the rest by hash order until ``limit`` rows are there."""
    ranked = hash_ranked(rows, [stratum], F.sha2(F.concat_ws(":", F.lit(str(seed)), key), 256))
    return ranked.orderBy(F.col("_rank") > quota, "_hash").limit(limit).drop("_rank", "_hash")


def one_per_author(rows: DataFrame, author: str, key: Column, limit: int, seed: int = 42) -> DataFrame:
    """One row an author by hash order, at most ``limit``."""
    rows = rows.withColumn("_hash", F.sha2(F.concat_ws(":", F.lit(str(seed)), key), 256))
    own = [c for c in rows.columns if c != author]
    once = rows.groupBy(author).agg(F.min_by(F.struct(*own), "_hash").alias("_one")).select(author, "_one.*")
    return once.orderBy("_hash").limit(limit).drop("_hash").select(*[c for c in rows.columns if c != "_hash"])


def group_split(rows: DataFrame, group: Column, fraction: float, seed: int) -> DataFrame:
    """``split_name``, holdout for the first ceil(fraction x groups) groups by hash order, train for the others.

    The cut is the hash at that rank, found as an exact percentile would be, so groups are never numbered in one task.
    """
    marked = rows.withColumn("_hash", F.sha2(F.concat(F.lit(f"{seed}:"), group), 256))
    groups = marked.select("_hash").distinct()
    # hashes are uniform: counts by their first digits find the part that holds the cut
    heads = groups.groupBy(F.substring("_hash", 1, 3).alias("_head")).count()
    total = heads.agg(F.ceil(F.sum("count") * fraction).cast("long").alias("_most"))
    ahead = heads.withColumn("_ahead", F.sum("count").over(Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["_ahead"])
    ranked = groups.join(ahead, F.substring("_hash", 1, 3) == F.col("_head")).withColumn("_rank", F.col("_ahead") + F.row_number().over(Window.partitionBy("_head").orderBy("_hash")))
    held = ranked.join(F.broadcast(total), F.col("_rank") <= F.col("_most")).select("_hash", F.lit("holdout").alias("_held"))  # one row is broadcast
    return marked.join(held, "_hash", "left").withColumn("split_name", F.coalesce("_held", F.lit("train"))).drop("_hash", "_held")


def fold_of(group: Column, folds: int, seed: int) -> Column:
    """A fold from 0 by the group's hash: groups never straddle folds, whatever the data's size."""
    return F.pmod(F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), group), 256), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int")


def fold_check(rows: DataFrame, fold: str, group: str, label: str) -> DataFrame:
    """Rows, groups, labels by fold, and a fingerprint of the folds' groups: the sum of their hashes, whatever their order."""
    found = rows.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("positives"))
    marks = F.conv(F.substring(F.sha2(F.col(group).cast("string"), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    groups = rows.select(fold, group).distinct().groupBy(fold).agg(F.count(F.lit(1)).alias("groups"), F.sum(marks).cast("string").alias("fingerprint"))
    return found.join(groups, fold)


def uncovered(rows: DataFrame, folds: int, fold: str, label: str) -> DataFrame:
    """The folds from 0 that lack rows of a label, which no model can be tested on; empty where every fold covers both."""
    have = rows.groupBy(fold).agg(F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"))
    every = rows.sparkSession.range(folds).select(F.col("id").cast("int").alias(fold))
    return every.join(have, fold, "left").fillna(0, ["positives", "negatives"]).where("positives = 0 or negatives = 0")


def straddling(rows: DataFrame, split: str, group: str) -> DataFrame:
    """The groups that more than one split holds, with the number of splits; empty for a sound split."""
    return rows.groupBy(group).agg(F.count_distinct(split).alias("splits")).where("splits > 1")


def stratified_folds(rows: DataFrame, group: str, label: str, folds: int, seed: int = 42) -> DataFrame:
    """``fold`` by group, dealt so that folds share each stratum evenly.

    A group's stratum is its share of positives in tenths and the size of its rows in powers of two; in each stratum groups are ranked by a seeded hash and
    dealt round and round, from another fold in each stratum.
    """
    groups = rows.groupBy(group).agg(F.floor(F.avg(F.col(label).cast("double")) * 10).cast("int").alias("_share"), F.floor(F.log2(F.count(F.lit(1)))).cast("int").alias("_size"))
    ranked = hash_ranked(groups, ["_share", "_size"], F.sha2(F.concat(F.lit(f"{seed}:"), F.col(group).cast("string")), 256))
    dealt = ranked.select(group, F.pmod(F.col("_rank") - 1 + F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), "_share", "_size"), 256), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int").alias("fold"))
    return rows.join(dealt, group)


def thresholds(scored: DataFrame, source: str = "source", score: str = "engagement_score", quantile: float = 0.75, fewest: int = 1) -> DataFrame:
    """Each platform's exact linear quantile of its train scores; platforms with fewer than ``fewest`` scores get none."""
    from tidemark.operators.reports import quantiles

    s = F.when(~F.isnan(score), F.col(score))
    rows = scored.groupBy(source).agg(F.count(s).alias("reference_count"), F.min(s).alias("lowest"), F.max(s).alias("highest")).where(F.col("reference_count") >= fewest)
    return rows.join(quantiles(scored.select(source, s.alias("_s")), "_s", {"median": 0.5, "threshold": quantile}, (source,)), source)


def reference_contract(spark: SparkSession, path: str, reference: dict, platforms: tuple[str, ...], horizon_hours: int, quantile: float = 0.75, fewest: int = 1) -> DataFrame:
    """The thresholds of a score file (CSV with a header, or Parquet) that another job left, a row a platform, with what identifies the data set they are of.

    Columns ``source`` and ``engagement_score`` must be there, the reference must name version, SHA-256 fingerprint and snapshots, and every platform must have ``fewest`` finite scores; else ValueError.
    """
    names = [f for f in ("dataset_version", "source_snapshots") if not reference.get(f)]
    if len(str(reference.get("dataset_fingerprint", ""))) != 64:
        names.append("dataset_fingerprint")
    if names:
        raise ValueError("the reference lacks " + ", ".join(sorted(names)))
    files = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.option("header", True).csv(path)
    lacking = sorted({"source", "engagement_score"} - set(files.columns))
    if lacking:
        raise ValueError("score file lacks columns " + ", ".join(lacking))
    score = F.expr("try_cast(engagement_score AS DOUBLE)")
    scored = files.where(F.col("source").isin(*platforms)).select("source", F.when(F.abs(score) < float("inf"), score).alias("engagement_score"))
    limits = thresholds(scored, quantile=quantile, fewest=fewest)
    without = sorted(set(platforms) - {r["source"] for r in limits.select("source").collect()})  # a row a platform
    if without:
        raise ValueError("too few scores of " + ", ".join(without))
    told = {"quantile": float(quantile), "horizon_hours": horizon_hours, "dataset_version": reference["dataset_version"], "dataset_fingerprint": reference["dataset_fingerprint"]}
    return limits.withColumns({k: F.lit(v) for k, v in told.items()})


def labelled(scored: DataFrame, limits: DataFrame, source: str = "source", score: str = "engagement_score") -> DataFrame:
    """viral from the platform's threshold on."""
    rows = scored.join(limits.select(source, "threshold"), source)
    return rows.withColumn("label_value", F.when(F.col(score) >= F.col("threshold"), "viral").otherwise("not_viral"))


def eligible(rows: DataFrame, sources: tuple[str, ...], least: int = 20) -> DataFrame:
    """Rows that may become examples: a known source, an id, a time, and a text of ``least`` characters."""
    return rows.where(F.col("source").isin(*sources) & F.col("platform_event_id").isNotNull() & F.col("event_ts").isNotNull() & (F.length(F.trim("text_for_model")) >= least))


def one_feature_row(rows: DataFrame, marks: tuple[str, ...] = ("author_hash", "text_for_model")) -> DataFrame:
    """The first feature row of each post; of rows of one time that with the least hash of ``marks``."""
    tie = F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in marks]), 256)
    own = [c for c in rows.columns if c not in KEYS]
    return rows.groupBy(*KEYS).agg(F.min_by(F.struct(*own), F.struct("event_ts", tie)).alias("_f")).select(*KEYS, "_f.*").select(*rows.columns)


def dataset_manifest(examples: DataFrame, schema_version: str, snapshots: dict[str, int], filters: dict[str, str], nullable: tuple[str, ...], key: str = "example_id") -> DataFrame:
    """One row that tells what a dataset is made of: version, period, counts, missing rates, labels by source, and a fingerprint of its ids.

    The version is a hash of the inputs (schema, snapshots, filters) in canonical form, so equal inputs have equal versions.
    """
    import json

    inputs = json.dumps({"schema_version": schema_version, "source_snapshots": snapshots, "filters": filters}, sort_keys=True, separators=(",", ":"))
    marks = F.conv(F.substring(F.col(key), 1, 15), 16, 10).cast("decimal(38,0)")
    rates = [F.round(F.avg(F.col(c).isNull().cast("double")), 6).alias(f"missing_{c}") for c in nullable]
    whole = examples.agg(F.count(F.lit(1)).alias("example_count"), F.min("event_ts").alias("period_start"), F.max("event_ts").alias("period_end"), F.sum(marks).cast("string").alias("fingerprint"), *rates)
    cells = examples.groupBy("source", "label_value").agg(F.count(F.lit(1)).alias("n"))  # a row a source and label
    told = cells.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "source", "label_value", F.col("n").cast("string")))), ",").alias("distribution"))
    version = F.concat(F.lit(f"dataset-{schema_version}-"), F.substring(F.sha2(F.lit(inputs), 256), 1, 20))
    return whole.crossJoin(told).withColumn("dataset_version", version)  # one row each


def persisted_holdout(rows: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """The rows of a hold-out that was stored before. Ids must be unique, and none of the hold-out may be missing."""
    doubled = rows.groupBy(key).count().where("count > 1").limit(1).count()
    lost = held.select(key).distinct().join(rows, key, "left_anti").count()
    if doubled or lost:
        raise ValueError(f"{'ids are not unique; ' if doubled else ''}{lost} ids of the hold-out are missing")
    return rows.join(held.select(key).distinct(), key, "left_semi")
