"""Reports: people, sources, coverage, progress, ranks and model metrics."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.snapshots import observed
from tidemark.scratch import written


def by_source(rows: DataFrame, summed: tuple[str, ...], profile: tuple[str, ...], time: str, tie: str, source: str = "source") -> DataFrame:
    """Sums that are null where nothing was observed, latest known profile values, coverage."""
    at = F.struct(F.col(time), F.col(tie))
    return rows.groupBy(source).agg(
        F.count(F.lit(1)).alias("events"),
        *[F.sum(F.when(observed(m, rows.columns), F.col(m))).alias(m) for m in summed],
        *[F.max_by(F.when(observed(m, rows.columns), F.col(m)), F.when(observed(m, rows.columns), at)).alias(f"latest_{m}") for m in profile],
        *[F.count(F.when(observed(m, rows.columns), 1)).alias(f"{m}_rows") for m in summed],
        F.max(time).alias("latest"),
    )


def identifier_activity(rows: DataFrame, identifier: str, metrics: tuple[str, ...], time: str, text: str, reply: str) -> DataFrame:
    """What each identifier did: where, as what, when, how long its texts are, totals and means, replies."""
    totals = [F.sum(m).alias(f"total_{m}") for m in metrics]
    rows = rows.groupBy(identifier).agg(
        F.count(F.lit(1)).alias("events"),
        F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"),
        F.array_join(F.array_sort(F.collect_set("role")), ", ").alias("roles"),
        F.min(time).alias("first_activity"),
        F.max(time).alias("last_activity"),
        F.count_distinct(F.to_date(time)).alias("active_days"),
        F.avg(F.size(F.split(F.trim(text), r"\s+"))).alias("avg_words"),
        (F.count_if(F.col(reply)) * 100.0 / F.nullif(F.count(reply), F.lit(0))).alias("reply_rate_pct"),
        *totals,
        *[F.avg(m).alias(f"avg_{m}") for m in metrics],
    )
    total = reduce(lambda a, b: a + b, [F.coalesce(f"total_{m}", F.lit(0)) for m in metrics])
    return rows.withColumns({"total_engagement": total, "avg_engagement": total / F.col("events")})


def top(rows: DataFrame, metric: str, n: int = 25, tie: str = "events", key: str = "identifier") -> DataFrame:
    """The first ``n`` by a metric, nulls last, ties by events and then by key."""
    return rows.orderBy(F.col(metric).desc_nulls_last(), F.col(tie).desc_nulls_last(), key).limit(n)


def progress(rows: DataFrame, identifier: str, time: str, measures: dict[str, Column]) -> DataFrame:
    """Running totals by day of each measure, one row a measure."""
    daily = rows.groupBy(identifier, F.to_date(time).alias("date")).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(m) for m, c in measures.items()])
    so_far = Window.partitionBy(identifier).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    running = daily.select(identifier, "date", *[F.sum(m).over(so_far).alias(m) for m in measures])
    return running.unpivot([identifier, "date"], list(measures), "metric", "value")


RANGES = 256  # a power of two


def _range_of(v: Column, cuts: Column) -> Column:
    """How many of the rising ``cuts`` are below a value, by halving; null for null."""
    steps = F.array(*[F.lit(RANGES >> i) for i in range(1, RANGES.bit_length())])
    return F.when(v.isNotNull(), F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) < v, at + step).otherwise(at)))


def running_sums(counts: DataFrame, keys: list[str], value: str, sums: tuple[str, ...], down: bool = False) -> DataFrame:
    """``counts`` (one row a key and value) with, for each of ``sums``, what the values before sum to (``_before``) and all of the key (``_all``).

    Each key's values are cut into ``RANGES`` ranges of about equally many values, wherever they lie (its quantiles, from mergeable summaries); the sums
    are taken over ranges first and inside each range then, so no window holds all values of a key. Where ranges are cut changes the plan's balance,
    never the result. Keys are compared null-safely; rows without a value are left out; NaN is above all. Values that are equal must be one row.
    """
    v = F.col(value).cast("double")
    cuts = counts.groupBy(*[F.col(k).alias(f"_c_{k}") for k in keys]).agg(F.percentile_approx(v, [i / RANGES for i in range(1, RANGES)], 4 * RANGES).alias("_cuts"))
    met = counts.join(cuts, reduce(lambda a, b: a & b, [counts[k].eqNullSafe(cuts[f"_c_{k}"]) for k in keys])) if keys else counts.crossJoin(F.broadcast(cuts))  # without keys one row
    ranged = met.select(*[counts[c] for c in counts.columns], (_range_of(v, F.col("_cuts")) * (-1 if down else 1)).alias("_g"))
    order = F.col(value).desc() if down else F.col(value)
    groups = ranged.groupBy(*keys, "_g").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    ahead, whole = Window.partitionBy(*keys).orderBy("_g").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    groups = groups.where(F.col("_g").isNotNull()).select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_g").alias("_gg"), *[F.coalesce(F.sum(f"_t_{s}").over(ahead), F.lit(0)).alias(f"_a_{s}") for s in sums], *[F.sum(f"_t_{s}").over(whole).alias(f"{s}_all") for s in sums])
    inside = Window.partitionBy(*keys, "_g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.withColumns({f"_i_{s}": F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in sums})
    joined = ranged.join(groups, reduce(lambda a, b: a & b, [ranged[k].eqNullSafe(groups[f"_k_{k}"]) for k in keys], ranged["_g"] == groups["_gg"]))
    return joined.select(*counts.columns, *[(F.col(f"_a_{s}") + F.col(f"_i_{s}")).alias(f"{s}_before") for s in sums], *[f"{s}_all" for s in sums])


def average_ranks(rows: DataFrame, columns: tuple[str, ...], partition: str | None = None) -> DataFrame:
    """Each column's average-tie rank over n, from counts by value rather than by numbering all rows in one window.

    A value's rank is the number of smaller values plus half of its own ties and a half; values are compared as doubles. All columns are counted and ranked in one pass, in long
    form; the ranks meet the rows by value, where a value that most rows share is one row on the ranks' side, which an adaptive join splits.
    """
    keys = [partition] if partition else []
    long = rows.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_value")) for c in columns])).alias("_l")).select(*keys, "_l.*")
    counts = long.where(F.col("_value").isNotNull()).groupBy("_column", *keys, "_value").agg(F.count(F.lit(1)).alias("_n"))
    ranks = written(running_sums(counts, ["_column", *keys], "_value", ("_n",)).select("_column", *keys, "_value", ((F.col("_n_before") + (F.col("_n") + 1) / 2) / F.col("_n_all")).alias("_rank")), "ranks")
    out = rows
    for c in columns:
        own = ranks.where(F.col("_column") == c).select(*keys, F.col("_value").alias("_v"), F.col("_rank").alias(f"{c}_rank"))
        out = out.withColumn("_v", F.col(c).cast("double")).join(own, [*keys, "_v"], "left").drop("_v")
    return out.select(*rows.columns, *[f"{c}_rank" for c in columns])


def quantiles(rows: DataFrame, value: str, shares: dict[str, float], keys: tuple[str, ...] = ()) -> DataFrame:
    """The exact, linearly interpolated quantiles of each key's values that are not null, by name; from counts by value, so no task holds all of them."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_sums(counts, list(keys), value, ("_n",))
    at = lambda place: F.max(F.when((F.col("_n_before") <= place) & (place < F.col("_n_before") + F.col("_n")), F.col(value).cast("double")))
    place = {name: (F.col("_n_all") - 1) * F.lit(float(q)) for name, q in shares.items()}
    found = ranked.groupBy(*keys).agg(*[x for name, p in place.items() for x in (at(F.floor(p)).alias(f"_lo_{name}"), at(F.ceil(p)).alias(f"_hi_{name}"), F.max(p).alias(f"_p_{name}"))])
    mixed = lambda n: F.when(F.col(f"_lo_{n}") == F.col(f"_hi_{n}"), F.col(f"_lo_{n}")).otherwise((F.ceil(f"_p_{n}") - F.col(f"_p_{n}")) * F.col(f"_lo_{n}") + (F.col(f"_p_{n}") - F.floor(f"_p_{n}")) * F.col(f"_hi_{n}"))
    return found.select(*keys, *[mixed(n).alias(n) for n in shares])


def classes(rows: DataFrame, score: str, names: tuple[str, ...] = ("low", "medium", "high")) -> DataFrame:
    """Classes between exact quantiles, the cut itself belonging to the lower class."""
    cuts = quantiles(rows, score, {f"_q{i}": i / len(names) for i in range(1, len(names))}).select(F.array(*[f"_q{i}" for i in range(1, len(names))]).alias("_cuts"))
    place = F.size(F.filter("_cuts", lambda x: F.col(score) > x))
    label = F.element_at(F.array(*map(F.lit, names)), place + 1)
    return rows.crossJoin(F.broadcast(cuts)).withColumn(f"{score}_class", label).drop("_cuts")  # one row is broadcast


def zscored(rows: DataFrame, metrics: tuple[str, ...], source: str = "source", quantile: float = 0.75) -> DataFrame:
    """The sum of per-source z-scores of logged metrics over the root of those observed, and 1 from the source's quantile on."""
    logs = {m: F.when(F.col(m).isNotNull(), F.log1p(F.greatest(F.col(m), F.lit(0)).cast("double"))) for m in metrics}
    stats = rows.groupBy(source).agg(*[F.avg(x).alias(f"_m_{m}") for m, x in logs.items()], *[F.stddev_pop(x).alias(f"_s_{m}") for m, x in logs.items()])
    joined = rows.join(stats, source)
    n = reduce(lambda a, b: a + b, [F.col(m).isNotNull().cast("int") for m in metrics])
    z = reduce(lambda a, b: a + b, [F.coalesce((x - F.col(f"_m_{m}")) / F.when(F.col(f"_s_{m}") > 0, F.col(f"_s_{m}")).otherwise(1.0), F.lit(0.0)) for m, x in logs.items()])
    scored = joined.withColumn("engagement_score", F.when(n > 0, z / F.sqrt(n.cast("double")))).drop(*[f"_{k}_{m}" for k in "ms" for m in metrics])
    cuts = quantiles(scored, "engagement_score", {"_cut": quantile}, (source,))
    return scored.join(cuts, source).withColumn("viral", (F.col("engagement_score") >= F.col("_cut")).cast("int")).drop("_cut")


def repetitions(rows: DataFrame, size: str, seconds: str) -> DataFrame:
    """Spread of repeated measurements by size, and the ratio of medians to the size before."""
    s = F.col(seconds)
    out = rows.groupBy(size).agg(F.count(s).alias("runs"), F.min(s).alias("least"), F.max(s).alias("most"), F.avg(s).alias("mean"), F.stddev_pop(s).alias("stddev"))
    out = out.join(quantiles(rows, seconds, {"median": 0.5}, (size,)), size)
    return out.withColumn("ratio_to_previous", F.col("median") / F.lag("median").over(Window.orderBy(size)))  # one row a size


def binary_metrics(rows: DataFrame, label: str, score: str, threshold: float, *by: str) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, F1 and Brier score; zero where a denominator is."""
    y, hit = F.col(label) == 1, F.col(score) >= threshold
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(y & hit).alias("tp"), F.count_if(~y & hit).alias("fp"), F.count_if(y & ~hit).alias("fn"), F.count_if(~y & ~hit).alias("tn"), F.avg(F.pow(F.col(score) - F.col(label), F.lit(2))).alias("brier"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp = F.col("tp")
    return out.withColumns({"accuracy": (tp + F.col("tn")) / F.col("n"), "precision": ratio(tp, tp + F.col("fp")), "recall": ratio(tp, tp + F.col("fn")), "f1": ratio(2 * tp, 2 * tp + F.col("fp") + F.col("fn"))})


def reliability(rows: DataFrame, label: str, score: str, bins: int = 10, *by: str) -> DataFrame:
    """Rows, mean score and rate of positives by equal-width bin."""
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return rows.groupBy(*by, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("confidence"), F.avg(label).alias("accuracy"))


def calibration_error(rows: DataFrame, label: str, score: str, bins: int = 10, *by: str) -> DataFrame:
    """The expected calibration error."""
    r = reliability(rows, label, score, bins, *by)
    return r.groupBy(*by).agg((F.sum(F.col("n") * F.abs(F.col("accuracy") - F.col("confidence"))) / F.sum("n")).alias("ece"))


def ranking_metrics(rows: DataFrame, label: str, score: str, *by: str) -> DataFrame:
    """ROC-AUC by average ranks and average precision by scores from the top; from counts by distinct score."""
    c = running_sums(rows.groupBy(*by, score).agg(F.sum(label).alias("hits"), F.count(F.lit(1)).alias("k")), list(by), score, ("hits", "k"), down=True)
    area = (F.col("k") - F.col("hits")) * (F.col("hits_before") + F.col("hits") / 2)  # positives above each negative, ties half
    gain = F.col("hits") * (F.col("hits_before") + F.col("hits")) / (F.col("k_before") + F.col("k"))
    out = c.groupBy(*by).agg(F.sum(area).alias("area"), F.sum(gain).alias("gain"), F.max("hits_all").alias("positives"), F.max("k_all").alias("n"))
    both = (F.col("positives") > 0) & (F.col("n") > F.col("positives"))
    return out.select(*by, F.when(both, F.col("area") / (F.col("positives") * (F.col("n") - F.col("positives")))).alias("roc_auc"), F.when(both, F.col("gain") / F.col("positives")).alias("average_precision"))


def bootstrap(rows: DataFrame, label: str, scores: tuple[str, ...], group: str, rounds: int, seed: int = 42) -> DataFrame:
    """Percentile intervals of each score's Brier score, and of the difference of each later one to the first, with whole groups drawn again and again.

    Each group's weight in a round is a Poisson(1) draw from a hash of seed, round and group, so groups need not be gathered and all scores share the
    draws (the differences are paired); sums by group are made first, and each round is one weighted sum of them.
    """
    errors = [F.sum(F.pow(F.col(s) - F.col(label), F.lit(2))).alias(f"_e{k}") for k, s in enumerate(scores)]
    groups = rows.groupBy(group).agg(*errors, F.count(F.lit(1)).alias("_n"))
    unit = (F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("round").cast("string"), F.col(group).cast("string")), 256), 1, 13), 16, 10).cast("double") + 0.5) / 2**52
    weight = reduce(lambda a, b: a + b, [(F.col("_u") >= s).cast("int") for s in POISSON])
    drawn = groups.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds)))).withColumn("_u", unit).withColumn("_w", weight)
    each = drawn.groupBy("round").agg(*[F.try_divide(F.sum(F.col(f"_e{k}") * F.col("_w")), F.sum(F.col("_n") * F.col("_w"))).alias(s) for k, s in enumerate(scores)])
    each = each.withColumns({f"{s} - {scores[0]}": F.col(s) - F.col(scores[0]) for s in scores[1:]})
    names = [c for c in each.columns if c != "round"]
    long = each.unpivot("round", names, "metric", "value")
    return long.groupBy("metric").agg(F.count("value").alias("rounds"), F.percentile("value", F.lit(0.025)).alias("low"), F.percentile("value", F.lit(0.975)).alias("high"))  # one value a round


def _poisson(most: int = 8) -> tuple[float, ...]:
    out, total, mass = [], 0.0, math.exp(-1)
    for k in range(most):
        total += mass
        out.append(total)
        mass /= k + 1
    return tuple(out)


#: The cumulative probabilities of Poisson(1): a draw is the number of them that do not exceed a uniform number.
POISSON = _poisson()


def collaborator_coverage(rows: DataFrame, owner: str, collaborators: str) -> DataFrame:
    """Known owners, rows with collaborators, different collaborators."""
    each = rows.select(F.explode(collaborators).alias("c")).agg(F.count_distinct("c").alias("collaborators"))
    return rows.agg(F.count(owner).alias("known_owners"), F.count_if(F.size(collaborators) > 0).alias("with_collaborators")).crossJoin(each)  # one row each


def fan_out(rows: DataFrame, author: str, owner: str, collaborators: str) -> DataFrame:
    """U4: a row for each author, owner and collaborator."""
    part = lambda c, role: rows.where(c.isNotNull()).withColumns({"identifier": c.cast("string"), "role": F.lit(role)})
    more = rows.withColumn("identifier", F.explode(collaborators)).withColumns({"identifier": F.col("identifier").cast("string"), "role": F.lit("collaborator")})
    return part(F.col(author), "author").unionByName(part(F.col(owner), "owner")).unionByName(more)


def completeness_of_row(fields: dict[str, Column]) -> tuple[Column, Column]:
    """how many of the fields are known, and the names of the others."""
    known = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in fields.values()])
    return known, F.array_join(F.array_compact(F.array(*[F.when(c.isNull(), F.lit(n)) for n, c in fields.items()])), ", ")


def staleness(at: Column, now: Column, hours: int) -> Column:
    """F46."""
    age = (F.unix_timestamp(now) - F.unix_timestamp(at)) / 3600
    return F.when(at.isNull(), "never").when(age > hours, "overdue").otherwise("fresh")


def audience(value: str, flag: str) -> dict[str, Column]:
    """a log, and whether the size is known and whether it is zero."""
    known = F.coalesce(F.col(flag), F.col(value).isNotNull()) & F.col(value).isNotNull()
    return {"audience_log": F.when(known, F.log1p(F.greatest(F.col(value), F.lit(0)).cast("double"))).otherwise(0.0), "audience_known": known.cast("int"), "audience_zero": (known & (F.col(value) == 0)).cast("int")}


def logit(p: Column, edge: float = 1e-6) -> Column:
    """F47."""
    c = F.greatest(F.lit(edge), F.least(F.lit(1 - edge), p))
    return F.log(c / (1 - c))


def platt(score: Column, slope: float, offset: float) -> Column:
    """a calibrated probability."""
    return 1 / (1 + F.exp(-(F.lit(slope) * score + offset)))


def topic_context(rows: DataFrame, key: str, topic: str, at: str, span: int = 3600) -> DataFrame:
    """For each row the topic's rows in the ``span`` seconds before it, its growth from the hour and the day before, and the hours since it was first seen.

    Rows are dealt by topic and hour, each to its own hour and the next, so no task holds a whole topic; growth comes from counts by hour and day.
    """
    hour = F.floor(F.col(at) / span)
    dealt = rows.select(key, topic, at, F.explode(F.array(hour, hour + 1)).alias("_h"))
    recent = F.count(F.lit(1)).over(Window.partitionBy(topic, "_h").orderBy(at).rangeBetween(-span, -1))
    out = dealt.withColumn("recent_posts_1h", recent).where(F.col("_h") == hour).drop("_h")
    for name, seconds in (("trend_growth_1h", 3600), ("trend_growth_24h", 86400)):
        n = rows.groupBy(topic, F.floor(F.col(at) / seconds).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
        grown = n.join(n.select(topic, (F.col("_p") + 1).alias("_p"), F.col("_n").alias("_b")), [topic, "_p"], "left").select(topic, "_p", ((F.col("_n") - F.col("_b")) / F.col("_b")).alias(name))
        out = out.withColumn("_p", F.floor(F.col(at) / seconds)).join(grown, [topic, "_p"]).drop("_p")
    first = rows.groupBy(topic).agg(F.min(at).alias("_first"))
    return out.join(first, topic).select(key, topic, "recent_posts_1h", "trend_growth_1h", "trend_growth_24h", ((F.col(at) - F.col("_first")) / 3600).alias("topic_freshness_hours"))


def dataset_overview(rows: DataFrame, source: str, language: str, text: str, viral: Column) -> DataFrame:
    """Rows, viral rate, mean length and language mix of each source: languages by share, the larger first.

    One aggregation by source and language, and one over its few rows a source.
    """
    n = F.count(F.lit(1))
    parts = rows.groupBy(source, language).agg(n.alias("_n"), F.sum(F.coalesce(viral.cast("long"), F.lit(0))).alias("_v"), F.count(viral).alias("_k"), F.sum(F.length(text)).alias("_l"), F.count(text).alias("_t"))
    total = parts.groupBy(source).agg(F.sum("_n").alias("n"), F.sum("_v").alias("_sv"), F.sum("_k").alias("_sk"), F.sum("_l").alias("_sl"), F.sum("_t").alias("_st"), F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("order"), F.coalesce(language, F.lit("unknown")).alias("lang")))).alias("_mix"))
    share = F.transform("_mix", lambda x: F.concat(x["lang"], F.lit(":"), F.format_number(-100.0 * x["order"] / F.col("n"), 1)))
    return total.select(source, "n", F.try_divide(F.col("_sv").cast("double"), "_sk").alias("viral_rate"), F.try_divide(F.col("_sl").cast("double"), "_st").alias("mean_length"), F.array_join(share, ", ").alias("language_mix"))
