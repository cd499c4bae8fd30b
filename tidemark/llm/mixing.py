"""Operator 5, mixing sources to target weights by systematic sampling.

Sources in code point order, null last, weigh 5, 2, 1, 5, 2, 1 ... and share ``SHARE`` of all words; a
target stops at ``MOST`` times its source's words and the excess is shared again by weight. Each document's
expected copies are its source's target over its source's words. Along a fixed order of the
documents within a source (size class, hash bucket, size, hash) the expected copies are summed up, one
random offset a source is added, and a document is emitted once for each integer boundary it crosses.
The order is by size first, so the copies' words follow the target closely.

The prefix sum is taken in two steps, over counts by bucket and inside each bucket, so that a source that holds
most rows is spread over many tasks. Null and empty texts have size zero and take part like others; long texts are
counted whole; ties in the order are rows with equal id, size and text, for which it does not matter who gets the copies.
An empty table gives no rows; extra columns, whatever their names, are ignored by ``systematic`` and kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import plain_columns, table, unused, written

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
#: Hash buckets of a source and size class; a window holds one of them.
BUCKETS = 256


def words(text: Column) -> Column:
    """The number of maximal runs of other than ASCII white space; null is 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Each source's target words."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest, heavy = total - sum(capped.values()), sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / heavy > most * sizes[s]]
        if not over:
            return {s: capped[s] if s in capped else rest * weight[s] / heavy for s in names}
        capped |= {s: most * sizes[s] for s in over}


def source_targets(sized: DataFrame) -> DataFrame:
    """source, source_size and target, from rows with source and size; one row a source."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    spark = sized.sparkSession
    found = {r["source"]: int(r["source_size"]) for r in sums.toLocalIterator()}
    share = targets(found)
    # as a written table its size is known, so that rows are not shuffled by source to meet it
    return written(spark.createDataFrame([(s, found[s], float(share[s])) for s in share], "source string, source_size long, target double"), "targets")


def systematic(sized: DataFrame, seed: int = 42) -> DataFrame:
    """Rows of doc_id, source, size and row (a hash of the text) with source_size, target and copies."""
    rate = source_targets(sized)
    kind = F.floor(F.log2(F.col("size") + 1) * 16).cast("int")
    spot = F.pmod(F.xxhash64("doc_id", "row", F.lit(seed)), F.lit(BUCKETS)).cast("int")
    rows = sized.withColumns({"kind": kind, "spot": spot})
    same = lambda a, b, *keys: [a[k].eqNullSafe(b[k]) for k in keys]
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy("source", "kind", "spot").agg(F.count(F.lit(1)).alias("n"))
    # first over the size classes of a source, then over the buckets of a size class: few rows to a window
    kinds = buckets.groupBy("source", "kind").agg(F.sum("n").alias("n"))
    kinds = kinds.select("source", "kind", F.coalesce(F.sum("n").over(before("source").orderBy("kind")), F.lit(0)).alias("below"))
    buckets = buckets.withColumn("inner", F.coalesce(F.sum("n").over(before("source", "kind").orderBy("spot")), F.lit(0)))
    buckets = buckets.join(kinds, same(buckets, kinds, "source", "kind")).select(buckets.source, buckets.kind, "spot", (F.col("inner") + F.col("below")).alias("ahead"))
    inside = Window.partitionBy("source", "kind", "spot").orderBy("size", "doc_id", "row")
    ranked = rows.withColumn("rank", F.row_number().over(inside))
    placed = ranked.join(buckets, same(ranked, buckets, "source", "kind", "spot")).select(ranked["*"], "ahead")
    # a fraction of 20 bits keeps the sums below exact
    offset = F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(1 << 20)) / (1 << 20)
    joined = placed.join(rate, placed.source.eqNullSafe(rate.source)).drop(rate.source)
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    at = F.col("ahead") + F.col("rank")
    copies = F.least(F.floor(at * each + offset) - F.floor((at - 1) * each + offset), F.lit(int(MOST)))
    return joined.select("doc_id", "row", "source", "size", "source_size", "target", copies.cast("long").alias("copies"))


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    return written(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), words(F.col(text)).alias("size"), F.xxhash64(text).alias("row")), "sizes")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: words taken of each."""
    rows = systematic(sizes(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents as often as the mix takes them; all columns stay. Rows equal in id, source and text share their copies."""
    found = systematic(sizes(docs, doc_id, text, source)).groupBy("doc_id", "row", "source").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    d, dn, r, s, sn, a, m, t = (unused(docs, x) for x in ("mix_id", "mix_id_null", "mix_row", "mix_source", "mix_source_null", "mix_copies", "mix_rows", "mix_times"))
    # keys without nulls, so that the join and the window below deal rows alike and texts are shuffled once
    keys = lambda of_id, of_source: {d: F.coalesce(of_id, F.lit(0).cast("long")), dn: of_id.isNull(), s: F.coalesce(of_source, F.lit("")), sn: of_source.isNull()}
    names = [d, dn, r, s, sn]
    found = found.select(*[c.alias(k) for k, c in keys(F.col("doc_id"), F.col("source")).items()], F.col("row").alias(r), F.col("copies").alias(a), F.col("rows").alias(m))
    mine = docs.withColumns({**keys(F.col(doc_id).cast("long"), F.col(source).cast("string")), r: F.xxhash64(text)})
    order = Window.partitionBy(*names).orderBy(F.xxhash64(*plain_columns(docs)))
    turn = F.when(F.col(m) == 1, 1).otherwise(F.row_number().over(order))
    times = F.floor(F.col(a) * turn / F.col(m)) - F.floor(F.col(a) * (turn - 1) / F.col(m))
    rows = mine.join(found, names).withColumn(t, times.cast("int")).where(F.col(t) > 0)
    return rows.withColumn(t, F.explode(F.sequence(F.lit(1), F.col(t)))).select(*docs.columns)
