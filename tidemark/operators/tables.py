"""Merges and upkeep of tables in plain partitioned Parquet folders.

A journal is only appended to. Beside it lies a table of its keys, dealt into buckets by their hashes, of which a batch reads its own only, so a
key is there once in the whole journal. Current state is dealt into buckets by key; a merge writes the buckets it has news for beside the live ones,
which stay until their successors are whole. Snapshots are partitions of one folder that are written whole and never changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.scratch import written

# Outcomes that later news cannot undo, and columns by their way to merge.
TERMINAL = {"transcript_lifecycle_status": ("available", ("available", "unavailable", "disabled", "permanent_error"))}
OUTCOMES = ("metadata_status", "transcript_status", "comments_status", "collection_status")
GREATEST = ("attempt_count", "last_attempt_at", "updated_at")


def _files(spark: SparkSession, path: str) -> DataFrame | None:
    """All files of a folder, or None if nothing was written yet; any other failure to read it is one."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or none with a file
            return None
        raise


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table in a folder, or None if nothing was written yet; of a state that ``upsert`` keeps, the live slots."""
    rows = _files(spark, path)
    if rows is None or not {"bucket", "slot", "generation"} <= set(rows.columns):
        return rows
    return rows.join(F.broadcast(_live(rows).select("bucket", "slot")), ["bucket", "slot"], "left_semi").drop("slot", "generation")  # a row a bucket


def touched(old: DataFrame, rows: DataFrame, part: str) -> DataFrame:
    """The rows of ``old`` in the parts that ``rows`` fall in; the parts found prune the scan."""
    parts = rows.select(F.col(part).cast(old.schema[part].dataType).alias(part)).distinct()
    return old.join(F.broadcast(parts), part, "left_semi")  # the days or buckets of one batch


def append_new(rows: DataFrame, path: str, key: str, part: str) -> None:
    """Adds the rows whose key is not there yet, where a row's ``part`` follows from its key, so that a repeated one is sought where it lies."""
    rows = rows.dropDuplicates([key])
    old = stored(rows.sparkSession, path)
    if old is not None:
        rows = new_rows(touched(old, rows, part), rows, [key])
    rows.write.mode("append").partitionBy(part).parquet(path)


def _of_keys(path: str) -> str:
    return f"{path.rstrip('/')}_keys"


def append_once(rows: DataFrame, path: str, key: str, part: str, order: tuple[str, ...] = (), buckets: int = 256, keys: DataFrame | None = None) -> None:
    """Adds the rows whose key is nowhere in the journal, whatever part they and the journal's row are in. Rows without a key are left out.

    A key belongs to one part, the least that the batch which brought it first had it in, and only a row of that part can be its row. The keys are written
    to their index before the rows are to the journal: a batch that stops between the two is read again, finds its keys with their parts,
    and adds the rows that are not yet there. So replays, also in other batches, give each key once. Of a batch's rows of one key and part the first by
    ``order`` is taken. ``keys`` are the rows' keys and parts, if they are to be had for less than the rows are.
    """
    spark = rows.sparkSession
    rows, keys = (df.where(F.col(key).isNotNull()).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")) for df in (rows, rows if keys is None else keys))
    kind = rows.schema[part].dataType
    claims = keys.groupBy("bucket", key).agg(F.min(part).alias(part), F.count(F.lit(1)).alias("_n"))
    known = stored(spark, _of_keys(path))
    if known is not None:
        known = touched(known, claims, "bucket").select(key, F.col(part).cast(kind).alias("_home"))
        claims = claims.join(known.select(key), key, "left_anti")
    claims = written(claims, "claims")
    claims.drop("_n").repartition("bucket").sortWithinPartitions(key).write.mode("append").partitionBy("bucket").parquet(_of_keys(path))
    if known is None and claims.where("_n > 1").isEmpty():  # the first batch, each key once: whole rows need not be moved to be chosen from
        rows.drop("bucket").write.mode("append").partitionBy(part).parquet(path, compression="zstd")
        return
    homes = claims.select(key, F.col(part).alias("_home"))
    if known is not None:
        homes = homes.unionByName(known)
    rows = rows.join(homes, key).where(F.col(part) == F.col("_home")).drop("_home", "bucket")
    first = F.struct(*order, F.xxhash64(*[c for c, k in rows.dtypes if "map<" not in k]))
    append_new(rows.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c != key]), first).alias("_r")).select(key, "_r.*"), path, key, part)


def compacted_keys(spark: SparkSession, path: str, key: str) -> None:
    """Rewrites the buckets of a journal's key index as one file each, each key once."""
    whole = written(spark.read.parquet(_of_keys(path)).dropDuplicates([key]), "keys")
    whole.repartition("bucket").sortWithinPartitions(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(_of_keys(path))


def _live(rows: DataFrame) -> DataFrame:
    """bucket and its slot of the highest generation: a row a bucket."""
    return rows.groupBy("bucket").agg(F.max_by("slot", "generation").alias("slot"), F.max("generation").alias("generation"))


def upsert(rows: DataFrame, path: str, key: Column, order: str | None = None, buckets: int = 64) -> None:
    """K4, K5: merges rows by ``key``, keeping known values; only buckets that have news are written.

    A bucket has two slots. Its merged rows go to the one that is not live and become live by their higher generation, so the rows before
    them are there until then, and a merge that stops halfway is simply repeated. A bucket is one file, which appears whole or not at all.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    old = _files(spark, path)
    live = {r["bucket"]: (r["slot"], r["generation"]) for r in _live(old).collect()} if old is not None else {}  # a row a bucket
    if old is not None:
        rows = merged(touched(stored(spark, path), rows, "bucket"), rows, key, order)
    slots = F.create_map(*[F.lit(x) for b, (slot, _) in live.items() for x in (b, 1 - slot)]) if live else F.lit(None)
    slot = F.coalesce(F.try_element_at(slots, F.col("bucket")), F.lit(0)) if live else F.lit(0)
    rows = rows.withColumns({"slot": slot.cast("int"), "generation": F.lit(1 + max((g for _, g in live.values()), default=0)).cast("long")})
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "slot").parquet(path)


def snapshot(rows: DataFrame, path: str, name: str) -> None:
    """K9: the whole table as a snapshot of that name."""
    rows.write.mode("overwrite").parquet(f"{path}/snapshot={name}")


def pinned(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """The snapshot of that name, or the last one: names that are numbers stand by number, others by time or text."""
    rows = spark.read.option("mergeSchema", True).parquet(path).withColumn("snapshot", F.col("snapshot").cast("string"))
    order = F.struct(F.col("snapshot").try_cast("decimal(38,0)"), F.col("snapshot").try_cast("timestamp"), "snapshot")
    name = name or rows.agg(F.max_by("snapshot", order)).first()[0]  # reads no column but the partition's
    return rows.where(F.col("snapshot") == name).drop("snapshot")


def aligned_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """All columns of both; those absent on one side are null there."""
    return a.unionByName(b, allowMissingColumns=True)


def new_rows(old: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys ``old`` lacks."""
    return rows.join(old.select(*keys), keys, "left_anti")


def identity(source: str = "source", platform_id: str = "platform_event_id", fallback: tuple[str, ...] = ("user_id", "url", "event_ts")) -> Column:
    """The business identity: the platform's id, or a hash of what else names the event."""
    other = F.sha2(F.concat_ws("\u001f", *[F.col(c).cast("string") for c in fallback]), 256)
    return F.concat_ws("\u001f", F.col(source), F.coalesce(F.concat(F.lit("id:"), F.col(platform_id)), F.concat(F.lit("h:"), other)))


def collapsed(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key with the last known value of every column, by one aggregation rather than a window a column."""
    at = F.struct(*[F.col(c) for c in order])
    own = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in own]).select(*rows.columns)


def assignment(name: str, old: Column, new: Column) -> Column:
    """K5: the value after a merge: outcomes that stick, the greater of counts and times, else the new value if known."""
    if name in TERMINAL:
        won, final = TERMINAL[name]
        return F.when(new == won, won).when(old.isin(*final), old).otherwise(F.coalesce(new, old))
    if name in OUTCOMES:
        return F.when(new == "success", "success").when(old.isin("success", "not_available", "disabled"), old).otherwise(F.coalesce(new, old))
    if name in GREATEST:
        return F.greatest(old, new)
    return F.coalesce(new, old)


def merged(old: DataFrame, rows: DataFrame, key: Column, order: str | None = None) -> DataFrame:
    """``rows`` merged into ``old`` by one equi-join on a computed key.

    With ``order`` (a time column) a field changes only if its row is no older than the old one; without, the last arrival wins.
    """
    old, rows = old.withColumn("_key", key), rows.withColumn("_key", key)
    for c in set(old.columns) - set(rows.columns):
        rows = rows.withColumn(c, F.lit(None).cast(old.schema[c].dataType))
    for c in set(rows.columns) - set(old.columns):
        old = old.withColumn(c, F.lit(None).cast(rows.schema[c].dataType))
    t, s = old.alias("t"), rows.alias("s")
    both = t.join(s, F.col("t._key") == F.col("s._key"), "full_outer")
    late = F.coalesce(F.col(f"s.{order}") < F.col(f"t.{order}"), F.lit(False)) if order else F.lit(False)

    def value(c: str) -> Column:
        new = assignment(c, F.col(f"t.{c}"), F.col(f"s.{c}"))
        # a late row fills gaps only, but what sticks or grows does so from any row
        return F.when(late, F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))).otherwise(new) if order and c not in (*TERMINAL, *OUTCOMES, *GREATEST) else new

    return both.select(*[value(c).alias(c) for c in old.columns if c != "_key"])


def updated(old: DataFrame, rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """K6: known values of ``columns`` for keys that are there; nothing is added."""
    new = rows.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = old.join(new, keys, "left")
    return joined.withColumns({c: F.coalesce(f"_new_{c}", c) for c in columns}).select(*old.columns)


def replaced(old: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """K7."""
    return aligned_union(old.join(rows.select(*keys), keys, "left_anti"), rows)


def null_safe_merged(old: DataFrame, rows: DataFrame, keys: list[str], update: bool = True) -> DataFrame:
    """K8: a merge whose keys may be null; without ``update`` old rows stay as they are."""
    same = [old[k].eqNullSafe(rows[k]) for k in keys]
    fresh = rows.join(old, same, "left_anti")
    if not update:
        return aligned_union(old, fresh)
    own = [c for c in old.columns if c not in keys]
    new = rows.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in own if c in rows.columns], F.lit(True).alias("_hit"))
    joined = old.join(new, [old[k].eqNullSafe(new[f"_k_{k}"]) for k in keys], "left")
    kept = joined.select(*keys, *[F.coalesce(f"_n_{c}", c).alias(c) if c in rows.columns else F.col(c) for c in own])
    return aligned_union(kept, fresh)


def backfilled(rows: DataFrame, **defaults: Column) -> DataFrame:
    """Nulls of the named columns filled from other columns."""
    return rows.withColumns({c: F.coalesce(F.col(c), v) for c, v in defaults.items()})


def without(rows: DataFrame, condition: Column) -> DataFrame:
    """All rows but those for which ``condition`` is true."""
    return rows.where(~F.coalesce(condition, F.lit(False)))


def with_optional(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Typed null columns where a file lacks them."""
    return rows.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in rows.columns})


def with_availability(rows: DataFrame, metrics: list[str]) -> DataFrame:
    """P5: a flag for each metric, from its value where the flag is missing or null."""
    there = lambda m: F.col(m).isNotNull()
    return rows.withColumns({f"{m}_available": F.coalesce(F.col(f"{m}_available"), there(m)) if f"{m}_available" in rows.columns else there(m) for m in metrics})


def aligned(rows: DataFrame, target: T.StructType) -> DataFrame:
    """P20: ISO texts read as the times and dates that the target holds; what cannot be read is null."""
    want = {f.name: f.dataType for f in target}
    cast = {f.name: F.col(f.name).try_cast(want[f.name]) for f in rows.schema if f.name in want and want[f.name] != f.dataType and isinstance(want[f.name], (T.TimestampType, T.TimestampNTZType, T.DateType))}
    return rows.withColumns(cast) if cast else rows


def compacted(rows: DataFrame, path: str, name: str, target_bytes: int = 128 << 20) -> DataFrame:
    """``rows`` as a snapshot of few files of about ``target_bytes``; their number must stay. Gives files, bytes and rows before and after."""
    totals = lambda df, when: storage(df).agg(F.lit(when).alias("when"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    before = totals(rows, "before").first()
    snapshot(rows.repartition(max(1, -(-(before["bytes"] or 0) // target_bytes))), path, name)
    report = totals(rows, "before").unionByName(totals(pinned(rows.sparkSession, path, name), "after"))
    after = report.where(F.col("when") == "after").first()
    if after["rows"] != before["rows"]:
        raise RuntimeError(f"compaction changed {before['rows']} rows into {after['rows']}")
    return report


def storage(rows: DataFrame) -> DataFrame:
    """Rows and bytes of each file of a file-based table."""
    files = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return files.groupBy("file").agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def partitions(rows: DataFrame, *by: str) -> DataFrame:
    """Files, bytes and rows of each partition of a file-based table."""
    files = rows.groupBy(*by, F.col("_metadata.file_path").alias("file")).agg(F.max(F.col("_metadata.file_size")).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return files.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))


def rekeyed(rows: DataFrame, key: Column, order: list[str], path: str, name: str) -> DataFrame:
    """A new key for all rows, one row a key (the last by ``order``), staged, checked, and only then the table's last snapshot.

    The snapshot before it stays as a backup. A row without a key, or a key left out or given twice, stops it before it becomes visible.
    """
    rows = rows.withColumn("row_key", key)
    own = [c for c in rows.columns if c != "row_key"]
    staged = written(rows.groupBy("row_key").agg(F.max_by(F.struct(*own), F.struct(*order)).alias("_r")).select("row_key", "_r.*"), "staged")
    want = rows.agg(F.count_distinct("row_key").alias("n"), F.count_if(F.col("row_key").isNull()).alias("bad")).first()
    have = staged.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_key").alias("keys")).first()
    if want["bad"] or not want["n"] == have["n"] == have["keys"]:
        raise ValueError(f"{want['bad']} rows without a key, {want['n']} keys, {have['n']} rows staged")
    snapshot(staged, path, name)
    return pinned(rows.sparkSession, path, name)


def backfill_journal(current: DataFrame, journal: DataFrame, id_of: Column, at: str) -> tuple[DataFrame, DataFrame]:
    """Journal rows, marked as synthetic, for rows of current tables that the journal lacks, and the proofs that they are applied."""
    made = current.withColumns({"event_id": id_of, "ingested_at": F.col(at), "synthetic": F.lit(True)})
    missing = new_rows(journal, made.dropDuplicates(["event_id"]), ["event_id"])
    return missing, missing.select("event_id", F.col("ingested_at").alias("applied_at"))


def exported(rows: DataFrame, path: str, order: str, form: str = "parquet", where: Column | None = None) -> DataFrame:
    """Rows (those for which ``where`` holds) in order over many files, as Parquet, CSV or JSON lines, and a manifest beside them.

    The manifest is a JSON file of the folder ``manifest``: the count, which must be that of the files, the columns and a fingerprint of the ids.
    """
    spark = rows.sparkSession
    rows = rows if where is None else rows.where(where)
    out = rows if form == "parquet" else flat(rows)
    writer = out.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite")
    reader = {"parquet": spark.read, "csv": spark.read.option("header", True).option("escape", '"').option("multiLine", True), "json": spark.read}[form]
    (writer.option("header", True).option("escape", '"') if form == "csv" else writer).format(form).save(f"{path}/data")
    marks = lambda df: df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.conv(F.substring(F.sha2(F.col(order).cast("string"), 256), 1, 15), 16, 10).cast("decimal(38,0)")).cast("string").alias("fingerprint"))
    want, have = marks(rows).first(), marks(reader.format(form).load(f"{path}/data")).first()
    if want != have:
        raise RuntimeError(f"{have['rows']} of {want['rows']} rows were written")
    manifest = spark.range(1).select(F.lit(form).alias("format"), F.lit(have["rows"]).alias("rows"), F.lit(have["fingerprint"]).alias("fingerprint"), F.lit(",".join(rows.columns)).alias("columns"))
    manifest.write.mode("overwrite").json(f"{path}/manifest")
    return spark.read.schema(manifest.schema).json(f"{path}/manifest")


def flat(rows: DataFrame) -> DataFrame:
    """Lists as JSON and times as ISO texts, for CSV and the like."""
    out = {}
    for f in rows.schema:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out[f.name] = F.to_json(f.name)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out[f.name] = F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss")
    return rows.withColumns(out) if out else rows
