"""Operator 9, sharding by jump consistent hashing, with DataFrame functions only.

A stable key (the id) walks through growing numbers of shards: a linear congruential step gives the next number
at which the key would move, until that lies beyond the number asked for. No ring table is kept, and one
shard more takes rows only into itself. Arithmetic modulo 2^64 is done in decimals of 38 digits.

Law ``key``: the id and the number of shards alone decide. A null id counts as id 0. Repeated ids share a
shard, and repeated rows follow each other in it: they tie, so which takes which slot makes no difference. Null texts have 16 bytes of
size and the checksum of the empty text; long texts are measured whole. An empty table gives no rows. Extra columns, whatever
their names, are ignored by ``placed``; ``sharded`` keeps them but for one named ``shard``, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table, written

SHARDS = 40
RECORD_BYTES = 16
#: Hash buckets of a shard; a window holds one of them.
BUCKETS = 256
#: Fixed values of the published algorithm.
MULTIPLIER, MODULUS = 2862933555777941757, 2**64


def jump(key: Column, shards: int) -> Column:
    """The shard, from 0, of a bigint key."""
    wide = lambda x: F.lit(str(x)).cast("decimal(38,0)")
    start = key.cast("decimal(38,0)")
    start = F.when(start < 0, start + wide(MODULUS)).otherwise(start)
    first = F.struct(start.cast("decimal(38,0)").alias("k"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(acc: Column, _: Column) -> Column:
        k = ((acc["k"] * wide(MULTIPLIER) + wide(1)) % wide(MODULUS)).cast("decimal(38,0)")
        high = F.floor(k.cast("decimal(38,0)") / wide(2**33)).cast("double") + 1.0
        j = F.floor((acc["j"] + 1) * (F.lit(float(2**31)) / high)).cast("long")
        return F.when(acc["j"] >= shards, acc).otherwise(F.struct(k.alias("k"), acc["j"].alias("b"), j.alias("j")))

    # b grows with each step, so as many steps as shards are enough
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), first, step, lambda acc: acc["b"].cast("int"))


def placed(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (the place in the shard) and grown_shard of every document."""
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(0))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(body) + RECORD_BYTES).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), jump(key, shards).alias("shard"), jump(key, shards + 1).alias("grown_shard"))
    return slotted(written(rows, "shards"), ["doc_id", "size", "text_crc32"])


def slotted(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with slot, gapless from 0 in each shard: a rank in a hash bucket after the counts of those before it."""
    rows = rows.withColumn("__spot", F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int"))
    ahead = Window.partitionBy("shard").orderBy("__spot").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "__spot").agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.select("shard", "__spot", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
    inside = Window.partitionBy("shard", "__spot").orderBy(*order)
    ranked = rows.withColumn("__rank", F.row_number().over(inside))
    slot = (F.col("__ahead") + F.col("__rank") - 1).cast("long")
    return ranked.join(counts, ["shard", "__spot"]).withColumn("slot", slot).drop("__spot", "__rank", "__ahead")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    rows = placed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def sharded(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id") -> DataFrame:
    """All columns of the documents and their shard; an old column of that name is replaced."""
    return docs.withColumn("shard", jump(F.coalesce(F.col(doc_id).cast("long"), F.lit(0)), shards))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, doc_id: str = "doc_id") -> None:
    """The documents as a Parquet table with a folder for each shard."""
    sharded(docs, shards, doc_id).write.partitionBy("shard").parquet(path)
