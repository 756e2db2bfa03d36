"""Which months hold a key: a persistent index beside a table of months.

Keys are known by a 64-bit hash and dealt into buckets by it. Each bucket has its hashes with
their months, and a Bloom filter cut into bitmaps of 32,768 bits. A batch asks the filters first and
reads only the buckets that may hold one of its keys, so loading new keys reads no key at all. Two
keys with one hash, like a key that has moved on, only name a month too many: the merge
compares the keys themselves.

The index lies in ``<table>.keys``. Hashes are appended before the table is written, so a
failure in between leaves the index complete. Replacing the table removes it; it is built again
from the key columns when it is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrips.operators.merge import FEW_KEYS

MONTH = "pickup_month"
#: Keys of a bucket and buckets of an index, about, when it is built.
BUCKET_KEYS, MOST_BUCKETS = 1 << 20, 4096
#: Bits of a bitmap, bits of a filter for each key at building, and bits set for a key.
BITMAP, BITS_PER_KEY, HASHES = 32_768, 10, 4
_HASHES = f"h bigint, {MONTH} int, bucket int"
_FILTERS = "bucket int, buckets int, block int, blocks int, bits binary"


def folder(path: str) -> str:
    return f"{path}.keys"


def hashed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash and month of the keys of some rows; a null key has a hash as well."""
    # a hash skips nulls, so where they are is hashed along
    h = F.xxhash64(*keys, *[F.col(k).isNull() for k in keys])
    return rows.select(h.alias("h"), F.col(MONTH).cast("int").alias(MONTH)).distinct()


def _dealt(hashes: DataFrame, buckets: int) -> DataFrame:
    return hashes.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)).cast("int"))


def _bits(hashes: DataFrame, blocks: int) -> DataFrame:
    """Where the filter of its bucket has the bits of a hash: block and place in its bitmap."""
    at = F.transform(F.sequence(F.lit(1), F.lit(HASHES)),
                     lambda i: F.pmod(F.xxhash64("h", i), F.lit(blocks * BITMAP).cast("bigint")))
    return hashes.withColumn("at", F.explode(at)).withColumns({
        "block": F.floor(F.col("at") / BITMAP).cast("int"), "place": F.col("at") % BITMAP})


def _append(spark: SparkSession, path: str, hashes: DataFrame, buckets: int, blocks: int) -> None:
    """Add hashes with months and buckets; the filters get rows with the new bits, which readers combine."""
    filters = _bits(hashes.select("h", "bucket").distinct(), blocks).groupBy("bucket", "block").agg(
        F.bitmap_construct_agg("place").alias("bits"))
    # a bucket with very many hashes is written by several tasks
    hashes.hint("rebalance", F.col("bucket")).write.mode("append").partitionBy("bucket").parquet(f"{folder(path)}/hashes")
    filters.select("bucket", F.lit(buckets).alias("buckets"), "block", F.lit(blocks).alias("blocks"), "bits").write.mode("append").parquet(
        f"{folder(path)}/filters")


def build(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str]) -> None:
    """Index the given rows of a table from scratch, with buckets and filters for their number."""
    hashes = hashed(rows, keys)
    count = hashes.count()
    buckets = min(MOST_BUCKETS, max(1, -(-count // BUCKET_KEYS)))
    blocks = max(1, -(-count * BITS_PER_KEY // (buckets * BITMAP)))
    _append(spark, path, _dealt(hashes, buckets), buckets, blocks)


def _filters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_FILTERS).parquet(f"{folder(path)}/filters")


def _shape(spark: SparkSession, path: str) -> tuple[int, int]:
    """Buckets of the index, bitmaps of each filter."""
    row = _filters(spark, path).select("buckets", "blocks").first()
    return (row[0], row[1]) if row else (1, 1)


def possible(spark: SparkSession, path: str, hashes: DataFrame, blocks: int) -> DataFrame:
    """The hashes, with buckets, that the filters do not rule out."""
    filters = _filters(spark, path).groupBy("bucket", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    asked = _bits(hashes.select("h", "bucket").distinct(), blocks).join(filters, ["bucket", "block"], "left")
    byte = F.conv(F.hex(F.substring("bits", (F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    is_set = F.coalesce(F.getbit(byte, (F.col("place") % 8).cast("int")).cast("int"), F.lit(0))
    return asked.groupBy("h", "bucket").agg(F.min(is_set).alias("all_set")).where("all_set = 1").select("h", "bucket")


def held(spark: SparkSession, path: str, hashes: DataFrame, blocks: int) -> DataFrame:
    """Hash and month that the index has for some of the hashes; other buckets are not read."""
    asked = possible(spark, path, hashes, blocks)
    buckets = dict(asked.groupBy("bucket").count().collect())  # at most MOST_BUCKETS
    known = spark.read.schema(_HASHES).parquet(f"{folder(path)}/hashes").where(F.col("bucket").isin(list(buckets)))
    wanted = asked.select("h")
    # a reload asks for as many hashes as the table has rows; only few may go through the driver
    wanted = F.broadcast(wanted) if sum(buckets.values()) <= FEW_KEYS else wanted.hint("merge")
    return known.join(wanted, "h", "left_semi").select("h", MONTH)


def months_and_note(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str]) -> set:
    """The months that hold an older version of a key of the batch, by the index; then the
    batch's own keys are added to it, each with its month, once."""
    buckets, blocks = _shape(spark, path)
    hashes = _dealt(hashed(batch, keys), buckets)
    known = held(spark, path, hashes, blocks)
    months = {r[0] for r in known.select(MONTH).distinct().collect()}  # one row a month
    fresh = hashes
    if months:
        # as many as the batch has keys, so never broadcast
        there = known.select(F.col("h").alias("_h"), F.col(MONTH).alias("_month")).hint("merge")
        fresh = hashes.join(there, (F.col("h") == F.col("_h")) & F.col(MONTH).eqNullSafe(F.col("_month")), "left_anti")
    _append(spark, path, fresh, buckets, blocks)
    return months
