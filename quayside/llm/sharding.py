"""Sharding by a two-pass external shuffle (native); law ``rows``.

Pass 1 scatters the records over buckets by a seeded hash of their id (never
of the text, so a large group of equal texts spreads like any other rows; copies
of a text without ids are numbered first and spread by their number); the number
of buckets follows from the total bytes, so one bucket fits in memory.  Pass 2
puts each bucket in a uniformly random order by a Fisher-Yates shuffle of its
records' places.  Bucket after bucket the records then form one uniformly random
sequence; record p goes to shard p mod n at slot p div n, so shard sizes differ
by at most one row.

The shuffles are seeded, dealt to a given number of partitions and stored, one
row for each bucket, and a record's place before the shuffle follows from its
keys: a task that runs again, or another run, deals the same order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import stored, with_result

BUCKET_BYTES = 32 << 20
MIN_BUCKETS = 1024


def _numbered(rows: DataFrame, key: Column) -> DataFrame:
    """Rows of equal ``key`` numbered from 0 as ``copy``, without a task that holds
    them all: places within a partition plus what the partitions before hold."""
    placed = rows.withColumn("k", key).withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33))
    counts = placed.groupBy("k", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("k", "part").orderBy("at")) - 1
    return (placed.withColumn("within", within).join(counts.select("k", "part", before.alias("before")), ["k", "part"])
            .withColumn("copy", F.col("before") + F.col("within")).drop("k", "at", "part", "within", "before"))


def shuffle_shards(docs: DataFrame, n_shards: int = 8, seed: int = 20, id_col: str = "doc_id",
                   text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, min_buckets: int = MIN_BUCKETS,
                   carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (its columns ``carry``, all by default) with size,
    text_crc32, law, shard and slot.

    * size = UTF-8 bytes of the text (NULL: none) plus 1; text_crc32 of NULL is NULL.
    * shard in 0..n_shards-1; slots of a shard run gapless from 0; shard sizes
      differ by at most one row.  An empty table gives no rows.
    * Rows that repeat an id and a text are interchangeable, and so are rows
      without an id that repeat a text: which of them gets which of their slots
      is not fixed, the set of slots is.
    * On a name clash the result column replaces the input's.
    """
    text, own = F.col(text_col), F.col(id_col).cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    rows = docs.select(F.struct(*(carry or ["*"])).alias("row"), own.alias("id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(text).alias("th"))
    total, unnamed = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.when(F.col("id").isNull(), 1))).first()
    key = F.coalesce("id", F.lit(""))
    named = rows.withColumn("copy", F.lit(-1).cast("long"))
    if unnamed:
        named = named.filter("id is not null").unionByName(_numbered(rows.filter("id is null"), F.struct("th", "size")))
    rows = named.withColumns({k: F.xxhash64(F.lit(seed), F.lit(k), key, F.when(F.col("copy") >= 0, F.struct("copy", "th"))) for k in ("h", "o")})
    buckets = max(min_buckets, -(-total // bucket_bytes))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).cast("int").alias("n")).withColumn("zone", F.floor(F.col("bucket") / 1024))
    # offsets in two levels: no window spans more than 1,024 buckets or buckets / 1,024 zones
    zones = counts.groupBy("zone").agg(F.sum("n").alias("zn")).withColumn("zoff", F.coalesce(F.sum("zn").over(
        Window.orderBy("zone").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = F.coalesce(F.sum("n").over(
        Window.partitionBy("zone").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("inner", inner).join(zones, "zone").select("bucket", "n", (F.col("inner") + F.col("zoff")).alias("off"))
    # the shuffles: one row for each bucket, in a fixed place
    deals = stored(offsets.repartition(16 + buckets // 4096, "bucket").sortWithinPartitions("bucket").select(
        "bucket", "off", F.shuffle(F.sequence(F.lit(0), F.col("n") - 1), seed).alias("to")), "shard-deals")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("o", "h", "th", "size")).cast("int")
    # the rows are dealt by bucket already, so this join moves the deals only
    dealt = rows.withColumn("place", place).join(deals, "bucket").withColumn("pos", F.col("off") + F.element_at("to", F.col("place")))
    return with_result(
        dealt, "row", size=F.col("size"), text_crc32=F.col("text_crc32"), law=F.lit("rows"),
        shard=F.pmod("pos", F.lit(n_shards)).cast("int"), slot=F.floor(F.col("pos") / n_shards).cast("long"),
        grown_shard=F.lit(None).cast("int"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows in slot order, files of bounded length."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").option("maxRecordsPerFile", 1_000_000).parquet(path))
