"""Global rank / running sum / exact median without a single-task window.

``Window.orderBy(...)`` with no partition moves every row to one task.
Instead:

1. sort with ``orderBy`` (range-partitioned, sampled boundaries: balanced
   when the order key is a total order — always add a unique tie-break);
2. tag rows with ``monotonically_increasing_id`` (partition index in the
   high bits, position in the low bits) and ``checkpoint()`` to the shared
   folder, so every later pass sees the same partitioning (a re-run of the
   sort could pick different range boundaries);
3. per-partition counts/sums (one row per partition) give each partition's
   offset — a tiny frame, broadcast by construction (its size is the
   partition count);
4. rank = offset + position; running sum = partition offset + running sum
   inside the partition (window partitioned by partition index: balanced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import shared_dir

_LOW = (1 << 33) - 1


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank",
                cum_of: str | None = None, cum_col: str = "cum") -> DataFrame:
    shared_dir(df.sparkSession)  # checkpoint dir: the cluster's shared folder
    s = df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    s = s.withColumn("__pid", F.shiftright(F.col("__mid"), 33)).withColumn(
        "__pos", F.col("__mid").bitwiseAND(F.lit(_LOW)))
    aggs = [F.count(F.lit(1)).alias("__n")]
    if cum_of:
        aggs.append(F.sum(cum_of).alias("__s"))
    stats = s.groupBy("__pid").agg(*aggs)
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = [F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")]
    if cum_of:
        offs.append(F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__soff"))
    offsets = stats.select("__pid", *offs)            # one row per partition
    out = s.join(F.broadcast(offsets), "__pid")
    local = Window.partitionBy("__pid").orderBy("__pos")
    out = out.withColumn(rank_col, (F.col("__off") + F.row_number().over(local)).cast("long"))
    if cum_of:
        out = out.withColumn(cum_col, F.col("__soff") + F.sum(cum_of).over(
            local.rowsBetween(Window.unboundedPreceding, 0)))
    return out.drop("__mid", "__pid", "__pos", "__off", "__soff")


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values with their number ``n``, kept in the shared folder: several
    figures of one column start from there, not each from the plan of ``df``."""
    shared_dir(df.sparkSession)
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)


def exact_median(df: DataFrame, value: str, alias: str = "median", count: str | None = None) -> DataFrame:
    """Exact median (interpolated between the two middle values) as DOUBLE; a row
    stands for as many values as ``count`` says (for one without it).

    Values are first collapsed to (value, count): a value shared by a third
    of the rows is one row.  The running count over sorted distinct values
    locates ranks floor((n+1)/2) and ceil((n+1)/2).
    """
    vc = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("__v")).agg(
        (F.sum(count) if count else F.count(F.lit(1))).alias("__c"))
    ranked = global_rank(vc, [F.col("__v").asc()], "__r", cum_of="__c", cum_col="__cum")
    n = ranked.agg(F.sum("__c").alias("__n"))      # from the stored ranks: the values are computed once
    j = ranked.crossJoin(n)  # n is a single row
    lo_k = F.floor((F.col("__n") + 1) / 2)
    hi_k = F.ceil((F.col("__n") + 1) / 2)
    first = F.col("__cum") - F.col("__c") + 1          # first rank held by this value
    hit = lambda k: (first <= k) & (F.col("__cum") >= k)
    picked = j.select(F.when(hit(lo_k), F.col("__v").cast("double")).alias("lo"),
                      F.when(hit(hi_k), F.col("__v").cast("double")).alias("hi"))
    agg = picked.agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"))
    return agg.select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.lit(0.5)).alias(alias))
