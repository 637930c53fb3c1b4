"""Mixing sources to target weights by capped water-filling (native).

1. Sizes are summed per source (partial aggregates, so a hot source is one
   row per task after the map side).
2. Water level: a source's share of the open budget is ``weight * num / den``
   with ``num`` = budget less what clamped sources hold and ``den`` = weight of
   the open ones.  Sources whose share is above ``max_epochs`` times their size
   are clamped there and the rest is reshared, until no share is too high.
   Each round is one aggregate over the per-source table.
3. Repetitions: a target of e epochs takes every document floor(e) times, and
   a seeded part of the source once more.  Documents fall into ``BUCKETS``
   seeded buckets per source; whole buckets are taken in order while that
   brings the sum nearer to the target, so each source ends within half a
   bucket (about 1/8192 of a large source) of its target, with no sort and no
   window over a source's documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import BROADCAST_ROWS, stored, with_result, word_count
from quayside.operators.ranking import global_rank

BUCKET_HEX = 3                  # leading hex digits of the seeded hash
BUCKETS = 16 ** BUCKET_HEX
SALTS = 64


@dataclass(frozen=True)
class MixPolicy:
    weights: tuple[int, ...] = (5, 2, 1)   # by rank of the source, repeating
    budget: float = 1.5                    # of the sum of all sizes
    max_epochs: float = 2.0                # a source is never repeated more often
    seed: str = "mix-1"


def seeded_bucket(doc_id: Column, text: Column, seed: str) -> Column:
    """Bucket 0..BUCKETS-1 from the seed and the id (the text where the id is
    NULL).  Rows with equal ids share a bucket and are taken alike."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), text), F.lit(""))
    digest = F.md5(F.concat(F.lit(seed + ":"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, BUCKET_HEX), 16, 10).cast("int")


def source_targets(per_source: DataFrame, policy: MixPolicy = MixPolicy()) -> DataFrame:
    """``(source, source_size)`` -> the same with ``target`` (double).

    Sources rank by code point, NULL last.  An empty table gives no rows; a
    source of size 0 gets target 0.
    """
    w = F.element_at(F.array(*[F.lit(int(x)) for x in policy.weights]),
                     (F.pmod(F.col("rank") - 1, F.lit(len(policy.weights))) + 1).cast("int"))
    cap = F.lit(float(policy.max_epochs)) * F.col("source_size")
    ranked = global_rank(per_source, [F.col("source").asc_nulls_last()]).withColumn("weight", w).withColumn("cap", cap)
    ranked = stored(ranked, "mix-sources")
    total, den = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)),
                            F.coalesce(F.sum("weight"), F.lit(0))).first()
    budget = float(policy.budget) * float(total)
    num, held = budget, -1
    while True:
        high = (F.col("weight") * F.lit(num) / F.lit(float(den)) > F.col("cap")) if den else F.lit(True)
        n, caps, left = ranked.agg(
            F.count(F.when(high, 1)), F.coalesce(F.sum(F.when(high, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~high, F.col("weight"))), F.lit(0))).first()
        if n == held:
            break
        held, num, den = n, budget - caps, left
    target = F.when(high, F.col("cap")).otherwise(F.col("weight") * F.lit(num) / F.lit(float(den or 1)))
    return ranked.withColumn("target", target).select("source", "source_size", "weight", "target")


def mix(docs: DataFrame, policy: MixPolicy = MixPolicy(), id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, copies, taken.

    * NULL text has size 0; NULL source is a source of its own, ranked last.
    * ``copies`` (0, 1, ... ceil(max_epochs)) is how often the mix holds the
      row, ``taken`` = copies * size.  Rows with equal ids get equal copies.
    * Same input and seed, same result; row order and partitioning play no part.
    * On a name clash the result column replaces the input's.
    """
    rows = docs.select(
        F.struct("*").alias("row"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        seeded_bucket(F.col(id_col), F.col(text_col), policy.seed).alias("bucket"))
    sums = stored(rows.groupBy("source", "bucket").agg(F.sum("size").alias("s")), "mix-buckets")
    targets = source_targets(sums.groupBy("source").agg(F.sum("s").alias("source_size")), policy)
    targets = targets.withColumn("whole", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    before = F.coalesce(F.sum("s").over(
        Window.partitionBy("b.source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.col("target") - F.col("whole") * F.col("source_size")     # words wanted beyond whole epochs
    nearer = 2 * F.col("before") + F.col("s") <= 2 * part
    cuts = (sums.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
            .select("b.source", "bucket", "s", "source_size", "target", "whole", before.alias("before"))
            .groupBy("source").agg(
                F.first("source_size").alias("source_size"), F.first("target").alias("target"),
                F.first("whole").alias("whole"),
                F.coalesce(F.max(F.when(nearer & (part > 0), F.col("bucket"))), F.lit(-1)).alias("cut")))
    cuts = stored(cuts, "mix-cuts")
    if cuts.count() <= BROADCAST_ROWS:
        joined = rows.alias("r").join(F.broadcast(cuts.alias("c")), F.col("r.source").eqNullSafe(F.col("c.source")), "left")
    else:  # many sources: salt both sides so that a hot one spreads over SALTS tasks
        spread = cuts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = (rows.withColumn("salt", F.pmod("bucket", F.lit(SALTS))).alias("r").join(
            spread.alias("c"), F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.salt") == F.col("c.salt")), "left"))
    copies = F.col("c.whole") + F.when(F.col("r.bucket") <= F.col("c.cut"), 1).otherwise(0)
    return with_result(joined.select(
        "row", "size", F.col("c.source_size").alias("source_size"), F.col("c.target").alias("target"),
        copies.cast("long").alias("copies")), "row",
        size=F.col("size"), source_size=F.col("source_size"), target=F.col("target"), copies=F.col("copies"),
        taken=F.col("copies") * F.col("size"))


def repeat_rows(mixed: DataFrame, columns: list[str], copies: str = "copies") -> DataFrame:
    """The mix itself: each row ``copies`` times, rows with 0 copies gone."""
    return (mixed.filter(F.col(copies) > 0)
            .select(*[F.col(f"`{c}`") for c in columns],
                    F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias("__copy")).drop("__copy"))


ORACLE_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 't' || text, '')), 1, 3))::INT AS bucket
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS rk
  FROM docs GROUP BY source),
weighted AS (
  SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 2.0::DOUBLE * source_size AS cap FROM src),
level(r, budget, num, den) AS (
  SELECT 0, 1.5::DOUBLE * sum(source_size)::DOUBLE, 1.5::DOUBLE * sum(source_size)::DOUBLE, sum(w)::BIGINT FROM weighted
  UNION ALL
  SELECT l.r + 1, l.budget,
         l.budget - sum(CASE WHEN l.den = 0 OR s.w * l.num / nullif(l.den, 0) > s.cap THEN s.cap ELSE 0 END),
         sum(CASE WHEN l.den = 0 OR s.w * l.num / nullif(l.den, 0) > s.cap THEN 0 ELSE s.w END)::BIGINT
  FROM level l, weighted s WHERE l.r < 64 GROUP BY l.r, l.budget, l.num, l.den),
final AS (SELECT num, den FROM level WHERE r = 64),
targets AS (
  SELECT source, source_size,
         CASE WHEN den = 0 OR w * num / nullif(den, 0) > cap THEN cap ELSE w * num / den END AS target
  FROM weighted, final),
whole AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
sums AS (SELECT source, bucket, sum(size)::BIGINT AS s FROM docs GROUP BY source, bucket),
runs AS (
  SELECT source, bucket, s,
         coalesce(sum(s) OVER (PARTITION BY source ORDER BY bucket
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sums),
cuts AS (
  SELECT w.source, w.source_size, w.target, w.whole,
         coalesce(max(CASE WHEN w.target - w.whole * w.source_size > 0
                            AND 2 * r.before + r.s <= 2 * (w.target - w.whole * w.source_size)
                           THEN r.bucket END), -1) AS cut
  FROM whole w JOIN runs r ON w.source IS NOT DISTINCT FROM r.source
  GROUP BY w.source, w.source_size, w.target, w.whole)
SELECT d.doc_id, d.size, c.source_size, c.target,
       (c.whole + CASE WHEN d.bucket <= c.cut THEN 1 ELSE 0 END) AS copies,
       d.size * (c.whole + CASE WHEN d.bucket <= c.cut THEN 1 ELSE 0 END) AS taken
FROM docs d JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""
