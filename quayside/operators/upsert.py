"""Keyed upsert, insert-if-absent, incremental selection, column sync.

Spark cannot ``MERGE INTO`` a plain Parquet table, and no table format jar
is assumed, so a merge is expressed as relational algebra:

    new_target = (target LEFT ANTI JOIN delta ON keys) UNION ALL delta

Both sides are shuffled once on the key; AQE broadcasts the (usually small)
delta key set when its runtime size allows.

``upsert`` gives the whole new target as a plan.  ``upsert_partitions`` writes
it into a table that is partitioned (facts by month): only the partitions that
a delta touches are written again, the files of all others stay as they are.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from quayside.operators.schema_ops import widened
from quayside.session import scratch_path


def dedupe_latest(df: DataFrame, keys: list[str], order_cols: list) -> DataFrame:
    """Keep one row per key: the greatest ``order_cols`` (deterministic)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() if isinstance(c, str) else c
                                            for c in order_cols])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def upsert(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``delta`` replace the target rows with the same key."""
    kept = target.join(delta.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(delta, allowMissingColumns=True)


def write_partitioned(df: DataFrame, path: str, part: str) -> None:
    """Write a table partitioned by ``part``, replacing those partitions of it
    that ``df`` holds; a partition's rows are spread over a few files by key."""
    spread = F.pmod(F.xxhash64(*[c for c in df.columns if c != part][:1]), F.lit(4))
    (df.repartition(F.col(part), spread).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part).parquet(path))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table by its declared schema (a partition's type is never guessed)."""
    return spark.read.schema(schema).parquet(path)


def upsert_partitions(spark: SparkSession, path: str, delta: DataFrame, keys: list[str], part: str, moves: bool = True) -> list[str]:
    """Upsert ``delta`` into the table at ``path``, partitioned by its string
    column ``part``; returns the partitions that were written again.

    ``moves``: a key's partition may change, so the partitions that hold the
    delta's keys now are found too (a scan of keys alone).  Without it only the
    partitions of the delta are read.  What is written is staged first, as a
    table can't be read and replaced in one job; a run that stops half way is
    simply run again.  A NULL partition value is a partition of its own.
    """
    target = read_partitioned(spark, path, delta.schema)
    touched = delta.select(part)
    if moves:
        touched = touched.unionByName(target.select(*keys, part).join(delta.select(*keys), keys, "left_semi").select(part))
    names = [r[0] for r in touched.distinct().collect()]                # partitions, not rows
    if not names:
        return []
    here = F.col(part).isin([n for n in names if n is not None])
    if None in names:
        here = here | F.col(part).isNull()
    staged = scratch_path(spark, "upsert-staged")
    upsert(target.filter(here), delta, keys).select(*delta.columns).write.partitionBy(part).parquet(staged)
    rows = read_partitioned(spark, staged, delta.schema)
    write_partitioned(rows, path, part)
    kept = {r[0] for r in rows.select(part).distinct().collect()}
    for name in set(names) - kept:          # every row of it moved elsewhere
        rest = delta.drop(part).limit(0)
        folder = "__HIVE_DEFAULT_PARTITION__" if name is None else name
        rest.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{part}={folder}")
    return sorted(names, key=lambda n: (n is None, n))


def insert_ignore(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT OR IGNORE``: add delta rows whose key is new; first copy wins
    within the delta (ties broken by all columns, so reruns are stable)."""
    first = dedupe_latest(delta, keys, [F.col(c).asc() for c in delta.columns if c not in keys])
    new = first.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new)


def high_water(target: DataFrame | None, ts_col: str):
    """max(ts_col) of the target as a Python value (one scalar, not data)."""
    if target is None:
        return None
    return target.agg(F.max(ts_col).alias("hw")).first()["hw"]


def incremental_filter(source: DataFrame, ts_expr, hw, lookback_days: int = 3) -> DataFrame:
    """Rows changed within ``lookback_days`` of the high-water mark.

    A NULL mark (empty target, or the reference's all-NULL payment_date trap)
    means a full load instead of selecting nothing.
    """
    if hw is None:
        return source
    if isinstance(hw, _dt.date) and not isinstance(hw, _dt.datetime):
        hw = _dt.datetime.combine(hw, _dt.time())
    cutoff = hw - _dt.timedelta(days=lookback_days)
    col = F.col(ts_expr) if isinstance(ts_expr, str) else ts_expr
    return source.filter(col >= F.lit(cutoff))


def sync_columns(target: DataFrame, delta: DataFrame, mode: str = "sync_all_columns") -> DataFrame:
    """Reconcile the columns of a target with those of a delta before a merge: the
    rows of both under the new columns (of the target alone with an empty delta).

    ``sync_all_columns``: new delta columns are added (NULL in old rows),
    columns missing from the delta are dropped, and a column whose type has
    grown (``schema_ops.widened``) takes the delta's type; a type that
    narrows or changes its kind raises.  ``append_new_columns`` keeps the
    removed ones.  ``fail`` raises on any difference.
    """
    t, d = target.columns, delta.columns
    kinds = {f.name: f.dataType for f in target.schema.fields}
    if mode == "fail" and (set(t) != set(d) or any(kinds[f.name] != f.dataType for f in delta.schema.fields)):
        raise ValueError(f"schema change: +{sorted(set(d) - set(t))} -{sorted(set(t) - set(d))}")
    cast = {f.name: F.col(f.name).cast(widened(f.name, kinds[f.name], f.dataType)) for f in delta.schema.fields if f.name in kinds}
    merged = target.withColumns(cast).unionByName(delta, allowMissingColumns=True)
    if mode == "append_new_columns":
        return merged.select(*t, *[c for c in d if c not in t])
    return merged.select(*d)
