"""Slowly-changing-dimension type 2 with the ``check`` strategy.

``scd2_apply(current, source, key, check_cols, run_ts)`` returns the whole
new snapshot table: every source column plus ``valid_from``, ``valid_to``
and ``scd_id``.

* A key absent from the open versions is inserted (``valid_from = run_ts``).
* A key whose check columns differ (NULL-safe) closes its open version at
  ``run_ts`` and gets a new open version.
* Keys missing from the source stay current (no hard-delete handling,
  as in the reference snapshots); closed history is carried unchanged.
* Re-running with an unchanged source adds nothing.

Plan shape: only the *open* versions meet the source, in one full outer
join (one shuffle per side on the key); each joined row emits one or two
output rows through a single ``inline`` — no self-union of rescans.

``scd2_append(spark, path, ...)`` keeps the same history as two tables that only
grow: ``opened`` (every version, with a digest of its checked columns) and
``closed`` (the id and end of versions that ended).  A run reads keys, digests
and ids of the open versions, joins them with the source, and writes the few
versions that open or close into folders of its own, which a repeated run
replaces; no earlier file is written again.  ``scd2_history`` reads the snapshot.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.scalars import scd_id

META = ("valid_from", "valid_to", "scd_id")


def _with_meta(df: DataFrame, key: str, run_ts) -> DataFrame:
    ts = F.lit(run_ts).cast("timestamp")
    return (df.withColumn("valid_from", ts)
            .withColumn("valid_to", F.lit(None).cast("timestamp"))
            .withColumn("scd_id", scd_id(key, ts)))


def scd2_apply(current: DataFrame | None, source: DataFrame, key: str,
               check_cols: list[str], run_ts) -> DataFrame:
    cols = source.columns
    if current is None:
        return _with_meta(source, key, run_ts)

    ts = F.lit(run_ts).cast("timestamp")
    open_v = current.filter(F.col("valid_to").isNull())
    closed = current.filter(F.col("valid_to").isNotNull())

    o = open_v.select([F.col(c).alias(f"o__{c}") for c in cols + list(META)])
    s = source.select([F.col(c).alias(f"s__{c}") for c in cols])
    j = o.join(s, F.col(f"o__{key}") == F.col(f"s__{key}"), "full_outer")

    o_here = F.col(f"o__{key}").isNotNull()
    s_here = F.col(f"s__{key}").isNotNull()
    same = reduce(lambda a, b: a & b,
                  [F.col(f"o__{c}").eqNullSafe(F.col(f"s__{c}")) for c in check_cols])
    changed = o_here & s_here & ~same

    def row(prefix, valid_from, valid_to, sid):
        return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in cols],
                        valid_from.alias("valid_from"), valid_to.alias("valid_to"),
                        sid.alias("scd_id"))

    old_row = row("o__", F.col("o__valid_from"), F.col("o__valid_to"), F.col("o__scd_id"))
    closed_row = row("o__", F.col("o__valid_from"), ts, F.col("o__scd_id"))
    new_row = row("s__", ts, F.lit(None).cast("timestamp"), scd_id(F.col(f"s__{key}"), ts))

    out = (F.when(changed, F.array(closed_row, new_row))
           .when(o_here, F.array(old_row))
           .otherwise(F.array(new_row)))
    moved = j.select(F.inline(out))
    return closed.select(*cols, *META).unionByName(moved)


def scd2_current(snapshot: DataFrame) -> DataFrame:
    return snapshot.filter(F.col("valid_to").isNull())


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """Persist a snapshot split into current / history partitions."""
    (snapshot.withColumn("is_current", F.col("valid_to").isNull())
     .write.mode("overwrite").partitionBy("is_current").parquet(path))


def read_snapshot(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("is_current")


# ---- append-only history ----------------------------------------------------
_RUN = T.StructField("run", T.StringType())
_CLOSED = T.StructType([T.StructField("scd_id", T.StringType()), T.StructField("valid_to", T.TimestampType()), _RUN])


def _run_name(run_ts: _dt.datetime) -> str:
    return "r" + run_ts.strftime("%Y%m%d%H%M%S%f")


def _digest(cols: list[str]) -> Column:
    """Equal exactly where all columns are (NULL equals NULL)."""
    return F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)]), {"ignoreNullFields": "false"}), 256)


def _opened_schema(source: T.StructType) -> T.StructType:
    return T.StructType([*source.fields, T.StructField("valid_from", T.TimestampType()), T.StructField("scd_id", T.StringType()),
                         T.StructField("__digest", T.StringType()), _RUN])


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scd2_append(spark: SparkSession, path: str, source: DataFrame, key: str, check_cols: list[str], run_ts: _dt.datetime) -> None:
    """One run.  Keys that are new or differ in a checked column open a version;
    the version such a key had open is closed.  Runs come in the order of their
    times; the same run again replaces what it wrote."""
    name, ts = _run_name(run_ts), F.lit(run_ts).cast("timestamp")
    before = F.col("run") < name
    opened = _rows(spark, f"{path}/opened", _opened_schema(source.schema)).filter(before)
    closed = _rows(spark, f"{path}/closed", _CLOSED).filter(before)
    held = (opened.select(F.col(key).alias("__key"), F.col("__digest").alias("__was"), F.col("scd_id").alias("__old"))
            .join(closed.select(F.col("scd_id").alias("__old")), "__old", "left_anti"))
    now = source.withColumn("__digest", _digest(check_cols))
    moved = (now.join(held, F.col(key) == F.col("__key"), "left").filter(F.col("__old").isNull() | (F.col("__was") != F.col("__digest"))))
    new = moved.select(*source.columns, ts.alias("valid_from"), scd_id(F.col(key), ts).alias("scd_id"), "__digest", F.col("__old"))
    staged = f"{path}/moved/run={name}"         # both tables are fed from here, the join runs once
    _replace(new, staged)
    rows = spark.read.schema(new.schema).parquet(staged)
    _replace(rows.drop("__old"), f"{path}/opened/run={name}")
    _replace(rows.filter(F.col("__old").isNotNull()).select(F.col("__old").alias("scd_id"), ts.alias("valid_to")), f"{path}/closed/run={name}")


def _replace(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)


def scd2_history(spark: SparkSession, path: str, source_schema: T.StructType) -> DataFrame:
    """Every version with ``valid_from``, ``valid_to`` (NULL: open) and ``scd_id``."""
    opened = _rows(spark, f"{path}/opened", _opened_schema(source_schema)).drop("run", "__digest")
    closed = _rows(spark, f"{path}/closed", _CLOSED).select("scd_id", "valid_to")
    out = opened.join(closed, "scd_id", "left")
    return out.select(*[f.name for f in source_schema.fields], *META)
