"""Declarative data-quality checks.

Each check returns a DataFrame of *offending* rows (or per-column failure
counts); ``summary`` turns any of them into the uniform scorecard row
``(check_name, failures, status)``.  All checks are aggregations or
anti-joins — no row ever travels to the driver, and a check over a
100 TB table is one distributed job.

* ``unique``: group by the key, keep keys seen more than once (NULL keys
  ignored, as in the warehouse test).  Nearly every key is seen once, so that a
  partial count before the shuffle would only hold a task's keys in memory: with
  ``parts``, the keys are dealt over so many tasks first.
* ``not_null``: one pass per table counting NULLs of many columns at once
  (``count_if`` per column, then ``stack`` to rows).
* ``relationships``: child keys absent from the parent (NULL FK passes);
  a left-anti join of the distinct keys of both sides, so only these are
  shuffled; the rows of a child key are counted before.
* ``accepted_values``: value counts outside the set (NULL passes).
* ``recency`` / ``freshness``: max(ts) against an explicit ``as_of``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, model: str, column: str, parts: int = 1) -> DataFrame:
    keys = df.filter(F.col(column).isNotNull()).select(column)
    return ((keys.repartition(parts, column) if parts > 1 else keys).groupBy(column).count()
            .filter(F.col("count") > 1)
            .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    F.col(column).cast("string").alias("key_value"), F.col("count").alias("n_rows")))


def not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.select(F.lit(model).alias("model"),
                         F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, failures)"))


def accepted_values(df: DataFrame, model: str, column: str, values) -> DataFrame:
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return (bad.groupBy(column).count()
            .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    F.col(column).cast("string").alias("value"), F.col("count").alias("n_rows")))


def relationships(child: DataFrame, model: str, column: str, parent: DataFrame,
                  parent_model: str, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    held = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    orphans = held.join(keys, column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        F.lit(f"{parent_model}.{parent_column}").alias("parent"), "failures")


def _hours_since(ts_col, as_of) -> F.Column:
    return ((F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds(ts_col)).cast("double")
            / F.lit(3600.0))


def recency(df: DataFrame, model: str, column: str, hours: int, as_of,
            severity: str = "warn") -> DataFrame:
    m = df.agg(F.max(column).alias("max_value"))
    age = _hours_since(F.col("max_value"), as_of)
    bad = F.col("max_value").isNull() | (age > hours)
    return m.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), "max_value",
                    age.alias("hours_behind"),
                    F.when(bad, F.lit(severity)).otherwise(F.lit("pass")).alias("status"))


def freshness(df: DataFrame, source: str, column: str, warn_h: int, error_h: int, as_of) -> DataFrame:
    m = df.agg(F.max(column).alias("max_loaded_at"))
    age = _hours_since(F.col("max_loaded_at"), as_of)
    status = (F.when(F.col("max_loaded_at").isNull() | (age > error_h), "error")
              .when(age > warn_h, "warn").otherwise("pass"))
    return m.select(F.lit(source).alias("source"), "max_loaded_at", age.alias("age_hours"),
                    status.alias("status"))


def summary(check_name: str, failures: DataFrame, count_col: str | None = None,
            severity: str = "fail") -> DataFrame:
    """One scorecard row: total failures (row count, or sum of ``count_col``)."""
    n = (F.coalesce(F.sum(count_col), F.lit(0)) if count_col else F.count(F.lit(1))).cast("long")
    return failures.agg(n.alias("failures")).select(
        F.lit(check_name).alias("check_name"), "failures",
        F.when(F.col("failures") == 0, "pass").otherwise(severity).alias("status"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
