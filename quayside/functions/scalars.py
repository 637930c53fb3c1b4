"""Column-level helpers with the reference's exact semantics.

All of these return ``Column`` expressions built from Spark built-ins, so
they stay inside whole-stage codegen (no Python UDF anywhere).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_between(start, end) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end``
    (warehouse ``datediff('day', a, b)``; not elapsed 24 h periods)."""
    return F.datediff(col_(end), col_(start))


def hours_between(start, end) -> Column:
    """Hour boundaries crossed (warehouse ``datediff('hour', a, b)``).

    ``timestampdiff(HOUR)`` counts *elapsed* hours (10:59 -> 11:01 gives 0);
    the warehouse counts the boundary (gives 1).
    """
    s = F.unix_seconds(F.date_trunc("hour", col_(start)))
    e = F.unix_seconds(F.date_trunc("hour", col_(end)))
    return F.floor((e - s) / F.lit(3600)).cast("long")


# Fixed values of the reference's price-band macro (upper bounds, exclusive).
PRICE_BANDS = (("budget", 25), ("mid_range", 75), ("premium", 200))
PRICE_BAND_TOP = "luxury"


def price_band(price) -> Column:
    """NULL price falls through to the top band, as in the reference macro."""
    p = col_(price)
    expr = None
    for name, upper in PRICE_BANDS:
        expr = (F.when(p < upper, name) if expr is None else expr.when(p < upper, name))
    return expr.otherwise(PRICE_BAND_TOP)


def customer_segment(order_count) -> Column:
    n = col_(order_count)
    return (F.when(n.isNull(), "never_ordered")
            .when(n == 1, "one_time")
            .when(n.between(2, 4), "repeat")
            .otherwise("loyal"))


def day_of_week_sunday0(d) -> Column:
    """0 = Sunday ... 6 = Saturday (Spark's dayofweek is 1-based)."""
    return F.dayofweek(col_(d)) - 1


def trunc_date(unit: str, d) -> Column:
    """``date_trunc`` returns a timestamp; the models want a DATE."""
    return F.date_trunc(unit, col_(d)).cast("date")


def safe_ratio(num, den) -> Column:
    """num / nullif(den, 0) as DOUBLE (NULL instead of an ANSI divide error)."""
    return col_(num).cast("double") / F.nullif(col_(den).cast("double"), F.lit(0.0))


def scd_id(key, valid_from) -> Column:
    """Surrogate key of an SCD2 version: md5 over key and version start."""
    return F.md5(F.concat_ws("|", col_(key).cast("string"),
                             F.date_format(col_(valid_from), "yyyy-MM-dd HH:mm:ss")))


# Tokens the warehouse's CSV format treats as NULL (fixed values).
NULL_TOKENS = ("", "NULL", "null")


def normalize_null_tokens(df: DataFrame, columns=None) -> DataFrame:
    """Map the NULL tokens to real NULLs in every (or the given) string column."""
    cols = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.select([
        (F.when(F.col(c).isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
         if c in cols else F.col(c)) for c in df.columns])
