"""File loaders of the bulk-load step (CSV, typed Parquet, Hive-partitioned
Parquet) and the matching exports.

* CSV: explicit schema (or one inferred from all values), header, ``"`` as quote *and* escape (so ``"a""b"``
  reads as ``a"b``), FAILFAST (abort the load on a malformed row), then the
  warehouse's NULL tokens ('', 'NULL', 'null') become real NULLs — Spark's
  ``nullValue`` accepts only one token.
* Typed Parquet: positional export types are cast to the declared schema.
* Hive layout: ``year=/month=`` folders, partition discovery from
  ``basePath``; the partition columns are not stored in the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.scalars import normalize_null_tokens
from quayside.sources.adapter import conform


CSV = {"header": True, "quote": '"', "escape": '"'}


def write_csv(df: DataFrame, path: str, multi_line: bool = False) -> None:
    """Export as CSV.  A line break inside a value would tear its row for readers
    that go by line; it raises, unless ``multi_line`` says that readers know."""
    if not multi_line:
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        for c in text:
            df = df.withColumn(c, F.when(F.col(c).rlike(r"[\r\n]"), F.raise_error(F.lit(f"{c} holds a line break"))).otherwise(F.col(c)))
    df.write.mode("overwrite").options(**CSV).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)


def read_csv(spark: SparkSession, path: str, schema, multi_line: bool = False) -> DataFrame:
    """Columns are taken by the header's names, in whatever order the file has
    them; a column the schema wants and the header lacks raises, others are left
    out.  All files of a folder need the same header (a file with another one
    aborts the load).

    Files are read by line, so that large ones are split over tasks; with
    ``multi_line`` quoted values may span lines, and each file is one task.
    """
    raw = (spark.read.options(**CSV).option("inferSchema", False)
           .option("enforceSchema", False).option("multiLine", multi_line)
           .option("mode", "FAILFAST").option("nullValue", None).csv(path))
    names = {c.strip().lower(): c for c in raw.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in names]
    if missing:
        raise ValueError(f"{path}: the header lacks {missing}")
    raw = raw.select([F.col(f"`{names[f.name.lower()]}`").alias(f.name) for f in schema.fields])
    typed = normalize_null_tokens(raw)
    return typed.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


#: Types a column of text may turn out to have, the narrowest first.
INFERRED = ("int", "bigint", "double", "boolean", "date", "timestamp")


def read_csv_inferred(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV without a declared schema: a column gets the narrowest type that every
    one of its values fits, over the whole file, the NULL tokens aside; text if
    none does or there are no values.  One aggregate decides for all columns."""
    raw = (spark.read.options(**CSV).option("inferSchema", False).option("enforceSchema", False).option("multiLine", multi_line)
           .option("mode", "FAILFAST").option("nullValue", None).csv(path))
    raw = normalize_null_tokens(raw.toDF(*[c.strip() for c in raw.columns]))

    def fits(c: str, kind: str):
        text = F.col(f"`{c}`")
        read = F.try_to_timestamp(text) if kind == "timestamp" else text.try_cast(kind)
        ok = read.isNotNull()
        if kind == "date":          # a time of day would be lost
            ok = ok & text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$")
        return F.count(F.when(text.isNotNull() & ~ok, 1))

    checks = [fits(c, k).alias(f"{i}-{k}") for i, c in enumerate(raw.columns) for k in INFERRED]
    values = [F.count(f"`{c}`").alias(f"{i}") for i, c in enumerate(raw.columns)]
    seen = raw.agg(*checks, *values).first().asDict()                   # one row
    out = []
    for i, c in enumerate(raw.columns):
        kind = next((k for k in INFERRED if seen[f"{i}"] and not seen[f"{i}-{k}"]), "string")
        out.append(F.col(f"`{c}`").cast(kind).alias(c))
    return raw.select(out)


def export(df: DataFrame, path: str, kind: str = "parquet", by_month: str | None = None) -> None:
    """Write a model out for others: ``parquet`` or ``csv``, in ``year=/month=``
    folders of the time column ``by_month`` if one is named."""
    if kind not in ("parquet", "csv"):
        raise ValueError(f"unknown export format {kind}")
    if by_month:
        if kind == "csv":
            raise ValueError("partitioned exports are Parquet")
        write_partitioned(df, path, by_month)
    elif kind == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_parquet_typed(spark: SparkSession, path: str, schema) -> DataFrame:
    return conform(spark.read.parquet(path), schema)


def write_partitioned(df: DataFrame, path: str, ts_col: str) -> None:
    (df.withColumn("year", F.year(ts_col)).withColumn("month", F.month(ts_col))
     .write.mode("overwrite").partitionBy("year", "month").parquet(path))


def read_partitioned(spark: SparkSession, path: str, years=None) -> DataFrame:
    df = (spark.read.option("basePath", path).option("pathGlobFilter", "*.parquet").parquet(path))
    if years is not None:           # partition pruning: only these folders are listed/read
        df = df.filter(F.col("year").isin(*years))
    return df.drop("year", "month")
