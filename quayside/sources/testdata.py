"""Readers for the driver-generated parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.session import pin_utc

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; projections and filters applied later reach the scan."""
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown driver table {name!r}")
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
