"""Upserts and histories that write only what changed; types that grow."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.schema_ops import can_widen
from quayside.operators.scd2 import scd2_append, scd2_apply, scd2_history
from quayside.operators.upsert import read_partitioned, sync_columns, upsert_partitions, write_partitioned

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
FACT = "k long, v string, __month string"


def _rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def _files(df):
    return set(df.inputFiles())


def _fact(spark, tmp_path, rows):
    path = f"file://{tmp_path}/fact"
    df = spark.createDataFrame(rows, FACT)
    write_partitioned(df, path, "__month")
    return path, df.schema


def test_upsert_leaves_untouched_months_as_they_are(spark, tmp_path):
    path, schema = _fact(spark, tmp_path, [(i, "old", f"2024-{1 + i % 4:02d}") for i in range(40)])
    before = _files(spark.read.parquet(path))
    delta = spark.createDataFrame([(1, "new", "2024-02"), (100, "new", "2024-02"), (101, "new", "2024-09")], FACT)
    assert upsert_partitions(spark, path, delta, ["k"], "__month") == ["2024-02", "2024-09"]
    after = _files(spark.read.parquet(path))
    same = lambda files: {f for f in files if "__month=2024-02" not in f and "__month=2024-09" not in f}
    assert same(before) == same(after) and len(same(before)) >= 3 and before - after
    got = read_partitioned(spark, path, schema)
    assert got.count() == 42 and _rows(got.filter("v = 'new'"), "k", "__month") == [(1, "2024-02"), (100, "2024-02"), (101, "2024-09")]
    files = _files(spark.read.parquet(path))
    assert upsert_partitions(spark, path, delta.limit(0), ["k"], "__month") == [] and _files(spark.read.parquet(path)) == files
    upsert_partitions(spark, path, delta, ["k"], "__month")                 # the same delta again
    assert read_partitioned(spark, path, schema).count() == 42


def test_upsert_of_rows_that_move(spark, tmp_path):
    """A row whose month changes leaves its old one, even if that is then empty."""
    path, schema = _fact(spark, tmp_path, [(1, "a", "2024-01"), (2, "b", "2024-02"), (3, "c", "2024-02"), (4, "d", None)])
    delta = spark.createDataFrame([(1, "A", "2024-02"), (4, "D", "2024-03")], FACT)
    assert upsert_partitions(spark, path, delta, ["k"], "__month") == ["2024-01", "2024-02", "2024-03", None]
    got = read_partitioned(spark, path, schema)
    assert _rows(got, "k", "v", "__month") == [(1, "A", "2024-02"), (2, "b", "2024-02"), (3, "c", "2024-02"), (4, "D", "2024-03")]


def test_history_appends_only_what_opens_or_closes(spark, tmp_path):
    path = f"file://{tmp_path}/scd"
    schema = "id string, x string, y int"
    v1 = spark.createDataFrame([("1", "a", None), ("2", "b", 1), ("3", "c", 2), ("4", None, None)], schema)
    v2 = spark.createDataFrame([("1", "a", None), ("2", "B", 1), ("4", None, 7), ("5", "n", 0)], schema)     # 3 is gone
    scd2_append(spark, path, v1, "id", ["x", "y"], T1)
    first = _files(spark.read.parquet(f"{path}/opened"))
    for _ in range(2):                                                      # the second run, and once more
        scd2_append(spark, path, v2, "id", ["x", "y"], T2)
    scd2_append(spark, path, v2, "id", ["x", "y"], T3)                      # nothing changed
    assert first <= _files(spark.read.parquet(f"{path}/opened"))
    assert spark.read.parquet(f"{path}/opened/run=*").count() == 4 + 3
    want = scd2_apply(scd2_apply(scd2_apply(None, v1, "id", ["x", "y"], T1), v2, "id", ["x", "y"], T2), v2, "id", ["x", "y"], T3)
    cols = ["id", "x", "y", "valid_from", "valid_to", "scd_id"]
    assert _rows(scd2_history(spark, path, v1.schema), *cols) == _rows(want, *cols)


@pytest.mark.parametrize("old,new,fine", [
    ("int", "bigint", True), ("bigint", "int", False), ("smallint", "double", True), ("bigint", "double", False),
    ("decimal(10,2)", "decimal(12,2)", True), ("decimal(10,2)", "decimal(12,4)", True), ("decimal(10,2)", "decimal(11,4)", False),
    ("decimal(12,2)", "decimal(10,2)", False), ("int", "decimal(12,2)", True), ("bigint", "decimal(12,2)", False),
    ("date", "timestamp", True), ("timestamp", "date", False), ("float", "double", True), ("double", "float", False),
    ("string", "int", False), ("int", "string", False), ("array<int>", "array<bigint>", True)])
def test_lattice(old, new, fine):
    assert can_widen(T._parse_datatype_string(old), T._parse_datatype_string(new)) == fine


def test_types_that_grow_and_types_that_shrink(spark):
    old = spark.createDataFrame([("1", 5, dt.date(2024, 1, 2))], "k string, n int, at date")
    new = spark.createDataFrame([("2", 2 ** 40, dt.datetime(2024, 1, 3, 4))], "k string, n bigint, at timestamp")
    got = sync_columns(old, new.limit(0))
    assert got.schema["n"].dataType == T.LongType() and _rows(got, "k", "n", "at") == [("1", 5, dt.datetime(2024, 1, 2))]
    with pytest.raises(ValueError, match="n: bigint can't become int"):
        sync_columns(new, old.withColumn("at", F.col("at").cast("timestamp")))
    with pytest.raises(ValueError, match="schema change"):
        sync_columns(old, new, "fail")
