import datetime as dt

from pyspark.sql import functions as F

from quayside.operators.scd2 import scd2_apply, scd2_current
from quayside.operators.upsert import incremental_filter, insert_ignore, sync_columns, upsert

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_scd2_versions_and_idempotence(spark):
    v1 = spark.createDataFrame([("1", "a", None), ("2", "b", 1), ("3", "c", 2)], "id string, x string, y int")
    v2 = spark.createDataFrame([("1", "a", None), ("2", "B", 1)], "id string, x string, y int")  # 3 removed
    s1 = scd2_apply(None, v1, "id", ["x", "y"], T1)
    s2 = scd2_apply(s1, v2, "id", ["x", "y"], T2)
    s3 = scd2_apply(s2, v2, "id", ["x", "y"], T3)
    assert s2.count() == 4 and s3.count() == 4            # rerun adds nothing
    assert _rows(scd2_current(s3), "id", "x") == [("1", "a"), ("2", "B"), ("3", "c")]  # deleted key stays
    closed = s3.filter(F.col("valid_to").isNotNull()).collect()
    assert [(r.id, r.x, r.valid_to) for r in closed] == [("2", "b", T2)]


def test_upsert_insert_ignore(spark):
    t = spark.createDataFrame([("1", 10), ("2", 20)], "k string, v int")
    d = spark.createDataFrame([("2", 21), ("3", 30)], "k string, v int")
    assert _rows(upsert(t, d, ["k"]), "k", "v") == [("1", 10), ("2", 21), ("3", 30)]
    d2 = spark.createDataFrame([("2", 99), ("3", 31), ("3", 30)], "k string, v int")
    assert _rows(insert_ignore(t, d2, ["k"]), "k", "v") == [("1", 10), ("2", 20), ("3", 30)]


def test_incremental_null_high_water_is_full_load(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1),), (dt.datetime(2020, 1, 10),)], "ts timestamp")
    assert incremental_filter(df, "ts", None).count() == 2
    assert incremental_filter(df, "ts", dt.datetime(2020, 1, 12), 3).count() == 1


def test_sync_columns(spark):
    old = spark.createDataFrame([("1", True)], "k string, legacy boolean")
    new = spark.createDataFrame([("2", 5)], "k string, extra int")
    out = sync_columns(old, new, "sync_all_columns")
    assert out.columns == ["k", "extra"]
    assert _rows(out, "k", "extra") == [("1", None), ("2", 5)]
