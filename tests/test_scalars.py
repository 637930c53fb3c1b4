import datetime as dt

from pyspark.sql import functions as F

from quayside.functions.scalars import customer_segment, days_between, hours_between, price_band


def test_hour_and_day_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 59), dt.datetime(2024, 1, 1, 11, 1)),
                                (dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 0)),
                                (dt.datetime(2024, 1, 1, 10, 0), None)], "a timestamp, b timestamp")
    r = df.select(hours_between("a", "b").alias("h"), days_between("a", "b").alias("d")).collect()
    assert [(x.h, x.d) for x in r] == [(1, 0), (1, 1), (None, None)]


def test_price_band_and_segment(spark):
    df = spark.createDataFrame([(24.99, None), (25.0, 1), (74.99, 2), (199.99, 4), (200.0, 5), (None, 9)],
                               "p double, n long")
    r = df.select(price_band("p").alias("b"), customer_segment("n").alias("s")).collect()
    assert [x.b for x in r] == ["budget", "mid_range", "mid_range", "premium", "luxury", "luxury"]
    assert [x.s for x in r] == ["never_ordered", "one_time", "repeat", "repeat", "loyal", "loyal"]
