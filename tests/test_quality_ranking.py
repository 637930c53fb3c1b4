from pyspark.sql import functions as F

from quayside.operators import quality as Q
from quayside.operators.ranking import exact_median, global_rank
from quayside.operators.schema_ops import is_backward_compatible
from pyspark.sql import types as T


def test_generic_checks_null_semantics(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "bad"), (None, "y")], "k string, v string")
    assert [r.key_value for r in Q.unique(df, "m", "k").collect()] == ["a"]   # NULL keys ignored
    av = Q.accepted_values(df, "m", "v", ["x", "y"]).collect()
    assert [(r.value, r.n_rows) for r in av] == [("bad", 1)]                   # NULL passes
    parent = spark.createDataFrame([("x",)], "v string")
    rel = Q.relationships(df, "m", "v", parent, "p", "v").collect()[0]
    assert rel.failures == 2                                                   # 'bad', 'y'; NULL FK passes
    nn = {r.column_name: r.failures for r in Q.not_null(df, "m", ["k", "v"]).collect()}
    assert nn == {"k": 2, "v": 1}


def test_global_rank_and_median(spark):
    vals = [(str(i), i % 7) for i in range(200)]
    df = spark.createDataFrame(vals, "id string, c int").repartition(5)
    r = global_rank(df, [F.col("c").desc(), F.col("id").asc()], "rk", cum_of="c", cum_col="cum")
    got = [(x.id, x.rk, x.cum) for x in r.orderBy("rk").collect()]
    exp = sorted(vals, key=lambda t: (-t[1], t[0]))
    cum = 0
    for i, (id_, c) in enumerate(exp, 1):
        cum += c
        assert got[i - 1] == (id_, i, cum)
    m_odd = exact_median(spark.createDataFrame([(1,), (5,), (3,)], "v int"), "v").first()[0]
    m_even = exact_median(spark.createDataFrame([(1,), (2,), (2,), (10,)], "v int"), "v").first()[0]
    assert (m_odd, m_even) == (3.0, 2.0)


def test_backward_compat():
    def old():
        return T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    ok, _ = is_backward_compatible(old(), old().add("c", T.StringType(), True))
    bad1, _ = is_backward_compatible(old(), old().add("c", T.StringType(), False))
    old = old()
    bad2, _ = is_backward_compatible(old, T.StructType([old.fields[0]]))
    bad3, _ = is_backward_compatible(old, T.StructType([old.fields[0], T.StructField("b", T.StringType())]))
    assert (ok, bad1, bad2, bad3) == (True, False, False, False)
