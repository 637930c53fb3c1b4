"""Exact top-k against scoring every pair."""
import math
from fractions import Fraction

import numpy as np
import pytest

from quayside.llm import topk
from tests.llm.util import with_extra

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, k):
    """Every row against every other row, in whole numbers of any size."""
    v = []
    for i, x in rows:
        if i is not None and x is not None and all(y is not None and math.isfinite(y) for y in x):
            v.append((i, [math.floor(256 * Fraction(y)) for y in x]))
    out = []
    for a, (q, x) in enumerate(v):
        if q % every == 0:
            s = sorted((-sum(m * n for m, n in zip(x, y)), d) for b, (d, y) in enumerate(v) if b != a)[:k]
            out += [(q, r, d, max(-2 ** 63, min(2 ** 63 - 1, -n))) for r, (n, d) in enumerate(s, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,query_block", [(4096, 1024), (37, 3)])
def test_against_all_pairs(spark, block, query_block):
    rng = np.random.default_rng(block)
    near = rng.normal(0, 0.2, 16)
    rows = [(i, (near + rng.normal(0, 0.02, 16) if i % 4 == 0 else rng.normal(0, 0.2, 16)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]                        # ties
    rows += [(500, None), (501, [None] * 16), (502, [float("nan")] * 16), (503, [float("inf")] * 16), (None, rows[0][1]),
             (504, []), (505, [0.5, -0.5]), (0, rows[0][1])]
    got = topk.top_k(with_extra(spark.createDataFrame(rows, SCHEMA)), 5, 5, block=block, query_block=query_block).collect()
    assert sorted(tuple(r) for r in got) == brute([(i, x and [None if y is None else float(np.float32(y)) for y in x]) for i, x in rows], 5, 5)


def test_few_rows_and_large_numbers(spark):
    rows = [(0, [1e12, 1.0]), (5, [-1e12, 2.0]), (7, [0.0, 3.0])]
    got = {tuple(r) for r in topk.top_k(spark.createDataFrame(rows, SCHEMA), 5, 5).collect()}
    assert {(q, r, v) for q, r, v, _ in got} == {(0, 1, 7), (0, 2, 5), (5, 1, 7), (5, 2, 0)}
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], SCHEMA)).count() == 0


def test_rows_that_share_an_id(spark):
    """None is dropped: each is a candidate for the other and a query of its own."""
    rng = np.random.default_rng(5)
    rows = [(i % 20, [float(x) for x in rng.normal(0, 0.3, 4)]) for i in range(60)] + [(0, [1.0] * 4)] * 4
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 7, block=13).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5, 7)


def test_components_of_any_size(spark):
    """Doubles whose product with the scale overflows are whole numbers all the same."""
    rng = np.random.default_rng(6)
    big = [1e307, -1e307, 1.7e308, 5e300, 0.5, -3.0, 1e15]
    rows = [(i, [float(rng.choice(big)) for _ in range(3)]) for i in range(40)] + [(100 + i, [0.0, float(i), 1e-3]) for i in range(20)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 4, block=16).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5, 4)


@pytest.mark.parametrize("d,size", [(64, 0.125), (5000, 0.125), (64, 1e200), (3, 1e6)])
def test_index_proof(spark, d, size):
    """The members of a block always hold the exact best, by the index, at any
    number and size of components."""
    rng = np.random.default_rng(1)
    v = topk._integers(list(rng.normal(0, size, (400, d))), 256.0)
    index = topk.Index(np.arange(400), np.arange(400), v)
    for i in range(0, 400, 50):
        rows = index.members(v[i], 5, np.array([i]))
        score = [(-int(x), j) for j, x in enumerate(topk._scores(v, v[i])) if j != i]
        assert {j for _, j in sorted(score)[:5]} <= set(rows.tolist()) and i not in rows


def test_no_side_is_copied_for_each_block_of_the_other(spark):
    """What is broadcast or shuffled holds each query block once, however many index blocks there are."""
    df = spark.createDataFrame([(i, [float(i % 7), float(i % 3) - 1, 0.5]) for i in range(200)], "vec_id long, embedding array<float>")
    out = topk.top_k(df, every=10, k=3, block=16, query_block=4)
    assert "explode" not in out._jdf.queryExecution().optimizedPlan().toString()
    whole = topk.top_k(df, every=10, k=3)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, whole.collect())) and out.count() == 60
