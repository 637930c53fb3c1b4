"""Ranked search against scoring every document."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quayside.llm import lexical
from tests.llm.util import docs, sentence, with_extra

ITEMS = "item_id long, text string"


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, items, k):
    held = [(i, Counter(split(t))) for i, t in rows if split(t)]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 75 + 25 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in split(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if gone else i, -s) for r, (s, gone, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows_of(n, seed):
    rng = random.Random(seed)
    rows = [(i * 7, sentence(rng, rng.randrange(1, 60), 150) + " the of") for i in range(n)]
    rows += [(10_000 + i, rows[5][1]) for i in range(40)]                       # ties
    rows += [(None, rows[3][1]), (None, rows[3][1]), (14, rows[2][1]), (14, "W1 w2 W1, É-w3")]
    rows += [(90, None), (91, ""), (92, " .,- \t"), (93, "w1 " * 20_000), (94, "the OF the")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,queries,vocabulary", [(8192, 2000, 50_000), (17, 3, 60)])
def test_against_all_documents(spark, block, queries, vocabulary):
    rng = random.Random(block)
    rows = rows_of(150, block)
    items = [(i, sentence(rng, rng.randrange(1, 40), 170) + " w1 w1 the") for i in range(12)]
    items += [(12, None), (13, ""), (14, "nowhere at all"), (None, "w5 W6"), (3, "É w3 w3 w9"), (15, rows[5][1])]
    got = lexical.search(with_extra(docs(spark, rows)).repartition(3), with_extra(spark.createDataFrame(items, ITEMS)),
                         k=5, block=block, max_queries=queries, max_terms=vocabulary).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, items, 5)


def test_no_documents_no_items(spark):
    some = docs(spark, [(1, "a b")])
    assert lexical.search(docs(spark, []), spark.createDataFrame([(1, "a")], ITEMS)).count() == 0
    assert lexical.search(some, spark.createDataFrame([], ITEMS)).count() == 0
    assert lexical.search(docs(spark, [(1, None), (2, "--")]), spark.createDataFrame([(1, "a")], ITEMS)).count() == 0


def test_pair_bounds_hold_and_are_tighter():
    """No document adds more than its pair's bound; pairs that never meet are bound by one term."""
    rng = np.random.default_rng(3)
    post = {t: (np.sort(rng.choice(400, 60, replace=False)).astype(np.int32), rng.integers(1, 1000, 60)) for t in range(6)}
    post[6] = np.setdiff1d(np.arange(400, dtype=np.int32), post[0][0])[:50], rng.integers(1, 1000, 50)
    made = lexical.Block(np.arange(400), post, {(0, 1), (2, 3), (0, 6)})
    for a, b in ((0, 1), (2, 3), (0, 6)):
        for m, n in ((1, 1), (2, 1), (1, 3)):
            total = np.zeros(400, np.int64)
            for t, times in ((a, m), (b, n)):
                total[post[t][0]] += times * post[t][1]
            bound = made.bound((a, m), (b, n))
            assert total.max() <= bound <= m * made.high[a] + n * made.high[b]
    assert made.bound((0, 1), (6, 1)) == max(made.high[0], made.high[6])
    both = set(post[0][0]) & set(post[1][0])
    high = max((int(post[0][1][list(post[0][0]).index(d)] + post[1][1][list(post[1][0]).index(d)]) for d in both), default=0)
    assert made.joint[0, 1] == (len(both), high)
