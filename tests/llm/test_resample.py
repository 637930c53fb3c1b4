"""Importance resampling against plain counting."""
import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from quayside.llm import resample
from tests.llm.util import docs, sentence, with_extra


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def feature_buckets(text, runs, buckets):
    w = words(text)
    return [crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, runs + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, runs=2, buckets=10_000, percent=25, least=20):
    s = Counter(b for _, t in rows for b in feature_buckets(t, runs, buckets))
    t = Counter(b for x in target for b in feature_buckets(x, runs, buckets))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    out = []
    for i, text in rows:
        f = feature_buckets(text, runs, buckets)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, len(words(text))])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for rank, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def rows_of(seed):
    rng = random.Random(seed)
    rows = [(i, sentence(rng, rng.randrange(1, 90), 200)) for i in range(120)]
    rows += [(500 + i, rows[0][1]) for i in range(60)]
    rows += [(7, rows[7][1]), (None, rows[9][1]), (None, rows[9][1]), (900, None), (901, ""), (902, " \n.7"), (903, "Éa b " * 9000),
             (904, "中文" * 400), (905, "ab--CD  ef\tgh \x00 " * 12)]
    return rows, [sentence(rng, 30, 60) for _ in range(20)] + [None, "", rows[3][1]]


@pytest.mark.parametrize("runs,buckets,percent,least", [(2, 10_000, 25, 20), (3, 101, 60, 1), (1, 50, 100, 0)])
def test_against_plain_counts(spark, runs, buckets, percent, least):
    rows, target = rows_of(runs)
    aim = with_extra(spark.createDataFrame([(t,) for t in target], "text string"))
    got = resample.resample(with_extra(docs(spark, rows)).repartition(5), aim, runs=runs, buckets=buckets, percent=percent, min_words=least)
    got = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, target, runs, buckets, percent, least)


def test_text_in_parts_has_the_same_windows(monkeypatch):
    text = "One two  three-four é5 " * 40 + "end"
    whole = resample.window_hashes(text, 3, resample._Split())
    monkeypatch.setattr(resample, "PIECE", 16)
    parts = resample.window_hashes(text, 3, resample._Split())
    assert whole[0] == parts[0] and sorted(whole[1]) == sorted(parts[1])
    assert Counter(x % 997 for x in whole[1].tolist()) == Counter(feature_buckets(text, 3, 997))


def test_carried_columns_and_empty_tables(spark):
    rows = docs(spark, [(1, "a " * 30, "en", "web"), (2, "b " * 30, "en", "web")]).withColumnRenamed("n_chars", "score")
    got = resample.resample(rows, spark.createDataFrame([("a a a",)], "text string"), carry=["doc_id", "text", "lang", "score"], percent=50)
    assert got.columns == ["doc_id", "text", "lang", "n_words", "n_features", "weight", "score", "rank"]
    (drawn,) = got.filter("rank is not null").collect()
    assert drawn.doc_id == 1 and drawn.text == "a " * 30 and drawn.n_words == 30
    none = spark.createDataFrame([], "text string")
    assert resample.resample(docs(spark, []), none).count() == 0
    assert resample.resample(rows, none).count() == 2
