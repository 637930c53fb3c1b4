"""Fixtures shared by the tests of the training-data operators."""
import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """``rows``: (doc_id, text[, lang[, source]])."""
    full = [(*r, *(None,) * (4 - len(r))) for r in rows]
    return spark.createDataFrame([(i, t, g, s, len(t) if t is not None else None) for i, t, g, s in full], DOCS)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def near(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
    return " ".join(words)


def shingles(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(width, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def components(rows, percent=80):
    """doc_id -> smallest id reachable, by comparing every pair."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(sets):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: low[find(i)] for i, (d, _) in enumerate(sets)}


def family(seed=1):
    """Random texts, copies, near copies in chains and stars, odd texts."""
    rng = random.Random(seed)
    out = []
    for _ in range(12):
        base = sentence(rng, rng.randrange(30, 120))
        out.append(base)
        out += [near(rng, base, rng.randrange(0, 6)) for _ in range(rng.randrange(1, 14))]
    chain = sentence(rng, 200)
    for _ in range(10):
        chain = near(rng, chain, 3)
        out.append(chain)
    out += ["", "one", "One", "one two three", "ONE two three", "\t \n", "long " * 5000]
    rng.shuffle(out)
    return [(i * 3, t) for i, t in enumerate(out)] + [(100_000, None), (100_003, None)]


#: For plans with extra and clashing columns.
EXTRA = dict(size="a", target="b", taken="c", bucket="d", row="e", shard="f", slot="g", law="h", node="i", label="j", key="k", n="l", rank="m")


def with_extra(df):
    from pyspark.sql import functions as F
    return df.withColumns({k: F.lit(v) for k, v in EXTRA.items() if k not in df.columns})
