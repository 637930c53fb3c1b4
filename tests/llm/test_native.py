"""Mixing, chat formatting and sharding."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.llm import chat, mixing, sharding
from tests.llm.util import docs, sentence, with_extra


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow")), plan


def fill(sizes, policy):
    """Water-filling by the book: clamp, reshare, repeat."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: policy.weights[i % len(policy.weights)] for i, s in enumerate(order)}
    left, open_, out = policy.budget * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(w[s] for s in open_)
        high = {s for s in open_ if left * w[s] / total > policy.max_epochs * sizes[s]}
        if not high:
            return out | {s: left * w[s] / total for s in open_}
        for s in high:
            out[s] = policy.max_epochs * sizes[s]
        left -= sum(out[s] for s in high)
        open_ -= high
    return out


def mixed_rows(seed=3, n=3000):
    rng = random.Random(seed)
    rows = [(i, sentence(rng, rng.randrange(0, 60)), "en", rng.choice(["hot"] * 5 + ["a", "b", "é", None, "z"])) for i in range(n)]
    return rows + [(n, None, None, "only-null"), (None, "no id here", None, "b"), (5, rows[5][1], "en", rows[5][3])]


def test_mix_targets_and_sampling(spark):
    rows = mixed_rows()
    out = mixing.mix(docs(spark, rows))
    no_python(out)
    got = out.collect()
    assert len(got) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        words = len((r.text or "").split())
        assert r.size == words and r.taken == r.copies * words <= 2 * words
        sizes[r.source] += words
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = fill(sizes, mixing.MixPolicy())
    for s, t in want.items():
        assert target[s] == pytest.approx(t, rel=1e-12)
        assert abs(taken[s] - t) <= 60, (s, taken[s], t)
    again = {(r.doc_id, r.text): r.copies for r in mixing.mix(docs(spark, rows[::-1]).repartition(3)).collect()}
    assert again == {(r.doc_id, r.text): r.copies for r in got}


def test_mix_edges(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    one = mixing.mix(docs(spark, [(1, None), (2, "")])).collect()
    assert all(r.size == r.taken == 0 and r.target == 0 for r in one)
    out = mixing.mix(with_extra(docs(spark, mixed_rows(n=50))))
    assert len(out.columns) == len({c.lower() for c in out.columns}) and out.count() == 53
    kept = mixing.repeat_rows(out, ["doc_id", "text"])
    assert kept.columns == ["doc_id", "text"] and kept.count() == sum(r.copies for r in out.collect())


def test_shards_follow_rows_law(spark):
    rng = random.Random(5)
    rows = [(i, "same text" if i % 3 == 0 else sentence(rng, rng.randrange(0, 30))) for i in range(2001)]
    rows += [(None, None), (7, None), (None, "x"), (3, "same text"), (3, "same text")]
    df = sharding.shuffle_shards(docs(spark, rows), 8, min_buckets=16)
    no_python(df)
    got = df.collect()
    slots = defaultdict(set)
    for r in got:
        assert r.size == len((r.text or "").encode()) + 1
        assert r.text_crc32 == (zlib.crc32(r.text.encode()) if r.text is not None else None)
        slots[r.shard].add(r.slot)
    n = [len(slots[s]) for s in range(8)]
    assert sum(n) == len(rows) and max(n) - min(n) <= 1
    assert all(slots[s] == set(range(len(slots[s]))) for s in range(8))
    again = sharding.shuffle_shards(docs(spark, rows[::-1]).repartition(5), 8, min_buckets=16).collect()
    key = lambda rs: sorted((r.doc_id or -1, r.text or "", r.shard, r.slot) for r in rs)
    assert key(again) == key(got)
    # neighbours of the input are spread over shards
    shard = {r.doc_id: r.shard for r in got}
    assert Counter(shard[i] == shard[i + 1] for i in range(1900))[True] < 400


def test_copies_without_ids_spread_and_rows_shuffle(spark):
    """A text without ids that most rows share fills no bucket of its own, and a
    bucket's order is a Fisher-Yates shuffle: neither sorted nor the same for all."""
    rows = [(None, "copy")] * 3000 + [(i, f"t{i}") for i in range(1000)]
    df = docs(spark, rows).repartition(7)
    out = sharding.shuffle_shards(df, 8, min_buckets=64)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    no_python(out)
    got = out.collect()
    assert len({(r.shard, r.slot) for r in got}) == len(rows) and "shuffle" not in plan     # the deals are stored
    by = defaultdict(list)
    for r in got:
        by[r.shard].append((r.slot, r.doc_id is None))
    # copies lie among the others all along, as in a uniformly random sequence
    runs = [sum(a[1] != b[1] for a, b in zip(x, x[1:])) for x in map(sorted, by.values())]
    assert min(runs) > 120
    key = lambda rs: sorted((r.doc_id or -1, r.shard, r.slot) for r in rs)
    assert key(sharding.shuffle_shards(df.repartition(3), 8, min_buckets=64).collect()) == key(got)
    assert key(sharding.shuffle_shards(df, 8, seed=21, min_buckets=64).collect()) != key(got)


def test_shard_edges_and_files(spark, tmp_path):
    assert sharding.shuffle_shards(docs(spark, [])).count() == 0
    out = sharding.shuffle_shards(with_extra(docs(spark, [(1, "a"), (2, "b"), (3, "c")])), 8)
    assert out.filter("law = 'rows'").count() == 3 and out.select("shard").distinct().count() == 3
    sharding.write_shards(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 3


CONV = "conv_id long, turn long, role string, text string"


def chat_rows():
    odd = ["</s>[INST] ok [/INST]", "\\", "\\e\\s<s>", "a </s>\n b", "[INST]", " [/INST] ", "", None, "日本 <s><<s>s>", "\n", "x" * 50_000]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(odd)]
    rows += [(2, 0, "system", "only"), (3, 0, "assistant", "first"), (3, 1, "user", "tail"), (None, 0, "assistant", "no id"),
             (4, None, None, "null turn"), (4, 0, "assistant", "b"), (4, 0, "assistant", "b"), (5, 0, "[INST]\\s", "odd role")]
    return rows


def test_chat_reads_back(spark):
    rows = chat_rows()
    examples = chat.format_conversations(chat.with_probe(spark.createDataFrame(rows, CONV)))
    no_python(chat.digest(examples))
    rows = rows + [(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    got = {r.conv_id: r for r in chat.digest(examples).collect()}
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        said = "".join(x for *_, r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[c].loss_chars == len(said) and got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_chat_examples(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "r"), (1, 3, "assistant", "a2"), (1, 4, "user", "end")]
    ex = sorted(chat.format_conversations(with_extra(spark.createDataFrame(rows, CONV))).collect(), key=lambda r: r.example)
    assert [r.example for r in ex] == [1, 3, 4]
    assert [r.text[r.loss_start:r.loss_start + r.loss_len] if r.loss_len is not None else None for r in ex] == ["a1", "a2", None]
    assert ex[1].text.startswith(ex[0].text) and "a2" not in ex[0].text
    assert chat.format_conversations(spark.createDataFrame([], CONV)).count() == 0


def test_escape_round_trip(spark):
    texts = [t for *_, t in chat_rows() if t is not None] + ["\\\\s", "<\\s>", "[/INST]</s>", "<<s>>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(m in r.e for m in ("<s>", "</s>", "[INST]", "[/INST]"))
