"""Near-duplicates and connected components against comparing every pair."""
import random

import pytest

from quayside.llm import neardup
from quayside.llm.components import connected_components
from tests.llm.util import components, docs, family, near, sentence, shingles, with_extra


@pytest.mark.parametrize("block", [4000, 5])
def test_against_all_pairs(spark, block):
    rows = family(block)
    got = {r.doc_id: r for r in neardup.near_duplicates(with_extra(docs(spark, rows)), block=block).collect()}
    want = components(rows)
    assert len(got) == len(rows)
    for i, t in rows:
        assert got[i].n_shingles == len(shingles(t))
        assert (i, got[i].component_id) == (i, want[i])
        assert got[i].kept == (want[i] == i)


def test_hot_group_in_blocks(spark):
    """One group of near copies of a common text, cut into many blocks."""
    rng = random.Random(9)
    base = sentence(rng, 150, 5000)
    rows = [(i, near(rng, base, rng.randrange(1, 9))) for i in range(120)] + [(1000 + i, sentence(rng, 80, 5000)) for i in range(60)]
    rows += [(2000 + i, base) for i in range(50)]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs(spark, rows), block=16).collect()}
    assert got == components(rows)


def test_repeats_nulls_and_empty(spark):
    text = " ".join("abcdefgh")
    rows = [(None, text), (4, text), (4, text), (9, text), (None, None), (None, "lone words of no other document"), (11, "")]
    got = neardup.near_duplicates(docs(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == sorted(
        [(-1, 4, False), (4, 4, True), (4, 4, True), (9, 4, False), (-1, -1, True), (-1, -1, True), (11, 11, True)])
    kept = neardup.drop_near_duplicates(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == sorted(
        [(-1, ""), (-1, "lone words of no other document"), (4, text), (11, "")])
    assert neardup.near_duplicates(docs(spark, [])).count() == 0
    assert neardup.drop_near_duplicates(docs(spark, [])).count() == 0


def test_one_row_of_each_component_stays(spark):
    """NULL ids, repeated rows and repeated ids with other texts; columns that clash."""
    rng = random.Random(3)
    a, b = sentence(rng, 60), sentence(rng, 60)
    rows = [(1, a, "en"), (1, a, "en"), (None, a, "en"), (None, a, "de"), (None, a, "en"), (None, b, "x"), (None, b, "x"), (None, near(rng, b, 1), "x"),
            (5, "copied words here now", "p"), (5, "copied words here now", "q"), (5, "Copied words here now", "r"), (6, "", "s"), (6, "", "s")]
    df = docs(spark, rows).withColumnsRenamed({"source": "__id", "n_chars": "stays", "lang": "__TH"})
    kept = neardup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, (r.text or "").lower()[:20]) for r in kept.collect()]
    texts = [t for _, t in got]
    assert texts.count(a[:20]) == 1 and got.count((1, a[:20])) == 1 and texts.count(b[:20]) <= 1
    assert sum(i is None for i, _ in got) == 1 and texts.count("copied words here no") == 1 and got.count((6, "")) == 2 and len(got) == 5


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3), (300, 299), (299, 300)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {299: 299, 300: 299}
