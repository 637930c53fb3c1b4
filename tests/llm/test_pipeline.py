"""The pipeline stage by stage, and the registered queries against DuckDB."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quayside.llm import decontam, langid
from tests.llm.util import components

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, rows[-1], SF).write.parquet(str(tmp_path / str(i)))
        rows.append(spark.read.parquet(str(tmp_path / str(i))))
        if i + 1 < len(corpus_pipeline.STAGES):
            assert rows[-1].columns == docs.columns
    raw, lang, dedup, clean, mixed, shards = rows
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    letters = {r.doc_id for r in raw.collect() if r.text and langid._LETTERS.search(r.text)}
    assert ids(lang) == letters
    low = components([(r.doc_id, r.text) for r in lang.collect()])
    assert ids(dedup) == set(low.values())
    made = decontam.automata(bench)
    hit = {r.doc_id for r in dedup.collect() if any(m.scan(decontam.words_of(r.text))[0] for m in made)}
    assert hit and ids(clean) == ids(dedup) - hit
    assert ids(mixed) <= ids(clean) and mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 2
    assert shards.count() == mixed.count() and shards.select("shard", "slot").distinct().count() == mixed.count()


def test_decontamination_stage_drops_short_items(spark, tmp_path):
    item, filler = " ".join(f"s{i}" for i in range(9)), " ".join(f"f{i}" for i in range(100))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, f"{filler} {item} {filler}", "en", "a", 1), (2, filler, "en", "a", 1), (3, f"{filler} {item[:-3]}", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()} == {2, 3}


def test_empty_and_null_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "the words of one", "en", None, None), (1, "the words of one", "en", None, None)],
                                docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, SF).select(*docs.columns)
    assert {r.doc_id for r in odd.collect()} <= {1}


@pytest.mark.parametrize("key", [k for k in entry.oracle_sql() if k.startswith("op")])
def test_oracles(spark, key):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark conversations".split():
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[key](spark, SF)
    cur = con.execute(entry.oracle_sql()[key])
    names = sorted(d[0] for d in cur.description)
    assert sorted(df.columns) == names
    at = {d[0]: i for i, d in enumerate(cur.description)}
    want = sorted(repr(tuple(r[at[n]] for n in names)) for r in cur.fetchall())
    assert sorted(repr(tuple(r[n] for n in names)) for r in df.collect()) == want


def test_registered():
    names = [k for k in entry.queries() if k.startswith("op") or k == "pipeline"]
    assert {int(k[2:].split("_")[0]) for k in names if k != "pipeline"} == set(range(1, 14)) and "pipeline" in names
