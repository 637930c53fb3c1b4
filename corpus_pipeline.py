"""From raw documents to training shards, one stage after another.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that the next one gets, written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontam, langid, mixing, neardup, sharding
from quayside.llm.common import on_workers, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told; ``lang`` becomes that language.
    Documents without text or without letters go."""
    on_workers(spark)
    rows = docs.select(*COLUMNS)
    model = langid.fit(rows.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(rows.select(F.col("doc_id").cast("string"), "text", "source", F.col("n_chars").cast("string")), model)
    return found.filter(F.col("__lang") != langid.UNKNOWN).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("__lang").alias("lang"), "source",
        F.col("n_chars").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    on_workers(spark)
    return neardup.drop_near_duplicates(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    bench = table(spark, sf_dir, "benchmark", "item_id", "text")
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "source",
                       F.col("n_chars").cast("string").alias("n_chars"))
    return decontam.clean(rows, bench, drop=True).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat_rows(mixing.mix(docs.select(*COLUMNS)), COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their slot in it."""
    return sharding.shuffle_shards(docs.select(*COLUMNS)).select(*COLUMNS, "size", "text_crc32", "shard", "slot")


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

#: Hashing and the fitted language model have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, "pipeline-" + name.replace(" ", "-").lower())
    return docs
