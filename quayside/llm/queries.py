"""Registered queries of the training-data operators.

Each query runs its operator over its whole table.  ``oracle_sql`` holds the
DuckDB equivalents where SQL can express them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import chat, decontam, htmltext, langid, lexical, mixing, neardup, pieces, pii, resample, sharding, topk, urlfilter
from quayside.llm.common import table

#: Fixed value: the vocabulary that the piece queries encode with.
PIECES = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "copies", "taken")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op5_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages", "page_id", "url"), urlfilter.rules_table(spark))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = chat.with_probe(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return chat.digest(chat.format_conversations(conv))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shuffle_shards(table(spark, sf_dir, "documents", "doc_id", "text"), carry=["doc_id"])


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.scan(table(spark, sf_dir, "documents", "doc_id", "text"),
                                         table(spark, sf_dir, "benchmark", "item_id", "text")))


def op10_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    model = public_tokenizers.path(PIECES)
    encoded = pieces.encode(table(spark, sf_dir, "documents", "doc_id", "text"), model)
    return pieces.digest(pieces.decode(encoded, model))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_mixing, op2_topk, op3_langid, op4_neardup, op5_urlfilter, op6_chat, op7_sharding,
                                    op8_pii, op9_decontam, op10_htmltext, op11_lexical, op12_pieces, op13_resample, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.ORACLE_SQL, "op2_topk": topk.ORACLE_SQL, "op4_neardup": neardup.ORACLE_SQL,
            "op5_urlfilter": urlfilter.ORACLE_SQL, "op6_chat": chat.ORACLE_SQL, "op9_decontam": decontam.ORACLE_SQL,
            "op11_lexical": lexical.ORACLE_SQL, "op13_resample": resample.ORACLE_SQL}
