"""Registered queries of the training-data operators and their SQL.

Every query applies its operator with production parameters to the whole given
table and returns the full result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tresoria.llm import brown, centroids, chat, divergence, hosts, mincut, packing, pii, quality, secrets, simhash, suffix, tiling
from tresoria.llm.common import read_table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read_table(spark, sf_dir, "documents", "doc_id", "text")))


def op2_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut.extract(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents", "doc_id", "text"), with_ids=False)


def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.leaks(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                        read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def op5_brown_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op7_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(read_table(spark, sf_dir, "documents", "doc_id", "text")))


def op8_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(read_table(spark, sf_dir, "documents", "doc_id", "text"), shingle=3, max_bits=3)


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove(read_table(spark, sf_dir, "documents", "doc_id", "text"), with_text=False)


def op11_va_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents", "lang", "source", "text"))


#: a conversation that says the template's own control strings
CONTROL_TURNS = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string"))
    return chat.read_back(chat.segments(turns), arranged=True)


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_html_mincut": op2_html_mincut,
    "op3_nnls_packing": op3_nnls_packing,
    "op4_string_tiling": op4_string_tiling,
    "op5_brown_scoring": op5_brown_scoring,
    "op6_host_trust": op6_host_trust,
    "op7_pii_boosting": op7_pii_boosting,
    "op8_simhash_pigeonring": op8_simhash_pigeonring,
    "op9_line_quality": op9_line_quality,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_va_centroids": op11_va_centroids,
    "op12_source_divergence": op12_source_divergence,
    "op13_chat_format": op13_chat_format,
}

ORACLE = {
    "op9_line_quality": quality.ORACLE_SQL,
    "op11_va_centroids": centroids.ORACLE_SQL,
    "op12_source_divergence": divergence.ORACLE_SQL,
    "op13_chat_format": chat.ORACLE_SQL,
}
