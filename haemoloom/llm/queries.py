"""Registered queries: each operator over its whole table, with production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haemoloom.llm import (
    bpe,
    chat,
    exact_dedup,
    line_rules,
    near_dedup,
    packing,
    personal_data,
    quality_model,
    ranked_search,
    token_counts,
    token_files,
    url_rules,
    whitening,
)
from haemoloom.runtime import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op2_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path)
    read = token_files.with_crc32(token_files.read_token_files(spark, path))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_line_rules(spark, sf_dir):
    return line_rules.judge_lines(_table(spark, sf_dir, "documents"))


def op4_url_rules(spark, sf_dir):
    rules = spark.sql(
        """SELECT * FROM VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block') AS rules(host, path, verdict)"""
    )
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), rules)


def op5_quality_model(spark, sf_dir):
    return quality_model.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_bpe(spark, sf_dir):
    return bpe.encoding_digests(_table(spark, sf_dir, "documents"))


def op7_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_personal_data(spark, sf_dir):
    return personal_data.span_texts(personal_data.find_personal_data(_table(spark, sf_dir, "documents")))


def op9_packing(spark, sf_dir):
    return token_files.with_crc32(packing.pack(_table(spark, sf_dir, "documents"))).drop("n_ids")


def op10_chat(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(turns.unionByName(more)))


def op11_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark, sf_dir):
    return ranked_search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_whitening(spark, sf_dir):
    return whitening.whitened_components(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_token_files": op2_token_files,
        "op3_line_rules": op3_line_rules,
        "op4_url_rules": op4_url_rules,
        "op5_quality_model": op5_quality_model,
        "op6_bpe": op6_bpe,
        "op7_near_dedup": op7_near_dedup,
        "op8_personal_data": op8_personal_data,
        "op9_packing": op9_packing,
        "op10_chat": op10_chat,
        "op11_token_counts": op11_token_counts,
        "op12_ranked_search": op12_ranked_search,
        "op13_whitening": op13_whitening,
    }
