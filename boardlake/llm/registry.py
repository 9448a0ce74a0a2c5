"""The registered queries of this subpackage with their SQL counterparts."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.llm import bitplanes, decontaminate, language, mixing, multi_index, oracles, repair, secrets, simhash, suffix_dedup, superkmer, tokens, toxicity, warc
from boardlake.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_copies(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op9_superkmer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.remove_repeated_windows(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_captures(warc.assemble(warc.read_records(spark, path)))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.damage(table(spark, sf_dir, "conversations"))
    return repair.repair_conversations(rows).withColumnRenamed("id", "conv_id")


def op12_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.with_inertia(*bitplanes.cluster_vectors(table(spark, sf_dir, "embeddings")))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    named = F.coalesce("nearest", F.lit(language.UNKNOWN)).alias("lang_pred")
    return found.select(F.col("id").alias("doc_id"), (~language.may_learn(F.col("id"))).alias("held_out"), named, "score", "rejected")


OPERATORS = (
    op1_toxicity, op2_simhash, op3_multi_index, op4_secrets, op5_tokens, op6_decontaminate, op7_suffix_dedup, op8_mixing, op9_superkmer,
    op10_warc, op11_repair, op12_bitplanes, op13_language,
)
QUERIES = {f.__name__: f for f in OPERATORS}


def _prepared(function):
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _prepared(function) for key, function in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
