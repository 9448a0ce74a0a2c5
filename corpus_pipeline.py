"""The training-data pipeline: five stages over the documents table, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boardlake.llm import stages
from boardlake.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.drop_toxic),
    ("simhash_dedup", stages.keep_one_of_near_copies),
    ("decontamination", stages.drop_benchmark_copies),
    ("secrets", stages.mask_secrets),
    ("mixing", stages.mix),
]

# Stages 1 to 4 learn a model, hash, align and test for randomness; SQL does not express them. tests/llm holds
# the run against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the mixed rows with ``n_words`` and ``taken``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
