"""Logs that micro-batches append to, and their fold into a base.

``<log>/batch=N`` holds the rows of micro-batch N; a retry replaces its folder. ``<log>-base/mark=M`` holds the newest row
per key of all batches up to M, with the batch it came from, and counts once ``<log>-marks/mark=M`` is there. Readers take the base
of the newest mark and the batches above it, so a fold that dies changes nothing they see and is simply done again.

The newest batch is never folded: its micro-batch may still be retried. What a fold replaces is removed by the next one, so
frames that were planned before a fold can be read to their end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.operators.grouping import latest_per_key
from boardlake.session import folder_names, remove_folder

BATCH = T.StructField("batch", T.LongType())


def append_batch(rows: DataFrame, log: str, batch_id: int, **options: str) -> None:
    """Write a micro-batch's rows, in place of what an earlier try left."""
    rows.write.mode("overwrite").options(**options).parquet(f"{log}/batch={batch_id}")


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    return sorted(int(n.removeprefix(f"{name}=")) for n in folder_names(spark, folder, "_SUCCESS") if n.startswith(f"{name}="))


def finished_batches(spark: SparkSession, log: str) -> list[int]:
    """Numbers of the batches that were written to their end."""
    return _numbers(spark, log, "batch")


def low_water_mark(spark: SparkSession, log: str) -> int:
    """The newest batch that is in the base; -1 without a base."""
    return max(_numbers(spark, f"{log}-marks", "mark"), default=-1)


def read_log(spark: SparkSession, log: str, schema: T.StructType, below: int | None = None) -> DataFrame:
    """Base and later batches of a log, with the number of each row's batch; empty where nothing was written.

    ``below`` leaves out batches from that number on, which a retry of that micro-batch must not see.
    """
    numbered = T.StructType([*schema.fields, BATCH])
    mark = low_water_mark(spark, log)
    parts = [spark.read.schema(numbered).parquet(f"{log}-base/mark={mark}")] if mark >= 0 else []
    later = [b for b in finished_batches(spark, log) if b > mark and (below is None or b < below)]
    if later:
        # Batches are named, so that the plan reads no folded folder and none that a fold may remove.
        parts.append(spark.read.schema(numbered).option("basePath", log).parquet(*[f"{log}/batch={b}" for b in later]))
    if not parts:
        return spark.createDataFrame([], numbered)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def fold_log(spark: SparkSession, log: str, schema: T.StructType, keys: list[str], order: list[Column | str]) -> int | None:
    """Fold all finished batches but the newest into a new base and return its mark; ``None`` if there is nothing to fold.

    The newest row per key by ``order`` stays, of equal ones that of the later batch. Only one fold of a log runs at a time.
    """
    mark = low_water_mark(spark, log)
    ready = [b for b in finished_batches(spark, log)[:-1] if b > mark]
    if not ready:
        return None
    rows = read_log(spark, log, schema, below=ready[-1] + 1)
    latest_per_key(rows, keys, [*order, "batch"]).write.mode("overwrite").parquet(f"{log}-base/mark={ready[-1]}")
    spark.createDataFrame([(ready[-1],)], "mark bigint").coalesce(1).write.mode("overwrite").json(f"{log}-marks/mark={ready[-1]}")
    for old in _numbers(spark, f"{log}-marks", "mark"):
        if old < mark:
            remove_folder(spark, f"{log}-base/mark={old}")
            remove_folder(spark, f"{log}-marks/mark={old}")
    for folded in finished_batches(spark, log):
        if folded <= mark:
            remove_folder(spark, f"{log}/batch={folded}")
    return ready[-1]


def stamp_commits(rows: DataFrame, ledger: str, batch_id: int, entity: str, scope: list[str], at: Column) -> None:
    """Enter a micro-batch in the commit ledger, after its rows are written: per ``scope`` its rows and the time."""
    counted = rows.groupBy(*scope).agg(F.count(F.lit(1)).alias("rows"))
    append_batch(counted.select(*scope, F.lit(entity).alias("entity"), "rows", at.alias("committed_at")), ledger, batch_id)


def ledger_schema(scope: T.StructType) -> T.StructType:
    """What :func:`stamp_commits` writes, without the batch number."""
    return T.StructType([*scope.fields, T.StructField("entity", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("committed_at", T.StringType())])
