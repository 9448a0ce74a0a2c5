"""Board tables on storage.

``write_version`` writes whole new table versions next to the old ones and then lists them in one commit file.
Readers take the newest committed version, so they never see half a run, and a failed run leaves
no trace in what they read. ``write_run`` does the same for the small tables of a sync run and adds only its changes to the
large ones (see ``deltas``).
"""

from __future__ import annotations

import re
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.schemas import ENTITIES, META, SYNC_RUNS, SYNC_STATE, entity_schema
from boardlake.sources import deltas

if TYPE_CHECKING:
    from boardlake.plans.sync_run import SyncResult

COMMIT = "table string, version string"
TABLE_SCHEMAS: dict[str, T.StructType] = {
    **{e: entity_schema(e) for e in ENTITIES},
    "sync_state": SYNC_STATE,
    "meta": META,
    "sync_runs": SYNC_RUNS,
}


def _layout(table: str, frame: DataFrame) -> DataFrame:
    """Rows clustered for the common filters; the range sort splits a company that dominates."""
    if "company_id" not in frame.columns or table == "sync_state":
        return frame
    order = [c for c in ("company_id", "updated_at", "created_at", "id") if c in frame.columns]
    return frame.repartitionByRange(*order).sortWithinPartitions(*order)


def write_version(root: str, version: str, tables: dict[str, DataFrame]) -> None:
    """Write tables as ``version`` and commit them together. Versions order as text, such as run stamps."""
    spark = next(iter(tables.values())).sparkSession
    version = re.sub(r"[^0-9A-Za-z.-]", "-", version)
    for name, frame in tables.items():
        writer = _layout(name, frame).write.mode("overwrite")
        if name in ENTITIES and name != "companies":
            writer = writer.partitionBy("company_id")
        writer.parquet(f"{root}/{name}/{version}")
    rows = spark.createDataFrame([(name, version) for name in tables], COMMIT)
    rows.coalesce(1).write.mode("overwrite").json(f"{root}/_commits/{version}")


def committed_versions(spark: SparkSession, root: str) -> dict[str, str]:
    """Newest committed version per table; empty when nothing was ever written."""
    try:
        commits = spark.read.schema(COMMIT).json(f"{root}/_commits/*")
        newest = commits.groupBy("table").agg(F.max("version").alias("version")).collect()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return {}
        raise
    return {row["table"]: row["version"] for row in newest}


def read_tables(spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """All board tables at their newest version; tables never written are empty."""
    versions = committed_versions(spark, root)
    tables = {}
    for name, schema in (schemas or TABLE_SCHEMAS).items():
        if name in versions:
            tables[name] = spark.read.schema(schema).parquet(f"{root}/{name}/{versions[name]}").select(*schema.names)
        else:
            tables[name] = spark.createDataFrame([], schema)
    return tables


def write_run(root: str, run: str, result: SyncResult) -> None:
    """Write what a sync run changed. Board tables get the run's changed rows on top of what is stored; state, ledger and values are small and written whole."""
    for entity, (rows, deleted) in result.changes.items():
        deltas.write_changes(f"{root}/{entity}", run, rows, deleted)
    # The commit of the small tables ends the run: until then readers take the runs up to the one before.
    write_version(root, run, {name: result.tables[name] for name in ("sync_state", "meta", "sync_runs")})


def read_mirror(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All board tables after the newest run that was written to its end."""
    small = read_tables(spark, root, {name: TABLE_SCHEMAS[name] for name in ("sync_state", "meta", "sync_runs")})
    last = max(committed_versions(spark, root).values(), default="")
    return {**{e: deltas.read_keyed(spark, f"{root}/{e}", TABLE_SCHEMAS[e], upto=last) for e in ENTITIES}, **small}


def fold_mirror(spark: SparkSession, root: str) -> None:
    """Fold the board tables where it is due. Not while a run is being written."""
    for entity in ENTITIES:
        deltas.fold_changes(spark, f"{root}/{entity}", TABLE_SCHEMAS[entity])


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    for name, frame in tables.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
