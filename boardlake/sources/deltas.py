"""Keyed tables whose writes cost what changed: a base, runs of changes on top of it, merged on read.

A run writes its changed rows and the keys it deletes (rows with a mark), sorted by key, into a folder of its own, and then
lists the new files in a commit with the range of their keys. Readers take the files of all commits: base rows whose key no later run
has, and of each key that runs have its newest row. Only base files whose range meets that of a change are checked against the
changed keys; a small set of keys is broadcast by Spark's own threshold, so the base is not shuffled.

Folding keeps reads cheap. Neighbouring runs of one size class become one run (so a row is rewritten once for each class,
not once for each run), and when the runs have grown to a share of the base files they meet, those files alone are rewritten. Files
that no commit lists any more are removed by the fold after the next, when no reader that started before can want them.

One writer at a time; keys are not null and, within a run, unique. Runs order as text, like run stamps.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.operators.grouping import latest_per_key
from boardlake.session import folder_names, remove_folder

GONE, RUN = "_gone", "_run"
FAN = 4
SHARE = 0.25


@dataclass(frozen=True)
class TableFile:
    """A file of a table: its run, whether it belongs to the base, and the range of its keys."""

    path: str
    run: str
    base: bool
    low: object
    high: object
    rows: int
    deletes: int
    bytes: int


def _commit_schema(key: T.DataType) -> T.StructType:
    fields = [("action", T.StringType()), ("path", T.StringType()), ("run", T.StringType()), ("base", T.BooleanType()), ("low", key), ("high", key)]
    return T.StructType([*[T.StructField(*f) for f in fields], *[T.StructField(n, T.LongType()) for n in ("rows", "deletes", "bytes", "number")]])


def _stored_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(GONE, T.BooleanType()), T.StructField(RUN, T.StringType())])


def _commits(spark: SparkSession, root: str) -> list[str]:
    return folder_names(spark, f"{root}/_commits", "_SUCCESS")


def commit_log(spark: SparkSession, root: str, schema: T.StructType, key: str = "id") -> DataFrame:
    """Every file that a run or a fold added or removed, with rows and bytes."""
    layout = _commit_schema(schema[key].dataType)
    names = _commits(spark, root)
    if not names:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).json([f"{root}/_commits/{n}" for n in names])


def live_files(spark: SparkSession, root: str, schema: T.StructType, key: str = "id") -> list[TableFile]:
    """The files that make up the table, as many as Spark lists for any table."""
    log = commit_log(spark, root, schema, key)
    removed = log.filter("action = 'remove'").select("path")
    rows = log.filter("action = 'add'").join(removed, "path", "left_anti").collect()
    return sorted((TableFile(r.path, r.run, r.base, r.low, r.high, r.rows, r.deletes, r.bytes) for r in rows), key=lambda f: (f.run, f.path))


def _add(frame: DataFrame, root: str, run: str, base: bool, schema: T.StructType, key: str, removed: list[TableFile]) -> list[TableFile]:
    """Write rows sorted by key and commit their files, together with the removal of others."""
    spark = frame.sparkSession
    folder = f"{root}/{run}-{uuid.uuid4().hex[:8]}"
    stored = _stored_schema(schema)
    frame.select(*stored.names).repartitionByRange(key).sortWithinPartitions(key).write.parquet(folder)
    file = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
    ranges = spark.read.schema(stored).parquet(folder).groupBy(*file).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(GONE)).alias("deletes")
    ).collect()
    added = [TableFile(r.path, run, base, r.low, r.high, r.rows, r.deletes, r.bytes) for r in ranges]
    number = len(_commits(spark, root))
    entries = [(action, f.path, f.run, f.base, f.low, f.high, f.rows, f.deletes, f.bytes, number) for action, files in (("add", added), ("remove", removed)) for f in files]
    name = f"{number:08d}-{re.sub(r'[^0-9A-Za-z.-]', '-', run)}"
    spark.createDataFrame(entries, _commit_schema(schema[key].dataType)).coalesce(1).write.mode("overwrite").json(f"{root}/_commits/{name}")
    return added


def write_changes(root: str, run: str, rows: DataFrame, deleted: DataFrame | None = None, key: str = "id") -> list[TableFile]:
    """Write a run: rows that are new or changed, and the keys in ``deleted``. A key in both is kept.

    The first run of a table is its base. Nothing of earlier runs is read or written. A run that is written again, before any fold,
    replaces what its first try wrote.
    """
    spark = rows.sparkSession
    run = re.sub(r"[^0-9A-Za-z.-]", "-", run)
    files = live_files(spark, root, rows.schema, key)
    if any(f.run > run for f in files):
        raise ValueError(f"run {run} is not after the runs that are stored")
    again = [f for f in files if f.run == run]  # of a try that failed later on
    known = [f for f in files if f.run < run]
    marked = rows.withColumns({GONE: F.lit(False), RUN: F.lit(run)})
    if known and deleted is not None:
        gone = deleted.select(key).distinct().join(rows.select(key), key, "left_anti")
        marked = marked.unionByName(gone.withColumns({GONE: F.lit(True), RUN: F.lit(run)}), allowMissingColumns=True)
    return _add(marked, root, run, not known, rows.schema, key, again)


def _read(spark: SparkSession, files: list[TableFile], schema: T.StructType) -> DataFrame:
    stored = _stored_schema(schema)
    return spark.read.schema(stored).parquet(*[f.path for f in files]) if files else spark.createDataFrame([], stored)


def _met(base: list[TableFile], changes: list[TableFile]) -> list[TableFile]:
    """Base files whose key range meets that of a change."""
    spans: list[list] = []
    for f in sorted(changes, key=lambda f: f.low):
        if spans and f.low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], f.high)
        else:
            spans.append([f.low, f.high])
    highs = [high for _, high in spans]
    found = []
    for f in base:
        at = bisect.bisect_left(highs, f.low)
        if at < len(spans) and spans[at][0] <= f.high:
            found.append(f)
    return found


def _merged(spark: SparkSession, base: list[TableFile], runs: list[TableFile], schema: T.StructType, key: str, deletes: bool = False) -> DataFrame:
    """Newest row of each key of the runs, and the base rows they do not replace. Deleted keys go, or stay as marks."""
    changes = _read(spark, runs, schema)
    newest = latest_per_key(changes, [key], [RUN])
    kept = newest if deletes else newest.filter(~F.col(GONE))
    return kept.unionByName(_read(spark, base, schema).join(changes.select(key), key, "left_anti")) if base else kept


def read_keyed(spark: SparkSession, root: str, schema: T.StructType, key: str = "id", upto: str | None = None) -> DataFrame:
    """The table as of its newest run, or of the newest up to ``upto``; empty where nothing was written."""
    files = [f for f in live_files(spark, root, schema, key) if upto is None or f.run <= upto]
    base, runs = [f for f in files if f.base], [f for f in files if not f.base]
    met = {f.path for f in _met(base, runs)}
    apart = _read(spark, [f for f in base if f.path not in met], schema)
    if not runs:
        return apart.select(*schema.names)
    merged = _merged(spark, [f for f in base if f.path in met], runs, schema, key)
    return (merged if len(met) == len(base) else merged.unionByName(apart)).select(*schema.names)


def files_of_keys(files: list[TableFile], keys: DataFrame) -> list[TableFile]:
    """The files whose key range holds one of the keys. Each task sends the files it found, however many keys it has."""
    ordered = sorted(files, key=lambda f: f.low)
    lows = [f.low for f in ordered]
    ends = list(itertools.accumulate((f.high for f in ordered), max))  # no range up to a place reaches further

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        touched: set[int] = set()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                at = bisect.bisect_right(lows, value) - 1
                while at >= 0 and ends[at] >= value:
                    if ordered[at].high >= value:
                        touched.add(at)
                    at -= 1
        yield pa.RecordBatch.from_arrays([pa.array(sorted(touched), pa.int64())], names=["file"])

    numbers = keys.filter(F.col(keys.columns[0]).isNotNull()).mapInArrow(found, "file bigint").distinct().collect() if files else []
    return [ordered[r.file] for r in numbers]


def read_keys(spark: SparkSession, root: str, schema: T.StructType, keys: DataFrame, key: str = "id") -> DataFrame:
    """The table's rows of the given keys, from the files whose ranges hold one of them: what a lookup reads follows the keys, not the table.

    Beyond Spark's broadcast threshold the join gets a Bloom filter of the keys from Spark itself, once the files are over 10 GB.
    """
    files = live_files(spark, root, schema, key)
    base, runs = (files_of_keys([f for f in files if f.base == part], keys.select(key)) for part in (True, False))
    rows = _merged(spark, base, runs, schema, key) if runs else _read(spark, base, schema)
    return rows.select(*schema.names).join(keys.select(key), key, "left_semi")


def _size_class(size: int, fan: int) -> int:
    return int(math.log(max(1, size), fan))


def _tier(runs: list[TableFile], fan: int) -> list[TableFile]:
    """Files of at least ``fan`` neighbouring runs of one size class, the newest such; none if there are none."""
    names = sorted({f.run for f in runs})
    classes = [_size_class(sum(f.bytes for f in runs if f.run == name), fan) for name in names]
    end = len(names)
    while end > 0:
        start = end - 1
        while start > 0 and classes[start - 1] == classes[end - 1]:
            start -= 1
        if end - start >= fan:
            return [f for f in runs if f.run in names[start:end]]
        end = start
    return []


def fold_changes(spark: SparkSession, root: str, schema: T.StructType, key: str = "id", fan: int = FAN, share: float = SHARE) -> list[TableFile]:
    """Merge runs of one size class, or the runs into the base files they meet; the files written, none if nothing was due.

    Readers see the same rows before, meanwhile and after. A new base file may span an old one that was not rewritten, but
    their keys stay apart.
    """
    files = live_files(spark, root, schema, key)
    base, runs = [f for f in files if f.base], [f for f in files if not f.base]
    if not runs:
        return []
    _remove_unlisted(spark, root, schema, key)
    met = _met(base, runs)
    newest = max(f.run for f in runs)
    if sum(f.bytes for f in runs) >= share * sum(f.bytes for f in met):
        rows = _merged(spark, met, runs, schema, key).withColumn(RUN, F.lit(newest))
        return _add(rows, root, newest, True, schema, key, [*met, *runs])
    tier = _tier(runs, fan)
    if not tier:
        return []
    last = max(f.run for f in tier)
    rows = _merged(spark, [], tier, schema, key, deletes=True).withColumn(RUN, F.lit(last))
    return _add(rows, root, last, False, schema, key, tier)


def _remove_unlisted(spark: SparkSession, root: str, schema: T.StructType, key: str) -> None:
    """Remove files that were taken out of the table before its newest removal."""
    removed = commit_log(spark, root, schema, key).filter("action = 'remove'")
    newest = removed.agg(F.max("number").alias("n")).first().n
    if newest is not None:
        for r in removed.filter(F.col("number") < newest).select("path").distinct().collect():
            remove_folder(spark, r.path)
