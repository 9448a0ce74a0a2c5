"""Streaming forms of the incremental sync: change logs written per micro-batch, merged on read.

A micro-batch only appends its own rows; nothing stored is rewritten. Each batch has its own
folder, replaced when the batch is retried, so results are exactly-once. ``log.fold_log`` folds old batches into a base.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from boardlake.functions.timing import iso_text
from boardlake.operators.grouping import latest_per_key
from boardlake.operators.index import CODEC, TextIndex, forward_tokens, replace_documents
from boardlake.operators.pieces import joined_fields, split_fields
from boardlake.operators.upsert import since_cursor
from boardlake.schemas import ACTIVE_STATUSES
from boardlake.session import freeing_shuffles, staged
from boardlake.streaming import log as logs


def merge_newest(stored: DataFrame, changes: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Newest row per key of stored and changed rows: late changes never undo newer ones."""
    touched = stored.join(changes.select(*keys).distinct(), keys, "left_semi")
    winners = latest_per_key(touched.unionByName(changes.select(*stored.columns)), keys, order)
    return stored.join(changes.select(*keys).distinct(), keys, "left_anti").unionByName(winners)


def stream_upsert(
    source: DataFrame,
    log_path: str,
    checkpoint: str,
    keys: list[str],
    order: list[Column | str],
    cursor: str | None = None,
    fold_every: int | None = None,
    ledger: str | None = None,
    entity: str = "rows",
    scope: list[str] | None = None,
    clock: Callable[[int], Column] | None = None,
) -> StreamingQuery:
    """Append each micro-batch's newest row per key to the change log.

    ``cursor`` keeps only rows updated at or after it, as an incremental pull would; by default
    every landed row counts, so late data is not lost. ``fold_every`` folds the log before every so many batches. With a
    ``ledger``, a batch whose rows are written is entered there, with ``entity`` and the columns in ``scope``; ``clock`` gives the time of a batch (default: now).
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if fold_every and batch_id and batch_id % fold_every == 0:
            logs.fold_log(spark, log_path, batch.schema, keys, order)
        rows = since_cursor(batch, cursor) if cursor else batch
        logs.append_batch(latest_per_key(rows, keys, order), log_path, batch_id)
        if ledger:
            written = spark.read.schema(batch.schema).parquet(f"{log_path}/batch={batch_id}")
            at = clock(batch_id) if clock else iso_text(F.current_timestamp())
            logs.stamp_commits(written, ledger, batch_id, entity, scope or [], at)

    return (
        source.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


read_log = logs.read_log

CANDIDATE = T.StructType([*[T.StructField(c, T.StringType()) for c in ("id", "company_id", "status", "updated_at", "reason")], T.StructField("read_before", T.LongType())])


def stream_candidates(source: DataFrame, log_path: str, checkpoint: str, every: int = 1, fold_every: int | None = None) -> StreamingQuery:
    """Log the issues whose threads each micro-batch of issue rows asks for: changed ones, and active ones read ``every`` batches ago.

    Rows have ``id``, ``company_id``, ``status``, ``updated_at``. An issue changed if it is new or its newest row of the batch is later
    than the one known; older rows never undo it. Active issues are due whether the batch holds them or not, as their threads grow without
    the issue changing. A logged row is at the same time the issue's state: status and time as last known, and its batch is
    that of the last read (``read_before``: of the one before). So a batch reads the log below its own number, writes one folder
    and gives the same rows when retried. ``fold_every`` keeps the newest row per issue and drops older reads, before every so many batches.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if fold_every and batch_id and batch_id % fold_every == 0:
            logs.fold_log(spark, log_path, CANDIDATE, ["id"], [])
        state = latest_per_key(logs.read_log(spark, log_path, CANDIDATE, below=batch_id), ["id"], ["batch"])
        rows = latest_per_key(batch.select("id", "company_id", "status", "updated_at").filter("id IS NOT NULL"), ["id"], ["updated_at", "status"])
        logs.append_batch(due_threads(state, rows, batch_id, every), log_path, batch_id)

    return (
        source.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def due_threads(state: DataFrame, rows: DataFrame, batch_id: int, every: int = 1) -> DataFrame:
    """Candidates of one batch (as :data:`CANDIDATE`) from the state per issue and the batch's newest row per issue."""
    known = state.select("id", *[F.col(c).alias(f"_{c}") for c in ("company_id", "status", "updated_at", "batch")])
    both = known.join(rows.withColumn("_new", F.lit(True)), "id", "full_outer")
    later = F.col("_new").isNotNull() & (F.col("_batch").isNull() | (F.coalesce("updated_at", F.lit("")) > F.coalesce("_updated_at", F.lit(""))))
    current = [F.when(F.col("_later"), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in ("company_id", "status", "updated_at")]
    merged = both.withColumn("_later", later).select("id", *current, "_later", "_batch")
    due = F.col("status").isin(*ACTIVE_STATUSES) & (batch_id - F.col("_batch") >= every)
    reason = F.when(F.col("_later"), F.lit("changed")).when(due, F.lit("active"))
    return merged.withColumn("reason", reason).filter("reason IS NOT NULL").select("id", "company_id", "status", "updated_at", "reason", F.col("_batch").alias("read_before"))


def stream_index(
    source: DataFrame, log_path: str, checkpoint: str, columns: list[str], order: list[str], key: str = "id", deleted: str | None = None
) -> StreamingQuery:
    """Keep a text index in step with a stream of rows: each micro-batch logs the tokens of its newest rows.

    ``order`` ranks the versions of a document; it is logged as ``version``, so that text which arrives late does not
    replace newer text. Rows with true in the column ``deleted`` take their document out of the index.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, [key], order).filter(F.col(key).isNotNull())
        gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
        version = F.array(*[F.col(o).cast("string") for o in order])
        with freeing_shuffles(batch.sparkSession):
            logs.append_batch(forward_tokens(rows, columns, key, version=version, gone=gone), log_path, batch_id, compression=CODEC)

    return (
        source.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def index_log_schema(base: TextIndex) -> T.StructType:
    """What :func:`stream_index` logs for an index."""
    more = [T.StructField("version", T.ArrayType(T.StringType())), T.StructField("gone", T.BooleanType())]
    return T.StructType(base.forward.schema.fields + more)


def merge_index(base: TextIndex, log: DataFrame) -> TextIndex:
    """Index with a token log applied: the newest logged version of a document replaces its stored one, or removes it.

    Versions compare as texts, like the stamps they hold; of equal versions the later batch counts.
    """
    with freeing_shuffles(log.sparkSession):
        newest = staged(log.groupBy("doc_id").agg(F.max(F.struct("version", "batch")).getField("batch").alias("batch")), "newest-versions")
    current = joined_fields(log).filter(~F.col("gone")).join(newest, ["doc_id", "batch"], "left_semi").select(*base.forward.columns)
    return replace_documents(base, newest.select("doc_id"), split_fields(current))
