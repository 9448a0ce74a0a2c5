"""Text index: forward token lists per document, and packed postings sorted by token."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions.text import tokenize
from boardlake.operators.pieces import counted, entries_of, joined_fields, packed_documents, packed_lines
from boardlake.session import freeing_shuffles, staged

# Indexed columns with their ranking weights (fixed values).
ISSUE_TEXT = {"identifier": 5.0, "title": 3.0, "description": 1.0}
COMMENT_TEXT = {"body": 1.0}
ROW_GROUP = 4 << 20  # bytes of a row group of postings, the least a search reads of a file
TASK_BYTES = 20 << 20  # bytes of the forward table whose postings one task sorts
COUNT_ROUNDS = 2  # parts of the touched documents that are counted one after another
CODEC = "zstd"  # of the stored tables: token lists take two thirds of the space they take with Spark's usual one


@dataclass(frozen=True)
class TextIndex:
    """``forward``: (doc_id, doc_tokens, fields[col, tokens]). ``entries``: (token, doc_id, col, doc_tokens, hits, places).

    ``dictionary`` gives ``terms``: (token, docs, hits) of every token. ``totals``: one row (docs, tokens) stored with the index; None while changes are merged on read.
    ``packed``: the entries as ``pieces`` packs them, with lists of documents; None likewise.
    """

    forward: DataFrame
    entries: DataFrame
    dictionary: Callable[[], DataFrame]
    weights: dict[str, float]
    totals: DataFrame | None = None
    packed: DataFrame | None = None

    @functools.cached_property
    def terms(self) -> DataFrame:
        return self.dictionary()

    @property
    def postings(self) -> DataFrame:
        """One row per token occurrence: (token, doc_id, col, pos, doc_tokens)."""
        placed = self.entries.select("token", "doc_id", "col", F.explode("places").alias("pos"), "doc_tokens")
        return placed.withColumn("pos", F.col("pos").cast("bigint"))


def forward_tokens(rows: DataFrame, columns: list[str], key: str = "id", **more: Column) -> DataFrame:
    """Tokens of every text column per document, with the columns ``more``; a NULL column has none."""
    fields = F.array(*[F.struct(F.lit(c).alias("col"), tokenize(F.col(c)).alias("tokens")) for c in columns])
    listed = rows.select(F.col(key).alias("doc_id"), fields.alias("fields"), *[c.alias(n) for n, c in more.items()])
    length = F.aggregate("fields", F.lit(0).cast("bigint"), lambda total, f: total + F.size(f["tokens"]))
    return listed.select("doc_id", length.alias("doc_tokens"), "fields", *more)


def build_index(rows: DataFrame, weights: dict[str, float], key: str = "id") -> TextIndex:
    """Index as lazy frames; use ``store_index`` before asking many queries."""
    forward = forward_tokens(rows, list(weights), key)
    packed = packed_documents(forward)
    return TextIndex(forward, entries_of(packed), lambda: counted(packed_documents(forward, whole_ids=True)), weights, packed=packed)


def store_index(rows: DataFrame, weights: dict[str, float], path: str, key: str = "id") -> TextIndex:
    """Write the index and read it back.

    Text is tokenised once, for the forward table. Each task then packs the postings of its documents and writes them sorted by
    token, without a shuffle: the documents of a frequent token spread over all files, and a search for a token or prefix
    reads only the row groups of each file whose minimum and maximum admit it.
    """
    return _store(forward_tokens(rows, list(weights), key), path, weights)


def fold_index(index: TextIndex, path: str) -> TextIndex:
    """Write an index, with the changes that are merged into it on read, as a stored one at a new path."""
    return _store(index.forward, path, index.weights)


def _store(forward: DataFrame, path: str, weights: dict[str, float]) -> TextIndex:
    spark = forward.sparkSession
    forward.write.option("compression", CODEC).option("parquet.block.size", str(TASK_BYTES // 2)).mode("errorifexists").parquet(f"{path}/forward")
    write_postings(load_forward(spark, path), f"{path}/postings")
    _count(load_forward(spark, path)).write.mode("errorifexists").parquet(f"{path}/totals")
    return load_index(spark, path, weights)


def write_postings(forward: DataFrame, path: str) -> None:
    packed = packed_by_id(joined_fields(forward.select("doc_id", "doc_tokens", "fields")))
    # A task holds what it sorts, so it reads less than Spark's usual share of the files.
    conf, name = forward.sparkSession.conf, "spark.sql.files.maxPartitionBytes"
    usual = conf.get(name)
    conf.set(name, str(TASK_BYTES))
    try:
        packed.sortWithinPartitions("token").write.option("compression", CODEC).option("parquet.block.size", str(ROW_GROUP)).mode("errorifexists").parquet(path)
    finally:
        conf.set(name, usual)


def packed_by_id(lines: DataFrame) -> DataFrame:
    """``packed_lines`` in which an id that several rows have counts once. Only these rows have to be brought together."""
    repeated = staged(lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("_id")), "repeated-ids")
    if repeated.isEmpty():
        return packed_lines(lines)
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    together = lines.join(repeated, same, "left_semi").repartition("doc_id").sortWithinPartitions("doc_id")
    return packed_lines(lines.join(repeated, same, "left_anti")).unionByName(packed_lines(together, whole_ids=True))


def load_forward(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/forward")


def load_index(spark: SparkSession, path: str, weights: dict[str, float]) -> TextIndex:
    packed = spark.read.parquet(f"{path}/postings")
    return TextIndex(load_forward(spark, path), entries_of(packed), lambda: counted(packed), weights, spark.read.parquet(f"{path}/totals"), packed)


def holding(index: TextIndex, matched: DataFrame) -> DataFrame:
    """Documents that hold a token of ``matched`` (token, word), without those that have no id: (word, doc_id), each once.

    Lists of documents meet the tokens, so that a shuffle has a row per token, column and piece.
    """
    if index.packed is None:
        found = index.entries.select("token", "doc_id").join(matched, "token").select("word", "doc_id")
    else:
        found = index.packed.select("token", "docs").join(matched, "token").select("word", F.explode("docs").alias("doc_id"))
    return found.filter("doc_id IS NOT NULL").distinct()


def only_documents(index: TextIndex, docs: DataFrame) -> TextIndex:
    """The part of an index that has the documents of ``docs`` (doc_id), staged. Their texts are shuffled joined, if at all."""
    lines = joined_fields(index.forward.select("doc_id", "doc_tokens", "fields")).join(docs, "doc_id", "left_semi")
    packed = staged(packed_lines(lines), "chosen-postings")
    return TextIndex(index.forward.join(docs, "doc_id", "left_semi"), entries_of(packed), lambda: counted(packed), index.weights, packed=packed)


def update_index(index: TextIndex, changed: DataFrame, removed: DataFrame, key: str = "id") -> TextIndex:
    """Replace the entries of ``changed`` rows and drop those of ``removed`` keys."""
    gone = changed.select(F.col(key).alias("doc_id")).unionByName(removed.select(F.col(key).alias("doc_id"))).distinct()
    new = forward_tokens(changed, list(index.weights), key)
    return replace_documents(index, gone, new)


def replace_documents(index: TextIndex, gone: DataFrame, new: DataFrame) -> TextIndex:
    """Index without the documents of ``gone`` and with the forward rows of ``new``."""
    forward = index.forward.join(gone, "doc_id", "left_anti").unionByName(new)
    entries = index.entries.join(gone, "doc_id", "left_anti").unionByName(entries_of(packed_documents(new)))
    return TextIndex(forward, entries.select(*index.entries.columns), lambda: _terms_after(index, gone, new), index.weights)


def _terms_after(index: TextIndex, gone: DataFrame, new: DataFrame) -> DataFrame:
    """The dictionary with documents replaced. Only those that are touched are counted anew: what they held is taken off, what they hold is added.

    Rows without an id are one document; they are never gone. Texts are shuffled joined, and those of a round of ids are off the disk before
    the next begins.
    """
    ids = new.select("doc_id").distinct()
    missing = index.forward.sparkSession.createDataFrame([(None,)], "_id string").select(F.col("_id").cast(ids.schema[0].dataType).alias("doc_id"))
    touched = gone.select("doc_id").unionByName(ids).unionByName(missing).distinct()
    kept = ids.join(gone, "doc_id", "left_anti").unionByName(missing).distinct()

    def stored(ids: DataFrame, label: str) -> DataFrame:
        chosen = staged(ids.select(F.col("doc_id").alias("_id")), label)
        return joined_fields(index.forward).join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def held(lines: DataFrame, sign: int, label: str) -> DataFrame:
        parts = []
        for turn in range(COUNT_ROUNDS):
            part = counted(packed_by_id(lines.filter(F.pmod(F.xxhash64("doc_id"), F.lit(COUNT_ROUNDS)) == turn)))
            parts.append(staged(part.select("token", (F.col("docs") * sign).alias("docs"), (F.col("hits") * sign).alias("hits")), label))
        return functools.reduce(DataFrame.unionByName, parts)

    with freeing_shuffles(index.forward.sparkSession):
        before = held(stored(touched, "touched-ids"), -1, "terms-before")
        after = held(stored(kept, "kept-ids").unionByName(joined_fields(new)), 1, "terms-after")
    parts = index.terms.unionByName(before).unionByName(after)
    return parts.groupBy("token").agg(F.sum("docs").alias("docs"), F.sum("hits").alias("hits")).filter("hits > 0")


def _count(forward: DataFrame) -> DataFrame:
    return forward.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("doc_tokens"), F.lit(0)).alias("tokens"))


def index_stats(index: TextIndex) -> DataFrame:
    """One row: number of documents (also those without tokens), tokens, average length."""
    totals = _count(index.forward) if index.totals is None else index.totals
    return totals.select("docs", "tokens", F.try_divide(F.col("tokens"), F.col("docs")).alias("avg_tokens"))


def term_stats(index: TextIndex) -> DataFrame:
    """Occurrences and documents per token, added up from the pieces of the index."""
    return index.terms
