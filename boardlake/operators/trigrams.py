"""Substring match by an index of three-letter pieces.

A text that holds a pattern holds all of its pieces. The index has a row per piece and text, sorted by piece, and the number of texts
of every piece. A search reads the rows of the pattern's rarest pieces only, and the texts that have them all are then matched as without
an index. Patterns with wildcards, or shorter than a piece, take the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.operators.reads import keep_if, matches_text

LOOKED_UP = 4  # pieces of a pattern that are looked up, the rarest


@dataclass(frozen=True)
class PieceIndex:
    """``pieces``: (piece, key) of every text. ``counts``: (piece, n)."""

    pieces: DataFrame
    counts: DataFrame


def pieces_of(text: Column) -> Column:
    """Distinct pieces of a text in lower case, from one pass of a pattern that looks ahead."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(.{3}))"), F.lit(1)))


def store_pieces(rows: DataFrame, columns: list[str], path: str, key: str = "id") -> PieceIndex:
    """Write the index of text columns and read it back. Keys are unique and not null; a null column has no pieces."""
    spark = rows.sparkSession
    lists = [F.coalesce(pieces_of(F.col(c)), F.array().cast("array<string>")) for c in columns]
    every = lists[0] if len(lists) == 1 else F.array_distinct(F.concat(*lists))
    listed = rows.select(F.col(key).alias("key"), F.explode(every).alias("piece"))
    listed.select("piece", "key").repartitionByRange("piece", "key").sortWithinPartitions("piece", "key").write.parquet(f"{path}/pieces")
    counts = spark.read.parquet(f"{path}/pieces").groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    counts.repartitionByRange("piece").sortWithinPartitions("piece").write.parquet(f"{path}/counts")
    return load_pieces(spark, path)


def load_pieces(spark: SparkSession, path: str) -> PieceIndex:
    return PieceIndex(spark.read.parquet(f"{path}/pieces"), spark.read.parquet(f"{path}/counts"))


def pattern_pieces(text: str) -> list[str]:
    """Pieces every match of a pattern holds; none if it has wildcards or is too short."""
    lower = text.lower()
    return [] if "%" in lower or "_" in lower else sorted({lower[i : i + 3] for i in range(len(lower) - 2)})


def candidates(index: PieceIndex, text: str) -> DataFrame | None:
    """Keys of the texts that have the rarest pieces of a pattern; ``None`` if the pattern needs the scan."""
    wanted = pattern_pieces(text)
    if not wanted:
        return None
    counted = {r.piece: r.n for r in index.counts.filter(F.col("piece").isin(*wanted)).collect()}
    rarest = sorted(wanted, key=lambda p: (counted.get(p, 0), p))[:LOOKED_UP]
    found = index.pieces.filter(F.col("piece").isin(*rarest))
    return found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(rarest)).select("key")


def match_indexed(index: PieceIndex, rows: DataFrame, text: str, columns: list[str], key: str = "id") -> DataFrame:
    """The rows ``reads.matches_text`` keeps for a pattern over the indexed columns."""
    keys = candidates(index, text)
    if keys is not None:
        rows = rows.join(keys.withColumnRenamed("key", key), key, "left_semi")
    return keep_if(rows, matches_text(text, columns))
