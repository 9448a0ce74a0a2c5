"""Grouping helpers that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(frame: DataFrame, keys: list[str], order: list[Column | str], first: bool = False) -> DataFrame:
    """The last (or first) row per key by ``order``.

    An aggregate instead of a window: each task reduces a hot key to one row before the shuffle.
    """
    rest = [c for c in frame.columns if c not in keys]
    pick = F.min_by if first else F.max_by
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    best = frame.groupBy(*keys).agg(pick(row, rank).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in frame.columns])


def repeated_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that more than one row has."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select(*keys)


def latest_of_repeated(frame: DataFrame, keys: list[str], order: list[Column | str], repeated: DataFrame) -> DataFrame:
    """``latest_per_key`` that moves only the rows of ``repeated`` keys; keys are not null."""
    once = frame.join(repeated, keys, "left_anti").select(*frame.columns)
    more = latest_per_key(frame.join(repeated, keys, "left_semi").select(*frame.columns), keys, order)
    return once.unionByName(more)


def with_positions(frame: DataFrame, keys: list[str], order: list[Column], part: Column) -> DataFrame:
    """Add ``position``, the 0-based place of each row in its group. ``order`` must be total.

    ``part`` cuts a group into parts in line with ``order`` (all rows of a part before all of the next, parts
    comparable, null first). Rows are numbered within their part, and the sizes of the earlier parts are added. So a
    group that owns a large share of the rows is numbered by as many tasks as it has parts; sizes are counted in each
    task before the shuffle. One method for every size of group, and no job until the rows are asked for.
    """
    parted = frame.withColumn("_part", part)
    sizes = parted.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy(F.col("_part").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_in"), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    local = Window.partitionBy(*keys, "_part").orderBy(*order)
    numbered = parted.withColumn("_local", F.row_number().over(local) - 1)
    same = F.col("_part").eqNullSafe(F.col("_in"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    position = (F.col("_offset") + F.col("_local")).cast("bigint")
    return numbered.join(offsets, same).select(*frame.columns, position.alias("position"))
