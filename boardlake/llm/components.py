"""Connected components by repeated contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.session import staged


def component_labels(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``label`` for the end points of ``edges`` (no nulls): nodes have the same label if a path joins them.

    Each round every node steps to the smallest of itself and its neighbours by a mixed order, a minimum that
    is taken in each task before the shuffle; edges are then drawn between the steps' ends and loops dropped, until
    no edge is left. The order is mixed anew each round, so long chains contract by a constant share. Rounds
    are written to the shared folder, so a lost executor costs a re-read.
    """
    rounds: list[DataFrame] = []
    left = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(F.col("a") != F.col("b"))
    kind = left.schema["a"].dataType
    while not left.isEmpty():
        salt = F.lit(len(rounds))
        both = left.select(F.col("a").alias("node"), F.col("b").alias("to")).union(left.select(F.col("b").alias("node"), F.col("a").alias("to")))
        best = both.groupBy("node").agg(F.min(F.struct(F.xxhash64("to", salt).alias("h"), "to")).alias("m"))
        own = F.struct(F.xxhash64("node", salt).alias("h"), F.col("node").alias("to"))
        step = staged(best.select("node", F.least(own, F.col("m")).getField("to").alias("label")), "component-step")
        rounds.append(step)
        first = step.select(F.col("node").alias("a"), F.col("label").alias("la"))
        second = step.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        drawn = left.join(first, "a").join(second, "b").filter(F.col("la") != F.col("lb"))
        left = staged(drawn.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(), "component-edges")
    if not rounds:
        return edges.sparkSession.createDataFrame([], edges.select(F.col(a).alias("node"), F.col(a).cast(kind).alias("label")).schema)

    def follow(known: DataFrame, step: DataFrame) -> DataFrame:
        onward = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        return known.join(onward, "label", "left").select("node", F.coalesce("next", "label").alias("label"))

    return reduce(follow, rounds[1:], rounds[0])
