"""Audits: leaked credentials, unredacted payloads, and parity with live records."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.operators.redaction import still_readable
from boardlake.schemas import MIN_TOKEN_LENGTH, PARITY_FIELDS, WITHHELD_KEYS
from boardlake.session import staged


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def secret_scan(tables: dict[str, tuple[DataFrame, str]], tokens: list[str]) -> DataFrame:
    """Rows per table that hold one of the known credentials, compared literally in any case.

    Each table is read once for all credentials. The output numbers the distinct credentials and never shows them.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    usable = sorted({t for t in tokens if len(t) >= MIN_TOKEN_LENGTH})
    # The credentials are data of a local frame, not literals of the plan: plans, the UI and logs never show them.
    numbered = spark.createDataFrame(list(enumerate(t.lower() for t in usable)), "token_no bigint, token string")
    sought = numbered.agg(F.array_sort(F.collect_list(F.struct("token_no", "token"))).alias("sought"))
    found = []
    for name, (rows, column) in tables.items():
        texts = rows.select(F.lower(column).alias("text"), sought.scalar().alias("sought"))
        hits = F.filter("sought", lambda t: F.contains(F.col("text"), t.token))
        found.append(texts.select(F.lit(name).alias("table"), F.explode(F.transform(hits, lambda t: t.token_no)).alias("token_no")))
    leaks = _union(found).groupBy("table", "token_no").agg(F.count(F.lit(1)).alias("leaks"))
    every = numbered.select(F.explode(F.array(*[F.lit(n) for n in tables])).alias("table"), "token_no")
    return every.join(leaks, ["table", "token_no"], "left").select("table", "token_no", F.coalesce("leaks", F.lit(0)).cast("bigint").alias("leaks"))


def secret_scan_many(tables: dict[str, tuple[DataFrame, str]], tokens: list[str]) -> DataFrame:
    """What ``secret_scan`` gives, for any number of credentials: one automaton of all of them reads each text once.

    Each task counts by credential and sends as many rows as it found credentials. The credentials go to the tasks inside the
    function, so plans do not show them.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    usable = sorted({t for t in tokens if len(t) >= MIN_TOKEN_LENGTH})
    by_text: dict[str, list[int]] = {}
    for no, token in enumerate(usable):
        by_text.setdefault(token.lower(), []).append(no)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for text, numbers in by_text.items():
            automaton.add_word(text, numbers)
        automaton.make_automaton()
        leaks: dict[int, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                # A credential counts once for a row, however often it is there.
                for no in {no for _, numbers in automaton.iter(text or "") for no in numbers}:
                    leaks[no] = leaks.get(no, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(leaks), pa.int64()), pa.array(list(leaks.values()), pa.int64())], names=["token_no", "n"])

    numbered = spark.range(len(usable)).select(F.col("id").alias("token_no"))
    every = numbered.select(F.explode(F.array(*[F.lit(n) for n in tables])).alias("table"), "token_no")
    if not usable:
        return every.withColumn("leaks", F.lit(0).cast("bigint"))
    found = [rows.select(F.lower(column).alias("text")).mapInArrow(count, "token_no bigint, n bigint").withColumn("table", F.lit(name)) for name, (rows, column) in tables.items()]
    leaks = _union(found).groupBy("table", "token_no").agg(F.sum("n").alias("leaks"))
    return every.join(leaks, ["table", "token_no"], "left").select("table", "token_no", F.coalesce("leaks", F.lit(0)).cast("bigint").alias("leaks"))


def redaction_audit(tables: dict[str, DataFrame], raw: str = "raw_json") -> DataFrame:
    """Rows per entity whose payload still shows a value under a withheld key."""
    checks = [
        rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(still_readable(F.col(raw), WITHHELD_KEYS[entity])).alias("unredacted"))
        .select(F.lit(entity).alias("entity"), "rows", "unredacted")
        for entity, rows in tables.items()
        if WITHHELD_KEYS[entity]
    ]
    return _union(checks)


def parity_diff(mirror: DataFrame, live: DataFrame, fields: list[str] | None = None, key: str = "id") -> DataFrame:
    """Field-level differences between mirror and live rows, including rows only one side has."""
    fields = [f for f in (fields or PARITY_FIELDS) if f != key]

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.col(key), F.struct(*[F.col(f).cast("string").alias(f) for f in fields]).alias(name))

    both = side(mirror, "mirror").join(side(live, "live"), key, "full_outer")
    one_sided = F.col("mirror").isNull() | F.col("live").isNull()
    presence = F.struct(
        F.lit(key).alias("field"),
        F.when(F.col("mirror").isNotNull(), F.col(key).cast("string")).alias("mirror"),
        F.when(F.col("live").isNotNull(), F.col(key).cast("string")).alias("live"),
    )
    pairs = F.array(
        *[
            F.struct(F.lit(f).alias("field"), F.col("mirror").getField(f).alias("mirror"), F.col("live").getField(f).alias("live"))
            for f in fields
        ]
    )
    unequal = F.filter(pairs, lambda p: ~p["mirror"].eqNullSafe(p["live"]))
    found = both.select(F.col(key), F.explode(F.when(one_sided, F.array(presence)).otherwise(unequal)).alias("d"))
    return found.select(key, "d.field", "d.mirror", "d.live")


LEAVES = 1 << 16
BRANCH = 1 << 8


def leaf_digests(rows: DataFrame, fields: list[str], key: str, leaves: int) -> DataFrame:
    """(leaf, digest) of rows dealt to leaves by their key: their number and two sums of row hashes, whatever their order.

    A row's hashes cover key and fields, nulls told from empty texts, with two seeds. Tasks add up leaves before the shuffle.
    """
    values = [F.col(key).cast("string"), *[F.col(f).cast("string") for f in fields]]
    row = [part for v in values for part in (v.isNull(), F.coalesce(v, F.lit("")))]
    hashes = [F.xxhash64(F.lit(seed), *row).cast("decimal(38,0)") for seed in (1, 2)]
    leaf = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(leaves)).alias("leaf")
    return rows.groupBy(leaf).agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(hashes[0]).alias("a"), F.sum(hashes[1]).alias("b")).alias("digest"))


def unequal_leaves(mirror: DataFrame, live: DataFrame, fields: list[str], key: str, leaves: int = LEAVES) -> DataFrame:
    """The leaves whose digests differ. Branches of ``BRANCH`` leaves are compared first, and leaves of unequal branches only."""

    def branched(digests: DataFrame) -> DataFrame:
        return digests.withColumn("branch", F.floor(F.col("leaf") / BRANCH))

    def trunk(digests: DataFrame) -> DataFrame:
        total = F.struct(*[F.sum(f"digest.{c}").alias(c) for c in ("n", "a", "b")])
        return digests.groupBy("branch").agg(total.alias("total"))

    sides = [branched(staged(leaf_digests(rows, fields, key, leaves), "leaf-digests")) for rows in (mirror, live)]
    trunks = trunk(sides[0]).withColumnRenamed("total", "other").join(trunk(sides[1]), "branch", "full_outer")
    open_ = trunks.filter(~F.col("total").eqNullSafe(F.col("other"))).select("branch")
    left, right = (side.join(open_, "branch", "left_semi").select("leaf", "digest") for side in sides)
    return left.withColumnRenamed("digest", "other").join(right, "leaf", "full_outer").filter(~F.col("digest").eqNullSafe(F.col("other"))).select("leaf")


def parity_by_digests(mirror: DataFrame, live: DataFrame, fields: list[str] | None = None, key: str = "id", leaves: int = LEAVES) -> DataFrame:
    """What ``parity_diff`` gives: rows meet only where the digests of their leaf differ, so the join follows the differences, not the mirror."""
    compared = [f for f in (fields or PARITY_FIELDS) if f != key]
    unequal = staged(unequal_leaves(mirror, live, compared, key, leaves), "unequal-leaves")
    leaf = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(leaves))
    sides = [rows.withColumn("leaf", leaf).join(unequal, "leaf", "left_semi").drop("leaf") for rows in (mirror, live)]
    return parity_diff(*sides, compared, key)
