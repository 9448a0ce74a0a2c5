"""k-means over integer vectors whose distances come from bit planes.

A component x becomes the integer floor(scale * x), written in two's complement over B bits. Bit i of all 64 components
is one word, the bit plane i, so a vector is B words. With the planes' weights w (powers of two, the topmost negative)

    a . b = sum over i, j of w_i w_j popcount(plane_i(a) & plane_j(b)),   |a - b|^2 = a . a - 2 a . b + b . b

exactly, in integers. B follows from the largest component of the table. Sums per component come from the same planes:
the number of members with that bit set, weighted. Each round is one pass over the staged planes; a task adds up its own
members per cluster first, so a round shuffles clusters x components rows per task, whatever a cluster's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.llm.batches import map_arrays
from boardlake.session import staged

SIZE = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
LARGEST_BITS = 28  # with it the distance of two vectors of 64 components fits in a long


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str, size: int = SIZE) -> DataFrame:
    """``id`` and ``v`` (doubles) of the vectors that have ``size`` components, none null or not finite."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(id_col).alias("id"), v.alias("v")).filter((F.size("v") == size) & finite)


def bits_for(low: int, high: int) -> int:
    """The least width whose two's complement holds both."""
    return max(low.bit_length() if low >= 0 else (-low - 1).bit_length(), high.bit_length() if high >= 0 else (-high - 1).bit_length()) + 1


def plane_weights(bits: int) -> np.ndarray:
    """Value of a set bit in each plane."""
    weights = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))
    weights[-1] = -weights[-1]
    return weights


def to_planes(values: np.ndarray, bits: int) -> np.ndarray:
    """(n, 64) integers as (n, bits) words: bit c of word i is bit i of component c."""
    out = np.empty((len(values), bits), np.uint64)
    for i in range(bits):
        set_ = ((values >> i) & 1).astype(np.uint8)
        out[:, i] = np.packbits(set_, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def plane_bits(planes: np.ndarray) -> np.ndarray:
    """(n, bits) words as (n, bits, 64) zeros and ones."""
    return np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")


def plane_dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of rows of ``a`` with the one vector ``b``, both as planes."""
    weights = plane_weights(a.shape[1])
    total = np.zeros(len(a), np.int64)
    for j, weight in enumerate(weights):
        total += weight * (np.bitwise_count(a & b[j]).astype(np.int64) @ weights)
    return total


def plane_norms(a: np.ndarray) -> np.ndarray:
    """Squared length of every row."""
    weights = plane_weights(a.shape[1])
    total = np.zeros(len(a), np.int64)
    for j, weight in enumerate(weights):
        total += weight * (np.bitwise_count(a & a[:, j : j + 1]).astype(np.int64) @ weights)
    return total


def nearest_centroid(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the squared distance, per row; both sides as planes."""
    own, theirs = plane_norms(planes), plane_norms(centroids)
    distances = np.stack([own - 2 * plane_dots(planes, c) + n for c, n in zip(centroids, theirs)], axis=1)
    cluster = distances.argmin(axis=1)
    return cluster, distances[np.arange(len(planes)), cluster]


def _plane_batch(column: pa.Array, bits: int) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()].view(np.uint64).reshape(-1, bits)


def with_planes(usable: DataFrame, bits: int, scale: int = SCALE) -> DataFrame:
    """``id`` and ``planes`` of the rows of :func:`usable_vectors`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(1)
            values = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()].reshape(batch.num_rows, -1)
            planes = to_planes(np.floor(values * scale).astype(np.int64), bits).view(np.int64)
            yield [batch.column(0), pa.ListArray.from_arrays(np.arange(0, planes.size + 1, bits, dtype=np.int32), planes.ravel())]

    return map_arrays(usable, run, f"id {usable.schema['id'].dataType.simpleString()}, planes array<bigint>")


def _member_sums(centroids: np.ndarray):
    """Per task one row for each cluster and component: ``cluster``, ``part``, ``total``, ``members``."""
    k, bits = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        counts, members = np.zeros((k, bits, SIZE), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            planes = _plane_batch(batch.column(0), bits)
            for start in range(0, len(planes), 4096):
                some = planes[start : start + 4096]
                cluster, _ = nearest_centroid(some, centroids)
                for c in np.unique(cluster):
                    own = some[cluster == c]
                    counts[c] += plane_bits(own).sum(axis=0, dtype=np.int64)
                    members[c] += len(own)
        if members.any():
            totals = np.einsum("kbc,b->kc", counts, plane_weights(bits))
            yield [np.repeat(np.arange(k), SIZE), np.tile(np.arange(SIZE), k), totals.ravel(), np.repeat(members, SIZE)]

    return run


def _assigned(centroids: np.ndarray):
    bits = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance = nearest_centroid(_plane_batch(batch.column(1), bits), centroids)
                yield [batch.column(0), cluster.astype(np.int32), distance]

    return run


def first_centroids(planed: DataFrame, k: int, seed: str) -> list[list[int]]:
    """Planes of the ``k`` rows whose ids hash lowest; equal hashes go by the planes, null ids come last."""
    hashed = planed.select(F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256).alias("h"), "planes")
    return [r.planes for r in hashed.orderBy(F.col("h").asc_nulls_last(), "planes").limit(k).collect()]


def cluster_vectors(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = "3:", id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, list[list[int]]]:
    """``id_col``, ``cluster`` and ``distance`` (squared) of every usable vector, and the final centroids.

    Centroids start as the ``k`` vectors whose text ``seed`` + id has the smallest SHA-256; with fewer vectors there are
    fewer. ``rounds`` times every vector goes to its nearest centroid and every centroid with members becomes the floor
    of their mean. Vectors of another length than 64, null ones, and those with a null or not finite component take
    no part. Repeated ids and repeated rows stay rows; null ids take part but start a centroid only if others are too few. An empty
    table gives no rows and no centroids. Components whose integers need over 28 bits are an error, as distances would not
    fit in a long. Other columns are not read. To the driver come k starting rows and k x 64 sums a round.
    """
    usable = usable_vectors(vectors, id_col, vector_col)
    scaled = F.transform("v", lambda x: F.floor(x * scale).cast("double"))
    ends = usable.select(scaled.alias("s")).agg(F.min(F.array_min("s")).alias("low"), F.max(F.array_max("s")).alias("high")).first()
    bits = 1 if ends.low is None else bits_for(int(ends.low), int(ends.high)) if max(abs(ends.low), abs(ends.high)) < 2.0**62 else 99
    if bits > LARGEST_BITS:
        raise ValueError(f"components from {ends.low} to {ends.high} need more than {LARGEST_BITS} bits")
    planed = staged(with_planes(usable, bits, scale), "bit-planes")
    centroids = np.array(first_centroids(planed, k, seed), np.int64).reshape(-1, bits).view(np.uint64)
    weights = plane_weights(bits)
    values = [[int(x) for x in row] for row in np.einsum("kbc,b->kc", plane_bits(centroids).astype(np.int64), weights)] if len(centroids) else []
    for _ in range(rounds if values else 0):
        sums = map_arrays(planed.select("planes"), _member_sums(centroids), "cluster int, part int, total bigint, members bigint")
        grouped = sums.groupBy("cluster", "part").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("members").alias("members"))
        moved = [list(row) for row in values]
        for r in grouped.filter("members > 0").collect():
            moved[r.cluster][r.part] = int(Decimal(r.total)) // r.members
        if moved == values:
            break  # every later round would change nothing either
        values = moved
        centroids = to_planes(np.array(values, np.int64), bits)
    kind = planed.schema["id"].dataType.simpleString()
    if not values:
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance bigint"), []
    placed = map_arrays(planed, _assigned(centroids), f"id {kind}, cluster int, distance bigint")
    return placed.withColumnRenamed("id", id_col), values


def with_inertia(placed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` to the rows of :func:`cluster_vectors`."""
    placed = staged(placed, "clustered")
    sums = {r.cluster: int(r.s) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(c, sums[c], sum(sums.values()), digests[c]) for c in sorted(sums)]
    known = placed.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(known), "cluster").select(*[c for c in placed.columns], "cluster_inertia", "inertia", "centroid_sha256")  # a row per cluster
