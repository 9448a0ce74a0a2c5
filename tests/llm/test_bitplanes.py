"""Bit-plane clustering against plain integer arithmetic."""

import hashlib
import random

import numpy as np
import pytest

from boardlake.llm import bitplanes

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, distance string"


def plain(rows: list[tuple], k: int, rounds: int) -> tuple[list[tuple], list[list[int]]]:
    kept = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v, *_ in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", bitplanes.to_planes(np.array([r[1]]), 28).tolist()))
    centroids = [list(v) for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups: dict = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, own in groups.items():
            centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), key=str), centroids


def vectors(seed: int, n: int, scale: float = 1.0) -> list[tuple]:
    dice = random.Random(seed)
    centre = [[dice.gauss(0, scale) for _ in range(64)] for _ in range(4)]
    return [(i, [c + dice.gauss(0, 0.3) for c in dice.choice(centre)], "x", "y") for i in range(n)]


def bad(v: list[float]) -> list[tuple]:
    return [(900, None, None, None), (901, [], None, None), (902, v[:63], None, None), (903, [*v, 1.0], None, None), (904, [None, *v[1:]], None, None), (905, [float("nan"), *v[1:]], None, None), (906, [float("inf"), *v[1:]], None, None), (907, [*v[1:], float("-inf")], None, None)]


def test_planes_give_exact_products_for_every_width():
    dice = np.random.default_rng(1)
    for bits in (1, 2, 5, 12, 28):
        a = dice.integers(-(1 << (bits - 1)), 1 << (bits - 1), (50, 64))
        b = dice.integers(-(1 << (bits - 1)), 1 << (bits - 1), (3, 64))
        pa, pb = bitplanes.to_planes(a, bits), bitplanes.to_planes(b, bits)
        assert (np.stack([bitplanes.plane_dots(pa, x) for x in pb], axis=1) == a @ b.T).all()
        assert (bitplanes.plane_norms(pa) == (a * a).sum(axis=1)).all()
        assert (np.einsum("nbc,b->nc", bitplanes.plane_bits(pa).astype(np.int64), bitplanes.plane_weights(bits)) == a).all()
    assert [bitplanes.bits_for(*x) for x in ((0, 0), (-1, 0), (0, 1), (-2, 1), (-513, 511))] == [1, 1, 2, 2, 11]


@pytest.mark.parametrize("scale", [1.0, 5_000.0])
def test_clusters_equal_plain_arithmetic(spark, scale):
    rows = vectors(3, 60, scale)
    rows += [*bad(rows[0][1]), rows[5], rows[5], (rows[7][0], rows[8][1], None, None), (None, rows[9][1], None, None), (None, rows[9][1], None, None), (500, [0.0] * 64, None, None)]
    placed, centroids = bitplanes.cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4), k=5, rounds=4)
    want, means = plain(rows, 5, 4)
    assert sorted((tuple(r) for r in placed.collect()), key=str) == want
    assert centroids == means
    found = bitplanes.with_inertia(placed, centroids).collect()
    assert {r.inertia for r in found} == {sum(d for *_, d in want)}
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, means[r.cluster])).encode()).hexdigest() for r in found)
    assert all(r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster) for r in found)


def test_few_equal_and_no_vectors(spark):
    same = [(i, [0.5] * 64, None, None) for i in range(3)]
    placed, centroids = bitplanes.cluster_vectors(spark.createDataFrame(same, SCHEMA))
    assert sorted(tuple(r) for r in placed.collect()) == [(0, 0, 0), (1, 0, 0), (2, 0, 0)] and len(centroids) == 3
    for rows in ([], bad([0.1] * 64)):
        placed, centroids = bitplanes.cluster_vectors(spark.createDataFrame(rows, SCHEMA))
        assert bitplanes.with_inertia(placed, centroids).collect() == [] and centroids == []


def test_components_too_large_for_exact_distances_are_an_error(spark):
    for x in (2.0**18, 1e300):
        with pytest.raises(ValueError, match="bits"):
            bitplanes.cluster_vectors(spark.createDataFrame([(1, [x] * 64, None, None)], SCHEMA))
