"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from boardlake.llm import multi_index


def brute(rows, k):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 8]
    out = {}
    for i, q in fine:
        if i % 5 == 0:
            best = {}
            for j, v in fine:
                if j != i:
                    best[j] = max(best.get(j, -2), multi_index.cosine(q, v))
            out[i] = sorted((-s, j) for j, s in best.items())[:k]
    return out


def made():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.4 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(600)]
    hot = rng.normal(size=8).astype(np.float32).tolist()
    rows += [(600 + i, hot) for i in range(200)]
    bad = [(900, None), (905, []), (910, [0.0] * 8), (915, [1.0] * 7 + [None]), (920, [1.0] * 7 + [float("nan")]), (925, [1.0] * 7 + [float("inf")]), (930, [1.0] * 5), (None, hot)]
    return rows + bad + [(935, [-0.0] * 7 + [2.0]), (936, [0.0] * 7 + [3.0]), (5, rows[5][1]), (940, [1e-30] * 8), (941, [1e30] * 8)]


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, key string, rank int")
    found = multi_index.nearest(frame, F.col("vec_id") % 5 == 0, **options).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert all([r.rank for r in found if r.query_id == q] and len({i for _, i in v}) == len(v) for q, v in out.items())
    return out


def test_all_probed_is_exact(spark):
    rows = made()
    got, expected = run(spark, rows, centroids=6, probe_share=1.0), brute(rows, 5)
    assert got.keys() == expected.keys()
    for q, want in expected.items():
        assert [i for _, i in got[q]] == [i for _, i in want] and np.allclose([s for s, _ in got[q]], [s for s, _ in want], atol=1e-15)


def test_recall(spark):
    rows = made()
    got, expected = run(spark, rows, centroids=6, probe_share=0.4, least_probed=1), brute(rows, 5)
    hits = sum(len({i for _, i in want} & {i for _, i in got[q]}) for q, want in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_few_and_no_rows(spark):
    assert run(spark, [(5, [1.0, 0.0]), (6, [1.0, 1.0])]) == {5: [(-multi_index.cosine(np.array([1.0, 0]), np.array([1.0, 1])), 6)]}
    assert run(spark, [(5, [1.0, 0.0])]) == {} and run(spark, [(5, None)]) == {}


def test_walk_goes_by_summed_distance():
    rng = np.random.default_rng(2)
    a, b = rng.random(7), rng.random(5)
    order = [a[i] + b[j] for i, j in multi_index.walk(a, b, np.ones((7, 5), int), 35)]
    assert order == sorted(order) and len(order) == 35
    assert len(list(multi_index.walk(a, b, np.full((7, 5), 4), 10))) == 3
