"""Targets and seats against plain versions; the mix against its promises."""

import random

from pyspark.sql import functions as F

from boardlake.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, limit=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, share * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > limit * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = limit * sizes[s]
            left -= target[s]
        free -= over
    return target


def plain_seats(weights, seats, caps):
    won = [0] * len(weights)
    for _ in range(seats):
        open_ = [i for i in range(len(weights)) if won[i] < caps[i] and weights[i] > 0]
        best = max(open_, key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


def test_targets(spark):
    rng = random.Random(1)
    for _ in range(4):
        sizes = {s: rng.choice([0, 1, 7, 50, 1000, 30_000]) for s in [None, "a", "B", "é", "src10", "src2", "😀", "z", "￿"]}
        rows = [(s, n, 0) for s, n in sizes.items()]
        got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size bigint, target int")).collect()}
        expected = plain_targets(sizes)
        assert all(abs(got[s] - expected[s]) < 1e-6 * (1 + expected[s]) for s in sizes)


def test_seats(spark):
    rng = random.Random(2)
    for seats in (1, 7, 300):
        weights = [rng.choice([1.0, 3.5, 40.0, 900.0, 0.0]) for _ in range(9)]
        rows = [("g", i, w, 10_000, seats) for i, w in enumerate(weights)]
        parties = spark.createDataFrame(rows, "g string, p int, w double, cap bigint, all bigint")
        got = {r.p: r.seats for r in mixing.sainte_lague(parties, ["g"], ["p"], "w", F.col("all"), "cap").collect()}
        assert [got[i] for i in range(9)] == plain_seats(weights, seats, [10_000] * 9)


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 300), rng.choice(["hot", "hot", "hot", "b", "c", None]), 1, 2) for i in range(900)]
    rows += [(None, "no id here", "b", 1, 2), (5, None, "b", 1, 2), (5, "", "d", 1, 2), (6, "x " * 20_000, "long", 1, 2), (7, "same row", "c", 1, 2), (7, "same row", "c", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, taken int, key int")
    got = mixing.mix_sources(docs, shard_rows=100)
    back = got.collect()
    assert len(back) == len(rows) and sorted(map(str, back)) == sorted(map(str, mixing.mix_sources(docs.repartition(7), shard_rows=100).collect()))
    assert all(0 <= r.taken <= 2 * r.size for r in back)
    size = {}
    for _, text, source, *_ in rows:
        size[source] = size.get(source, 0) + len((text or "").split())
    expected = plain_targets(size)
    by_size = {v: k for k, v in size.items()}
    taken = {}
    for r in back:
        source = by_size[r.source_size]
        assert abs(r.target - expected[source]) < 1e-6 * (1 + expected[source])
        taken[source] = taken.get(source, 0) + r.taken
    assert all(abs(taken[s] - expected[s]) <= 16 * 12 for s in size)


def test_empty(spark):
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id bigint, text string, source string")).collect() == []
    one = mixing.mix_sources(spark.createDataFrame([(1, None, None)], "doc_id bigint, text string, source string")).collect()
    assert [(r.size, r.target, r.taken) for r in one] == [(0, 0.0, 0)]


def test_one_id_in_many_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART_COPIES", (3, 10))
    rows = [(None, "w " * (i % 4), "a") for i in range(700)] + [(7, "two words", "a")] * 500 + [(i, "w " * 30, "a") for i in range(100)] + [(7, "b", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    entries = mixing._entries(docs, "doc_id", "text", "source", 1).collect()
    assert sum(e.copies for e in entries) == len(rows) and max(e.copies for e in entries) <= 10 and len({e.key for e in entries}) > 150
    got = mixing.mix_sources(docs, shard_rows=20).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(docs.repartition(5), shard_rows=20).collect()))
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    target = {r.source_size: r.target for r in got}
    for size, wanted in target.items():
        assert abs(sum(r.taken for r in got if r.source_size == size) - wanted) <= 16 * 12
