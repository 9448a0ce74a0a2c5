"""Copies of benchmark items against a brute-force search, and alignments against the textbook table."""

import random

from boardlake.llm import decontaminate as leaks


def plain_score(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, above[j - 1] + (1 if x == y else -1), above[j] - 1, row[j - 1] - 1))
        best, above = max(best, *row), row
    return best


def test_alignment():
    rng = random.Random(1)
    for _ in range(150):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 25))] for _ in range(2))
        score, equal, columns, first, end = leaks.align(a, b)
        assert score == plain_score(a, b) and equal <= columns and end - first <= columns
    assert leaks.align([1, 2, 3, 4], [9, 1, 2, 8, 3, 4, 9]) == (3, 4, 5, 1, 6)


def words(rng, n, vocabulary=3000):
    return [f"w{rng.randint(0, vocabulary)}" for _ in range(n)]


def edited(rng, item, share):
    out = []
    for w in item:
        r = rng.random()
        if r < share / 3:
            continue
        out.append("edit" + w if r < 2 * share / 3 else w)
        if r > 1 - share / 3:
            out.append("added")
    return out


def test_planted_and_clean(spark):
    rng = random.Random(2)
    items = [words(rng, rng.randint(15, 60)) for _ in range(20)] + [words(rng, 3), words(rng, 600)]
    rows, expected = [], set()
    for i in range(200):
        text = words(rng, rng.randint(0, 300))
        if i % 4 == 0:
            k = rng.randrange(20)
            text[len(text) // 2 : len(text) // 2] = edited(rng, items[k], 0.06 if i % 8 else 0)
            expected.add((i, k))
        elif i % 4 == 1:
            k = rng.randrange(20)
            text[0:0] = items[k][: len(items[k]) // 2]  # half an item is no copy of it
        rows.append((i, ", ".join(text).upper(), "x", 1))
    rows += [(300, None, "x", 1), (301, "", "x", 1), (None, " ".join(items[3]), "x", 1), (0, "short", "x", 1), (302, " ".join(words(rng, 60_000) + items[5] + words(rng, 10)), "x", 1)]
    rows += [(310 + j, " ".join(items[7]), "x", 1) for j in range(40)] + [(400, " ".join(items[21][100:200]), "x", 1)]
    expected |= {(None, 3), (302, 5), (400, 21)} | {(310 + j, 7) for j in range(40)}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key string, hits int")
    bench = spark.createDataFrame([(k, " ".join(t), "clash") for k, t in enumerate(items)] + [(0, " ".join(items[0]), "clash"), (50, None, "clash")], "item_id bigint, text string, similarity string")
    got = leaks.find_copies(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected and len(got) == len(expected)
    assert all(0.8 <= r.similarity <= 1 for r in got)
    assert leaks.find_copies(docs.limit(0), bench).collect() == leaks.find_copies(docs, bench.limit(0)).collect() == []


def test_against_all_pairs(spark):
    rng = random.Random(3)
    items = [words(rng, 30, 60) for _ in range(8)]
    texts = [edited(rng, rng.choice(items), rng.choice([0.02, 0.1, 0.2])) + words(rng, 30, 60) for _ in range(80)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.find_copies(docs, bench).collect()}
    number = {w: i for i, w in enumerate({w for t in items + texts for w in t})}
    best = {}
    for i, t in enumerate(texts):
        for k, item in enumerate(items):
            _, equal, columns, _, _ = leaks.align([number[w] for w in item], [number[w] for w in t])
            best[i, k] = min(equal / len(item), equal / max(columns, 1))
    assert got <= {p for p, s in best.items() if s >= 0.79}
    assert {p for p, s in best.items() if s >= 0.85} <= got


def test_edited_copies_beside_exact_ones(spark):
    """All pairs at the threshold itself; the exact copies make the grams that edited copies kept the frequent ones."""
    rng = random.Random(4)
    items = [words(rng, n) for n in (5, 6, 8, 10, 12, 15, 15, 16, 20, 20, 30, 30, 40, 55)]
    texts = [item[:] for item in items for _ in range(2)]
    for item in items:
        for every in (5, 6, 7):
            texts.append([f"new{rng.random()}"[5:] if i % every == every - 1 else w for i, w in enumerate(item)])
        for _ in range(12):
            text = item[:]
            for i in rng.sample(range(len(item)), len(item) // 5):
                text[i] = f"e{rng.randint(0, 10**9)}"
            texts.append(words(rng, 20, 10**6) + text + words(rng, 20, 10**6))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string")
    number = {w: i for i, w in enumerate({w for t in items + texts for w in t})}
    expected = set()
    for i, t in enumerate(texts):
        for k, item in enumerate(items):
            _, equal, columns, _, _ = leaks.align([number[w] for w in item], [number[w] for w in t])
            if min(equal / min(len(item), leaks.ENOUGH), equal / max(columns, 1)) >= 0.8:
                expected.add((i, k))
    assert {(r.doc_id, r.item_id) for r in leaks.find_copies(docs, bench).collect()} == expected
    assert len(expected) > 150


def test_seed_length():
    assert [leaks.seed_length(n, 5, 0.8) for n in (5, 6, 10, 15, 16, 30, 50, 300)] == [2, 3, 3, 3, 4, 4, 4, 4]
    assert leaks.seed_length(30, 5, 1.0) == 5
