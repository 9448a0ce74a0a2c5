"""Fingerprints, anchors and groups against brute force."""

import math
import random

import numpy as np
import xxhash

from boardlake.llm import simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def groups(points):
    """Smallest id per row by comparing all pairs."""
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(points))]


def test_every_pair_within_two_bits_shares_an_anchor():
    rng = random.Random(3)
    for _ in range(60):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.choice([0, 1, 2])):
            y ^= 1 << b
        _, ax = simhash.anchors(np.array([x], np.uint64))
        _, ay = simhash.anchors(np.array([y], np.uint64))
        assert set(ax.tolist()) & set(ay.tolist())
        assert all(((int(a) ^ x) & ~1).bit_count() <= 2 for a in ax)


def test_groups_against_brute_force(spark):
    rng = random.Random(5)
    points = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(260):  # chains and balls
        y = rng.choice(points)
        for b in rng.sample(range(64), rng.choice([1, 2, 3])):
            y ^= 1 << b
        points.append(y)
    points = list(dict.fromkeys(points))
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    links = simhash.linked_points(spark.createDataFrame([(p,) for p in signed], "fp bigint"))
    from boardlake.llm.components import component_labels

    labels = {r.node: r.label for r in component_labels(links, "a", "b").collect()}
    expected = groups(points)
    mine = [labels.get(p, p) for p in signed]
    assert len(set(zip(expected, mine))) == len(set(expected)) == len(set(mine))
    assert links.count() < 4 * len(points)


def test_documents(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(120)) for _ in range(12)]
    texts = base + [t.upper() for t in base[:4]] + [t + " tail" for t in base[4:8]] + [None, "", " \t\n", "one", "Two words", "É é", "x " * 70_000]
    texts += [base[0]] * 30
    rows = [(i * 3, t, i, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp int, label string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_fingerprint(t or "") for t in texts]
    expected = groups(prints)
    first = {}
    for i, g in enumerate(expected):
        first.setdefault(g, i * 3)
    assert got == {i * 3: (f"{p:016x}", first[g]) for i, (p, g) in enumerate(zip(prints, expected))}


def test_null_ids_repeats_and_no_rows(spark):
    schema = "doc_id bigint, text string"
    docs = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (None, "other words here now")], schema)
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, -1), (-1, 4), (4, 4), (4, 4)]
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).collect() == []


def test_bucket_of_many_blocks_loses_no_link(spark):
    """Chains of similar texts among many unlike ones in one bucket, dealt into blocks far smaller than the bucket."""
    rng = np.random.default_rng(4)
    sketches = []
    for c in range(30):
        row = rng.integers(1, 60_000, simhash.BINS, np.uint16)
        for step in range(rng.integers(1, 9)):
            row = row.copy()
            row[rng.choice(simhash.BINS, 40, replace=False)] = rng.integers(1, 60_000, 40, np.uint16)
            sketches.append((c, f"{rng.integers(1 << 40):010x}", row))
    keys = [k for _, k, _ in sketches]
    rows = spark.createDataFrame([(k, [7, int(rng.integers(8, 12))], bytearray(r.tobytes())) for _, k, r in sketches], "key string, bands array<bigint>, bins binary")
    table = np.array([r for *_, r in sketches])
    near = {(keys[i], keys[j]) for i in range(len(keys)) for j in range(len(keys)) if i != j and (table[i] == table[j]).mean() >= 0.8}
    assert near

    def reach(links):
        label = {k: k for k in keys}
        while True:
            before = dict(label)
            for x, y in links:
                label[x] = label[y] = min(label[x], label[y])
            if label == before:
                return label

    for block_rows in (5, 40, 1_000):
        found = {(r.x, r.y) for r in simhash.similar_links(rows, 0.8, block_rows).collect()}
        assert found <= near
        assert reach(found) == reach(near)


def test_near_copies_at_the_threshold(spark):
    """Pairs of short and long texts on both sides of similarity 0.8; all pairs are their own."""
    rng = random.Random(11)

    def fresh(n):
        return [f"w{rng.randint(0, 10**9)}" for _ in range(n)]

    def shingles(words):
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    pairs = [(t, t[:-1]) for n in (9, 10, 12, 18, 26, 30) for t in [fresh(n) for _ in range(4)]] + [(t, t[1:]) for n in (9, 10, 14, 28) for t in [fresh(n) for _ in range(4)]]
    for _ in range(150):
        text = fresh(rng.randint(50, 600))
        copy = text + fresh(round(len(text) * rng.uniform(0.2, 0.27)))
        pairs.append((text, copy))
    rows = [(f"{i:03d}{side}", " ".join(t)) for i, pair in enumerate(pairs) for side, t in zip("ab", pair)]
    label = {r.key: r.label for r in simhash.near_copy_groups(spark.createDataFrame(rows, "key string, text string")).collect()}
    near = {i for i, (x, y) in enumerate(map(lambda p: map(shingles, p), pairs)) if len(x & y) / len(x | y) >= 0.8}
    assert {i for i in range(len(pairs)) if label[f"{i:03d}a"] == label[f"{i:03d}b"]} == near
    assert 90 < len(near) < len(pairs) - 40
    assert all(label[f"{i:03d}{s}"][:3] == f"{i:03d}" for i in range(len(pairs)) for s in "ab")


def test_short_keys_are_shared():
    rng = np.random.default_rng(12)
    for _ in range(2_000):
        own = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 31)).astype(np.uint64))
        kept = rng.permutation(own)[: max(1, math.ceil(0.8 * len(own)))]
        other = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, rng.integers(0, 3)).astype(np.uint64)]))
        if len(kept) / len(np.union1d(own, other)) >= 0.8:
            assert {*simhash.short_keys(own, 0.8)} & {*simhash.short_keys(other, 0.8)}


def test_equal_fingerprints_of_unlike_texts(spark):
    rng = random.Random(13)
    texts = [" ".join(["na"] * 80 + [f"w{rng.randint(0, 10**9)}" for _ in range(20)]) for _ in range(6)]
    assert len({simhash.fingerprint(t.encode(), 5) for t in texts}) == 1
    rows = list(enumerate([*texts, texts[0] + " na", "", " ", "\n"]))
    frame = spark.createDataFrame([(f"{i}", t) for i, t in rows], "key string, text string")
    label = {r.key: r.label for r in simhash.near_copy_groups(frame).collect()}
    assert len(label) == 10 and len({label[str(i)] for i in range(6)}) == 6
    assert label["6"] == label["0"] and label["7"] == label["8"] == label["9"] != label["0"]
