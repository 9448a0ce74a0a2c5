"""Repeated bytes against brute force."""

import hashlib
import random
import tracemalloc
from collections import Counter

import pytest

from boardlake.llm import suffix_dedup

SCHEMA = "doc_id bigint, text string, id string, digest int"


def brute(rows, window):
    docs = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[j : j + window] for _, d in docs for j in range(len(d) - window + 1))
    out = []
    for i, d in docs:
        gone = bytearray(len(d))
        for j in range(len(d) - window + 1):
            if seen[d[j : j + window]] > 1:
                gone[j : j + window] = b"\1" * window
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(1 for j in range(len(d)) if gone[j] and not (j and gone[j - 1]))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed, n, window):
    rng = random.Random(seed)

    def words(size):
        return "".join(rng.choice("abcdefghé \n") for _ in range(size))

    passages = [words(window * 2), words(window + 5), words(window), words(window - 1)]
    rows = []
    for i in range(n):
        text = words(rng.choice([0, 5, window - 1, window, window * 3]))
        for passage in rng.sample(passages, rng.choice([0, 1, 1, 2])):
            cut = rng.randint(0, window // 2)
            at = rng.randint(0, len(text))
            text = text[:at] + passage[cut:] + text[at:]
        if i % 6 == 0 and rows:
            text = list(rng.choice(rows)[1])
            if text and i % 4:
                text[rng.randrange(len(text))] = "Z"
            text = "".join(text)
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("limit", [2, 20_000])
@pytest.mark.parametrize("window,gram", [(400, 64), (40, 8)])
def test_against_brute_force(spark, window, gram, limit):
    rows = made(window + limit, 90, window) + [(500, "a" * 3 * window), (501, "ab" * window + "c" + "ab" * window), (502, "xyz" * window), (None, None), (None, "q" * window), (None, "q" * window), (7, ""), (7, "r" * window)]
    docs = spark.createDataFrame([(*r, "q", 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, suffix_dedup.remove_repeated_bytes(docs, window, gram, limit).collect()), key=str)
    assert got == brute(rows, window)


def test_spans_of_a_group_against_all_pairs():
    rng = random.Random(4)
    for _ in range(40):
        contexts = list({(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 14))) + b"MID" + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 14))), 0) for _ in range(rng.randint(2, 30))})
        contexts = [(c, c.index(b"MID")) for c, _ in contexts]
        expected = {}
        for i, (x, p) in enumerate(contexts):
            for y, q in contexts:
                if x != y:
                    left = next((n for n in range(min(p, q)) if x[p - 1 - n] != y[q - 1 - n]), min(p, q))
                    room = min(len(x) - p, len(y) - q)
                    right = next((n for n in range(room) if x[p + n] != y[q + n]), room)
                    if left + right >= 9:
                        expected.setdefault(i, []).append((-left, right))
        assert suffix_dedup.repeated_spans(contexts, 9) == {i: suffix_dedup.merged(s) for i, s in expected.items()}


def test_misleading_hashes_are_verified():
    assert suffix_dedup.common(b"abcd", b"abxd", [0, 1, 2, 3, 4], [0, 1, 2, 3, 4]) == 2


def test_misleading_hashes_of_steps_are_verified():
    x = bytes(range(100))
    y = x[:40] + b"!" + x[41:]
    own = suffix_dedup._prefix_hashes(x)
    assert len(own) == 1 + 100 // suffix_dedup._STEP
    assert suffix_dedup.common(x, y, own, own) == 40


def test_common_prefixes_of_all_lengths():
    rng = random.Random(6)
    for size in range(150):
        x = bytes(rng.choice(b"ab") for _ in range(size))
        for n in range(0, size + 1, 7):
            y = x[:n] + b"c" * rng.randint(0, 70)
            assert suffix_dedup.common(x, y, suffix_dedup._prefix_hashes(x), suffix_dedup._prefix_hashes(y)) == n


def test_a_large_group_takes_little_memory():
    rng = random.Random(5)
    base = bytes(rng.choice(b"abcdefghij ") for _ in range(736))
    contexts = [(base[:at] + b"%07d" % i + base[at + 7 :], 336) for i, at in enumerate(rng.choice([*range(329), *range(400, 729)]) for _ in range(1500))]
    tracemalloc.start()
    spans = suffix_dedup.repeated_spans(contexts, 400)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(spans) > 700
    assert peak / len(contexts) < 4_000


def test_long_text_and_no_rows(spark):
    rng = random.Random(8)
    long = "".join(rng.choice("abcdefghij") for _ in range(900_000))
    docs = spark.createDataFrame([(1, long), (2, "x" + long[300_000:700_000] + "y")], "doc_id bigint, text string")
    got = sorted(map(tuple, suffix_dedup.remove_repeated_bytes(docs).collect()))
    assert [r[:4] for r in got] == [(1, 900_000, 400_000, 1), (2, 400_002, 400_000, 1)]
    assert suffix_dedup.remove_repeated_bytes(docs.limit(0)).collect() == []
