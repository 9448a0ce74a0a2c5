"""Removed windows against brute force."""

import hashlib
import random

import pytest

from boardlake.llm import superkmer

SCHEMA = "doc_id bigint, text string, id string, digest int"


def brute(rows, window):
    first = {}
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in docs:
        if i is not None:
            for j in range(len(words) - window + 1):
                w = tuple(words[j : j + window])
                first[w] = min(first.get(w, i), i)
    out = []
    for i, words in docs:
        gone = set()
        if i is not None:
            for j in range(len(words) - window + 1):
                if first[tuple(words[j : j + window])] < i:
                    gone.update(range(j, j + window))
        kept = b" ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed, n, vocabulary=400):
    rng = random.Random(seed)

    def words(k):
        return [rng.choice("abcdé") * rng.randint(1, 3) + str(rng.randint(0, vocabulary)) for _ in range(k)]

    passage, rows = words(70), []
    for i in range(n):
        text = words(rng.choice([0, 3, 49, 50, 60, 150]))
        if i % 3 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = passage[rng.randint(0, 10) :]
        if i % 7 == 0 and rows:
            text = (rng.choice(rows)[1] or "").split()
            if text and i % 2:
                text[rng.randrange(len(text))] = "edit"
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [3, 5000])
@pytest.mark.parametrize("window,k", [(50, 8), (12, 4)])
def test_against_brute_force(spark, window, k, limit):
    rows = made(window, 120) + [(500, "a " * 300), (501, "b " * 20 + "a " * 200), (502, "x y z " * 90), (503, "y z " + "x y z " * 60), (None, "a " * 90), (None, None), (7, None), (7, "a " * 100), (504, " \n")]
    docs = spark.createDataFrame([(*r, "q", 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, superkmer.remove_repeated_windows(docs, window, k, limit).collect()), key=str)
    assert got == brute(rows, window)


def test_long_text_and_no_rows(spark):
    long = " ".join(str(i) for i in range(100_000))
    docs = spark.createDataFrame([(1, long), (2, "start " + long)], "doc_id bigint, text string")
    got = sorted(map(tuple, superkmer.remove_repeated_windows(docs).collect()))
    assert [r[:3] for r in got] == [(1, 100_000, 0), (2, 100_001, 100_000)]
    assert got[1][3] == hashlib.sha256(b"start").hexdigest()
    assert superkmer.remove_repeated_windows(docs.limit(0)).collect() == []


def test_phrase_that_one_text_repeats_is_not_held_in_one_group(spark, monkeypatch):
    """Two texts share a phrase that one of them has thousands of times: its windows are counted, not its texts."""
    phrase = [f"w{i}" for i in range(60)]
    odd = [w for i in range(400) for w in [*phrase, f"mark{i}"]]
    rows = [(1, " ".join(odd)), (2, "own start " + " ".join(phrase) + " own end"), (3, " ".join(f"u{i}" for i in range(80)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    # The bucket has nothing left to count: all of its windows are rows of their own.
    monkeypatch.setattr(superkmer, "_count", lambda packs, window: packs.filter("false").selectExpr("digest", "0 AS start", "0 AS end"))
    got = sorted(map(tuple, superkmer.remove_repeated_windows(docs, group_limit=500).collect()), key=str)
    assert got == brute(rows, 50) and got[1][2] == 60
