"""The automaton against edit distances, and held-out accuracy."""

import math
import random
import zlib

from boardlake.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_all_entries():
    rng = random.Random(1)
    entries = {"".join(rng.choice("abc") for _ in range(rng.randint(3, 11))): rng.random() + 1 for _ in range(25)}
    entries |= {"".join(rng.choice("abc") for _ in range(rng.randint(4, 6))) + "*": rng.random() + 1 for _ in range(4)}
    automaton = toxicity.LexiconAutomaton(entries)
    for _ in range(3000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 13)))
        near = [(distance(word, e), -w) for e, w in entries.items() if not e.endswith("*") and distance(word, e) <= toxicity.allowance(e)]
        near += [(0, -w) for e, w in entries.items() if e.endswith("*") and word.startswith(e[:-1])]
        got = automaton.match(word)
        assert (got is None) == (not near)
        if near:
            assert (got[1], -got[0]) == min(near)


def made(n):
    rng = random.Random(2)
    bad, plain = ["horrible", "nasty", "wicked"], [f"{a}{b}ly" for a in "bcdfghklmn" for b in ("an", "or", "ui", "ex", "im", "ol")]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 40))]
        toxic = i % 5 == 0
        for _ in range(2 if toxic else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(bad) if i % 2 else "grozz" + rng.choice(plain))
        docs.append((i, " ".join(words), "xx", 9))
        labels.append((i, int(toxic), 1))
    return docs, labels


def test_held_out(spark):
    rows, marks = made(800)
    rows += [(1000, None, "x", 9), (1001, "", "x", 9), (None, "nasty wicked", "x", 9), (1002, "a horible nasti person", "x", 9), (1003, "word " * 100_000 + "nasty wicked", "x", 9), (1004, 'she said "nasty wicked" to us', "x", 9), (1004, "again", "x", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string, held_out int")
    labels = spark.createDataFrame(marks + [(None, 1, 1), (3, None, 1), (0, 1, 1)], "doc_id bigint, toxic int, quality int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2) for r in got)
    truth = {i: t for i, t, _ in marks}
    hidden = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in hidden) >= 0.98 * len(hidden) > 100
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r.score)
    assert by_id[1000] == by_id[1001] and by_id[1000][0] < 0.3
    assert by_id[None][0] >= 0.3 and by_id[1002][0] > by_id[1001][0] and by_id[1003][0] >= 0.3
    assert max(by_id[1004]) < by_id[None][0]


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "nasty")], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    assert [r.predicted for r in toxicity.score(docs, model).collect()] == [0]
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_quotation():
    inside = toxicity.Scorer._in_quotes
    assert inside('he said "you nasty one" again', 12, 17) and not inside("you nasty one", 4, 9)
    assert not inside('"a quote". you nasty one "b"', 15, 20) and not inside("don't be nasty, isn't it", 9, 14)


def test_sample_has_one_text_of_an_id_that_fills_the_table(spark):
    docs = spark.createDataFrame([(1, f"text {i % 7}") for i in range(500)] + [(i, f"own {i}") for i in range(2, 40)] + [(None, "x")], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, 0, i % 2) for i in [1, 1, *range(2, 40)]] + [(None, 0, 1)], "doc_id bigint, quality int, toxic int")
    free = {r.doc_id for r in docs.filter(~toxicity.held_out(docs.doc_id)).filter("doc_id IS NOT NULL").collect()}
    for rows in (1000, 10):
        sample = toxicity._labelled(docs, labels, "doc_id", "text", "toxic", rows).collect()
        assert len({r.id for r in sample}) == len(sample) == min(rows, len(free)) and {r.id for r in sample} <= free


def test_words_below_a_stem_keep_their_misspellings():
    kept = toxicity._pruned([("grozz*", 40, 5.0), ("grozzanly", 5, 4.0), ("grozzly*", 6, 4.0), ("nasty", 9, 3.0), ("gro", 30, 2.5)])
    assert set(kept) == {"grozz*", "grozzanly", "nasty", "gro"}
    automaton = toxicity.LexiconAutomaton(kept)
    assert automaton.match("grozzanly") == (5.0, 0) and automaton.match("grozly") is None
    assert automaton.match("gozzanly") == (4.0, 1) and automaton.match("grrozzanlly") == (4.0, 2)
    assert toxicity.WORD.findall("na5ty 12 n4s7y x9") == ["na5ty", "n4s7y", "x"] and automaton.match("na5ty") == (3.0, 1)


def plain_features(text, weights):
    """The features by comparing every word with every entry."""
    lowered = text.lower()
    found = list(toxicity.WORD.finditer(lowered))
    words = [m.group() for m in found]
    exact = fuzzy = quoted = strongest = direct = 0.0
    for i, m in enumerate(found):
        near = [(distance(words[i], e), -w) for e, w in weights.items() if not e.endswith("*") and distance(words[i], e) <= toxicity.allowance(e)]
        near += [(0, -w) for e, w in weights.items() if e.endswith("*") and words[i].startswith(e[:-1])]
        if not near:
            continue
        edits, weight = min(near)[0], -min(near)[1]
        window = words[max(0, i - toxicity.WINDOW_WORDS) : i + toxicity.WINDOW_WORDS + 1]
        if toxicity.Scorer._in_quotes(lowered, *m.span()) or set(window) & toxicity.REPORTING:
            quoted += weight
            continue
        weight /= 1 + edits
        strongest, direct = max(strongest, weight), direct + bool(set(window) & toxicity.ADDRESS)
        exact, fuzzy = exact + weight * (not edits), fuzzy + weight * bool(edits)
    return [math.log1p(exact + fuzzy), math.log1p(fuzzy), math.log1p(quoted), strongest, math.log1p(direct)]


def test_scores_against_brute_force(spark):
    rows, marks = made(300)
    rng = random.Random(5)
    rows += [(5000 + i, " ".join(rng.choice(["you", "said", '"nasty"', "horribel", "wickd", "n4sty", "grozzanly", "grozanly", "plain", ".", "the"]) for _ in range(rng.randint(0, 30))), "x", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string, held_out int")
    model = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id bigint, toxic int, quality int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert model.weights and len(got) == len(rows)
    for doc_id, text, *_ in rows:
        z = model.coefficients[0] + sum(c * f for c, f in zip(model.coefficients[1:], plain_features(text, model.weights)))
        assert abs(got[doc_id] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9


def test_a_labelled_id_in_many_rows(spark):
    rows = [(8, f"text {i} nasty", "x", 1) for i in range(3000)] + [(i, "fine", "x", 1) for i in range(100, 140)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string, held_out int")
    labels = spark.createDataFrame([(8, 1)] + [(i, 0) for i in range(100, 140)], "doc_id bigint, toxic int")
    sample = toxicity._labelled(docs, labels, "doc_id", "text", "toxic", 20).collect()
    assert len(sample) <= 20 and len({r.id for r in sample}) == len(sample)
