"""Toxicity scores: a lexicon trie read through Levenshtein automata, and context windows around the hits.

The lexicon is learned from labelled documents: words, and stems of four to eight letters, that toxic documents have and
clean ones hardly do. Its entries form a trie. A word of a text (letters, and digits between letters) is run through
the product of that trie with the Levenshtein automaton of each entry's edit allowance (one edit from five letters on,
two from nine; stems take none, but the learned words below a stem stay entries, so their misspellings are found), whose states are made deterministic as they are met and kept, so that a letter costs one look-up and misspelled
entries are found without trying any entry by itself.

A hit weighs by its entry. Its window tells quotation from abuse: quotation marks around it or a reporting verb near
by count it as quoted, a word of address makes it direct. A logistic regression over the sums scores the document.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, the smallest by hash of the id); the lexicon
holds ``LEXICON_ENTRIES`` at most. Scoring is one pass over whole texts without a shuffle.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.llm.batches import map_rows
from boardlake.session import staged

SAMPLE_ROWS = 20_000
LEXICON_ENTRIES = 2_000
LEAST_TOXIC = 3
LEAST_WEIGHT = 2.0
STEMS = range(4, 9)
WORD = re.compile(r"[^\W\d_]+(?:\d+[^\W\d_]+)*")
THRESHOLD = 0.3
REMEMBERED_WORDS = 500_000
REMEMBERED_STATES = 200_000
WINDOW_WORDS = 6
QUOTE_CHARS = 60
# Marks and words of the context windows.
OPENING, CLOSING = "\"'“«„‘‚‹", "\"'”»“’‘›"
REPORTING = {"said", "says", "say", "wrote", "writes", "called", "calls", "quote", "quoted", "quotes", "claimed", "according", "sagte", "schrieb", "dit", "disait", "écrit", "dijo", "escribió"}
ADDRESS = {"you", "your", "youre", "u", "du", "dich", "dein", "tu", "toi", "ton", "tú", "te", "eres"}


def allowance(entry: str) -> int:
    return 0 if entry.endswith("*") else (len(entry) >= 5) + (len(entry) >= 9)


class LexiconAutomaton:
    """The trie of the entries (a final ``*`` marks a stem) and its lazily determinised product with the edits.

    A state is the set of (node, edits so far) the letters read may stand at. ``match`` gives for a word the weight of
    its best entry and the edits it took, or None.
    """

    def __init__(self, weights: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.word: list[tuple[float, int] | None] = [None]
        self.stem: list[float | None] = [None]
        self.most = [0]  # edits that some entry below allows
        for entry, weight in weights.items():
            node, allowed = 0, allowance(entry)
            self.most[0] = max(self.most[0], allowed)
            for c in entry.rstrip("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    for column, blank in ((self.children, {}), (self.word, None), (self.stem, None), (self.most, 0)):
                        column.append(blank)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], allowed)
            if entry.endswith("*"):
                self.stem[node] = weight
            else:
                self.word[node] = (weight, allowed)
        self._forget()

    def _forget(self):
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: dict[tuple[int, str], int] = {}
        self.start = self._number(self._closed({0: 0}))

    def _closed(self, reached: dict[int, int]) -> dict[int, int]:
        """Add the nodes reached by skipping entry letters, an edit each."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            e = reached[node] + 1
            for child in self.children[node].values():
                if e <= self.most[child] and reached.get(child, e + 1) > e:
                    reached[child] = e
                    todo.append(child)
        return reached

    def _number(self, reached: dict[int, int]) -> int:
        state = tuple(sorted(reached.items()))
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state]

    def _step(self, number: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if e <= self.most[node] and reached.get(node, e + 1) > e:
                reached[node] = e

        for node, e in self.states[number]:
            reach(node, e + 1)  # a letter too many
            for c, child in self.children[node].items():
                reach(child, e + (c != letter))
        to = self._number(self._closed(reached)) if reached else -1
        self.steps[number, letter] = to
        return to

    def match(self, word: str) -> tuple[float, int] | None:
        if len(self.states) > REMEMBERED_STATES:
            self._forget()
        state, steps, best = self.start, self.steps, None
        for letter in word:
            to = steps.get((state, letter))
            state = self._step(state, letter) if to is None else to
            if state < 0:
                return best
            for node, e in self.states[state]:
                if e == 0 and self.stem[node] is not None:
                    best = max(best or (0.0, 0), (self.stem[node], 0))
        for node, e in self.states[state]:
            entry = self.word[node]
            if entry and e <= entry[1] and (best is None or (-e, entry[0]) > (-best[1], best[0])):
                best = (entry[0], e)
        return best


_ready: dict[tuple, tuple[LexiconAutomaton, dict]] = {}


def _kept_ready(weights: dict[str, float]) -> tuple[LexiconAutomaton, dict]:
    """The automaton of a lexicon and the words it has matched, kept by the worker process from task to task."""
    key = tuple(weights.items())
    if key not in _ready:
        _ready.clear()
        _ready[key] = (LexiconAutomaton(weights), {})
    return _ready[key]


@dataclass
class Scorer:
    """A fitted model: entry weights and the coefficients of the regression (the first is the intercept)."""

    weights: dict[str, float]
    coefficients: list[float] = field(default_factory=list)

    def features(self, text: str, automaton: LexiconAutomaton, known: dict) -> list[float]:
        """Sums of all direct, the misspelled and the quoted hits, the strongest direct hit, and hits with a word of address."""
        words = WORD.findall(text.lower())
        for w in words:
            if w not in known:
                known[w] = automaton.match(w)
        if len(known) > REMEMBERED_WORDS:
            kept = {w: known[w] for w in set(words)}
            known.clear()
            known.update(kept)
        hits = [i for i, w in enumerate(words) if known[w]]
        exact = fuzzy = quoted = strongest = direct = 0.0
        if hits:
            places = [m.span() for m in WORD.finditer(text.lower())]
            lowered = text.lower()
            for i in hits:
                weight, edits = known[words[i]]
                window = words[max(0, i - WINDOW_WORDS) : i + WINDOW_WORDS + 1]
                if self._in_quotes(lowered, *places[i]) or not REPORTING.isdisjoint(window):
                    quoted += weight
                    continue
                weight /= 1 + edits
                strongest = max(strongest, weight)
                if edits:
                    fuzzy += weight
                else:
                    exact += weight
                direct += not ADDRESS.isdisjoint(window)
        # Misspelled hits are in the first sum too: the second only learns how far they are to be trusted less.
        return [np.log1p(exact + fuzzy), np.log1p(fuzzy), np.log1p(quoted), strongest, np.log1p(direct)]

    @staticmethod
    def _in_quotes(text: str, start: int, end: int) -> bool:
        """An opening mark before and a closing one after, no sentence end or line break between."""
        before = re.split(r"[.!?\n]", text[max(0, start - QUOTE_CHARS) : start])[-1]
        after = re.split(r"[.!?\n]", text[end : end + QUOTE_CHARS])[0]
        opened = [i for i, c in enumerate(before) if c in OPENING and (i == 0 or not before[i - 1].isalnum())]
        closed = [i for i, c in enumerate(after) if c in CLOSING and not after[i + 1 : i + 2].isalnum()]
        return bool(opened) and bool(closed)

    def score(self, features: list[float]) -> float:
        z = self.coefficients[0] + float(np.dot(self.coefficients[1:], features))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def held_out(id_column: Column) -> Column:
    """Rows whose labels are never learned; a null id has the checksum of the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 4 == 2


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """``id``, ``text``, ``toxic`` of the sample: at most ``rows`` ids with a label that may be learned, each with one text.

    Several labels of an id: the largest. Several texts of an id: that of the smallest hash, found in each task before the shuffle, so an
    id that fills the table does not grow the sample.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # At most ``rows`` ids with a label each are broadcast.
    found = texts.join(F.broadcast(known), "id").groupBy("id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one"))
    return found.select("id", F.col("one.text").alias("text"), "toxic")


def _terms(sample: DataFrame) -> DataFrame:
    """``term``, ``toxic`` and ``clean``: how many sample documents of either label have a word or stem."""

    def run(batches):
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = set(WORD.findall(text.lower()))
                for term in words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}:
                    counts.setdefault(term, [0, 0])[0 if toxic else 1] += 1
            for term, (t, c) in counts.items():
                yield term, t, c

    return map_rows(sample, run, "term string, toxic bigint, clean bigint").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _significant(terms: DataFrame, toxic: int, clean: int) -> list:
    """The strongest terms that toxic documents have more often than chance allows among as many terms (likelihood-ratio test)."""
    t, c, rate = F.col("toxic"), F.col("clean"), toxic / max(1, toxic + clean)
    share = t / (t + c)
    evidence = 2 * (t * F.log(share / rate) + F.when(c > 0, c * F.log((1 - share) / (1 - rate))).otherwise(0.0))
    weight = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    least = 2 * float(np.log(2 * max(1, terms.count())))
    strong = terms.withColumn("weight", weight).filter((share > rate) & (evidence >= least) & (F.col("weight") >= LEAST_WEIGHT))
    return strong.orderBy(F.desc(evidence), "term").limit(LEXICON_ENTRIES).collect()


def _pruned(rows: list[tuple[str, int, float]]) -> dict[str, float]:
    """Of words and stems that stand for the same documents one is kept: a word if it has nearly all of them, else the shortest stem.

    Words below a kept stem that are long enough for an edit are kept too: the stem finds them as they are, they their misspellings.
    """
    kept: dict[str, float] = {}
    counts = {term: n for term, n, _ in rows}
    for term, n, weight in sorted(rows, key=lambda r: (len(r[0].rstrip("*")), r[0])):
        own = term.rstrip("*")
        if any(own[:k] + "*" in kept for k in range(1, len(own) + (not term.endswith("*")))):
            if allowance(term):
                kept[term] = weight
            continue
        longer = [t for t in counts if t.startswith(own) and t != term] if term.endswith("*") else []
        if any(counts[t] >= 0.9 * n for t in longer):
            continue  # a longer term says the same more exactly
        kept[term] = weight
    return kept


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> Scorer:
    """Learn lexicon and coefficients from the labels of rows that are not held out. Without toxic labels every score is low."""
    sample = staged(_labelled(docs, labels, id_col, text_col, label_col, rows).select("text", "toxic"), "toxic-sample")
    sizes = {bool(r.toxic): r["count"] for r in sample.groupBy(F.col("toxic").cast("int").alias("toxic")).count().collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    found = _significant(staged(_terms(sample).filter(F.col("toxic") >= LEAST_TOXIC), "toxic-terms"), toxic, clean) if toxic else []
    model = Scorer(_pruned([(r.term, r.toxic, r.weight) for r in found]))

    def measured(batches):
        automaton, known = _kept_ready(model.weights)
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"]):
                yield int(bool(label)), [float(x) for x in model.features(text, automaton, known)]

    points = map_rows(sample, measured, "label int, features array<double>").collect()  # the sample's rows at most
    points.sort(key=lambda r: (r.label, r.features))  # reruns add in the same order
    model.coefficients = _regression(np.array([r.features for r in points], float).reshape(len(points), 5), np.array([r.label for r in points], float))
    return model


def _regression(features: np.ndarray, labels: np.ndarray, ridge: float = 0.1, steps: int = 30) -> list[float]:
    """Ridge-penalised logistic regression by Newton steps."""
    if not labels.any():
        return [-4.0, *[0.0] * 5]
    x = np.hstack([np.ones((len(features), 1)), features])
    beta, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[ridge] * features.shape[1]])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + penalty, x.T @ (labels - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta.tolist()


def score(docs: DataFrame, model: Scorer, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` per row of ``docs``.

    Null and empty texts get the score of a text without hits. Rows with null or repeated ids are scored by their
    own text. An empty table gives none. Other columns are not read.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scored = map_rows(picked, _Scoring(model), f"id {picked.schema['id'].dataType.simpleString()}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


class _Scoring:
    def __init__(self, model: Scorer):
        self.model = model

    def __call__(self, batches):
        automaton, known = _kept_ready(self.model.weights)
        for batch in batches:
            for key, text in zip(batch["id"], batch["text"]):
                yield key, self.model.score(self.model.features(text, automaton, known))


def score_texts(docs: DataFrame, model: Scorer, text_col: str, score_col: str) -> DataFrame:
    """``docs`` with all its columns and the score of each row's text as ``score_col``."""

    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton, known = _kept_ready(model.weights)
        for texts in parts:
            yield texts.map(lambda t: model.score(model.features(t, automaton, known))).astype("float64")

    return docs.withColumn(score_col, F.pandas_udf(scores, "double")(F.coalesce(F.col(text_col), F.lit(""))))
