"""Top-k from blocks against the ranking of all postings, and what is read for it."""

import random

import pytest
from pyspark.sql import functions as F

from boardlake.operators import blocks as B
from boardlake.operators import search as S
from boardlake.operators.index import build_index, store_index
from boardlake.session import scratch_path

WEIGHTS = {"title": 3.0, "body": 1.0}


def corpus(spark, n, seed):
    dice = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["apple", "apply", "apt", "bear"]
    odds = [1 / (i + 1) for i in range(60)] + [0.05] * 4
    rows = [(f"d{i:05d}", dice.choice([None, " ".join(dice.choices(words, odds, k=3))]), " ".join(dice.choices(words, odds, k=dice.choice([0, 5, 40, 400])))) for i in range(n)]
    return spark.createDataFrame(rows, "id string, title string, body string").repartition(4)


QUERIES = {"one": '"w0"', "two": "w10 w3", "prefix": "app", "both": "w2 ap", "rare": "bear w5", "none": "absent", "half": "w0 absent", "empty": " - "}


def top(hits):
    return sorted((r.query_id, r.doc_id, r["rank"]) for r in hits.collect())


@pytest.fixture(scope="module")
def indexed(spark):
    rows = corpus(spark, 1500, 4)
    index = store_index(rows, WEIGHTS, scratch_path(spark, "index"))
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(B, "BLOCK_DOCS", 32)
        yield index, B.store_blocks(index, scratch_path(spark, "blocks"))


@pytest.mark.parametrize("limit", [1, 10, 2000])
def test_rows_are_those_of_the_whole_ranking(spark, indexed, limit):
    index, blocks = indexed
    found = B.search_top(blocks, QUERIES, limit)
    assert top(found.hits) == top(S.best_per_query(S.rank_matches(index, QUERIES), limit, ["doc_id"]))


def test_blocks_under_the_kth_score_are_not_read(spark, indexed):
    found = B.search_top(indexed[1], {"one": '"w0"', "two": "w1 w3"}, 5)
    held, read = ({r.query_id: r["count"] for r in f.groupBy("query_id").count().collect()} for f in (found.bounds, found.chosen))
    assert all(held[q] > 30 and read[q] < 0.5 * held[q] for q in held), (held, read)


def test_dictionary_and_expansion(spark, indexed):
    index, blocks = indexed
    counted = {r.token: (r.docs, r.hits) for r in blocks.terms.collect()}
    postings = index.postings.groupBy("token").agg(F.count_distinct("doc_id").alias("d"), F.count(F.lit(1)).alias("h")).collect()
    assert counted == {r.token: (r.d, r.h) for r in postings}
    assert {(r.word, r.token) for r in B.expand_terms(blocks, {"q": 'ap "bear" app'}).collect()} >= {("ap*", "apple"), ("ap*", "apply"), ("ap*", "apt"), ("app*", "apple"), ("app*", "apply")}
    found = B.expanded_postings(index, blocks, 'app "w0"')
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "token" in plan and "StartsWith" not in plan
    assert {r.token for r in found.select("token").distinct().collect()} == {"apple", "apply", "w0"}


def test_long_expansions_go_to_the_scan_as_prefixes(spark, indexed, monkeypatch):
    index, blocks = indexed
    monkeypatch.setattr(B, "EXPANDED", 1)
    assert {r.token for r in B.expanded_postings(index, blocks, "app").select("token").distinct().collect()} == {"apple", "apply"}


def test_phrases_are_refused_and_an_empty_index_finds_nothing(spark, indexed):
    with pytest.raises(ValueError, match="phrases"):
        B.search_top(indexed[1], '"w0 w1"', 3)
    none = store_index(corpus(spark, 1, 1).limit(0), WEIGHTS, scratch_path(spark, "index"))
    assert top(B.search_top(B.store_blocks(none, scratch_path(spark, "blocks")), "w0", 3).hits) == []


def test_lazy_index_can_be_stored_as_blocks(spark):
    rows = corpus(spark, 40, 9)
    index = build_index(rows, WEIGHTS)
    assert top(B.search_top(B.store_blocks(index, scratch_path(spark, "blocks")), "w0", 7).hits) == top(S.best_per_query(S.rank_matches(index, {"q": "w0"}), 7, ["doc_id"]))
