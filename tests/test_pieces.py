"""Packed postings: lists instead of rows per occurrence, counted right where ids repeat or are missing."""

import pytest
from pyspark.sql import functions as F

from boardlake.operators import pieces
from boardlake.operators import search as S
from boardlake.operators.index import build_index, store_index, term_stats, update_index
from boardlake.session import scratch_path

WEIGHTS = {"title": 3.0, "body": 1.0}
ROWS = [("a", "moss", "moss fern moss"), ("b", None, "fern"), ("a", "reed", "moss"), (None, "moss", "x"), (None, "", "moss moss"), ("c", "", None)]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "id string, title string, body string").repartition(3)


def by_rows(index):
    per_doc = index.postings.groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("hits"))
    return sorted(map(tuple, per_doc.groupBy("token").agg(F.count(F.lit(1)), F.sum("hits")).collect()))


@pytest.mark.parametrize("tokens", [1, 4, 1000])
def test_counts_of_repeated_and_missing_ids(spark, rows, monkeypatch, tokens):
    monkeypatch.setattr(pieces, "PIECE_TOKENS", tokens)
    expected = [("fern", 2, 2), ("moss", 2, 7), ("reed", 1, 1), ("x", 1, 1)]
    for index in (build_index(rows, WEIGHTS), store_index(rows, WEIGHTS, scratch_path(spark, "pieces"))):
        assert sorted(map(tuple, term_stats(index).collect())) == by_rows(index) == expected
    updated = update_index(index, rows.filter("id = 'b'").withColumn("body", F.lit("fern x")), rows.filter("id = 'a'"))
    assert sorted(map(tuple, term_stats(updated).collect())) == by_rows(updated)


def test_stored_postings_have_a_row_per_token_and_piece(spark):
    texts = spark.range(400).select(F.concat(F.lit("d"), "id").alias("id"), F.lit("fern").alias("title"), F.lit("moss fern " * 50).alias("body")).coalesce(1)
    path = scratch_path(spark, "pieces")
    index = store_index(texts, WEIGHTS, path)
    assert spark.read.parquet(f"{path}/postings").count() == 3 and index.postings.count() == 400 * 101


def test_phrases_of_lists_are_those_of_positions(spark):
    texts = [("a", "the the the", "of the of the of"), ("b", None, "of of the"), ("c", "of", "the of")]
    index = build_index(spark.createDataFrame(texts, "id string, title string, body string"), WEIGHTS)
    request = S.prepare(index, {"two": '"of the"', "same": '"the the"'})
    found = sorted((r.word, r.doc_id, r.col, r.start) for r in S.phrase_hits(request.entries, request.terms).collect())
    assert found == [("of the", "a", "body", 0), ("of the", "a", "body", 2), ("of the", "b", "body", 1), ("the the", "a", "title", 0), ("the the", "a", "title", 1)]


def test_queries_of_a_frame_match_distinct_tokens_first(spark, rows):
    index = build_index(rows, WEIGHTS)
    frame = spark.createDataFrame([("q", "mo f"), ("r", '"moss fern"')], "query_id string, text string")
    request = S.prepare(index, frame)
    found = S.match_terms(request.entries, request.terms, request.tokens)
    assert "substr" not in found._jdf.queryExecution().optimizedPlan().toString()
    columns = ["token", "doc_id", "col", "word", "term_no"]
    plain = S.match_terms(request.entries, request.terms).select(columns)
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, plain.collect())) != []


def test_words_of_a_frame_are_looked_up_in_documents_that_hold_the_rarest_ones(spark, monkeypatch):
    texts = spark.createDataFrame([(f"d{n}", "the moss", f"the of rare{n % 40} odd{n % 30} the") for n in range(120)], "id string, title string, body string")
    queries = {"few": "the of rare7 odd7", "prefix": "th rare1", "phrase": 'x "of', "quoted": '"of rare3"', "none": "the absent"}
    frame, frequency, asked = spark.createDataFrame(list(queries.items()), "query_id string, text string"), S.word_frequency, []
    stored = store_index(texts, WEIGHTS, scratch_path(spark, "rare"))
    merged = update_index(stored, texts.filter("id = 'd1'").withColumn("body", F.lit("the of rare7 odd7")), texts.filter("id = 'd10'"))
    for index in (stored, merged):
        literal = sorted(map(tuple, S.rank_matches(index, queries).collect()))
        with monkeypatch.context() as patched:
            patched.setattr(S, "word_frequency", lambda i, request: asked.append(request) or frequency(i, request))
            assert sorted(map(tuple, S.rank_matches(index, frame).collect())) == literal != []
        assert asked[-1].entries.select("doc_id").distinct().count() <= 40
