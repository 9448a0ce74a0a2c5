"""Search against SQLite's full-text index in memory, as an independent implementation."""

import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from boardlake.operators import search as S
from boardlake.operators.index import COMMENT_TEXT, ISSUE_TEXT, build_index, fold_index, index_stats, store_index, update_index
from boardlake.session import scratch_path

WORDS = "sync lock ledger Élan export bank re-sync naïve the a of issue lockstep Blocked 12 x_y".split()
QUERIES = {
    "word": "ledger", "two": "sync lock", "ident": "CCS-1", "phrase": '"sync lock"', "common": "the", "accent": "elan naive",
    "operators": "a OR b NOT c", "dash": "- lock", "short": "l", "overlap": '"the the"', "none": "zzz", "only dash": "-", "empty": "  ", "quote": '"',
}


def fts_text(text: str) -> str:
    """The match expression SQLite gets for a user query."""
    text = text.strip()
    if not text:
        return '""'
    if len(text) > 1 and text[0] == text[-1] == '"':
        return '"' + text[1:-1].replace('"', '""') + '"'
    return " ".join(f'"{w}"*' for w in (t.replace('"', "") for t in text.split()) if w)


def corpus(seed: int, size: int):
    rng = random.Random(seed)

    def prose(longest):
        words = [rng.choice(WORDS) for _ in range(rng.randint(0, longest))]
        return "".join(w + rng.choice([" ", " ", ", ", ". ", ": ", "\n", ".\n"]) for w in words)

    return [(f"d{n:03d}", f"CCS-{n}", prose(6), None if n % 11 == 0 else prose(90)) for n in range(size)]


@pytest.fixture(scope="module")
def both(spark):
    rows = corpus(7, 120)
    issues = spark.createDataFrame(rows, "id string, identifier string, title string, description string").withColumns(
        {"company_id": F.lit("co"), "status": F.when(F.col("id") < "d060", "todo").otherwise("done"), "updated_at": F.lit("u")}
    )
    index = store_index(issues, ISSUE_TEXT, scratch_path(spark, "test-index"))
    lite = sqlite3.connect(":memory:")
    lite.execute("CREATE VIRTUAL TABLE t USING fts5(id UNINDEXED, identifier, title, description, tokenize='unicode61 remove_diacritics 2')")
    lite.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", rows)
    return issues, index, lite


def lite_hits(lite, query):
    text = fts_text(query)
    if not text:
        return {}
    sql = "SELECT id, bm25(t, 0, 5.0, 3.0, 1.0), snippet(t, 3, '[', ']', '…', 18) FROM t WHERE t MATCH ?"
    return {r[0]: (r[1], r[2]) for r in lite.execute(sql, (text,))}


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_ranks_and_snippets(both, name):
    issues, index, lite = both
    expected = lite_hits(lite, QUERIES[name])
    hits = S.search_issues(index, issues, QUERIES[name], limit=1000).collect()
    assert {h.issue_id for h in hits} == set(expected)
    for hit in hits:
        rank, snippet = expected[hit.issue_id]
        assert hit["rank"] == pytest.approx(rank, abs=2e-9)
        assert hit.snippet == snippet, (QUERIES[name], hit.issue_id)
    scanned = {r.doc_id for r in S.scan_matches(issues, ISSUE_TEXT, QUERIES[name]).collect()}
    assert scanned == set(expected)


def test_many_queries_in_one_job_equal_single_ones(both, spark):
    issues, index, _ = both
    frame = spark.createDataFrame(list(QUERIES.items()), "query_id string, text string")
    together = {(r.query_id, r.doc_id, r["rank"]) for r in S.rank_matches(index, frame).collect()}
    literal = {(r.query_id, r.doc_id, r["rank"]) for r in S.rank_matches(index, QUERIES).collect()}
    assert together == literal


def test_filters_and_limits(both):
    issues, index, _ = both
    every = S.search_issues(index, issues, "the", limit=1000).collect()
    todo = S.search_issues(index, issues, "the", status=["todo"], limit=1000).collect()
    assert {h.issue_id for h in todo} == {h.issue_id for h in every if h.status == "todo"}
    assert {h["rank"] for h in todo} <= {h["rank"] for h in every}
    assert S.search_issues(index, issues, "the", company_id="none").count() == 0
    assert S.search_issues(index, issues, "the").count() == 25
    assert S.search_issues(index, issues, "the", limit=-3).count() == 1
    best = S.search_issues(index, issues, "the", limit=5).collect()
    assert sorted(h["rank"] for h in best) == sorted(h["rank"] for h in every)[:5]


def test_user_query_words(spark):
    def words(text):
        frame = spark.createDataFrame([("q", text)], "query_id string, text string")
        return [(list(r.terms), r.is_prefix) for r in S.query_words(frame).orderBy("word_no").collect()]

    assert words("ORD-7b") == [(["ord", "7b"], True)] and words("pallet  jam") == [(["pallet"], True), (["jam"], True)]
    assert words('"fork lift"') == [(["fork", "lift"], False)]
    assert words("NOT x AND y") == [([w], True) for w in ("not", "x", "and", "y")]
    assert words("\t") == [] and words(' "" ') == [] and words('"') == []
    assert words('say "hi there') == [(["say"], True), (["hi"], True), (["there"], True)]


def test_index_follows_changes_and_comments_join(spark):
    schema = "id string, company_id string, identifier string, status string, title string, description string, updated_at string"
    stock = [("k9", "north", "ORD-40", "todo", "Pallet wrapper jams", "belt slips after rain", "2"), ("k2", "north", "ORD-41", "done", "Forklift charger", None, "1"), ("k5", "south", "ORD-7", "todo", "Charger cable frayed", "see pallet bay", "3")]
    notes = [("n1", "k2", "swap the fuse of bay four", "5"), ("n2", "nowhere", "fuse of a vanished order", "6"), ("n3", "k9", "no answer yet", "7")]
    issues = spark.createDataFrame(stock, schema)
    comments = spark.createDataFrame(notes, "id string, issue_id string, body string, created_at string")
    index, threads = build_index(issues, ISSUE_TEXT), build_index(comments, COMMENT_TEXT)

    def found(index, issues, text, **options):
        return {h.identifier for h in S.search_issues(index, issues, text, **options).collect()}

    assert found(index, issues, "charger") == {"ORD-41", "ORD-7"} and found(index, issues, "charger", status=["todo"]) == {"ORD-7"}
    assert found(index, issues, "pallet", company_id="north") == {"ORD-40"} and found(index, issues, "ord-40") == {"ORD-40"}
    fuse = S.search_all(index, threads, issues, comments, "fuse").collect()
    assert [(h.kind, h.comment_id, h.identifier) for h in fuse] == [("comment", "n1", "ORD-41")] and "[fuse]" in fuse[0].snippet

    # The wrapper's text changes, the cable's order is deleted.
    changed = spark.createDataFrame([("k9", "north", "ORD-40", "todo", "Wrapper film torn", None, "9")], schema)
    gone = issues.filter("id = 'k5'")
    now = issues.filter("id = 'k2'").unionByName(changed)
    updated = update_index(index, changed, gone)
    assert found(updated, now, "pallet") == set() and found(updated, now, "film") == {"ORD-40"} and found(updated, now, "charger") == {"ORD-41"}
    rebuilt = build_index(now, ISSUE_TEXT)
    assert sorted(map(tuple, updated.postings.collect())) == sorted(map(tuple, rebuilt.postings.collect()))

    folded = fold_index(updated, scratch_path(spark, "test-folded"))
    assert folded.totals is not None and index_stats(folded).collect() == index_stats(rebuilt).collect()
    assert sorted(map(tuple, folded.postings.collect())) == sorted(map(tuple, rebuilt.postings.collect()))
    assert found(folded, now, "film") == {"ORD-40"} and found(folded, now, "pallet") == set()


def test_empty_index_is_stored_and_searched(spark):
    schema = "id string, company_id string, identifier string, status string, title string, description string, updated_at string"
    issues = spark.createDataFrame([], schema)
    index = store_index(issues, ISSUE_TEXT, scratch_path(spark, "test-none"))
    assert index_stats(index).collect() == [(0, 0, None)]
    assert S.search_issues(index, issues, "anything").collect() == []
