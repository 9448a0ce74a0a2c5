import json

import pytest
from pyspark.sql import functions as F

from boardlake.functions import text as X
from boardlake.functions.timing import duration_ms, instant, relative_time
from boardlake.operators import reads
from boardlake.operators.grouping import latest_per_key, with_positions
from boardlake.operators.rollups import max_stamp, run_rollup

ISSUES = "id string, company_id string, identifier string, status string, title string, description string, assignee_agent_id string, updated_at string"


@pytest.fixture(scope="module")
def board(spark):
    issues = spark.createDataFrame(
        [
            ("i1", "co", "TST-1", "done", "Issue 1 ledger", "Body 1", None, "2026-01-01T00:01:00.000Z"),
            ("i2", "co", "TST-2", "in_progress", "Issue 2 ledger", "50% of a\\b", "agent-1", "2026-01-01T00:02:00.000Z"),
            ("i3", "other", "TST-3", "todo", "Issue 3 ledger", None, "gone-agent-7", None),
        ],
        ISSUES,
    )
    agents = spark.createDataFrame([("agent-1", "Ops")], "id string, name string")
    comments = spark.createDataFrame(
        [("c2", "i2", "agent-1", "comment 2", "2026-01-02T00:02:00.000Z"), ("c1", "i2", None, "comment 1", "2026-01-02T00:01:00.000Z"), ("c0", "i2", None, "undated", None)],
        "id string, issue_id string, author_agent_id string, body string, created_at string",
    )
    return issues, agents, comments


def idents(frame):
    return [r.identifier for r in frame.collect()]


def test_list_filters_order_and_limit(board):
    issues, agents, _ = board
    assert idents(reads.list_issues(issues, agents)) == ["TST-2", "TST-1", "TST-3"]
    assert idents(reads.list_issues(issues, agents, company_id="co")) == ["TST-2", "TST-1"]
    assert idents(reads.list_issues(issues, agents, status=["in_progress"])) == ["TST-2"]
    assert idents(reads.list_issues(issues, agents, status=[])) == ["TST-2", "TST-1", "TST-3"]
    assert idents(reads.list_issues(issues, agents, assignee_agent_id="agent-1")) == ["TST-2"]
    assert idents(reads.list_issues(issues, agents, match="ISSUE 3")) == ["TST-3"]
    assert idents(reads.list_issues(issues, agents, match="A\\B")) == ["TST-2"]
    assert idents(reads.list_issues(issues, agents, match="tst_1")) == ["TST-1"]
    assert idents(reads.list_issues(issues, agents, limit=1)) == ["TST-2"]
    assert len(idents(reads.list_issues(issues, agents, limit=0))) == 3
    assert len(idents(reads.list_issues(issues, agents, limit=-4))) == 1
    assert len(idents(reads.list_issues(issues, agents, limit=float("nan")))) == 3


def test_labels(board):
    issues, agents, _ = board
    rows = reads.with_assignee_label(reads.list_issues(issues, agents)).collect()
    assert {r.id: r.assignee for r in rows} == {"i1": "", "i2": "Ops", "i3": "gone-age"}


def test_get_by_identifier_in_any_case_and_scope(board):
    issues, agents, _ = board
    full = issues.withColumn("raw_json", F.lit("{}"))
    assert idents(reads.get_issue(full, agents, " tst-2 ")) == ["TST-2"]
    assert idents(reads.get_issue(full, agents, "i1")) == ["TST-1"]
    assert idents(reads.get_issue(full, agents, "TST-3", "co")) == []


def test_thread_order_and_document(board):
    issues, agents, comments = board
    thread = reads.read_thread(comments, agents).collect()
    assert [r.body for r in thread] == ["undated", "comment 1", "comment 2"]
    assert [r.author for r in thread] == ["?", "?", "Ops"]
    raw = issues.withColumn("raw_json", F.lit('{"id":"x","comments":"upstream","n":null}')).withColumn("synced_at", F.lit("s"))
    document = json.loads(reads.issue_document(raw, comments, agents, "TST-2").collect()[0].document)
    assert [c["body"] for c in document["comments"]] == ["undated", "comment 1", "comment 2"]
    assert document["_mirror"] == {"synced_at": "s", "comments_synced_at": None}
    assert document["n"] is None and document["id"] == "x"
    empty = json.loads(reads.issue_document(raw, comments, agents, "TST-1").collect()[0].document)
    assert empty["comments"] == []


def test_positions_do_not_depend_on_the_parts(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"), F.when(F.col("id") % 11 > 0, F.hash("id") % 200).alias("h"), "id")
    order = [F.col("h").asc_nulls_first(), F.col("id").asc()]
    expected, groups = [], {}
    for r in rows.collect():
        groups.setdefault(r.g, []).append((r.h is not None, r.h or 0, r.id))
    for g, members in groups.items():
        expected += [(g, i, place) for place, (_, _, i) in enumerate(sorted(members))]
    for part in (F.floor(F.col("h") / 10), F.lit(1), F.col("h")):
        got = with_positions(rows, ["g"], order, part).select("g", "id", "position").collect()
        assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_document_pages_of_hot_issue(board, spark):
    issues, agents, _ = board
    many = spark.range(1201).select(
        F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("id"), F.lit("i1").alias("issue_id"),
        F.lit(None).cast("string").alias("author_agent_id"), F.col("id").cast("string").alias("body"), F.lit("2026").alias("created_at"),
    )
    pages = reads.issue_documents(issues, many, agents).filter("issue_id = 'i1'").orderBy("page").collect()
    assert [r.n_comments for r in pages] == [500, 500, 201]
    bodies = [c["body"] for r in pages for c in json.loads(r.document)["comments"]]
    assert bodies == [str(n) for n in range(1201)]
    assert all("_mirror" in json.loads(r.document) for r in pages)


def test_latest_per_key(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), ("b", 1, "z")], "k string, n int, v string")
    assert sorted(map(tuple, latest_per_key(rows, ["k"], ["n"]).collect())) == [("a", 3, None), ("b", 1, "z")]
    assert sorted(map(tuple, latest_per_key(rows, ["k"], ["n"], first=True).collect())) == [("a", 1, "x"), ("b", 1, "z")]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


def test_scalars(spark):
    now = instant(F.lit("2026-01-03T00:00:00.000Z"))
    ages = {
        None: "never", "": "never", "soon": "soon", "2026-01-02T23:59:30.500Z": "30s ago", "2026-01-02T23:59:00.400Z": "1m ago",
        "2026-01-02T23:00:29.000Z": "1h ago", "2026-01-01T00:30:00.000Z": "2d ago", "2026-01-01T00:31:00.000Z": "47h ago", "2027-01-01T00:00:00Z": "0s ago",
    }
    for stamp, age in ages.items():
        assert one(spark, relative_time(F.lit(stamp).cast("string"), now)) == age, stamp
    durations = {"5m": 300_000, "2h": 7_200_000, "90s": 90_000, "1d": 86_400_000, "250ms": 250, " 7 ": 7000, "5 m": 300_000, "5w": None, "m": None, "": None}
    for text, ms in durations.items():
        assert one(spark, duration_ms(F.lit(text))) == ms, text
    assert one(spark, X.csv_split(F.lit(" a, b ,,c\t"))) == ["a", "b", "c"]
    assert one(spark, X.truncate(F.lit("  a \n b  "), 5)) == "a b"
    assert one(spark, X.truncate(F.lit("abcdef"), 5)) == "abcd…"
    assert one(spark, X.truncate(F.lit(None).cast("string"), 5)) == ""
    assert one(spark, X.strip_slashes(F.lit(" https://x.example/a// "))) == "https://x.example/a"
    assert one(spark, X.label(F.lit("sync runs"))) == "Sync runs"
    assert one(spark, X.tokenize(F.lit("Élan_vital CCS-12, ½ naïve"))) == ["elan", "vital", "ccs", "12", "½", "naive"]
    assert one(spark, X.tokenize(F.lit(None).cast("string"))) == []


def test_run_stamps_strictly_increase(spark):
    stored = spark.createDataFrame([("2026-01-01T00:00:00.005Z",)], "synced_at string")
    empty = spark.createDataFrame([], "synced_at string")

    def stamp(tables, now):
        return max_stamp(tables, instant(F.lit(now))).collect()[0].run_stamp

    assert stamp([stored, empty], "2026-01-01T00:00:01.000Z") == "2026-01-01T00:00:01.000Z"
    assert stamp([stored, empty], "2026-01-01T00:00:00.005Z") == "2026-01-01T00:00:00.006Z"
    assert stamp([stored, empty], "2025-01-01T00:00:00.000Z") == "2026-01-01T00:00:00.006Z"
    assert stamp([empty], "2025-01-01T00:00:00.000Z") == "2025-01-01T00:00:00.000Z"


def test_stamps_ignore_the_session_time_zone(spark):
    stored = spark.createDataFrame([("2026-07-01T00:00:00.005Z",)], "synced_at string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = max_stamp([stored], instant(F.lit("2025-01-01T00:00:00.000Z"))).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.run_stamp == "2026-07-01T00:00:00.006Z"


@pytest.mark.parametrize(
    "statuses, expected",
    [([], "ok"), (["ok", "ok"], "ok"), (["ok", "error"], "partial"), (["partial"], "partial"), (["error", "error"], "error")],
)
def test_run_status(spark, statuses, expected):
    rows = spark.createDataFrame([(s,) for s in statuses], "status string")
    assert run_rollup(rows).collect()[0].status == expected
