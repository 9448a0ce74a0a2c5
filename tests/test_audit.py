import json
import random
import time

import pytest
from pyspark.sql import functions as F

from boardlake.operators.audit import parity_diff, redaction_audit, secret_scan
from boardlake.operators.projection import project_records
from boardlake.operators.redaction import is_secret_key, redact_columns, redact_json, redact_text
from boardlake.plans.sql import ReadOnlyError, run_sql
from boardlake.schemas import REDACTED, WITHHELD_KEYS
from boardlake.session import scratch_path
from boardlake.operators.index import build_index, store_index
from boardlake.streaming.feeds import index_log_schema, merge_index, merge_newest, read_log, stream_index, stream_upsert


def leaves(value, key=None):
    """(key, value) pairs that a clean document must not show."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield k, v
            yield from leaves(v)
    elif isinstance(value, list):
        for v in value:
            yield from leaves(v)


def random_json(rng, depth=0):
    kind = rng.random()
    if depth < 6 and kind < 0.35:
        keys = ["a", "apiKey", "API_KEY", "x-api-key", "tokenName", "myToken", "Cookie", "note", "hasCredential", "credentials", "env", "workspaces", "é"]
        return {rng.choice(keys): random_json(rng, depth + 1) for _ in range(rng.randint(0, 5))}
    if depth < 6 and kind < 0.5:
        return [random_json(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return rng.choice([None, True, 3, 2.5, "text", "say \"token\": 1", "ß\n"])


def test_random_documents_hold_no_secret(spark):
    rng = random.Random(3)
    documents = [random_json(rng) for _ in range(400)]
    frame = spark.createDataFrame([(json.dumps(d, ensure_ascii=rng.random() < 0.5),) for d in documents], "raw string")
    for before, row in zip(documents, frame.select(redact_json(F.col("raw"), "projects").alias("raw")).collect()):
        after = json.loads(row.raw)
        for key, value in leaves(after):
            assert not is_secret_key(key) or value in (None, REDACTED)
        if isinstance(before, dict):
            for key in set(before) & set(WITHHELD_KEYS["projects"]):
                assert after[key] == REDACTED
            assert list(after) == list(before)


def test_texts_left_in_the_jvm_are_those_the_text_form_leaves(spark):
    rng = random.Random(8)
    hidden = ['[{"token":1},5]', '[[{"a":{"secret":1}}],{"b":2}]', '{"a":[{"k":1},{"k":{"cookie":"x"}}]}', '[{"apiKey":1},null]', '{"`token`":1}', '{"a b":{"x: token<":1}}', '{"secret":1,"secret":null}', '{"env":1}', '{"environment":{"env":2}}', '"token"', "null", "", " ", "{", '{"a":NaN}', '{"tok\\u0065n":"x"}', '{"a":"\\ud800"}', "[" * 32 + "1" + "]" * 32, "[" * 33 + "1" + "]" * 33, '{"a":1e400}', '{"n":123456789012345678901234567890123456789012}']
    texts = hidden + [json.dumps(random_json(rng), ensure_ascii=rng.random() < 0.5) for _ in range(500)]
    withheld = frozenset(WITHHELD_KEYS["projects"])
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "raw string").coalesce(1)
    found = [r.clean for r in frame.select(redact_json(F.col("raw"), "projects").alias("clean")).collect()]
    assert found == [redact_text(t, withheld) for t in texts] + [None]


def test_projection_redacts_and_parses_each_text_once(spark):
    records = spark.createDataFrame([('{"id":"a","companyId":"c","apiToken":"x"}',)], "raw string")
    rows = project_records(records, "issues", "2031-05-01T00:00:00.000Z")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert [plan.count(x) for x in ("ArrowEvalPython", "parseJson", "from_json(", "RLIKE(")] == [1, 1, 1, 1]
    assert [json.loads(r.raw_json) for r in rows.collect()] == [{"id": "a", "companyId": "c", "apiToken": REDACTED}]


def test_redaction_details():
    none = frozenset()
    assert json.loads(redact_text('{"Authorization":{"a":1},"token":null,"tokenId":"x","body":"my password is 1"}', none)) == {
        "Authorization": REDACTED, "token": None, "tokenId": "x", "body": "my password is 1"
    }
    assert json.loads(redact_text('{"metadata":null}', frozenset(["metadata"]))) == {"metadata": REDACTED}
    assert json.loads(redact_text('{"tok\\u0065n":"x"}', none)) == {"token": REDACTED}
    deep = "[" * 40 + "1" + "]" * 40
    assert REDACTED in redact_text(deep, none) and "1" not in redact_text(deep, none).replace(REDACTED, "")
    assert redact_text("[" * 33 + "1" + "]" * 33, none).count("[") == 33 + 1  # depth 33 is one too many
    assert json.loads(redact_text("{broken token", none)) == REDACTED
    assert redact_text(None, none) is None


def test_typed_redaction_equals_the_text_form(spark):
    frame = spark.createDataFrame(
        [(1, {"Api-Key": "x", "k": "v", "cookie": None}, [("a", "s")], ("in", 5)), (2, None, None, None)],
        "id int, attrs map<string,string>, items array<struct<note:string,secretValue:string>>, env struct<a:string,tokenCount:int>",
    )
    options = {"ignoreNullFields": "false"}
    text = frame.select(redact_json(F.to_json(F.struct(*frame.columns), options), "projects").alias("raw")).collect()
    clean = redact_columns(frame, "projects")
    typed = clean.select(F.to_json(F.struct(*clean.columns), options).alias("raw")).collect()
    assert [json.loads(r.raw) for r in typed] == [json.loads(r.raw) for r in text]


def test_audits(spark):
    agents = spark.createDataFrame([('{"adapterConfig":{"a":1}}',), ('{"adapterConfig":"[redacted]"}',), ('{"id":"x"}',)], "raw_json string")
    assert redaction_audit({"agents": agents}).collect()[0].unredacted == 1
    meta = spark.createDataFrame([("tok_ABCDEFGHIJKL in text",), ("tok-ABCDEFGHIJKL",), (None,)], "value string")
    scan = secret_scan({"meta": (meta, "value")}, ["TOK_abcdefghijkl", "short", "TOK_abcdefghijkl"]).collect()
    assert [(r.table, r.leaks) for r in scan] == [("meta", 1)]
    assert secret_scan({"meta": (meta, "value")}, ["short"]).count() == 0


def test_parity(spark):
    mirror = spark.createDataFrame([("a", "t", None), ("b", "t", "x"), ("c", None, None)], "id string, title string, status string")
    live = spark.createDataFrame([("a", "t", None), ("b", "u", None), ("d", "t", None)], "id string, title string, status string")
    rows = parity_diff(mirror, live, ["id", "title", "status"]).collect()
    assert sorted((r.id, r.field, r.mirror, r.live) for r in rows if r.id == "b") == [("b", "status", "x", None), ("b", "title", "t", "u")]
    assert {(r.id, r.field, r.mirror, r.live) for r in rows if r.id in "cd"} == {("c", "id", "c", None), ("d", "id", None, "d")}


@pytest.fixture
def cards(spark):
    rows = [(7, "open", 3.5), (8, "closed", None), (9, "open", 0.5)]
    frame = spark.createDataFrame(rows, "card bigint, lane string, hours double")
    frame.createOrReplaceTempView("cards")
    return frame


PROGRAMS = [
    "select transform(card) using 'cat' as (x string) from cards",
    "select * from (select transform(card) using 'cat' as (x string) from cards) t",
    "select lane from cards where exists (select transform(card) using 'cat' as (x string) from cards)",
    "with t as (from cards map card using 'cat' as x) select * from t",
]
CALLS = [
    "select reflect('java.lang.System', 'currentTimeMillis')",
    "select lane from cards where hours > (select max(length(java_method('java.util.UUID', 'randomUUID'))) from cards)",
    "select `try_reflect`('java.lang.System', 'nanoTime') from cards",
    "select max(concat('x', reflect('java.lang.System', 'nanoTime'))) over (partition by lane) from cards",
]
PATHS = ["select * from text.`/etc`", "select lane from cards where lane in (select value from text.`/etc`)", "with p as (select * from parquet.`/x`) select * from p", "select * from unknown_table"]
CHANGES = [
    "truncate table cards", "create or replace temporary view other as select 1", "refresh table cards", "use other",
    "explain analyze table cards compute statistics", "with c as (select 7) insert into cards select * from c", "reset", "   ",
    "from cards insert overwrite directory '/tmp/out' using csv select lane", "merge into cards using cards c on true when matched then delete",
]


@pytest.mark.parametrize("text", PROGRAMS + CALLS + PATHS + CHANGES)
def test_sql_refuses(spark, cards, text):
    with pytest.raises(ReadOnlyError):
        run_sql(spark, text)


def test_sql_answers(spark, cards):
    assert [r.card for r in run_sql(spark, "SELECT card FROM cards WHERE lane = 'open' ORDER BY hours").collect()] == [9, 7]
    nested = "with a as (select lane, sum(hours) as h from cards group by lane), b as (select * from a) select count(*) as n from b where h > 1"
    assert run_sql(spark, nested).collect()[0].n == 1
    assert run_sql(spark, "select * from cards c where hours = (select max(hours) from cards where lane = c.lane)").count() == 1
    assert "Filter" in run_sql(spark, "explain select card from cards where hours > 1").collect()[0].plan
    assert run_sql(spark, "values (1), (2)").count() == 2 and run_sql(spark, "select 'reflect', explode(array(1, 2))").count() == 2
    assert [r.col_name for r in run_sql(spark, 'PRAGMA table_info("cards");').collect()] == ["card", "lane", "hours"]
    assert "cards" in [r.tableName for r in run_sql(spark, "pragma table_list").collect()]


def test_stream_equals_batch_and_late_rows_do_not_win(spark):
    rows = [(f"k{n % 7}", f"v{n}", f"2026-01-01T00:{(n * 37) % 60:02d}:00.000Z") for n in range(60)]
    changes = spark.createDataFrame(rows, "id string, v string, updated_at string")
    stored = spark.createDataFrame([("k0", "kept", "2027"), ("k1", "old", "2020"), ("z", "alone", "2020")], changes.schema)
    path, log = scratch_path(spark, "t-changes"), scratch_path(spark, "t-log")
    changes.repartition(5).write.parquet(path)
    progress = scratch_path(spark, "t-progress")
    for _ in range(2):  # a second run finds nothing new
        source = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 2).parquet(path)
        stream_upsert(source, log, progress, ["id"], ["updated_at", "v"]).awaitTermination()
    logged = read_log(spark, log, changes.schema)
    assert logged.select("batch").distinct().count() == 3
    streamed = merge_newest(stored, logged.drop("batch"), ["id"], ["updated_at", "v"])
    batch = merge_newest(stored, changes, ["id"], ["updated_at", "v"])
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert {r.id: r.v for r in streamed.collect()}["k0"] == "kept"


def test_index_log_keeps_the_newest_text_and_drops_deleted_documents(spark):
    schema = "id string, body string, updated_at string, dead boolean"
    base = build_index(spark.createDataFrame([("a", "old moss", "1", False), ("b", "fern", "1", False), ("c", "reed", "1", False)], schema), {"body": 1.0})
    feed, log = scratch_path(spark, "t-feed"), scratch_path(spark, "t-tokens")
    for row in (("a", "new moss", "5", False), ("a", "draft", "3", False), ("b", None, "4", True), ("d", "sedge", "2", None)):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(feed)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
    stream_index(source, log, scratch_path(spark, "t-at"), ["body"], ["updated_at"], deleted="dead").awaitTermination()
    merged = merge_index(base, read_log(spark, log, index_log_schema(base)))
    assert sorted((r.doc_id, r.token) for r in merged.postings.collect()) == [("a", "moss"), ("a", "new"), ("c", "reed"), ("d", "sedge")]


def test_index_log_and_its_counts_leave_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return {name for name in files.split() if "/shuffle_" in name}

    schema = "id string, body string, updated_at string, dead boolean"
    base = store_index(spark.createDataFrame([(f"k{n}", f"moss w{n}", "1", False) for n in range(40)] + [("k3", "moss", "1", False), (None, "reed", "1", False)], schema), {"body": 1.0}, scratch_path(spark, "t-base"))
    feed, log = scratch_path(spark, "t-feed"), scratch_path(spark, "t-tokens")
    changed = [(f"k{n}", "fern" if n % 2 else None, "2", n % 5 == 0) for n in range(20)] + [("z", "fern  reed", "2", None), (None, "lost", "2", False)]
    for stamp in ("2", "1"):
        rows = spark.createDataFrame(changed, schema).withColumn("updated_at", F.lit(stamp))
        (rows if stamp == "2" else rows.withColumn("body", F.lit("draft"))).coalesce(1).write.mode("append").parquet(feed)
    before = shuffled()
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
    stream_index(source, log, scratch_path(spark, "t-at"), ["body"], ["updated_at"], deleted="dead").awaitTermination()
    merged = merge_index(base, read_log(spark, log, index_log_schema(base)))
    terms = merged.terms
    for _ in range(100):  # they are removed beside the jobs
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left
    per_doc = merged.postings.groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("hits"))
    expected = per_doc.groupBy("token").agg(F.count(F.lit(1)).alias("docs"), F.sum("hits").alias("hits"))
    assert sorted(map(tuple, terms.collect())) == sorted(map(tuple, expected.collect()))
    assert {r.token: (r.docs, r.hits) for r in terms.collect() if not r.token.startswith("w")} == {"moss": (20, 20), "fern": (9, 9), "reed": (2, 2)}


def test_plans_do_not_show_credentials(spark, capsys):
    rows = spark.createDataFrame([("the Quince-Key-0042 here",), ("none",)], "raw string")
    found = secret_scan({"notes": (rows, F.col("raw"))}, ["quince-key-0042", "absent-key-77"])
    assert sorted(map(tuple, found.collect())) == [("notes", 0, 0), ("notes", 1, 1)]
    found.explain(True)
    assert "quince" not in capsys.readouterr().out.lower()
