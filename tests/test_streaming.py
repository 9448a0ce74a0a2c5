"""Streams that die and go on, folds that die and are done again, and what readers see meanwhile."""

import pytest
from pyspark.sql import functions as F

from boardlake.operators.rollups import freshness_of_commits
from boardlake.streaming import feeds
from boardlake.streaming import log as logs

SCHEMA = "id string, company_id string, status string, updated_at string"
BATCHES = [
    [("a", "c1", "todo", "2024-01-01"), ("b", "c1", "done", "2024-01-01"), ("c", "c2", "blocked", "2024-01-01"), (None, "c2", "todo", "2024-01-01")],
    [("b", "c1", "in_progress", "2024-01-02"), ("a", "c1", "done", "2023-12-31"), ("d", "c2", "done", None)],
    [("c", "c2", "done", "2024-01-03"), ("c", "c2", "todo", "2024-01-02"), ("d", "c2", "done", None)],
    [],
]
# (batch, id, reason, read before): issue a stays active although an older row says otherwise, b was closed and is open, c is closed at last.
WANTED = [
    (0, "a", "changed", None), (0, "b", "changed", None), (0, "c", "changed", None),
    (1, "a", "active", 0), (1, "b", "changed", 0), (1, "c", "active", 0), (1, "d", "changed", None),
    (2, "a", "active", 1), (2, "b", "active", 1), (2, "c", "changed", 1),
]


def feed(spark, path, start, batches=BATCHES):
    """Each batch lands and is taken by the stream before the next one lands."""
    for rows in batches:
        if rows:
            spark.createDataFrame(rows, SCHEMA).coalesce(2).write.mode("append").parquet(path)
        start(spark.readStream.schema(SCHEMA).parquet(path)).awaitTermination()


def candidates(spark, log):
    return sorted((r.batch, r.id, r.reason, r.read_before) for r in logs.read_log(spark, log, feeds.CANDIDATE).collect())


def test_candidates_of_each_batch(spark, tmp_path):
    log, progress = str(tmp_path / "log"), str(tmp_path / "progress")
    feed(spark, str(tmp_path / "rows"), lambda source: feeds.stream_candidates(source, log, progress))
    assert candidates(spark, log) == WANTED


def test_candidates_when_the_stream_dies_after_and_before_its_write(spark, tmp_path, monkeypatch):
    log, progress, rows = (str(tmp_path / n) for n in ("log", "progress", "rows"))
    write, died = logs.append_batch, []

    def dying(frame, path, batch_id):
        if (batch_id, "after") == (1, "after") and "after" not in died:
            write(frame, path, batch_id)
            died.append("after")
            raise RuntimeError("executor lost")
        if batch_id == 2 and "before" not in died:
            died.append("before")
            raise RuntimeError("executor lost")
        write(frame, path, batch_id)

    monkeypatch.setattr(logs, "append_batch", dying)

    class Started:
        """Starts the stream again after it died."""

        def __init__(self, source):
            self.source = source

        def awaitTermination(self):
            for _ in range(2):
                try:
                    return feeds.stream_candidates(self.source, log, progress).awaitTermination()
                except Exception as error:  # noqa: BLE001
                    assert "executor lost" in str(error)
            raise AssertionError("died twice in one batch")

    feed(spark, rows, Started)
    assert died == ["after", "before"]
    assert candidates(spark, log) == WANTED


def test_candidates_with_folds_and_a_longer_interval(spark, tmp_path):
    log, progress = str(tmp_path / "log"), str(tmp_path / "progress")
    start = lambda source: feeds.stream_candidates(source, log, progress, every=2, fold_every=1)
    feed(spark, str(tmp_path / "rows"), start, BATCHES[:3])
    # Issue a was read in batch 0 and is due again in batch 2.
    tail = [(1, "b", "changed", 0), (1, "d", "changed", None), (2, "a", "active", 0), (2, "c", "changed", 0)]
    assert logs.low_water_mark(spark, log) == 0 and candidates(spark, log) == WANTED[:3] + tail
    # A fold leaves the last read of each issue.
    assert logs.fold_log(spark, log, feeds.CANDIDATE, ["id"], []) == 1
    assert candidates(spark, log) == [(0, "a", "changed", None), (0, "c", "changed", None), *tail]


def logged(spark, log, batches):
    for n, rows in batches.items():
        logs.append_batch(spark.createDataFrame(rows, SCHEMA), log, n)


def newest(spark, log, schema):
    return sorted((r.id, r.status) for r in feeds.latest_per_key(logs.read_log(spark, log, schema), ["id"], ["updated_at", "batch"]).collect())


def test_fold_that_dies_leaves_the_log_and_is_done_again(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    schema = spark.createDataFrame([], SCHEMA).schema
    assert logs.read_log(spark, log, schema).collect() == [] and logs.fold_log(spark, log, schema, ["id"], ["updated_at"]) is None
    logged(spark, log, {0: [("a", "c", "one", "1")], 1: [("a", "c", "two", "2"), ("b", "c", "x", "1")], 2: [("a", "c", "late", "1"), ("b", "c", "y", "1")]})
    before = newest(spark, log, schema)
    assert before == [("a", "two"), ("b", "y")]
    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("died before the mark")))
        with pytest.raises(RuntimeError, match="before the mark"):
            logs.fold_log(spark, log, schema, ["id"], ["updated_at"])
    assert logs.low_water_mark(spark, log) == -1 and newest(spark, log, schema) == before
    assert logs.fold_log(spark, log, schema, ["id"], ["updated_at"]) == 1
    assert newest(spark, log, schema) == before
    # A frame planned now outlives one fold; the newest batch is never in the base.
    planned = logs.read_log(spark, log, schema)
    logged(spark, log, {3: [("c", "c", "z", "9")]})
    assert logs.fold_log(spark, log, schema, ["id"], ["updated_at"]) == 2 and logs.fold_log(spark, log, schema, ["id"], ["updated_at"]) is None
    assert len(planned.collect()) == 4
    assert newest(spark, log, schema) == [*before, ("c", "z")]
    assert logs.finished_batches(spark, log) == [2, 3]
    assert sorted((r.id, r.batch) for r in logs.read_log(spark, log, schema, below=3).collect()) == [("a", 1), ("b", 2)]


def test_half_written_batch_is_not_read(spark, tmp_path):
    log = tmp_path / "log"
    schema = spark.createDataFrame([], SCHEMA).schema
    logged(spark, str(log), {0: [("a", "c", "one", "1")], 1: [("b", "c", "two", "1")]})
    (log / "batch=1" / "_SUCCESS").unlink()
    assert newest(spark, str(log), schema) == [("a", "one")]


def test_ledger_of_commits(spark, tmp_path):
    log, progress, ledger = (str(tmp_path / n) for n in ("log", "progress", "ledger"))
    clock = lambda n: F.lit(f"2024-02-0{n + 1}T00:00:00.000Z")
    start = lambda source: feeds.stream_upsert(source, log, progress, ["id"], ["updated_at"], ledger=ledger, entity="issues", scope=["company_id"], clock=clock)
    feed(spark, str(tmp_path / "rows"), start, BATCHES[:2])
    feed(spark, str(tmp_path / "rows"), start, [[("z", "c2", "todo", "2024-01-09")]])
    entries = logs.read_log(spark, ledger, logs.ledger_schema(spark.createDataFrame([], "company_id string").schema))
    now = F.lit("2024-02-03T00:10:00Z").cast("timestamp")
    found = sorted((r.company_id, r.entity, r.rows, r.batch, r.last_commit, r.state) for r in freshness_of_commits(entries, ["company_id"], now).collect())
    assert found == [("c1", "issues", 4, 1, "24h ago", "stale"), ("c2", "issues", 4, 2, "10m ago", "current")]
