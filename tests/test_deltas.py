"""Tables written run by run, against a dictionary, and sync runs written as changes, against whole versions."""

import random

import pytest
from pyspark.sql import functions as F

import test_sync
from boardlake.functions.timing import instant
from boardlake.operators import upsert as U
from boardlake.schemas import ENTITIES
from boardlake.session import scratch_path
from boardlake.sources import deltas
from boardlake.sources.tables import TABLE_SCHEMAS, fold_mirror, read_mirror, read_tables, write_run
from test_sync import FARM, Board, job, note

SCHEMA = "id string, name string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], SCHEMA)


def stored(spark, root, **how):
    schema = spark.createDataFrame([], SCHEMA).schema
    return {r.id: (r.name, r.n) for r in deltas.read_keyed(spark, root, schema, **how).collect()}


def folded(spark, root, **how):
    return deltas.fold_changes(spark, root, spark.createDataFrame([], SCHEMA).schema, **how)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_runs_and_folds_give_what_a_dictionary_gives(spark, seed):
    dice, root, model = random.Random(seed), scratch_path(spark, "deltas"), {}
    versions = {}
    for run in range(9):
        rows = {f"k{dice.randrange(60):02d}": (dice.choice(["x", None]), run) for _ in range(dice.choice([0, 3, 20]))}
        gone = [f"k{dice.randrange(70):02d}" for _ in range(dice.choice([0, 2, 10]))]
        deltas.write_changes(root, f"run-{run}", frame(spark, rows), spark.createDataFrame([(k,) for k in gone], "id string"))
        model = {**{k: v for k, v in model.items() if k not in gone}, **rows}
        versions[f"run-{run}"] = dict(model)
        if dice.random() < 0.5:
            folded(spark, root, fan=2, share=dice.choice([0.0, 1e9]))
        assert stored(spark, root) == model
    assert stored(spark, root, upto="run-8") == model


def test_older_runs_can_be_read_until_they_are_folded(spark):
    root = scratch_path(spark, "deltas")
    for run, rows in {"run-1": {"a": ("x", 1), "b": ("y", 1)}, "run-2": {"a": ("z", 2)}}.items():
        deltas.write_changes(root, run, frame(spark, rows))
    assert stored(spark, root, upto="run-1") == {"a": ("x", 1), "b": ("y", 1)}
    with pytest.raises(ValueError, match="not after"):
        deltas.write_changes(root, "run-1", frame(spark, {}))
    # A run that is written again replaces its first try.
    deltas.write_changes(root, "run-2", frame(spark, {"b": ("again", 2)}))
    assert stored(spark, root) == {"a": ("x", 1), "b": ("again", 2)}


def test_cost_follows_the_change(spark):
    root = scratch_path(spark, "deltas")
    base = spark.range(200_000).select(F.format_string("k%08d", "id").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("name"), F.lit(0).alias("n"))
    first = deltas.write_changes(root, "run-1", base.repartition(8))
    assert len(first) > 1 and all(a.high < b.low for a, b in zip(sorted(first, key=lambda f: f.low), sorted(first, key=lambda f: f.low)[1:]))
    few = {f"k{i:08d}": ("new", 1) for i in range(100)}
    second = deltas.write_changes(root, "run-2", frame(spark, few), spark.createDataFrame([("k00000200",)], "id string"))
    assert sum(f.bytes for f in second) < 0.02 * sum(f.bytes for f in first) and sum(f.rows for f in second) == 101
    schema = base.schema
    # Only base files whose keys may have changed are checked against the changes, and only those are rewritten.
    plan = deltas.read_keyed(spark, root, schema)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftAnti") == 1
    met = deltas._met(first, second)
    assert len(met) == 1
    written = folded(spark, root, share=0.0)
    assert sum(f.bytes for f in written) < 1.2 * met[0].bytes
    files = deltas.live_files(spark, root, schema)
    assert {f.path for f in first} - {f.path for f in files} == {met[0].path} and all(f.base for f in files)
    assert deltas.read_keyed(spark, root, schema).filter("n = 1").count() == 100
    assert deltas.read_keyed(spark, root, schema).count() == 199_999


def test_runs_of_one_size_become_one_run(spark):
    root = scratch_path(spark, "deltas")
    deltas.write_changes(root, "run-0", frame(spark, {f"k{i:03d}": ("x" * 50, 0) for i in range(900)}))
    for run in range(1, 5):
        deltas.write_changes(root, f"run-{run}", frame(spark, {f"k{run:03d}": ("y", run)}), spark.createDataFrame([(f"k{run + 500:03d}",)], "id string"))
    written = folded(spark, root, share=1e9)
    assert [(f.run, f.base, f.rows, f.deletes) for f in written] == [("run-4", False, 8, 4)]
    rows = stored(spark, root)
    assert len(rows) == 896 and rows["k002"] == ("y", 2) and "k502" not in rows
    assert folded(spark, root, share=1e9) == []


def test_fold_that_dies_before_its_commit_changes_nothing(spark, monkeypatch):
    root = scratch_path(spark, "deltas")
    for run, rows in {"run-1": {"a": ("x", 1)}, "run-2": {"b": ("y", 2)}}.items():
        deltas.write_changes(root, run, frame(spark, rows))
    with monkeypatch.context() as patched:
        patched.setattr(deltas, "_commits", lambda *a: (_ for _ in ()).throw(RuntimeError("died")) if died.append(1) or len(died) > 2 else real(*a))
        died, real = [], lambda s, r: ["00000000-run-1", "00000001-run-2"]
        with pytest.raises(RuntimeError, match="died"):
            folded(spark, root, share=0.0)
    assert stored(spark, root) == {"a": ("x", 1), "b": ("y", 2)}
    assert folded(spark, root, share=0.0) and stored(spark, root) == {"a": ("x", 1), "b": ("y", 2)}


def rows_of(tables):
    return {e: sorted(map(tuple, tables[e].select(*TABLE_SCHEMAS[e].names).collect()), key=str) for e in [*ENTITIES, "sync_state", "meta", "sync_runs"]}


def test_sync_runs_as_changes_equal_whole_versions(spark, monkeypatch):
    board = Board(spark)
    root, whole = scratch_path(spark, "mirror"), test_sync.write_version

    def both(path, version, tables):
        whole(path, version, tables)
        runs.append(version)

    runs: list[str] = []
    monkeypatch.setattr(test_sync, "write_version", both)
    board.upstream |= {"issues": [[job("prune", 2), job("graft", 3, status="in_review"), job("mow", 1)]], "agents": [[{"id": "robot", "companyId": FARM, "name": "Robot"}, {"id": "hand", "companyId": FARM, "name": "Hand"}]]}
    board.sync({"prune": [[note("prune", "n1"), note("prune", "n2")]], "graft": [[note("graft", "n3")]], "mow": [[note("mow", "n4")]]})
    write_run(root, runs[-1], board.done)
    assert rows_of(read_mirror(spark, root)) == rows_of(read_tables(spark, board.root))
    # One issue vanishes, a thread shrinks, an agent leaves, another is renamed.
    board.upstream |= {"issues": [[job("prune", 5), job("graft", 3, status="in_review")]], "agents": [[{"id": "hand", "companyId": FARM, "name": "New hand"}]]}
    board.sync({"prune": [[note("prune", "n2", "again")]], "graft": [[note("graft", "n3")]]}, full=True)
    write_run(root, runs[-1], board.done)
    assert rows_of(read_mirror(spark, root)) == rows_of(read_tables(spark, board.root))
    fold_mirror(spark, root)
    board.upstream |= {"issues": [[job("prune", 6)]]}
    board.sync({"prune": [[note("prune", "n5")]], "graft": [[]]})
    write_run(root, runs[-1], board.done)
    assert rows_of(read_mirror(spark, root)) == rows_of(read_tables(spark, board.root))


def test_fresh_targets_are_skipped(spark):
    board = Board(spark)
    targets = ((0, "field", "https://farm.example", FARM), (1, "barn", "https://farm.example", "barn"))
    barn = [r for e in test_sync.ENTITIES for r in test_sync.pages(e, [{"id": "barn", "name": "Barn"}] if e == "companies" else [[]], company="barn", profile="barn")]
    results, _ = board.sync(targets=targets[:1])
    assert set(results) == {FARM}
    before = rows_of(read_tables(spark, board.root))
    # A day later: the first target is fresh, the second was never read. Of the whole mirror that makes a fresh one.
    results, _ = board.sync(targets=targets, extra=barn, skip_younger_than="2d")
    assert results == {} and rows_of(board.done.tables) == before
    results, _ = board.sync(targets=targets, extra=barn, skip_younger_than="3d", by_target=True)
    assert set(results) == {"barn"}
    after = rows_of(read_tables(spark, board.root))
    assert [r for r in after["sync_state"] if r[1] == FARM] == before["sync_state"] and len(after["sync_runs"]) == 2
    results, _ = board.sync(targets=targets, extra=barn, skip_younger_than="1h", by_target=True)
    assert set(results) == {FARM, "barn"}


def test_state_without_a_good_step_is_never_fresh(spark):
    state = spark.createDataFrame([("p", "c", "issues", "x", "error", "2031-06-01T00:00:00.000Z")], "profile string, company_id string, entity string, cursor string, last_status string, last_sync_at string")
    targets = spark.createDataFrame([("p", "c"), ("q", "d")], "profile string, company_id string")
    for by_target in (False, True):
        plan = U.plan_sync(targets, state, skip_younger_than="9999d", now=instant(F.lit("2031-06-01T00:00:00.000Z")), by_target=by_target)
        assert [r.skipped for r in plan.collect()] == [False, False]
