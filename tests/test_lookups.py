"""Indexes and digests that save reading: each gives what the plain way gives, and reads what it should."""

import random

import pytest
from pyspark.sql import functions as F

from boardlake.operators import audit, trigrams
from boardlake.operators.reads import keep_if, matches_text
from boardlake.operators.upsert import detect_changes
from boardlake.session import scratch_path, staged
from boardlake.sources import deltas


@pytest.fixture(scope="module")
def texts(spark):
    dice = random.Random(2)
    letters = "abcé É\n.XY\U0001f642"
    rows = [(i, dice.choice([None, "", "ab", "".join(dice.choices(letters, k=dice.choice([3, 20, 300])))]), "".join(dice.choices(letters, k=12))) for i in range(400)]
    return staged(spark.createDataFrame(rows + [(900, "x" * 50_000 + "needle", None)], "id int, title string, body string"), "texts")


@pytest.mark.parametrize("pattern", ["ab", "abc", "ABCÉ", "a b", "É\n.", "needle", "xxxx", "absent", "a_c", "%", "b\\", "\U0001f642a\U0001f642", "", None])
def test_matches_are_those_of_the_scan(spark, texts, pattern):
    columns = ["title", "body"]
    index = trigrams.store_pieces(texts, columns, scratch_path(spark, "pieces"))
    want = sorted(r.id for r in keep_if(texts, matches_text(pattern, columns)).collect())
    if pattern:
        assert sorted(r.id for r in trigrams.match_indexed(index, texts, pattern, columns).collect()) == want
    if pattern == "needle":
        assert [r.key for r in trigrams.candidates(index, pattern).collect()] == [900]


def test_many_credentials_are_counted_like_few(spark):
    dice = random.Random(6)
    tokens = ["".join(dice.choices("abC1", k=dice.choice([7, 12, 16]))) for _ in range(1000)] + ["SAME-token-1", "same-TOKEN-1", "token-1-inner", "inner-of-it-xyz"]
    bodies = [dice.choice(tokens).swapcase() + " " + dice.choice(tokens) * 2 for _ in range(300)] + ["Same-Token-1-Inner-of-it-xyz", None, ""]
    rows = spark.createDataFrame([(b,) for b in bodies], "record string").repartition(3)
    tables = {"one": (rows, "record"), "two": (rows.limit(0), "record")}
    few, many = ({(r.table, r.token_no): r.leaks for r in scan(tables, tokens).collect()} for scan in (audit.secret_scan, audit.secret_scan_many))
    assert few == many and sum(many.values()) > 300
    plan = audit.secret_scan_many(tables, tokens)._jdf.queryExecution().toString()
    assert "same-token" not in plan.lower()
    assert audit.secret_scan_many(tables, ["short"]).count() == 0


def test_parity_by_digests(spark):
    dice = random.Random(3)
    live = {f"k{i}": (dice.choice(["a", "", None]), i % 5) for i in range(3000)}
    mirror = dict(live)
    for k in dice.sample(sorted(mirror), 6):
        mirror[k] = (dice.choice([v for v in ["a", "", None] if v != live[k][0]]), live[k][1])
    del mirror["k1"], live["k2"]
    mirror["new"] = ("a", 1)
    sides = [staged(spark.createDataFrame([(k, *v) for k, v in rows.items()], "id string, status string, n int"), "side") for rows in (mirror, live)]
    want = sorted(map(str, audit.parity_diff(*sides, ["status", "n"]).collect()))
    assert sorted(map(str, audit.parity_by_digests(*sides, ["status", "n"]).collect())) == want and len(want) == 9
    # What is joined follows the differences: a leaf or so for each.
    leaves = audit.unequal_leaves(*sides, ["status", "n"], "id")
    assert leaves.count() <= 9
    assert audit.parity_by_digests(sides[0], sides[0], ["status", "n"]).collect() == []
    assert audit.parity_by_digests(sides[0].limit(0), sides[1].limit(0), ["status", "n"]).collect() == []


def test_repeated_rows_change_a_digest(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, status string")
    assert audit.unequal_leaves(rows, rows.unionByName(rows.limit(1)), ["status"], "id").count() == 1


def test_lookup_reads_the_files_of_its_keys(spark):
    root = scratch_path(spark, "deltas")
    base = spark.range(50_000).select(F.format_string("k%08d", "id").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("updated_at"))
    schema = base.schema
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        deltas.write_changes(root, "run-1", base)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    deltas.write_changes(root, "run-2", spark.createDataFrame([("k00000007", "later"), ("zz", "new")], schema), spark.createDataFrame([("k00000008",)], "id string"))
    incoming = spark.createDataFrame([("k00000006", "x"), ("k00000007", "later"), ("k00000008", "back"), ("zz", "new"), ("unknown", "u"), (None, "u")], "id string, updated_at string")
    files = deltas.live_files(spark, root, schema)
    near = deltas.files_of_keys([f for f in files if f.base], incoming.select("id"))
    assert len([f for f in files if f.base]) > 2 and len(near) == 1
    assert {r.id: r.changed for r in detect_changes(deltas.read_keys(spark, root, schema, incoming), incoming).collect()} == {
        "k00000006": True, "k00000007": False, "k00000008": True, "zz": False, "unknown": True, None: True
    }
    whole = deltas.read_keyed(spark, root, schema)
    assert sorted(map(tuple, deltas.read_keys(spark, root, schema, incoming).collect())) == sorted(map(tuple, whole.join(incoming.select("id"), "id", "left_semi").collect()))
