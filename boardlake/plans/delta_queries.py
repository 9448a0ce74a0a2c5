"""Registered queries over keyed tables that are written run by run, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.operators.grouping import latest_per_key
from boardlake.operators.upsert import detect_changes
from boardlake.plans.views import STAMP_1, views
from boardlake.session import scratch_path
from boardlake.sources import deltas

QUERIES = {}
ORACLES = {}
COLUMNS = ["id", "company_id", "status", "updated_at", "synced_at"]


def register(name: str, oracle: str):
    def add(function):
        QUERIES[name] = function
        ORACLES[name] = oracle
        return function

    return add


def _runs(spark, sf) -> tuple[str, DataFrame]:
    """The stored orders; a listing that has lost pending orders; the newest row of each order in the feed of lines."""
    stored, listed, feed = views(spark, sf, "orders_stored", "orders_listed", "lines_feed")
    root = scratch_path(spark, "delta-orders")
    rows = stored.select(*COLUMNS)
    deltas.write_changes(root, "run-1", rows)
    deltas.write_changes(root, "run-2", listed.select(*COLUMNS), stored.filter("status = 'P'").select("id"))
    deltas.write_changes(root, "run-3", latest_per_key(feed, ["id"], ["seq"]).select(*COLUMNS))
    return root, rows


_STATE = """lines AS (SELECT id, max_by(company_id, seq) AS company_id, max_by(status, seq) AS status, max_by(updated_at, seq) AS updated_at, max(synced_at) AS synced_at FROM lines_feed GROUP BY id),
listed AS (SELECT id, company_id, status, updated_at, synced_at FROM orders_listed WHERE id NOT IN (SELECT id FROM lines)),
kept AS (SELECT id, company_id, status, updated_at, synced_at FROM orders_stored WHERE status <> 'P' AND id NOT IN (SELECT id FROM orders_listed) AND id NOT IN (SELECT id FROM lines))"""
_MERGED = f"WITH {_STATE} SELECT * FROM lines UNION ALL SELECT * FROM listed UNION ALL SELECT * FROM kept"


@register("delta_merge", _MERGED)
def merged_on_read(spark, sf):
    """Base and two runs, merged as they are read."""
    root, rows = _runs(spark, sf)
    return deltas.read_keyed(spark, root, rows.schema)


@register("delta_fold", _MERGED)
def folded(spark, sf):
    """The same table after the two runs became one, and then part of the base."""
    root, rows = _runs(spark, sf)
    deltas.fold_changes(spark, root, rows.schema, fan=2, share=1e9)
    deltas.fold_changes(spark, root, rows.schema, share=0.0)
    return deltas.read_keyed(spark, root, rows.schema)


@register("delta_snapshot", "SELECT id, company_id, status, updated_at, synced_at FROM orders_stored WHERE status <> 'P' AND id NOT IN (SELECT id FROM orders_listed) UNION ALL SELECT id, company_id, status, updated_at, synced_at FROM orders_listed")
def as_of_run(spark, sf):
    """The table as of its second run."""
    root, rows = _runs(spark, sf)
    return deltas.read_keyed(spark, root, rows.schema, upto="run-2")


@register(
    "delta_runs",
    f"""SELECT 'run-1' AS run, count(*) AS rows, CAST(0 AS BIGINT) AS deletes FROM orders_stored WHERE synced_at = '{STAMP_1}'
UNION ALL SELECT 'run-2', (SELECT count(*) FROM orders_listed) + count(*), count(*) FROM orders_stored WHERE status = 'P' AND id NOT IN (SELECT id FROM orders_listed)
UNION ALL SELECT 'run-3', count(DISTINCT id), 0 FROM lines_feed""",
)
def run_costs(spark, sf):
    """What each run wrote: its changes, not the table."""
    root, rows = _runs(spark, sf)
    log = deltas.commit_log(spark, root, rows.schema).filter("action = 'add'")
    return log.groupBy("run").agg(F.sum("rows").alias("rows"), F.sum("deletes").alias("deletes"))


@register(
    "delta_changes",
    """SELECT l.id, l.company_id, l.status, l.updated_at, l.synced_at, s.id IS NULL OR s.updated_at IS DISTINCT FROM l.updated_at AS changed
FROM orders_listed l LEFT JOIN orders_stored s ON s.id = l.id""",
)
def changes_of_stored_files(spark, sf):
    """Listed orders against the stored ones, looked up in the files that hold their keys."""
    stored, listed = views(spark, sf, "orders_stored", "orders_listed")
    root = scratch_path(spark, "delta-orders")
    deltas.write_changes(root, "run-1", stored.select(*COLUMNS))
    incoming = listed.select(*COLUMNS)
    return detect_changes(deltas.read_keys(spark, root, stored.select(*COLUMNS).schema, incoming), incoming)
