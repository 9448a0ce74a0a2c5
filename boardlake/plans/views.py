"""Board tables derived from the test tables. Each text is read by Spark and by DuckDB alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from boardlake.schemas import ENTITIES

NOW = "2024-02-10T00:00:00.000Z"
STAMP_1 = "2024-02-03T00:00:00.000Z"
STAMP_2 = "2024-02-09T00:00:00.000Z"

# Texts of the views; names of other views and of the test tables may appear in them.
VIEWS: dict[str, str] = {
    "companies": f"""
SELECT concat('co-', cast(r_regionkey AS string)) AS id, r_name AS name, upper(substr(r_name, 1, 3)) AS issue_prefix,
  'active' AS status, '{STAMP_1}' AS updated_at, 'https://board.example' AS api_base, '{STAMP_1}' AS synced_at
FROM region""",
    "projects": f"""
SELECT concat('pr-', cast(n_nationkey AS string)) AS id, concat('co-', cast(n_regionkey AS string)) AS company_id,
  n_name AS name, lower(n_name) AS url_key, 'active' AS status, '{STAMP_1}' AS updated_at, '{STAMP_1}' AS synced_at
FROM nation""",
    "agents": f"""
SELECT concat('ag-', cast(s_suppkey AS string)) AS id, concat('co-', cast(n_regionkey AS string)) AS company_id,
  s_name AS name, 'engineer' AS role, CASE WHEN s_acctbal < 0 THEN 'paused' ELSE 'active' END AS status,
  '{STAMP_1}' AS updated_at, '{STAMP_1}' AS synced_at
FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "issues": f"""
SELECT concat('is-', cast(doc_id AS string)) AS id, concat('co-', cast(doc_id % 5 AS string)) AS company_id,
  concat(upper(lang), '-', cast(doc_id AS string)) AS identifier, concat('pr-', cast(doc_id % 25 AS string)) AS project_id,
  CASE doc_id % 7 WHEN 0 THEN 'todo' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'in_review' WHEN 3 THEN 'blocked'
    WHEN 4 THEN 'done' WHEN 5 THEN 'cancelled' ELSE 'backlog' END AS status,
  CASE doc_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE NULL END AS priority,
  split_part(text, '.', 1) AS title, text AS description,
  CASE WHEN doc_id % 3 = 0 THEN NULL ELSE concat('ag-', cast(doc_id % 120 AS string)) END AS assignee_agent_id,
  concat('2024-01-01T00:00:', lpad(cast(doc_id % 60 AS string), 2, '0'), '.000Z') AS created_at,
  concat('2024-01-', lpad(cast(1 + doc_id % 28 AS string), 2, '0'), 'T', lpad(cast(doc_id % 24 AS string), 2, '0'), ':',
    lpad(cast(doc_id % 60 AS string), 2, '0'), ':00.000Z') AS updated_at,
  '{STAMP_1}' AS synced_at, CASE WHEN lang = 'en' THEN '{STAMP_1}' ELSE NULL END AS comments_synced_at
FROM documents""",
    "comments": f"""
SELECT concat('cm-', cast(conv_id AS string), '-', cast(turn AS string)) AS id, concat('is-', cast(conv_id AS string)) AS issue_id,
  concat('co-', cast(conv_id % 5 AS string)) AS company_id, role AS author_type,
  CASE WHEN role = 'assistant' THEN concat('ag-', cast(1 + conv_id % 120 AS string)) ELSE NULL END AS author_agent_id,
  CASE WHEN role = 'user' THEN concat('us-', cast(conv_id AS string)) ELSE NULL END AS author_user_id, text AS body,
  concat('2024-02-01T00:', lpad(cast(turn AS string), 2, '0'), ':00.000Z') AS created_at, '{STAMP_1}' AS synced_at
FROM conversations""",
    "approvals": f"""
SELECT concat('ap-', cast(event_id AS string)) AS id, concat('co-', cast(user_id % 5 AS string)) AS company_id,
  event_type AS type, CASE WHEN value >= 50 THEN 'approved' WHEN value >= 10 THEN 'pending' ELSE 'rejected' END AS status,
  concat('ag-', cast(user_id AS string)) AS requested_by_agent_id,
  concat(substr(cast(ts AS string), 1, 10), 'T', substr(cast(ts AS string), 12, 8), '.000Z') AS created_at, '{STAMP_1}' AS synced_at
FROM events""",
    # Keyed tables of order size: the stored mirror, and a complete listing taken later. Open orders
    # are not stored yet, pending ones have vanished upstream, urgent ones have moved.
    "orders_stored": f"""
SELECT concat('or-', cast(o_orderkey AS string)) AS id, concat('co-', substr(o_orderpriority, 1, 1)) AS company_id,
  o_orderstatus AS status, concat(substr(cast(o_orderdate AS string), 1, 10), 'T00:00:00.000Z') AS updated_at,
  '{STAMP_1}' AS synced_at, CASE WHEN o_totalprice > 100000 THEN '{STAMP_1}' ELSE NULL END AS comments_synced_at
FROM orders WHERE o_orderstatus <> 'O'""",
    "orders_listed": f"""
SELECT concat('or-', cast(o_orderkey AS string)) AS id, concat('co-', substr(o_orderpriority, 1, 1)) AS company_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'done' ELSE o_orderstatus END AS status,
  concat(substr(cast(o_orderdate AS string), 1, 10), CASE WHEN o_orderpriority = '1-URGENT' THEN 'T12:00:00.000Z' ELSE 'T00:00:00.000Z' END) AS updated_at,
  '{STAMP_2}' AS synced_at
FROM orders WHERE o_orderstatus <> 'P'""",
    # A change feed with many rows per key.
    "lines_feed": f"""
SELECT concat('or-', cast(l_orderkey AS string)) AS id, concat('co-', l_returnflag) AS company_id, l_linestatus AS status,
  concat(substr(cast(l_shipdate AS string), 1, 10), 'T00:00:00.000Z') AS updated_at, '{STAMP_2}' AS synced_at,
  concat(substr(cast(l_shipdate AS string), 1, 10), '-', cast(l_linenumber AS string), '-', lpad(cast(l_partkey AS string), 12, '0')) AS seq
FROM lineitem""",
}

# Steps of a stored sync state: one row per company and entity. The two engines spell the list differently.
_STATE = f"""
SELECT concat('p-', id) AS profile, id AS company_id, entity,
  CASE WHEN entity = 'issues' THEN '2024-01-20T00:00:00.000Z' ELSE NULL END AS cursor,
  concat('2024-02-0', cast(1 + length(name) % 9 AS string), 'T00:0', cast(length(entity) % 10 AS string), ':00.000Z') AS last_sync_at,
  '{STAMP_1}' AS last_full_at,
  CASE WHEN id = 'co-4' AND entity = 'issues' THEN 'error' WHEN id = 'co-2' AND entity = 'comments' THEN 'partial' ELSE 'ok' END AS last_status,
  CASE WHEN id = 'co-4' AND entity = 'issues' THEN 'API error 503' WHEN id = 'co-2' AND entity = 'comments' THEN '2 failed' ELSE NULL END AS last_error,
  cast(length(name) AS bigint) AS last_count
FROM (SELECT id, name, {{entities}} AS entity FROM companies) AS steps"""
_ENTITY_LIST = ", ".join(f"'{e}'" for e in ENTITIES)
SPARK_VIEWS = {**VIEWS, "sync_state": _STATE.format(entities=f"explode(array({_ENTITY_LIST}))")}
DUCKDB_VIEWS = {**VIEWS, "sync_state": _STATE.format(entities=f"unnest([{_ENTITY_LIST}])")}
TEST_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _names_in(text: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", text)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A board table over the test tables."""
    text = SPARK_VIEWS[name]
    inputs = {n: view(spark, sf_dir, n) for n in _names_in(text, SPARK_VIEWS)}
    inputs.update({n: table(spark, sf_dir, n) for n in _names_in(text, TEST_TABLES)})
    for n in inputs:
        text = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", text)
    return spark.sql(text, **inputs)


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [view(spark, sf_dir, n) for n in names]


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """DuckDB text of a query over the board tables: the views it needs come first."""
    known = {**DUCKDB_VIEWS, **(extra or {})}
    needed: list[str] = []

    def need(text: str) -> None:
        for name in _names_in(text, known):
            if name not in needed:
                need(known[name])
                needed.append(name)

    need(sql)
    parts = [f"{n} AS ({known[n]})" for n in needed]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        parts.append(body[5:])
        return "WITH " + ",\n".join(parts)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body

