"""Registered sync operators: change detection, upserts, pruning, threads, cursors, runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardlake.functions.timing import instant
from boardlake.operators import rollups, upsert as U
from boardlake.operators.grouping import with_positions
from boardlake.plans.read_queries import _typed_sql, issue_pages, payloads
from boardlake.plans.sync_run import SyncResult, sync_run
from boardlake.plans.views import NOW, STAMP_1, STAMP_2, table, view, views
from boardlake.schemas import ENTITIES, META, SYNC_STATE, entity_schema
from boardlake.session import scratch_path, staged
from boardlake.sources.landing import read_pages
from boardlake.sources.tables import TABLE_SCHEMAS

QUERIES = {}
ORACLES = {}


def register(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


# Comment-like rows of line size: every line is a comment on its order.
ORACLE_VIEWS = {
    "line_comments": f"""
SELECT concat('ln-', cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', cast(l_partkey AS string), '-', substr(cast(l_shipdate AS string), 1, 10)) AS id,
  concat('or-', cast(l_orderkey AS string)) AS issue_id, concat('co-', substr(o_orderpriority, 1, 1)) AS company_id,
  l_returnflag AS author_type, l_linestatus AS body, '{STAMP_1}' AS synced_at
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
}


def line_comments(spark, sf) -> DataFrame:
    # Joined by the issue's id, the rows lie where joins with other tables of issues look for them.
    lines = table(spark, sf, "lineitem").withColumn("issue_id", F.concat(F.lit("or-"), F.col("l_orderkey").cast("string")))
    orders = table(spark, sf, "orders").select(F.concat(F.lit("or-"), F.col("o_orderkey").cast("string")).alias("issue_id"), "o_orderpriority")
    rows = lines.join(orders, "issue_id")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return rows.select(
        F.concat_ws("-", F.lit("ln"), F.substr("issue_id", F.lit(4)), "l_linenumber", "l_partkey", day).alias("id"),
        "issue_id",
        F.concat(F.lit("co-"), F.substring("o_orderpriority", 1, 1)).alias("company_id"),
        F.col("l_returnflag").alias("author_type"), F.col("l_linestatus").alias("body"), F.lit(STAMP_1).alias("synced_at"),
    )


_CHANGED = "s.id IS NULL OR s.updated_at IS DISTINCT FROM l.updated_at"


@register(
    "change_detect",
    f"SELECT l.id, l.seq, l.updated_at, {_CHANGED} AS changed FROM lines_feed l LEFT JOIN orders_stored s ON s.id = l.id",
)
def change_detect(spark, sf):
    stored, feed = views(spark, sf, "orders_stored", "lines_feed")
    return U.detect_changes(stored, feed).select("id", "seq", "updated_at", "changed")


@register(
    "change_counts",
    f"SELECT l.company_id, count(*) AS listed, count(*) FILTER (WHERE {_CHANGED}) AS changed "
    "FROM orders_listed l LEFT JOIN orders_stored s ON s.id = l.id GROUP BY l.company_id",
)
def change_counts(spark, sf):
    stored, listed = views(spark, sf, "orders_stored", "orders_listed")
    flagged = U.detect_changes(stored, listed)
    return flagged.groupBy("company_id").agg(F.count(F.lit(1)).alias("listed"), F.count_if("changed").alias("changed"))


_UPSERTED = """SELECT coalesce(l.id, s.id) AS id, coalesce(l.company_id, s.company_id) AS company_id, coalesce(l.status, s.status) AS status,
  coalesce(l.updated_at, s.updated_at) AS updated_at, coalesce(l.synced_at, s.synced_at) AS synced_at, s.comments_synced_at
FROM orders_stored s FULL JOIN orders_listed l ON l.id = s.id"""


@register("upsert_issues", _UPSERTED)
def upsert_issues(spark, sf):
    stored, listed = views(spark, sf, "orders_stored", "orders_listed")
    return U.upsert_issues(stored, listed)


@register(
    "upsert_entities",
    """WITH last AS (SELECT id, max_by(company_id, seq) AS company_id, max_by(status, seq) AS status,
  max_by(updated_at, seq) AS updated_at, max(synced_at) AS synced_at FROM lines_feed GROUP BY id)
SELECT coalesce(l.id, s.id) AS id, coalesce(l.company_id, s.company_id) AS company_id, coalesce(l.status, s.status) AS status,
  coalesce(l.updated_at, s.updated_at) AS updated_at, coalesce(l.synced_at, s.synced_at) AS synced_at
FROM orders_stored s FULL JOIN last l ON l.id = s.id""",
)
def upsert_entities(spark, sf):
    stored, feed = views(spark, sf, "orders_stored", "lines_feed")
    return U.upsert(stored.drop("comments_synced_at"), feed, ["id"], ["seq"])


@register(
    "kv_upsert",
    """WITH last AS (SELECT 'cu-' || o_custkey AS key, max_by(o_orderpriority, (o_orderdate, o_orderkey)) AS value FROM orders GROUP BY o_custkey)
SELECT coalesce(l.key, 'cu-' || c.c_custkey) AS key, coalesce(l.value, c.c_mktsegment) AS value
FROM customer c FULL JOIN last l ON l.key = 'cu-' || c.c_custkey""",
)
def kv_upsert(spark, sf):
    def key(column):
        return F.concat(F.lit("cu-"), F.col(column).cast("string")).alias("key")

    meta = table(spark, sf, "customer").select(key("c_custkey"), F.col("c_mktsegment").alias("value"))
    values = table(spark, sf, "orders").select(key("o_custkey"), F.col("o_orderpriority").alias("value"), "o_orderdate", "o_orderkey")
    return U.put_values(meta, values, ["o_orderdate", "o_orderkey"]).select(*META.names)


@register(
    "partial_upsert",
    """WITH stored AS (SELECT 'p' AS profile, 'us-' || c_custkey AS company_id, 'issues' AS entity, c_name AS cursor, c_mktsegment AS last_status, CAST(c_nationkey AS BIGINT) AS last_count FROM customer),
latest AS (SELECT 'us-' || user_id AS company_id, max_by(event_type, event_id) AS last_status, max(event_id) AS event_id FROM events GROUP BY user_id),
good AS (SELECT 'us-' || user_id AS company_id, max_by(CAST(floor(value) AS BIGINT), event_id) AS last_count FROM events WHERE event_type <> 'error' GROUP BY user_id)
SELECT 'p' AS profile, coalesce(s.company_id, l.company_id) AS company_id, 'issues' AS entity, s.cursor,
  coalesce(l.last_status, s.last_status) AS last_status, CASE WHEN l.last_status = 'error' THEN e.props END AS last_error,
  coalesce(g.last_count, s.last_count) AS last_count
FROM stored s FULL JOIN latest l ON l.company_id = s.company_id LEFT JOIN good g ON g.company_id = l.company_id LEFT JOIN events e ON e.event_id = l.event_id""",
)
def partial_upsert(spark, sf):
    def of(column):
        return F.concat(F.lit("us-"), F.col(column).cast("string")).alias("company_id")

    key = [F.lit("p").alias("profile"), F.lit("issues").alias("entity")]
    stored = table(spark, sf, "customer").select(
        *key, of("c_custkey"), F.col("c_name").alias("cursor"), F.col("c_mktsegment").alias("last_status"),
        F.lit("before").alias("last_error"), F.col("c_nationkey").cast("bigint").alias("last_count"),
    )
    # Customers start without an error so that only patches can set one.
    stored = stored.withColumn("last_error", F.lit(None).cast("string"))
    failed = F.col("event_type") == "error"
    base = F.array(F.lit("last_status"), F.lit("last_error"))
    patches = table(spark, sf, "events").select(
        *key, of("user_id"), F.col("event_id").alias("seq"), F.lit("unset").alias("cursor"), F.col("event_type").alias("last_status"),
        F.when(failed, F.col("props")).alias("last_error"), F.floor("value").cast("bigint").alias("last_count"),
        F.when(failed, base).otherwise(F.concat(base, F.array(F.lit("last_count")))).alias("fields_set"),
    )
    return U.partial_upsert(stored, patches, fields=["cursor", "last_status", "last_error", "last_count"])


_STALE = "s.company_id IN (SELECT id FROM companies) AND s.id NOT IN (SELECT id FROM orders_listed)"


@register("prune_snapshot", f"SELECT s.id, s.company_id, s.status, s.updated_at FROM orders_stored s WHERE NOT ({_STALE})")
def prune_snapshot(spark, sf):
    stored, listed, companies = views(spark, sf, "orders_stored", "orders_listed", "companies")
    scope = companies.select(F.col("id").alias("company_id"))
    return U.prune_unlisted(stored, listed, scope).select("id", "company_id", "status", "updated_at")


@register("prune_counts", f"SELECT s.company_id, count(*) AS pruned FROM orders_stored s WHERE {_STALE} GROUP BY s.company_id")
def prune_counts(spark, sf):
    stored, listed, companies = views(spark, sf, "orders_stored", "orders_listed", "companies")
    runs = companies.select(F.col("id").alias("company_id"), F.lit(STAMP_2).alias("started_at"))
    stale = U.stale_rows(U.upsert_issues(stored, listed), runs)
    return stale.groupBy("company_id").agg(F.count(F.lit(1)).alias("pruned"))


@register(
    "prune_cascade",
    "SELECT c.id, c.issue_id, c.company_id FROM line_comments c WHERE NOT (c.company_id IN (SELECT id FROM companies) AND c.issue_id NOT IN (SELECT id FROM orders_listed))",
)
def prune_cascade(spark, sf):
    listed, companies = views(spark, sf, "orders_listed", "companies")
    kept = U.drop_orphans(line_comments(spark, sf), listed, companies.select(F.col("id").alias("company_id")))
    return kept.select("id", "issue_id", "company_id")


@register(
    "thread_replace",
    f"""SELECT id, issue_id, body, synced_at FROM line_comments WHERE issue_id NOT IN (SELECT id FROM orders_listed WHERE status = 'done')
UNION ALL SELECT id, issue_id, body || '+', '{STAMP_2}' FROM line_comments
WHERE issue_id IN (SELECT id FROM orders_listed WHERE status = 'done') AND author_type <> 'N'""",
)
def thread_replace(spark, sf):
    comments = line_comments(spark, sf)
    hydrated = view(spark, sf, "orders_listed").filter("status = 'done'").select(F.col("id").alias("issue_id"))
    fetched = comments.filter("author_type <> 'N'").join(hydrated, "issue_id", "left_semi")
    fetched = fetched.withColumn("body", F.concat("body", F.lit("+"))).withColumn("synced_at", F.lit(STAMP_2))
    # The operator reads what was fetched twice, for its ids and its rows.
    return U.replace_threads(comments, hydrated, staged(fetched, "fetched")).select("id", "issue_id", "body", "synced_at")


@register(
    "thread_stamps",
    f"SELECT i.id, CASE WHEN l.status = 'done' THEN '{STAMP_2}' ELSE i.comments_synced_at END AS comments_synced_at "
    "FROM orders_stored i LEFT JOIN orders_listed l ON l.id = i.id",
)
def thread_stamps(spark, sf):
    stored, listed = views(spark, sf, "orders_stored", "orders_listed")
    hydrated = listed.filter("status = 'done'").select(F.col("id").alias("issue_id"), F.lit(STAMP_2).alias("at"))
    return U.stamp_threads(stored, hydrated).select("id", "comments_synced_at")


@register(
    "refresh_one",
    f"""SELECT 'issue' AS kind, id, CASE WHEN identifier = 'EN-7' THEN 'closed' ELSE status END AS state,
  CASE WHEN identifier = 'EN-7' THEN '{STAMP_2}' ELSE comments_synced_at END AS stamp FROM issues
UNION ALL SELECT 'comment', c.id, c.author_type, CASE WHEN i.identifier = 'EN-7' THEN '{STAMP_2}' ELSE c.synced_at END
FROM comments c JOIN issues i ON i.id = c.issue_id WHERE NOT (i.identifier = 'EN-7' AND c.author_type = 'user')""",
)
def refresh_one(spark, sf):
    from boardlake.operators.reads import find_issue

    issues, comments = views(spark, sf, "issues", "comments")
    record = find_issue(issues, "EN-7").withColumn("status", F.lit("closed")).withColumn("synced_at", F.lit(STAMP_2))
    thread = comments.filter("author_type <> 'user'").join(record.select(F.col("id").alias("issue_id")), "issue_id", "left_semi")
    new_issues, new_comments = U.refresh_issue(issues, comments, record, thread.withColumn("synced_at", F.lit(STAMP_2)), STAMP_2)
    rows = new_issues.select(F.lit("issue").alias("kind"), "id", F.col("status").alias("state"), F.col("comments_synced_at").alias("stamp"))
    return rows.unionByName(
        new_comments.select(F.lit("comment").alias("kind"), "id", F.col("author_type").alias("state"), F.col("synced_at").alias("stamp"))
    )


# Some rows carry a time that does not parse.
_DATED = "SELECT id, company_id, CASE WHEN company_id = 'co-5' THEN 'n/a ' || updated_at ELSE updated_at END AS updated_at FROM orders_stored"


def _dated(spark, sf) -> DataFrame:
    broken = F.when(F.col("company_id") == "co-5", F.concat(F.lit("n/a "), "updated_at")).otherwise(F.col("updated_at"))
    return view(spark, sf, "orders_stored").select("id", "company_id", broken.alias("updated_at"))


@register(
    "cursor_filter",
    f"SELECT id, updated_at FROM ({_DATED}) AS dated WHERE company_id = 'co-5' OR updated_at >= '1999-06-30T22:00:00.000Z'",
)
def cursor_filter(spark, sf):
    return U.since_cursor(_dated(spark, sf), "1999-07-01T00:00:00+02:00").select("id", "updated_at")


@register(
    "cursor_advance",
    f"""WITH old AS (SELECT id AS company_id, CASE id WHEN 'co-1' THEN '2030-01-01T00:00:00.000Z' WHEN 'co-2' THEN '1990-01-01T00:00:00.000Z' END AS cursor FROM companies),
newest AS (SELECT company_id, max(updated_at) AS seen FROM ({_DATED}) AS dated WHERE company_id <> 'co-5' GROUP BY company_id)
SELECT coalesce(o.company_id, n.company_id) AS company_id, greatest(o.cursor, n.seen) AS cursor FROM old o FULL JOIN newest n ON n.company_id = o.company_id
UNION ALL SELECT 'co-5', NULL""",
)
def cursor_advance(spark, sf):
    cursor = F.when(F.col("id") == "co-1", "2030-01-01T00:00:00.000Z").when(F.col("id") == "co-2", "1990-01-01T00:00:00.000Z")
    old = view(spark, sf, "companies").select(F.col("id").alias("company_id"), cursor.alias("cursor"))
    return U.advance_cursor(old, _dated(spark, sf), ["company_id"])


@register(
    "hydration_candidates",
    f"""SELECT DISTINCT l.id AS issue_id, l.company_id FROM orders_listed l LEFT JOIN orders_stored s ON s.id = l.id WHERE {_CHANGED}
UNION SELECT id, company_id FROM issues WHERE status IN ('todo', 'in_progress', 'in_review', 'blocked') OR company_id = 'co-3'""",
)
def hydration_candidates(spark, sf):
    stored, listed, issues = views(spark, sf, "orders_stored", "orders_listed", "issues")
    changed = U.detect_changes(stored, listed).filter("changed")
    return U.hydration_candidates(issues, changed, "changed", full=F.col("company_id") == "co-3")


@register(
    "sync_plan",
    """WITH cursors AS (SELECT user_id, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%gZ') AS cursor FROM events GROUP BY user_id)
SELECT 'p-' || c_custkey AS profile, 'us-' || c_custkey AS company_id, u.cursor,
  CASE WHEN u.cursor IS NULL THEN 'full' ELSE 'incremental' END AS mode, u.cursor AS since
FROM customer LEFT JOIN cursors u ON u.user_id = c_custkey""",
)
def sync_plan(spark, sf):
    return U.plan_sync(*_plan_input(spark, sf))


@register(
    "sync_plan_fresh",
    f"""WITH users AS (SELECT user_id, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%gZ') AS cursor, max(ts) FILTER (WHERE event_type <> 'error') AS good FROM events GROUP BY user_id)
SELECT 'p-' || c_custkey AS profile, 'us-' || c_custkey AS company_id, u.cursor, CASE WHEN u.cursor IS NULL THEN 'full' ELSE 'incremental' END AS mode,
  u.cursor AS since, coalesce(epoch_ms(TIMESTAMP '{NOW[:19]}') - epoch_ms(date_trunc('milliseconds', good)) < 14 * 86400000, false) AS skipped
FROM customer LEFT JOIN users u ON u.user_id = c_custkey""",
)
def sync_plan_fresh(spark, sf):
    """The plan with the targets that a run may leave out, as their newest good step is younger than two weeks."""
    targets, state = _plan_input(spark, sf)
    return U.plan_sync(targets, state, skip_younger_than="14d", now=instant(F.lit(NOW)), by_target=True)


def _plan_input(spark, sf):
    def target(column):
        number = F.col(column).cast("string")
        return F.concat(F.lit("p-"), number).alias("profile"), F.concat(F.lit("us-"), number).alias("company_id")

    targets = table(spark, sf, "customer").select(*target("c_custkey"))
    good = F.max(F.when(F.col("event_type") != "error", F.col("ts")))
    newest = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("ts"), good.alias("good"))
    text = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    step = [F.date_format("ts", text).alias("cursor"), F.date_format("good", text).alias("last_sync_at"), F.when(F.col("good").isNotNull(), "ok").alias("last_status")]
    return targets, newest.select(*target("user_id"), F.lit("issues").alias("entity"), *step)


@register(
    "max_stamp",
    f"SELECT max(stamp) AS max_stamp, '2024-02-09T00:00:00.001Z' AS run_stamp FROM ("
    + " UNION ALL ".join(f"SELECT max(synced_at) AS stamp FROM {t}" for t in [*ENTITIES, "orders_stored", "orders_listed"])
    + ") AS stamps",
)
def max_stamp(spark, sf):
    tables = views(spark, sf, *ENTITIES, "orders_stored", "orders_listed")
    return rollups.max_stamp(tables, instant(F.lit(STAMP_1)))


# Step results of event size: kinds of events stand for outcomes.
_OUTCOME = "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'partial' ELSE 'ok' END"
_DAY = "substr(cast(ts AS string), 1, 10)"


def _steps(spark, sf) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind == "error", "error").when(kind == "signup", "partial").otherwise("ok")
    return table(spark, sf, "events").withColumn("status", status).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


_ROLLED = """CASE WHEN bool_and(status = 'ok') THEN 'ok' WHEN bool_or(status <> 'error') THEN 'partial' ELSE 'error' END"""


@register(
    "run_rollup",
    f"SELECT user_id, day, {_ROLLED} AS status, count(*) AS companies FROM (SELECT user_id, {_DAY} AS day, {_OUTCOME} AS status FROM events) AS steps GROUP BY user_id, day "
    "UNION ALL SELECT -1, '', 'ok', 0",
)
def run_rollup(spark, sf):
    steps = _steps(spark, sf)
    nothing = rollups.run_rollup(steps.filter("user_id IS NULL")).select(F.lit(-1).cast("bigint").alias("user_id"), F.lit("").alias("day"), "status", "companies")
    return rollups.run_rollup(steps, ["user_id", "day"]).unionByName(nothing)


@register(
    "entity_rollup",
    f"SELECT user_id, day, CASE WHEN bool_or(status = 'error') THEN 'partial' ELSE 'ok' END AS status, count(*) AS steps "
    f"FROM (SELECT user_id, {_DAY} AS day, {_OUTCOME} AS status FROM events) AS steps GROUP BY user_id, day",
)
def entity_rollup(spark, sf):
    return rollups.entity_rollup(_steps(spark, sf), ["user_id", "day"])


@register(
    "run_ledger",
    f"""WITH results AS (SELECT {_DAY} AS run_id, event_id, 'p-' || user_id AS profile, 'us-' || user_id AS company_id, {_OUTCOME} AS status,
  CAST(floor(value) AS BIGINT) AS changed, CAST(user_id AS BIGINT) AS hydrated, row_number() OVER (PARTITION BY {_DAY} ORDER BY event_id) - 1 AS place FROM events),
totals AS (SELECT run_id, {_ROLLED} AS status FROM results GROUP BY run_id),
lists AS (SELECT run_id, place // 500 AS page, string_agg(profile, ',' ORDER BY place) AS profiles,
  '[' || string_agg('{{"profile":"' || profile || '","companyId":"' || company_id || '","status":"' || status || '","issuesChanged":' || changed || ',"commentsHydrated":' || hydrated || '}}', ',' ORDER BY place) || ']' AS summary_json
  FROM results GROUP BY run_id, page)
SELECT t.run_id, t.run_id || 'T00:00:00.000Z' AS started_at, t.run_id || 'T01:00:00.000Z' AS finished_at, 'incremental' AS mode,
  CAST(l.page AS BIGINT) AS page, t.status, l.profiles, l.summary_json FROM totals t JOIN lists l ON l.run_id = t.run_id
UNION ALL SELECT 'aborted', '2024-02-09T00:00:00.000Z', NULL, 'full', 0, 'ok', '', '[]'""",
)
def run_ledger(spark, sf):
    steps = _steps(spark, sf).withColumnRenamed("day", "run_id")
    results = steps.select(
        "run_id", F.col("event_id").alias("place"), F.concat(F.lit("p-"), F.col("user_id").cast("string")).alias("profile"),
        F.concat(F.lit("us-"), F.col("user_id").cast("string")).alias("company_id"), "status",
        F.floor("value").cast("bigint").alias("issues_changed"), F.col("user_id").alias("comments_hydrated"),
        F.concat("run_id", F.lit("T01:00:00.000Z")).alias("finished_at"),
    )
    starts = results.select("run_id").distinct().withColumn("started_at", F.concat("run_id", F.lit("T00:00:00.000Z")))
    starts = starts.withColumn("mode", F.lit("incremental"))
    aborted = spark.createDataFrame([("aborted", STAMP_2, "full")], starts.schema)
    return rollups.run_ledger(starts.unionByName(aborted), results)


@register(
    "first_wins_dedup",
    r"""WITH targets AS (SELECT page_id AS position, 'p-' || page_id AS profile, regexp_extract(url, '^https?://[^/]+', 0) AS api_base,
  regexp_extract(url, '^https?://[^/]+/([a-z][a-z])/', 1) AS company_id FROM pages)
SELECT min(position) AS position, min_by(profile, position) AS profile, api_base, company_id FROM targets WHERE company_id <> '' GROUP BY api_base, company_id""",
)
def first_wins_dedup(spark, sf):
    base = F.concat(F.lit(" "), F.regexp_extract("url", "^https?://[^/]+", 0), F.lit("//"))
    targets = table(spark, sf, "pages").select(
        F.col("page_id").alias("position"), F.concat(F.lit("p-"), F.col("page_id").cast("string")).alias("profile"),
        base.alias("api_base"), F.regexp_extract("url", "^https?://[^/]+/([a-z][a-z])/", 1).alias("company_id"),
    )
    return U.dedupe_targets(targets)


# --- a whole run ---


def stored_tables(spark, sf) -> dict[str, DataFrame]:
    """The mirror before the run: the board views, completed to the stored schemas."""
    tables = {}
    for name in TABLE_SCHEMAS:
        if name in ("meta", "sync_runs"):
            tables[name] = spark.createDataFrame([], TABLE_SCHEMAS[name])
            continue
        rows = view(spark, sf, name)
        schema = SYNC_STATE if name == "sync_state" else entity_schema(name)
        missing = [c for c in schema.names if c not in rows.columns]
        tables[name] = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in missing]).select(*schema.names)
    return tables


def upstream_pages(spark, sf) -> DataFrame:
    """What the run finds upstream, as landed pages.

    Issues: those labelled toxic are gone, those labelled of good quality are closed and newer, the
    rest is unchanged. Threads: user comments only. The issue listing of co-3 fails, and so does the
    company record of co-4; projects answer in an unknown shape.
    """
    issues, comments, companies, agents, projects, approvals = views(
        spark, sf, "issues", "comments", "companies", "agents", "projects", "approvals"
    )
    labels = table(spark, sf, "labels").select(F.concat(F.lit("is-"), F.col("doc_id").cast("string")).alias("id"), "quality", "toxic")
    labelled = issues.join(labels, "id", "left").filter(F.coalesce("toxic", F.lit(0)) == 0)
    good = F.coalesce(F.col("quality") == 1, F.lit(False))
    current = labelled.withColumn("status", F.when(good, "done").otherwise(F.col("status"))).withColumn(
        "updated_at", F.when(good, STAMP_2).otherwise(F.col("updated_at"))
    )
    nothing = F.lit(None).cast("string")

    def page(entity: str, rows: DataFrame, payload, issue_id=nothing, page_no=F.lit(0), last=F.lit(True)) -> DataFrame:
        return rows.select(
            F.concat(F.lit("p-"), "company_id").alias("profile"), "company_id", F.lit(entity).alias("entity"), issue_id.alias("issue_id"),
            page_no.cast("bigint").alias("page_no"), payload.alias("payload"), nothing.alias("error"), last.alias("last"),
        )

    def ended(entity: str, rows: DataFrame, owners: DataFrame, shape: str, *keys: str) -> DataFrame:
        """One record per page in the order of ids, and an empty page that ends each owner's listing.

        A company's listing may be a large share of the rows, so it is numbered in parts, by the first letters of the ids.
        """
        if "issue_id" in keys:
            numbered = rows.withColumn("number", F.row_number().over(Window.partitionBy(*keys).orderBy("id")) - 1)
        else:
            numbered = with_positions(rows, list(keys), [F.col("id")], F.substring("id", 1, 6)).withColumnRenamed("position", "number")
        records = payloads(entity, numbered)
        count = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("number"))
        ends = owners.join(count, list(keys), "left").withColumn("number", F.coalesce("number", F.lit(0)))
        issue = F.col("issue_id") if "issue_id" in keys else nothing
        listed = page(entity, records, F.format_string(shape, F.col("raw")), issue, F.col("number"), F.lit(False))
        return listed.unionByName(page(entity, ends, F.lit(shape.replace("%s", "")), issue, F.col("number")))

    everyone = companies.select(F.col("id").alias("company_id"))

    def single(entity: str, rows: DataFrame, shape: str = "[%s]") -> DataFrame:
        return ended(entity, rows, everyone, shape, "company_id")

    records = payloads("companies", companies).withColumn("company_id", F.col("id"))
    threads = comments.filter("author_type = 'user'")
    pages = [
        page("companies", records, F.col("raw")),
        single("agents", agents.filter("status = 'active'")),
        single("projects", projects, '{"list":[%s]}'),
        single("approvals", approvals.filter("status <> 'rejected'"), '{"data":[%s]}'),
        issue_pages(current),
        ended("comments", threads, threads.select("company_id", "issue_id").distinct(), '{"items":[%s]}', "company_id", "issue_id"),
    ]
    landed = U.union_all(pages)
    outage = ((F.col("entity") == "companies") & (F.col("company_id") == "co-4")) | ((F.col("entity") == "issues") & (F.col("company_id") == "co-3"))
    return landed.withColumn("error", F.when(outage, "API error 503")).withColumn("payload", F.when(~outage, F.col("payload")))


_done: dict[tuple[str, str], SyncResult] = {}


def _run(spark, sf) -> SyncResult:
    """The run, made once per application; its tables, results and steps are three queries."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _done:
        _done[key] = _sync(spark, sf)
    return _done[key]


def _sync(spark, sf, **options) -> SyncResult:
    path = scratch_path(spark, "landed")
    upstream_pages(spark, sf).write.json(path)
    targets = view(spark, sf, "companies").select(
        F.substring_index("id", "-", -1).cast("bigint").alias("position"), F.concat(F.lit("p-"), "id").alias("profile"),
        F.concat("api_base", F.lit("/")).alias("api_base"), F.col("id").alias("company_id"),
    )
    return sync_run(stored_tables(spark, sf), read_pages(spark, path), targets, NOW, full=True, **options)


_RUN_SQL = f"""current AS (
  SELECT i.id, i.company_id, CASE WHEN l.quality = 1 THEN 'done' ELSE i.status END AS status,
    CASE WHEN l.quality = 1 THEN '{STAMP_2}' ELSE i.updated_at END AS updated_at, i.title
  FROM issues i LEFT JOIN labels l ON i.id = 'is-' || l.doc_id WHERE coalesce(l.toxic, 0) = 0),
listed AS (SELECT * FROM current WHERE company_id NOT IN ('co-3', 'co-4')),
threads AS (SELECT * FROM comments WHERE author_type = 'user' AND issue_id IN (SELECT id FROM listed)),
new_issues AS (
  SELECT i.id, i.company_id, coalesce(n.status, i.status) AS status, coalesce(n.updated_at, i.updated_at) AS updated_at, i.title,
    CASE WHEN n.id IS NULL THEN i.synced_at ELSE '{NOW}' END AS synced_at,
    CASE WHEN i.id IN (SELECT issue_id FROM threads) THEN '{NOW}' ELSE i.comments_synced_at END AS comments_synced_at
  FROM issues i LEFT JOIN listed n ON n.id = i.id WHERE n.id IS NOT NULL OR i.company_id IN ('co-3', 'co-4')),
new_comments AS (
  SELECT c.id, c.issue_id, c.body, CASE WHEN t.id IS NULL THEN c.synced_at ELSE '{NOW}' END AS synced_at
  FROM comments c LEFT JOIN threads t ON t.id = c.id
  WHERE c.issue_id IN (SELECT id FROM new_issues) AND (t.id IS NOT NULL OR c.issue_id NOT IN (SELECT issue_id FROM threads)))"""


@register(
    "sync_run",
    f"""WITH {_RUN_SQL}
SELECT 'issue' AS kind, id, company_id AS parent, status AS state, title AS body, synced_at, comments_synced_at FROM new_issues
UNION ALL SELECT 'comment', id, issue_id, NULL, body, synced_at, NULL FROM new_comments
UNION ALL SELECT 'agent', id, company_id, status, name, CASE WHEN company_id = 'co-4' THEN synced_at ELSE '{NOW}' END, NULL FROM agents WHERE status = 'active' OR company_id = 'co-4'
UNION ALL SELECT 'project', id, company_id, status, name, synced_at, NULL FROM projects
UNION ALL SELECT 'approval', id, company_id, status, type, CASE WHEN company_id = 'co-4' THEN synced_at ELSE '{NOW}' END, NULL FROM approvals WHERE status <> 'rejected' OR company_id = 'co-4'
UNION ALL SELECT 'company', id, '', status, name, CASE WHEN id = 'co-4' THEN synced_at ELSE '{NOW}' END, NULL FROM companies""",
)
def run_tables(spark, sf):
    new = _run(spark, sf).tables
    nothing = F.lit(None).cast("string")

    def rows(kind: str, name: str, parent, state, body, stamp=nothing) -> DataFrame:
        return new[name].select(
            F.lit(kind).alias("kind"), "id", parent.alias("parent"), state.alias("state"), body.alias("body"), "synced_at",
            stamp.alias("comments_synced_at"),
        )

    company, status = F.col("company_id"), F.col("status")
    return U.union_all(
        [
            rows("issue", "issues", company, status, F.col("title"), F.col("comments_synced_at")),
            rows("comment", "comments", F.col("issue_id"), nothing, F.col("body")),
            rows("agent", "agents", company, status, F.col("name")),
            rows("project", "projects", company, status, F.col("name")),
            rows("approval", "approvals", company, status, F.col("type")),
            rows("company", "companies", F.lit(""), status, F.col("name")),
        ]
    )


@register(
    "sync_run_results",
    f"""WITH {_RUN_SQL}
SELECT c.id AS company_id, 'full' AS mode, CASE WHEN c.id = 'co-4' THEN 'error' ELSE 'partial' END AS status,
  (SELECT count(*) FROM listed l JOIN issues i ON i.id = l.id WHERE l.company_id = c.id AND l.updated_at IS DISTINCT FROM i.updated_at) AS issues_changed,
  (SELECT count(DISTINCT issue_id) FROM threads t WHERE t.company_id = c.id) AS comments_hydrated FROM companies c""",
)
def run_results(spark, sf):
    return _run(spark, sf).results.select("company_id", "mode", "status", "issues_changed", "comments_hydrated")


@register("sync_run_skipping", f"SELECT * FROM ({ORACLES['sync_run_results']}) AS results WHERE company_id IN (SELECT id FROM companies WHERE 1 + length(name) % 9 <= 7)")
def run_skipping(spark, sf):
    """Results of a run that leaves out the companies with a good step in the last two days."""
    results = _sync(spark, sf, skip_younger_than="2d", by_target=True).results
    return results.select("company_id", "mode", "status", "issues_changed", "comments_hydrated")


@register(
    "sync_run_steps",
    f"""WITH {_RUN_SQL}
SELECT id AS company_id, 'companies' AS entity, CASE WHEN id = 'co-4' THEN 0 ELSE 1 END AS count, CASE WHEN id <> 'co-4' THEN 0 END AS pruned,
  CASE WHEN id = 'co-4' THEN 'error' ELSE 'ok' END AS status, CASE WHEN id = 'co-4' THEN 'API error 503' END AS error FROM companies
UNION ALL SELECT c.id, 'agents', count(a.id) FILTER (WHERE a.status = 'active'), count(a.id) FILTER (WHERE a.status <> 'active'), 'ok', NULL FROM companies c LEFT JOIN agents a ON a.company_id = c.id WHERE c.id <> 'co-4' GROUP BY c.id
UNION ALL SELECT c.id, 'approvals', count(a.id) FILTER (WHERE a.status <> 'rejected'), count(a.id) FILTER (WHERE a.status = 'rejected'), 'ok', NULL FROM companies c LEFT JOIN approvals a ON a.company_id = c.id WHERE c.id <> 'co-4' GROUP BY c.id
UNION ALL SELECT id, 'projects', 0, NULL, 'error', 'unknown response shape' FROM companies WHERE id <> 'co-4'
UNION ALL SELECT company_id, 'issues', 0, NULL, 'error', 'API error 503' FROM issues WHERE company_id = 'co-3' GROUP BY company_id
UNION ALL SELECT l.company_id, 'issues', count(*), (SELECT count(*) FROM issues i WHERE i.company_id = l.company_id AND i.id NOT IN (SELECT id FROM listed)), 'ok', NULL FROM listed l GROUP BY l.company_id
UNION ALL SELECT company_id, 'comments', count(DISTINCT issue_id), NULL, 'ok', NULL FROM threads GROUP BY company_id""",
)
def run_steps(spark, sf):
    return _run(spark, sf).entities.select("company_id", "entity", "count", "pruned", "status", "error")


@register(
    "sync_ledger",
    f"""WITH {_RUN_SQL}, shown AS (
  SELECT c.id, CASE WHEN c.id = 'co-4' THEN 'error' ELSE 'partial' END AS status,
    (SELECT count(*) FROM listed l JOIN issues i ON i.id = l.id WHERE l.company_id = c.id AND l.updated_at IS DISTINCT FROM i.updated_at) AS changed,
    (SELECT count(DISTINCT issue_id) FROM threads t WHERE t.company_id = c.id) AS hydrated FROM companies c)
SELECT 1 AS id, '{NOW}' AS started_at, '{NOW}' AS finished_at, 'full' AS mode, 'partial' AS status, string_agg('p-' || id, ',' ORDER BY id) AS profiles,
  '[' || string_agg('{{"profile":"p-' || id || '","companyId":"' || id || '","status":"' || status || '","issuesChanged":' || changed || ',"commentsHydrated":' || hydrated || '}}', ',' ORDER BY id) || ']' AS summary_json,
  '{NOW}' AS last_sync_at FROM shown""",
)
def run_ledger_row(spark, sf):
    new = _run(spark, sf).tables
    stamp = new["meta"].filter("key = 'last_sync_at'").select(F.col("value").alias("last_sync_at"))
    return new["sync_runs"].withColumn("last_sync_at", stamp.scalar())


@register(
    "sync_run_state",
    f"""WITH {_RUN_SQL}, fresh AS (
  SELECT company_id, 'agents' AS entity, '{NOW}' AS last_sync_at, 'ok' AS last_status, NULL AS last_error FROM (SELECT id AS company_id FROM companies WHERE id <> 'co-4')
  UNION ALL SELECT id, 'approvals', '{NOW}', 'ok', NULL FROM companies WHERE id <> 'co-4'
  UNION ALL SELECT id, 'projects', NULL, 'error', 'unknown response shape' FROM companies WHERE id <> 'co-4'
  UNION ALL SELECT id, 'companies', CASE WHEN id <> 'co-4' THEN '{NOW}' END, CASE WHEN id = 'co-4' THEN 'error' ELSE 'ok' END, CASE WHEN id = 'co-4' THEN 'API error 503' END FROM companies
  UNION ALL SELECT id, 'issues', CASE WHEN id <> 'co-3' THEN '{NOW}' END, CASE WHEN id = 'co-3' THEN 'error' ELSE 'ok' END, CASE WHEN id = 'co-3' THEN 'API error 503' END FROM companies WHERE id <> 'co-4'
  UNION ALL SELECT DISTINCT company_id, 'comments', '{NOW}', 'ok', NULL FROM threads)
SELECT company_id, entity, last_status, last_error, last_sync_at = '{NOW}' AS synced_now FROM fresh""",
)
def run_state(spark, sf):
    """State rows the run has touched: those of this run's profiles whose step it recorded."""
    done = _run(spark, sf)
    touched = done.entities.select("profile", "company_id", "entity")
    rows = done.tables["sync_state"].join(touched, ["profile", "company_id", "entity"], "left_semi")
    now = F.when(F.col("last_status") != "error", F.col("last_sync_at") == NOW)
    return rows.select("company_id", "entity", "last_status", "last_error", now.alias("synced_now"))
