"""Registered reads, projections and scalar functions, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions import text as X
from boardlake.functions.timing import duration_ms, instant, relative_time
from boardlake.operators import reads, rollups
from boardlake.operators.projection import project_records
from boardlake.operators.upsert import fallback_rows
from boardlake.plans.sql import run_sql
from boardlake.plans.views import NOW, table, view, views
from boardlake.schemas import ENTITIES, ENTITY_FIELDS, ISSUE_LIST_COLUMNS
from boardlake.session import scratch_path
from boardlake.sources.landing import page_records, read_pages

QUERIES = {}
ORACLES = {}
KEEP_NULLS = {"ignoreNullFields": "false"}


def register(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


def payloads(entity: str, frame: DataFrame, **extra) -> DataFrame:
    """Upstream-style records of a board table: one JSON object per row, with camel-case keys."""
    keys = [F.col(name).alias(key) for name, key, *_ in ENTITY_FIELDS[entity] if name in frame.columns]
    keys += [value.alias(key) for key, value in extra.items()]
    return frame.select("*", F.to_json(F.struct(*keys), KEEP_NULLS).alias("raw"))


def _now():
    return instant(F.lit(NOW))


# --- lists and lookups ---

_LISTED = "i.id, i.company_id, i.identifier, i.project_id, i.status, i.priority, i.title, i.description, i.assignee_agent_id, a.name AS assignee_name, i.created_at, i.updated_at, i.synced_at, i.comments_synced_at"
_LIST_SQL = f"SELECT {_LISTED} FROM issues i LEFT JOIN agents a ON a.id = i.assignee_agent_id"


def _list(spark: SparkSession, sf: str, **options) -> DataFrame:
    issues, agents = views(spark, sf, "issues", "agents")
    return reads.list_issues(issues, agents, **options)


@register("issue_list", f"{_LIST_SQL} ORDER BY i.updated_at DESC NULLS LAST, i.id")
def issue_list(spark, sf):
    return _list(spark, sf)


@register("issue_topk", f"{_LIST_SQL} ORDER BY i.updated_at DESC NULLS LAST, i.id LIMIT 25")
def issue_topk(spark, sf):
    return _list(spark, sf, limit=25.9)


@register("issue_filter_eq", f"{_LIST_SQL} WHERE i.company_id = 'co-1' AND i.project_id = 'pr-11' AND i.assignee_agent_id = 'ag-11'")
def issue_filter_eq(spark, sf):
    return _list(spark, sf, company_id="co-1", project_id="pr-11", assignee_agent_id="ag-11")


@register("issue_filter_status", f"{_LIST_SQL} WHERE i.status IN ('todo', 'blocked')")
def issue_filter_status(spark, sf):
    return _list(spark, sf, status=["todo", "blocked"])


@register(
    "issue_match",
    f"{_LIST_SQL} WHERE list_bool_or([lower(t) LIKE '%the_re%' FOR t IN [i.identifier, i.title, i.description] IF t IS NOT NULL])",
)
def issue_match(spark, sf):
    return _list(spark, sf, match="The_Re")


@register(
    "issue_get",
    f"SELECT {_LISTED}, i.title || '/' || i.status AS raw_json FROM issues i LEFT JOIN agents a ON a.id = i.assignee_agent_id "
    "WHERE i.id = 'en-7' OR upper(i.identifier) = 'EN-7' ORDER BY i.id LIMIT 1",
)
def issue_get(spark, sf):
    issues, agents = views(spark, sf, "issues", "agents")
    return reads.get_issue(issues.withColumn("raw_json", F.concat_ws("/", "title", "status")), agents, " en-7 ")


@register(
    "issue_thread",
    "SELECT c.issue_id, c.id, c.author_type, c.author_agent_id, a.name AS author_name, c.author_user_id, c.body, c.created_at, "
    "coalesce(a.name, c.author_agent_id, c.author_user_id, c.author_type, '?') AS author "
    "FROM comments c LEFT JOIN agents a ON a.id = c.author_agent_id ORDER BY c.issue_id, c.created_at NULLS FIRST, c.id",
)
def issue_thread(spark, sf):
    comments, agents = views(spark, sf, "comments", "agents")
    return reads.read_thread(comments, agents)


@register(
    "issue_labels",
    "SELECT i.id, coalesce(a.name, substr(i.assignee_agent_id, 1, 8), '') AS assignee FROM issues i LEFT JOIN agents a ON a.id = i.assignee_agent_id",
)
def issue_labels(spark, sf):
    return reads.with_assignee_label(_list(spark, sf)).select("id", "assignee")


@register(
    "issue_document",
    """WITH placed AS (
  SELECT c.issue_id, c.id, c.body, row_number() OVER (PARTITION BY c.issue_id ORDER BY c.created_at, c.id) - 1 AS place FROM comments c),
paged AS (SELECT issue_id, place // 3 AS page, count(*) AS n, min_by(id, place) AS first_id, max_by(body, place) AS last_body
  FROM placed GROUP BY ALL),
pages AS (SELECT id AS issue_id, 0 AS page FROM issues UNION
  SELECT p.issue_id, p.page FROM paged p JOIN issues i ON i.id = p.issue_id)
SELECT g.issue_id, CAST(g.page AS BIGINT) AS page, CAST(coalesce(p.n, 0) AS BIGINT) AS n_comments,
  i.title, i.synced_at,
  p.first_id AS first_comment, p.last_body AS last_body
FROM pages g JOIN issues i ON i.id = g.issue_id LEFT JOIN paged p ON p.issue_id = g.issue_id AND p.page = g.page""",
)
def issue_document(spark, sf):
    issues, comments, agents = views(spark, sf, "issues", "comments", "agents")
    raw = payloads("issues", issues).withColumnRenamed("raw", "raw_json")
    pages = reads.issue_documents(raw, comments, agents, page_size=3)
    item = F.from_json(F.get_json_object("document", "$.comments"), "array<struct<id:string,body:string>>")
    return pages.select(
        "issue_id", "page", "n_comments",
        F.get_json_object("document", "$.title").alias("title"),
        F.get_json_object("document", "$._mirror.synced_at").alias("synced_at"),
        F.get(item, 0)["id"].alias("first_comment"),
        F.try_element_at(item, F.lit(-1))["body"].alias("last_body"),
    )


# --- roll-ups ---

_ACTIVE = "('todo', 'in_progress', 'in_review', 'blocked')"
_SUMMARY_SQL = f"""WITH per_company AS (
  SELECT company_id, count(*) AS n, count(*) FILTER (status IN {_ACTIVE}) AS n_open FROM issues GROUP BY company_id),
last_runs AS (
  SELECT company_id, max(last_sync_at) FILTER (entity = 'issues' AND last_status = 'ok') AS synced FROM sync_state GROUP BY company_id)
SELECT c.id, c.name, c.issue_prefix, coalesce(n, 0) AS issues, coalesce(n_open, 0) AS open_issues, synced AS last_sync_at
FROM companies c LEFT JOIN per_company p ON p.company_id = c.id LEFT JOIN last_runs s ON s.company_id = c.id"""


@register("company_summary", f"{_SUMMARY_SQL} ORDER BY c.name, c.id")
def company_summary(spark, sf):
    return rollups.company_summary(*views(spark, sf, "companies", "issues", "sync_state"))


def _tables(spark, sf) -> dict[str, DataFrame]:
    return {e: view(spark, sf, e) for e in ENTITIES}


_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{e}' AS id, '{e[0].upper() + e[1:]}' AS label, count(*) AS value FROM {e}" for e in ENTITIES
)


@register("table_counts", _COUNTS_SQL)
def table_counts(spark, sf):
    return rollups.table_counts(_tables(spark, sf))


_AGE = f"epoch_ms(TIMESTAMP '{NOW[:-1]}') - epoch_ms(CAST(replace(last_sync_at, 'Z', '') AS TIMESTAMP))"


@register(
    "freshness",
    f"""WITH latest AS (SELECT max(last_sync_at) AS last_sync_at FROM sync_state WHERE last_status = 'ok')
SELECT last_sync_at, {_AGE} AS age_ms, CASE WHEN last_sync_at IS NULL THEN 'empty' WHEN {_AGE} > 1800000 THEN 'stale' ELSE 'current' END AS state,
  CAST(CAST(floor(({_AGE}) / 86400000.0 + 0.5) AS BIGINT) AS VARCHAR) || 'd ago' AS last_sync, ({_AGE}) < 300000 AS skip FROM latest""",
)
def freshness(spark, sf):
    return rollups.freshness(view(spark, sf, "sync_state"), _now())


@register(
    "freshness_by_entity",
    f"""WITH latest AS (SELECT entity, max(CASE WHEN last_status = 'ok' THEN last_sync_at END) AS last_sync_at FROM sync_state GROUP BY entity)
SELECT entity, last_sync_at, CASE WHEN last_sync_at IS NULL THEN 'empty' WHEN {_AGE} > 1800000 THEN 'stale' ELSE 'current' END AS state FROM latest""",
)
def freshness_by_entity(spark, sf):
    return rollups.freshness_by_entity(view(spark, sf, "sync_state"), _now())


@register(
    "sync_errors",
    "SELECT profile, company_id, entity, last_status, last_error FROM sync_state WHERE last_status IS NOT NULL AND last_status <> 'ok'",
)
def sync_errors(spark, sf):
    return rollups.sync_errors(view(spark, sf, "sync_state"))


@register(
    "sync_state_list",
    "SELECT profile, company_id, entity, cursor, last_sync_at, last_full_at, last_status, last_error, last_count FROM sync_state "
    "ORDER BY profile, company_id, entity",
)
def sync_state_list(spark, sf):
    return rollups.list_sync_state(view(spark, sf, "sync_state"))


def _quoted(column: str) -> str:
    return f"coalesce('\"' || {column} || '\"', 'null')"


@register(
    "status_report",
    f"""WITH latest AS (SELECT max(last_sync_at) AS last_sync_at FROM sync_state WHERE last_status = 'ok'),
summary AS ({_SUMMARY_SQL}), counts AS ({_COUNTS_SQL}),
state AS (SELECT last_sync_at, CASE WHEN {_AGE} > 1800000 THEN 'stale' ELSE 'current' END AS state,
  (SELECT value FROM counts WHERE id = 'issues') || ' issues across ' || (SELECT value FROM counts WHERE id = 'companies')
  || ' companies; last sync ' || CAST(CAST(floor(({_AGE}) / 86400000.0 + 0.5) AS BIGINT) AS VARCHAR) || 'd ago' AS headline FROM latest)
SELECT 'status' AS section, 'state' AS item, state AS value FROM state
UNION ALL SELECT 'status', 'summary', headline FROM state
UNION ALL SELECT 'status', 'last_sync_at', last_sync_at FROM state
UNION ALL SELECT 'status', 'next_step', CASE WHEN state = 'current' THEN 'none' ELSE 'sync' END FROM state
UNION ALL SELECT 'count', id, CAST(value AS VARCHAR) FROM counts
UNION ALL SELECT 'company', id, '{{"id":' || {_quoted('id')} || ',"name":' || {_quoted('name')} || ',"issue_prefix":' || {_quoted('issue_prefix')}
  || ',"issues":' || issues || ',"open_issues":' || open_issues || ',"last_sync_at":' || {_quoted('last_sync_at')} || '}}' FROM summary
UNION ALL SELECT 'sync_state', profile || '/' || company_id || '/' || entity, last_status FROM sync_state
UNION ALL SELECT 'error', profile || '/' || company_id || '/' || entity, last_error FROM sync_state WHERE last_status <> 'ok'""",
)
def status_report(spark, sf):
    return rollups.status_report(_tables(spark, sf), view(spark, sf, "sync_state"), _now())


# --- ingest ---


def _typed_sql(entity: str, **changed: str) -> str:
    given = {
        "companies": ["id", "name", "issue_prefix", "status", "updated_at"],
        "issues": ["id", "company_id", "identifier", "project_id", "status", "priority", "title", "description", "assignee_agent_id", "created_at", "updated_at"],
        "comments": ["id", "issue_id", "company_id", "author_type", "author_agent_id", "author_user_id", "body", "created_at"],
        "approvals": ["id", "company_id", "type", "status", "requested_by_agent_id", "created_at"],
        "agents": ["id", "company_id", "name", "role", "status", "updated_at"],
        "projects": ["id", "company_id", "name", "url_key", "status", "updated_at"],
    }[entity]
    columns = []
    for name, _, _, *default in ENTITY_FIELDS[entity]:
        value = changed.get(name, name if name in given else (f"'{default[0]}'" if default else "CAST(NULL AS VARCHAR)"))
        columns.append(f"{value} AS {name}")
    if entity == "companies":
        columns.append("'https://board.example' AS api_base")
    columns.append("'2024-02-09T00:00:00.000Z' AS synced_at")
    if entity == "issues":
        columns.append("CAST(NULL AS VARCHAR) AS comments_synced_at")
    return f"SELECT {', '.join(columns)} FROM {entity}"


def _project(spark, sf, entity: str) -> DataFrame:
    records = payloads(entity, view(spark, sf, entity)).select("raw")
    base = "https://board.example" if entity == "companies" else None
    return project_records(records, entity, "2024-02-09T00:00:00.000Z", base).drop("raw_json")


for _entity, _single in zip(ENTITIES, ["company", "issue", "comment", "approval", "agent", "project"]):
    register(f"project_{_single}", _typed_sql(_entity))(lambda spark, sf, entity=_entity: _project(spark, sf, entity))


@register(
    "raw_json_sink",
    "SELECT id, title, description, assignee_agent_id, '[redacted]' AS overrides, '[redacted]' AS api_token, '5' AS token_id FROM issues",
)
def raw_json_sink(spark, sf):
    overrides = F.struct(F.col("project_id").alias("note"))
    extra = F.struct(F.col("identifier").alias("apiToken"), F.lit(5).alias("tokenId"))
    records = payloads("issues", view(spark, sf, "issues"), assigneeAdapterOverrides=overrides, extra=extra).select("raw")
    stored = project_records(records, "issues", "2024-02-09T00:00:00.000Z")
    paths = {
        "title": "$.title", "description": "$.description", "assignee_agent_id": "$.assigneeAgentId",
        "overrides": "$.assigneeAdapterOverrides", "api_token": "$.extra.apiToken", "token_id": "$.extra.tokenId",
    }
    return stored.select("id", *[F.get_json_object("raw_json", path).alias(name) for name, path in paths.items()])


_SHAPES = {
    "view": '[{"id":"a%s"},{"id":"b%s"}]',
    "click": '{"total":2,"data":[{"id":"a%s"},{"id":"b%s"}]}',
    "purchase": '{"issues":{"n":1},"items":[{"id":"a%s"},{"id":"b%s"}],"rows":[{"id":"x"}]}',
    "signup": '{"issues":[],"items":[{"id":"a%s"}],"note":"%s"}',
    "error": '{"list":[{"id":"a%s"}],"note":"%s"}',
}


@register(
    "envelope_unwrap",
    """SELECT event_id, CAST(i AS BIGINT) AS item, CASE WHEN i = 0 THEN 'a' ELSE 'b' END || CAST(event_id AS VARCHAR) AS id
FROM (SELECT event_id, unnest([0, 1]) AS i FROM events WHERE event_type IN ('view', 'click', 'purchase')) AS listed""",
)
def envelope_unwrap(spark, sf):
    payload = F.lit(None).cast("string")
    for kind, shape in _SHAPES.items():
        payload = F.when(F.col("event_type") == kind, F.format_string(shape, F.col("event_id").cast("string"), F.col("event_id").cast("string"))).otherwise(payload)
    pages = table(spark, sf, "events").select("event_id", payload.alias("payload"))
    return page_records(pages).select("event_id", F.col("item").cast("bigint").alias("item"), F.get_json_object("raw", "$.id").alias("id"))


def issue_pages(issues: DataFrame, size: int = 500) -> DataFrame:
    """Issue listing as landed pages of at most ``size`` records each: ids number the documents, so a page is a range of them.

    Ranges without a record are empty pages, so that the numbers have no gaps.
    """
    number = F.floor(F.substring_index("id", "-", -1).cast("bigint") / size).cast("bigint")
    records = payloads("issues", issues).withColumn("page_no", number)
    ends = issues.groupBy("company_id").agg(F.max(number).alias("end"))
    every = ends.select("company_id", "end", F.explode(F.sequence(F.lit(0).cast("bigint"), "end")).alias("page_no"))
    filled = every.join(records, ["company_id", "page_no"], "left")
    listed = filled.groupBy("company_id", "page_no", "end").agg(F.sort_array(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("id", "raw")))).alias("rows"))
    body = F.concat(F.lit('{"issues":['), F.array_join("rows.raw", ","), F.lit("]}"))
    return listed.select(
        F.concat(F.lit("p-"), "company_id").alias("profile"), "company_id", F.lit("issues").alias("entity"),
        F.lit(None).cast("string").alias("issue_id"), "page_no", body.alias("payload"), F.lit(None).cast("string").alias("error"),
        (F.col("page_no") == F.col("end")).alias("last"),
    )


@register("ingest_pages", _typed_sql("issues"))
def ingest_pages(spark, sf):
    path = scratch_path(spark, "pages")
    issue_pages(view(spark, sf, "issues")).write.json(path)
    records = page_records(read_pages(spark, path)).select("raw")
    return project_records(records, "issues", "2024-02-09T00:00:00.000Z").drop("raw_json")


@register(
    "fallback_source",
    """SELECT 'cu-' || c_custkey AS id, CASE WHEN c_acctbal >= 0 THEN c_name ELSE c_mktsegment END AS name,
  CASE WHEN c_acctbal >= 0 THEN 'record' ELSE 'list' END AS source FROM customer""",
)
def fallback_source(spark, sf):
    customers = table(spark, sf, "customer").withColumn("id", F.concat(F.lit("cu-"), F.col("c_custkey").cast("string")))
    readable = customers.filter("c_acctbal >= 0").select("id", F.col("c_name").alias("name"), F.lit("record").alias("source"))
    listed = customers.select("id", F.col("c_mktsegment").alias("name"), F.lit("list").alias("source"))
    return fallback_rows(readable, listed)


# --- scalar functions ---

_FLAT = r"trim(regexp_replace(coalesce(text, ''), '[\s\p{Z}\x{FEFF}]+', ' ', 'g'))"


@register("text_truncate", f"SELECT doc_id, CASE WHEN length({_FLAT}) > 100 THEN substr({_FLAT}, 1, 99) || '…' ELSE {_FLAT} END AS short FROM documents")
def text_truncate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.truncate(F.col("text"), 100).alias("short"))


@register(
    "relative_time",
    """WITH ages AS (SELECT event_id, greatest(0, CAST(floor((epoch_ms(TIMESTAMP '2024-01-16T00:00:00') - epoch_ms(date_trunc('millisecond', ts))) / 1000.0 + 0.5) AS BIGINT)) AS s,
  event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS stamp FROM events),
steps AS (SELECT *, CAST(floor(s / 60.0 + 0.5) AS BIGINT) AS m FROM ages),
more AS (SELECT *, CAST(floor(m / 60.0 + 0.5) AS BIGINT) AS h FROM steps)
SELECT event_id, CASE WHEN event_type = 'error' THEN 'at ' || stamp WHEN event_type = 'signup' THEN 'never' WHEN s < 60 THEN s || 's ago' WHEN m < 60 THEN m || 'm ago' WHEN h < 48 THEN h || 'h ago'
  ELSE CAST(floor(h / 24.0 + 0.5) AS BIGINT) || 'd ago' END AS age FROM more""",
)
def relative_times(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    given = F.when(F.col("event_type") == "error", F.concat(F.lit("at "), stamp)).when(F.col("event_type") != "signup", stamp)
    now = instant(F.lit("2024-01-16T00:00:00.000Z"))
    return table(spark, sf, "events").select("event_id", relative_time(given, now).alias("age"))


@register(
    "parse_duration",
    r"""WITH given AS (SELECT event_id, event_type, CAST(regexp_extract(props, '\d+', 0) AS BIGINT) AS n FROM events)
SELECT event_id, CASE event_type WHEN 'view' THEN n WHEN 'click' THEN n * 1000 WHEN 'purchase' THEN n * 60000 WHEN 'signup' THEN n * 86400000 END AS ms FROM given""",
)
def parse_durations(spark, sf):
    number = F.regexp_extract("props", r"\d+", 0)
    kind = F.col("event_type")
    written = (
        F.when(kind == "view", F.concat(number, F.lit("ms"))).when(kind == "click", F.concat(F.lit(" "), number))
        .when(kind == "purchase", F.concat(number, F.lit(" m "))).when(kind == "signup", F.concat(number, F.lit("d")))
        .otherwise(F.concat(number, F.lit("w")))
    )
    return table(spark, sf, "events").select("event_id", duration_ms(written).alias("ms"))


_ITEMS = r"list_filter(list_transform(string_split(text, ','), lambda x: regexp_replace(x, '^[\s\p{Z}\x{FEFF}]+|[\s\p{Z}\x{FEFF}]+$', '', 'g')), lambda x: x <> '')"


@register("csv_split", f"SELECT doc_id, len({_ITEMS}) AS items, array_to_string({_ITEMS}, '|') AS listed FROM documents")
def csv_splits(spark, sf):
    items = X.csv_split(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(items).cast("bigint").alias("items"), F.array_join(items, "|").alias("listed"))


# --- SQL ---

_USER_SQL = """WITH spent AS (
  SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS orders FROM orders GROUP BY o_custkey)
SELECT c.c_mktsegment AS segment, count(*) AS customers, cast(sum(s.orders) AS bigint) AS orders, round(sum(s.total), 2) AS total,
  max(s.orders) AS most FROM customer c JOIN spent s ON s.o_custkey = c.c_custkey GROUP BY c.c_mktsegment"""


@register("sql_readonly", _USER_SQL)
def sql_readonly(spark, sf):
    for name in ("orders", "customer"):
        table(spark, sf, name).createOrReplaceTempView(name)
    return run_sql(spark, _USER_SQL)
