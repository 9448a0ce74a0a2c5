"""Registered redaction and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from boardlake.operators.audit import parity_by_digests, parity_diff, redaction_audit, secret_scan, secret_scan_many
from boardlake.operators.redaction import redact_columns, redact_json
from boardlake.plans.views import table, view, views
from boardlake.schemas import PARITY_FIELDS

QUERIES = {}
ORACLES = {}


def register(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


@register(
    "redact_fields",
    """SELECT c_custkey, c_name AS name, '[redacted]' AS adapter_config, '[redacted]' AS permissions,
  CASE WHEN c_acctbal >= 0 THEN '[redacted]' END AS api_key, CAST(c_nationkey AS VARCHAR) AS token_id, c_mktsegment AS inner_note, '[redacted]' AS inner_token FROM customer""",
)
def redact_fields(spark, sf):
    """Typed rows, redacted by expressions alone."""
    customers = table(spark, sf, "customer")
    agents = customers.select(
        "c_custkey", F.col("c_name").alias("name"),
        F.struct(F.col("c_name").alias("url")).alias("adapterConfig"),
        F.lit(None).cast("string").alias("permissions"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("apiKey"),
        F.col("c_nationkey").cast("string").alias("tokenId"),
        F.array(F.struct(F.col("c_mktsegment").alias("note"), F.col("c_name").alias("Bearer_Token"))).alias("history"),
    )
    clean = redact_columns(agents, "agents")
    return clean.select(
        "c_custkey", "name", F.col("adapterConfig").alias("adapter_config"), "permissions", F.col("apiKey").alias("api_key"),
        F.col("tokenId").alias("token_id"), F.get("history", 0)["note"].alias("inner_note"), F.get("history", 0)["Bearer_Token"].alias("inner_token"),
    )


@register(
    "redact_map",
    """SELECT event_id, event_type AS kind, CASE WHEN event_type = 'error' THEN NULL ELSE '[redacted]' END AS cookie FROM events""",
)
def redact_map(spark, sf):
    """Map entries follow the same key rules."""
    entries = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("Cookie"), F.when(F.col("event_type") != "error", F.col("props")))
    clean = redact_columns(table(spark, sf, "events").select("event_id", entries.alias("attributes")), "comments")
    return clean.select("event_id", F.col("attributes").getItem("kind").alias("kind"), F.col("attributes").getItem("Cookie").alias("cookie"))


@register(
    "redact_sweep",
    """SELECT event_id, '[redacted]' AS env, '[redacted]' AS codebase, CAST(regexp_extract(props, '\\d+', 0) AS VARCHAR) AS k,
  '[redacted]' AS secret, CASE WHEN event_type = 'error' THEN NULL ELSE '[redacted]' END AS password, event_type AS token_name,
  event_type AS deep_note, '[redacted]' AS deep_key FROM events""",
)
def redact_sweep(spark, sf):
    """Opaque JSON of projects: withheld keys and secret-looking keys at any depth."""
    kind = F.col("event_type")
    inner = F.struct(
        F.from_json("props", "k bigint").getField("k").alias("k"),
        F.array(F.struct(F.col("user_id").alias("client_Secret"), F.array(kind).alias("list"))).alias("items"),
        F.when(kind != "error", F.col("value")).alias("Password"),
        kind.alias("tokenName"),
        F.struct(kind.alias("note"), F.struct(kind.alias("x")).alias("private-key")).alias("deep"),
    )
    document = F.to_json(
        F.struct("event_id", F.col("props").alias("env"), F.lit(None).cast("string").alias("codebase"), inner.alias("data")), {"ignoreNullFields": "false"}
    )
    clean = table(spark, sf, "events").select("event_id", redact_json(document, "projects").alias("raw"))
    paths = {
        "env": "$.env", "codebase": "$.codebase", "k": "$.data.k", "secret": "$.data.items[0].client_Secret", "password": "$.data.Password",
        "token_name": "$.data.tokenName", "deep_note": "$.data.deep.note", "deep_key": "$.data.deep.private-key",
    }
    return clean.select("event_id", *[F.get_json_object("raw", p).alias(n) for n, p in paths.items()])


# Texts looked for: long enough ones count, in any case, literally.
_TOKENS = ["Board.Example", "supplier#00000", "Reeoria Token", "the there_re", "token = \"2321bac4d15ec8f9", "of the thing", "short"]
_USABLE = sorted(t for t in _TOKENS if len(t) >= 12)
# Text of a record per scanned table: the six entities, the key-value table and landed pages.
_META = "SELECT concat('api_base ', id) AS key, api_base AS value FROM companies"
_SCANNED = {
    "companies": ["id", "name", "api_base"], "projects": ["id", "name", "url_key"], "agents": ["id", "name", "role"],
    "issues": ["id", "identifier", "title", "description"], "comments": ["id", "author_agent_id", "body"],
    "approvals": ["id", "type", "requested_by_agent_id"], "meta": ["key", "value"], "pages": ["html"],
}


@register(
    "secret_scan",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", CAST({i} AS BIGINT) AS token_no, count(*) FILTER (WHERE contains(lower(concat_ws(' | ', {', '.join(c)})), '{token.lower()}')) AS leaks FROM {f'({_META}) AS meta' if t == 'meta' else t}"
        for t, c in _SCANNED.items()
        for i, token in enumerate(_USABLE)
    ),
)
def secrets(spark, sf):
    """All stored records, the key-value table and the landed pages."""
    entities = {name: view(spark, sf, name) for name in _SCANNED if name not in ("meta", "pages")}
    meta = spark.sql(_META.replace("companies", "{companies}"), companies=entities["companies"])
    scanned = {**entities, "meta": meta, "pages": table(spark, sf, "pages")}
    texts = {name: rows.select(F.concat_ws(" | ", *_SCANNED[name]).alias("record")) for name, rows in scanned.items()}
    return secret_scan({name: (rows, "record") for name, rows in texts.items()}, _TOKENS)


@register(
    "secret_scan_many",
    """WITH sought AS (SELECT lower(t) AS token, row_number() OVER (ORDER BY t) - 1 AS token_no FROM (SELECT DISTINCT substr(text, 5, 16) AS t FROM benchmark WHERE strlen(text) = length(text)) AS s),
records AS (SELECT 'issues' AS "table", lower(description) AS record FROM issues UNION ALL SELECT 'comments', lower(body) FROM comments)
SELECT n."table", token_no, CAST(count(record) AS BIGINT) AS leaks FROM sought CROSS JOIN (SELECT unnest(['issues', 'comments']) AS "table") AS n
LEFT JOIN records r ON r."table" = n."table" AND contains(record, token) GROUP BY n."table", token_no""",
)
def many_secrets(spark, sf):
    """A piece of every benchmark item as a credential, sought in issues and comments at once."""
    items = table(spark, sf, "benchmark").filter(F.octet_length("text") == F.length("text"))
    tokens = [r.t for r in items.select(F.substring("text", 5, 16).alias("t")).distinct().collect()]
    issues, comments = views(spark, sf, "issues", "comments")
    return secret_scan_many({"issues": (issues, "description"), "comments": (comments, "body")}, tokens)


@register(
    "redaction_audit",
    """SELECT 'issues' AS entity, count(*) AS rows, count(*) FILTER (WHERE lang = 'en') AS unredacted FROM documents
UNION ALL SELECT 'agents', count(*), count(*) FILTER (WHERE s_acctbal < 0) FROM supplier
UNION ALL SELECT 'projects', count(*), count(*) FILTER (WHERE n_regionkey = 0) FROM nation""",
)
def audit(spark, sf):
    issues = table(spark, sf, "documents").select(
        F.to_json(F.struct("text", F.when(F.col("lang") == "en", F.struct("source")).alias("executionWorkspaceSettings"))).alias("raw_json")
    )
    held = F.when(F.col("s_acctbal") < 0, F.to_json(F.struct("s_name"))).otherwise(F.lit('"[redacted]"'))
    agents = table(spark, sf, "supplier").select(F.concat(F.lit('{"id":1,"runtimeConfig":'), held, F.lit("}")).alias("raw_json"))
    env = F.when(F.col("n_regionkey") == 0, F.to_json(F.struct("n_name"))).otherwise(F.lit('"[redacted]"'))
    projects = table(spark, sf, "nation").select(F.concat(F.lit('{"id":1,"env":'), env, F.lit("}")).alias("raw_json"))
    return redaction_audit({"issues": issues, "agents": agents, "projects": projects})


_SIDES = "FROM orders_stored m FULL JOIN orders_listed l ON l.id = m.id"


@register(
    "parity_diff",
    f"""SELECT coalesce(m.id, l.id) AS id, 'id' AS field, m.id AS mirror, l.id AS live {_SIDES} WHERE m.id IS NULL OR l.id IS NULL
UNION ALL SELECT m.id, 'status', m.status, l.status {_SIDES} WHERE m.status <> l.status
UNION ALL SELECT m.id, 'updated_at', m.updated_at, l.updated_at {_SIDES} WHERE m.updated_at <> l.updated_at
UNION ALL SELECT m.id, 'company_id', m.company_id, l.company_id {_SIDES} WHERE m.company_id <> l.company_id""",
)
def parity(spark, sf):
    mirror, live = views(spark, sf, "orders_stored", "orders_listed")
    return parity_diff(mirror, live, ["id", "company_id", "status", "updated_at"])


@register("parity_digests", ORACLES["parity_diff"])
def parity_digests(spark, sf):
    """The same differences, found by digests first."""
    mirror, live = views(spark, sf, "orders_stored", "orders_listed")
    return parity_by_digests(mirror, live, ["id", "company_id", "status", "updated_at"])


@register(
    "parity_issues",
    """SELECT i.id, 'priority' AS field, i.priority AS mirror, CAST(NULL AS VARCHAR) AS live FROM issues i WHERE i.priority = 'low'
UNION ALL SELECT i.id, 'assignee_agent_id', NULL, 'none' FROM issues i WHERE i.assignee_agent_id IS NULL""",
)
def parity_issues(spark, sf):
    """The seven compared fields of issues: a lost value and a value in place of NULL both count."""
    mirror = view(spark, sf, "issues")
    live = mirror.withColumn("priority", F.when(F.col("priority") != "low", F.col("priority"))).withColumn(
        "assignee_agent_id", F.coalesce("assignee_agent_id", F.lit("none"))
    )
    return parity_diff(mirror, live, PARITY_FIELDS)
