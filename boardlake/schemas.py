"""Declared schemas of the board tables and of the upstream payloads."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: status names, redaction sentinel, envelope keys, page sizes, search defaults ---
ACTIVE_STATUSES = ["todo", "in_progress", "in_review", "blocked"]
UNKNOWN_STATUS = "unknown"
REDACTED = "[redacted]"
ENVELOPE_KEYS = ["issues", "items", "data", "rows", "results"]
COMMENT_PAGE = 500
STALE_AFTER_MS = 30 * 60 * 1000
SEARCH_LIMIT = 25
SNIPPET_TOKENS = 18
MIN_TOKEN_LENGTH = 12

# Typed columns of each entity: (column, payload key, rule).
#   id    required text; rows without it are quarantined
#   text  strings as they are, other JSON values as their JSON text
#   time  strings only, not validated
# A fourth item is the default for a missing or null value.
ENTITY_FIELDS: dict[str, list[tuple]] = {
    "companies": [
        ("id", "id", "id"),
        ("name", "name", "text", ""),
        ("issue_prefix", "issuePrefix", "text"),
        ("status", "status", "text"),
        ("updated_at", "updatedAt", "time"),
    ],
    "issues": [
        ("id", "id", "id"),
        ("company_id", "companyId", "id"),
        ("identifier", "identifier", "text"),
        ("project_id", "projectId", "text"),
        ("goal_id", "goalId", "text"),
        ("parent_id", "parentId", "text"),
        ("status", "status", "text", UNKNOWN_STATUS),
        ("priority", "priority", "text"),
        ("title", "title", "text", ""),
        ("description", "description", "text"),
        ("assignee_agent_id", "assigneeAgentId", "text"),
        ("assignee_user_id", "assigneeUserId", "text"),
        ("created_at", "createdAt", "time"),
        ("updated_at", "updatedAt", "time"),
        ("completed_at", "completedAt", "time"),
    ],
    "comments": [
        ("id", "id", "id"),
        ("issue_id", "issueId", "id"),
        ("company_id", "companyId", "id"),
        ("author_type", "authorType", "text"),
        ("author_agent_id", "authorAgentId", "text"),
        ("author_user_id", "authorUserId", "text"),
        ("body", "body", "text", ""),
        ("created_at", "createdAt", "time"),
        ("updated_at", "updatedAt", "time"),
    ],
    "approvals": [
        ("id", "id", "id"),
        ("company_id", "companyId", "id"),
        ("type", "type", "text"),
        ("status", "status", "text"),
        ("requested_by_agent_id", "requestedByAgentId", "text"),
        ("created_at", "createdAt", "time"),
        ("updated_at", "updatedAt", "time"),
    ],
    "agents": [
        ("id", "id", "id"),
        ("company_id", "companyId", "id"),
        ("name", "name", "text", ""),
        ("url_key", "urlKey", "text"),
        ("role", "role", "text"),
        ("title", "title", "text"),
        ("status", "status", "text"),
        ("reports_to", "reportsTo", "text"),
        ("updated_at", "updatedAt", "time"),
    ],
    "projects": [
        ("id", "id", "id"),
        ("company_id", "companyId", "id"),
        ("name", "name", "text", ""),
        ("url_key", "urlKey", "text"),
        ("status", "status", "text"),
        ("lead_agent_id", "leadAgentId", "text"),
        ("updated_at", "updatedAt", "time"),
    ],
}
ENTITIES = ["companies", "issues", "comments", "approvals", "agents", "projects"]
DIRECTORY_ENTITIES = ["agents", "projects", "approvals"]

# Keys whose whole value is withheld, per entity; present keys become the sentinel even when null.
WITHHELD_KEYS: dict[str, list[str]] = {
    "agents": ["adapterConfig", "runtimeConfig", "permissions", "metadata"],
    "projects": ["env", "codebase", "workspaces", "primaryWorkspace"],
    "issues": ["assigneeAdapterOverrides", "executionWorkspaceSettings"],
    "companies": [],
    "comments": [],
    "approvals": [],
}
# Key pattern of the recursive sweep, and the keys it leaves alone (case-sensitive).
SECRET_KEY_PATTERN = (
    r"(token|secret|password|passwd|api[_-]?key|apikey|private[_-]?key|credential|authorization|bearer|cookie)"
)
ALLOWED_KEYS = [
    "tokenName", "tokenId", "tokenCreatedAt", "apiKeyEnvVarName", "checkoutRunId",
    "credentialId", "hasCredential", "requiresCredential",
]
MAX_SWEEP_DEPTH = 32

# Fields compared between the mirror and the live records.
PARITY_FIELDS = ["id", "identifier", "title", "status", "priority", "assignee_agent_id", "updated_at"]

ISSUE_LIST_COLUMNS = [
    "id", "company_id", "identifier", "project_id", "status", "priority", "title", "description",
    "assignee_agent_id", "assignee_name", "created_at", "updated_at", "synced_at", "comments_synced_at",
]
# --- end of fixed values ---


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def entity_schema(entity: str) -> T.StructType:
    """Stored schema: typed columns, bookkeeping stamps and the redacted payload."""
    names = [f[0] for f in ENTITY_FIELDS[entity]]
    if entity == "companies":
        names.append("api_base")
    names.append("synced_at")
    if entity == "issues":
        names.append("comments_synced_at")
    return T.StructType(_texts(*names, "raw_json"))


def payload_ddl(entity: str) -> str:
    """``from_json`` schema of one record: time keys stay VARIANT so that their JSON type is known."""
    return ", ".join(
        f"{key} {'variant' if rule == 'time' else 'string'}" for _, key, rule, *_ in ENTITY_FIELDS[entity]
    )


SYNC_STATE = T.StructType(
    _texts("profile", "company_id", "entity", "cursor", "last_sync_at", "last_full_at", "last_status", "last_error")
    + [T.StructField("last_count", T.LongType())]
)
SYNC_STATE_KEYS = ["profile", "company_id", "entity"]
SYNC_STATE_FIELDS = [f.name for f in SYNC_STATE.fields if f.name not in SYNC_STATE_KEYS]
META = T.StructType(_texts("key", "value"))
SYNC_RUNS = T.StructType(
    [T.StructField("id", T.LongType())]
    + _texts("started_at", "finished_at", "mode", "profiles", "status", "summary_json")
)
# One landed page: the raw response text, or the error that came instead. Pages of a listing or thread are numbered
# from 0 without gaps; ``last`` marks the one it ends with, which is known when the page is fetched (a page shorter
# than asked for, or one with rows older than the bound of an incremental pull).
LANDED_PAGE = T.StructType(
    _texts("profile", "company_id", "entity", "issue_id")
    + [T.StructField("page_no", T.LongType())]
    + _texts("payload", "error")
    + [T.StructField("last", T.BooleanType())]
)
SYNC_TARGET = T.StructType(
    [T.StructField("position", T.LongType())] + _texts("profile", "api_base", "company_id")
)
