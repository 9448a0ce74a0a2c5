"""Filtered lists, one-issue lookup, threads and issue documents."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.functions.text import assignee_label, author_label
from boardlake.operators.grouping import with_positions
from boardlake.schemas import COMMENT_PAGE, ISSUE_LIST_COLUMNS


def with_columns_of(frame: DataFrame, names: list[str]) -> DataFrame:
    """Add missing text columns as NULL, so that partial tables read like full ones."""
    missing = [name for name in names if name not in frame.columns]
    return frame.select("*", *[F.lit(None).cast("string").alias(name) for name in missing])


def list_limit(limit: float | None) -> int | None:
    """Row limit of a list: none, zero and NaN mean no limit; anything else is at least one."""
    if not limit or math.isnan(limit):
        return None
    return max(1, math.floor(limit))


def status_in(column: str, statuses: list[str] | None) -> Column | None:
    return F.col(column).isin(*statuses) if statuses else None


def equals(column: str, value: str | None) -> Column | None:
    return F.col(column) == value if value else None


def matches_text(text: str | None, columns: list[str]) -> Column | None:
    """Case-insensitive substring of any column; ``%`` and ``_`` in the text are wildcards."""
    if not text:
        return None
    pattern = "%" + text.lower().replace("\\", "\\\\") + "%"
    return reduce(lambda a, b: a | b, [F.coalesce(F.lower(c).like(pattern), F.lit(False)) for c in columns])


def keep_if(frame: DataFrame, *conditions: Column | None) -> DataFrame:
    """Apply the given conditions; absent ones do not filter."""
    return reduce(lambda rows, condition: rows.filter(condition), [c for c in conditions if c is not None], frame)


def agent_names(agents: DataFrame, key: str, name: str) -> DataFrame:
    return agents.select(F.col("id").alias(key), F.col("name").alias(name))


def list_issues(
    issues: DataFrame,
    agents: DataFrame,
    company_id: str | None = None,
    status: list[str] | None = None,
    assignee_agent_id: str | None = None,
    project_id: str | None = None,
    match: str | None = None,
    limit: float | None = None,
) -> DataFrame:
    """Issues with their assignee's name, newest change first.

    Filters run before the join and reach the scan. With a limit only the listed rows meet the
    agents, since the outer join neither drops nor repeats issues (agent ids are unique).
    """
    rows = keep_if(
        with_columns_of(issues, [c for c in ISSUE_LIST_COLUMNS if c != "assignee_name"]),
        equals("company_id", company_id),
        status_in("status", status),
        equals("assignee_agent_id", assignee_agent_id),
        equals("project_id", project_id),
        matches_text(match, ["identifier", "title", "description"]),
    )
    newest_first = [F.col("updated_at").desc_nulls_last(), F.col("id")]
    count = list_limit(limit)
    if count is not None:
        rows = rows.orderBy(*newest_first).limit(count)
    named = rows.join(agent_names(agents, "assignee_agent_id", "assignee_name"), "assignee_agent_id", "left")
    return named.select(*ISSUE_LIST_COLUMNS).orderBy(*newest_first)


def with_assignee_label(listed: DataFrame) -> DataFrame:
    return listed.withColumn("assignee", assignee_label(F.col("assignee_name"), F.col("assignee_agent_id")))


def find_issue(issues: DataFrame, key: str, company_id: str | None = None) -> DataFrame:
    """At most one issue by id, or by identifier in any case; the smallest id wins a tie."""
    wanted = key.strip()
    rows = keep_if(
        issues, (F.col("id") == wanted) | (F.upper("identifier") == wanted.upper()), equals("company_id", company_id)
    )
    return rows.orderBy("id").limit(1)


def get_issue(issues: DataFrame, agents: DataFrame, key: str, company_id: str | None = None) -> DataFrame:
    """The issue row of ``find_issue`` with assignee name and raw payload."""
    columns = [c for c in ISSUE_LIST_COLUMNS if c != "assignee_name"] + ["raw_json"]
    row = find_issue(with_columns_of(issues, columns), key, company_id)
    named = row.join(agent_names(agents, "assignee_agent_id", "assignee_name"), "assignee_agent_id", "left")
    return named.select(*ISSUE_LIST_COLUMNS, "raw_json")


THREAD_COLUMNS = ["issue_id", "id", "author_type", "author_agent_id", "author_name", "author_user_id", "body", "created_at"]


def named_comments(comments: DataFrame, agents: DataFrame) -> DataFrame:
    source = with_columns_of(comments, [c for c in THREAD_COLUMNS if c != "author_name"])
    named = source.join(agent_names(agents, "author_agent_id", "author_name"), "author_agent_id", "left")
    return named.select(*THREAD_COLUMNS)


def read_thread(comments: DataFrame, agents: DataFrame, issues: DataFrame | None = None) -> DataFrame:
    """Comments with author names in thread order; ``issues`` restricts them to some issues' threads."""
    if issues is not None:
        comments = comments.join(issues.select(F.col("id").alias("issue_id")), "issue_id", "left_semi")
    author = author_label(F.col("author_name"), F.col("author_agent_id"), F.col("author_user_id"), F.col("author_type"))
    return (
        named_comments(comments, agents)
        .withColumn("author", author)
        .orderBy("issue_id", F.col("created_at").asc_nulls_first(), "id")
    )


def thread_pages(comments: DataFrame, agents: DataFrame, page_size: int = COMMENT_PAGE) -> DataFrame:
    """Threads as arrays of at most ``page_size`` comments, so that no array grows with a hot issue."""
    order = [F.col("created_at").asc_nulls_first(), F.col("id").asc()]
    # Parts by the minute of the text: a prefix sorts like the text it begins.
    placed = with_positions(named_comments(comments, agents), ["issue_id"], order, F.substring("created_at", 1, 16))
    paged = placed.withColumn("page", F.floor(F.col("position") / page_size).cast("bigint"))
    item = F.struct("position", *[c for c in THREAD_COLUMNS if c != "issue_id"])
    grouped = paged.groupBy("issue_id", "page").agg(F.sort_array(F.collect_list(item)).alias("comments"))
    return grouped.withColumn("comments", F.transform("comments", lambda c: c.dropFields("position")))


def issue_documents(
    issues: DataFrame,
    comments: DataFrame,
    agents: DataFrame,
    page_size: int = COMMENT_PAGE,
) -> DataFrame:
    """Issues as JSON documents with nested threads.

    Every page holds the payload with ``_mirror`` stamps and its part of the comments; longer threads go on in
    further pages. Our ``comments`` and ``_mirror`` keys replace those of the payload.
    """
    head = with_columns_of(issues, ["synced_at", "comments_synced_at", "raw_json"]).select(
        F.col("id").alias("issue_id"), "raw_json", "synced_at", "comments_synced_at"
    )
    pages = thread_pages(comments, agents, page_size)
    # An issue without comments has one page.
    rows = head.join(pages, "issue_id", "left").withColumn("page", F.coalesce("page", F.lit(0)).cast("bigint"))
    keep_nulls = {"ignoreNullFields": "false"}
    thread = F.to_json(F.coalesce("comments", F.array().cast(pages.schema["comments"].dataType)), keep_nulls)
    mirror = F.to_json(F.struct("synced_at", "comments_synced_at"), keep_nulls)
    payload = F.from_json(F.coalesce("raw_json", F.lit("{}")), "map<string,variant>")
    own = F.map_from_arrays(
        F.array(F.lit("_mirror"), F.lit("comments")), F.array(F.parse_json(mirror), F.parse_json(thread))
    )
    merged = F.map_concat(F.map_filter(payload, lambda key, _: ~key.isin("_mirror", "comments")), own)
    document = F.to_json(merged, keep_nulls)
    return rows.select("issue_id", "page", F.coalesce(F.size("comments"), F.lit(0)).cast("bigint").alias("n_comments"), document.alias("document"))


def issue_document(
    issues: DataFrame, comments: DataFrame, agents: DataFrame, key: str, company_id: str | None = None
) -> DataFrame:
    """Document pages of one issue."""
    one = find_issue(issues, key, company_id)
    thread = comments.join(one.select(F.col("id").alias("issue_id")), "issue_id", "left_semi")
    return issue_documents(one, thread, agents).orderBy("page")
