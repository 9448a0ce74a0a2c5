"""Keyed upserts, change detection, pruning and thread replacement on plain tables.

Every function takes and returns frames. Incoming batches are usually far smaller than the stored
table, so the plans touch the stored side with anti and semi joins only: below the broadcast
threshold they run without shuffling it, above it Spark falls back to sort-merge joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.functions.text import strip_slashes
from boardlake.functions.timing import duration_ms, instant, millis
from boardlake.operators.grouping import latest_per_key
from boardlake.schemas import ACTIVE_STATUSES, SYNC_STATE_FIELDS, SYNC_STATE_KEYS


def upsert(
    stored: DataFrame, batch: DataFrame, keys: list[str], order: list[Column | str] | None = None, preserve: list[str] | None = None
) -> DataFrame:
    """Last write wins per key. ``preserve`` columns keep the stored value of existing rows.

    ``order`` ranks repeated keys within the batch; without it the batch must be unique per key.
    """
    preserve = preserve or []
    # Semi and anti joins do not mind repeated keys, so they need not wait for the deduplication.
    touched = batch.select(*keys)
    if order:
        batch = latest_per_key(batch, keys, order)
    fresh = batch.select(*[c for c in stored.columns if c in batch.columns and c not in preserve])
    if preserve:
        kept = stored.join(touched, keys, "left_semi").select(*keys, *preserve)
        fresh = fresh.join(kept, keys, "left")
    untouched = stored.join(touched, keys, "left_anti")
    return untouched.unionByName(fresh, allowMissingColumns=True)


def upsert_issues(stored: DataFrame, batch: DataFrame, order: list[Column | str] | None = None) -> DataFrame:
    """Issues keep the stamp of their last thread read."""
    return upsert(stored, batch, ["id"], order, preserve=["comments_synced_at"])


def put_values(meta: DataFrame, values: DataFrame, order: list[Column | str] | None = None) -> DataFrame:
    """Key-value upsert."""
    return upsert(meta, values, ["key"], order)


def partial_upsert(
    stored: DataFrame,
    patches: DataFrame,
    keys: list[str] = SYNC_STATE_KEYS,
    fields: list[str] = SYNC_STATE_FIELDS,
    order: str = "seq",
) -> DataFrame:
    """Patch single fields per key: only fields named in ``fields_set`` change, and they may become NULL.

    Several patches of one key apply in ``order``: each field takes its latest setting.
    """

    def latest(field: str) -> list[Column]:
        turn = F.when(F.array_contains("fields_set", field), F.col(order))
        boxed = F.when(turn.isNotNull(), F.struct(F.col(field)))
        return [F.max_by(boxed, turn).alias(f"_{field}")]

    merged = patches.groupBy(*keys).agg(*[c for f in fields for c in latest(f)])
    joined = stored.join(merged, keys, "full_outer")
    values = [
        F.when(F.col(f"_{f}").isNotNull(), F.col(f"_{f}").getField(f)).otherwise(F.col(f)).alias(f) for f in fields
    ]
    return joined.select(*keys, *values)


def detect_changes(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Flag incoming rows that are new or whose ``updated_at`` text differs from the stored one."""
    # The semi join cuts the stored rows to those of the batch, so that a small batch never shuffles the store.
    asked = stored.join(incoming.select("id"), "id", "left_semi")
    known = asked.select("id", F.col("updated_at").alias("_stored_at"), F.lit(True).alias("_known"))
    differs = F.col("_known").isNull() | ~F.col("_stored_at").eqNullSafe(F.col("updated_at"))
    return incoming.join(known, "id", "left").withColumn("changed", differs).drop("_known", "_stored_at")


def prune_unlisted(stored: DataFrame, listed: DataFrame, scope: DataFrame) -> DataFrame:
    """Drop rows of the companies in ``scope`` whose id is not in a complete listing."""
    companies = scope.select("company_id").distinct().withColumn("_scoped", F.lit(True))
    ids = listed.select("id").distinct().withColumn("_listed", F.lit(True))
    stale = F.col("_scoped").isNotNull() & F.col("_listed").isNull()
    return stored.join(companies, "company_id", "left").join(ids, "id", "left").filter(~stale).select(*stored.columns)


def _stale_in(stored: DataFrame, runs: DataFrame, how: str) -> DataFrame:
    starts = runs.select(F.col("company_id").alias("_company"), F.col("started_at").alias("_started"))
    older = (F.col("company_id") == F.col("_company")) & (F.col("synced_at") < F.col("_started"))
    return stored.join(starts, older, how)


def prune_stale(stored: DataFrame, runs: DataFrame, protected: DataFrame | None = None) -> DataFrame:
    """Drop rows a run did not touch; ``runs`` holds company_id and started_at of complete listings.

    Rows whose id is in ``protected`` stay: they were listed, though not in a form that can be stored.
    """
    if protected is None:
        return _stale_in(stored, runs, "left_anti")
    return drop_rows(stored, stale_rows(stored, runs, protected))


def drop_rows(stored: DataFrame, stale: DataFrame) -> DataFrame:
    """Drop the rows whose id is that of a stale one."""
    return stored.join(stale.select("id"), "id", "left_anti").select(*stored.columns)


def stale_rows(stored: DataFrame, runs: DataFrame, protected: DataFrame | None = None) -> DataFrame:
    """The rows ``prune_stale`` drops."""
    stale = _stale_in(stored, runs, "left_semi")
    return stale if protected is None else stale.join(protected.select("id"), "id", "left_anti")


def drop_orphans(comments: DataFrame, issues: DataFrame, companies: DataFrame) -> DataFrame:
    """Drop comments of the given companies whose issue is gone from that company."""
    scope = companies.select("company_id").distinct()
    alive = issues.join(scope, "company_id", "left_semi").select(F.col("id").alias("issue_id"), "company_id")
    checked = comments.join(scope, "company_id", "left_semi").join(alive, ["issue_id", "company_id"], "left_semi")
    # The rows outside the scope never meet the issues.
    return comments.join(scope, "company_id", "left_anti").select(*comments.columns).unionByName(checked.select(*comments.columns))


def orphaned(comments: DataFrame, issues: DataFrame, companies: DataFrame) -> DataFrame:
    """The comments that ``drop_orphans`` drops."""
    scope = companies.select("company_id").distinct()
    alive = issues.join(scope, "company_id", "left_semi").select(F.col("id").alias("issue_id"), "company_id")
    return comments.join(scope, "company_id", "left_semi").join(alive, ["issue_id", "company_id"], "left_anti")


def replace_threads(
    comments: DataFrame, hydrated: DataFrame, fetched: DataFrame, order: list[Column | str] | None = None, protected: DataFrame | None = None
) -> DataFrame:
    """Replace the threads of the ``hydrated`` issue ids by the fetched comments; other threads stay.

    Stored comments whose id is in ``protected`` stay too: they were sent, though not in a form that can be stored.
    """
    sent = fetched.select("id")
    if order:
        fetched = latest_per_key(fetched, ["id"], order)
    kept = comments.join(hydrated.select("issue_id"), "issue_id", "left_anti").select(*comments.columns)
    if protected is not None:
        held = comments.join(hydrated.select("issue_id"), "issue_id", "left_semi").join(protected.select("id"), "id", "left_semi")
        kept = kept.unionByName(held.select(*comments.columns))
    return kept.join(sent, "id", "left_anti").select(*comments.columns).unionByName(
        fetched.select(*[c for c in comments.columns if c in fetched.columns]), allowMissingColumns=True
    )


def stamp_threads(issues: DataFrame, hydrated: DataFrame) -> DataFrame:
    """Set ``comments_synced_at`` of issues; ``hydrated`` holds issue_id and the stamp ``at``."""
    stamps = hydrated.select(F.col("issue_id").alias("id"), F.col("at").alias("_at"))
    stamped = issues.join(stamps, "id", "left")
    return stamped.withColumn("comments_synced_at", F.coalesce("_at", "comments_synced_at")).select(*issues.columns)


def refresh_issue(
    issues: DataFrame, comments: DataFrame, record: DataFrame, thread: DataFrame, at: str
) -> tuple[DataFrame, DataFrame]:
    """Deep refresh of single issues: upsert the rows in ``record`` and replace their threads."""
    hydrated = record.select(F.col("id").alias("issue_id"), F.lit(at).alias("at"))
    refreshed = stamp_threads(upsert_issues(issues, record), hydrated)
    return refreshed, replace_threads(comments, hydrated, thread)


def since_cursor(incoming: DataFrame, since: Column | str | None) -> DataFrame:
    """Rows updated at or after an instant; rows with an unreadable time stay.

    A missing or unreadable ``since`` keeps everything.
    """
    bound = instant(F.lit(since) if since is None or isinstance(since, str) else since)
    moment = instant(F.col("updated_at"))
    return incoming.filter(bound.isNull() | moment.isNull() | (moment >= bound))


def advance_cursor(cursors: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """New cursor per key: the newest readable ``updated_at`` by instant; it never moves back."""
    moment = instant(F.col("updated_at"))
    newest = incoming.groupBy(*keys).agg(
        F.max_by("updated_at", F.when(moment.isNotNull(), F.struct(moment, F.col("updated_at")))).alias("_newest")
    )
    ahead = instant(F.col("_newest")).isNotNull() & (
        instant(F.col("cursor")).isNull() | (instant(F.col("_newest")) > instant(F.col("cursor")))
    )
    return cursors.join(newest, keys, "full_outer").withColumn(
        "cursor", F.when(ahead, F.col("_newest")).otherwise(F.col("cursor"))
    ).drop("_newest")


def hydration_candidates(
    issues: DataFrame, changed: DataFrame, mode: str = "changed", full: Column | bool = False
) -> DataFrame:
    """Issue ids whose threads are to be read: changed or active ones, all of them, or none.

    ``full`` may be a column of ``issues`` telling which companies run in full.
    """
    if mode not in ("none", "changed", "all"):
        raise ValueError("comments mode must be none, changed or all")
    ids = issues.select(F.col("id").alias("issue_id"), "company_id")
    if mode == "none":
        return ids.limit(0)
    if mode == "all" or full is True:
        return ids
    every = full if isinstance(full, Column) else F.lit(False)
    active = issues.filter(F.col("status").isin(*ACTIVE_STATUSES) | F.coalesce(every, F.lit(False)))
    active = active.select(F.col("id").alias("issue_id"), "company_id")
    return active.unionByName(changed.select(F.col("id").alias("issue_id"), "company_id")).distinct()


def dedupe_targets(targets: DataFrame) -> DataFrame:
    """First target per (api base, company); targets without a company are skipped."""
    usable = targets.filter(F.coalesce(F.length("company_id"), F.lit(0)) > 0)
    usable = usable.withColumn("api_base", strip_slashes(F.col("api_base")))
    return latest_per_key(usable, ["api_base", "company_id"], ["position"], first=True)


def plan_sync(
    targets: DataFrame,
    sync_state: DataFrame,
    full: bool = False,
    since: str | None = None,
    skip_younger_than: str | None = None,
    now: Column | None = None,
    by_target: bool = False,
) -> DataFrame:
    """Mode and lower bound per target: full without a stored cursor or on request, else incremental.

    ``since`` beats the cursor. A bounded pull is recorded as incremental, since it never sees the
    older rows. ``skip_younger_than`` (a duration) adds ``skipped``: whether the newest good step of the whole state, or with
    ``by_target`` that of the target, is younger than that at ``now``. A state without a good step is never fresh.
    """
    cursors = sync_state.filter(F.col("entity") == "issues").select("profile", "company_id", "cursor")
    planned = targets.join(cursors, ["profile", "company_id"], "left")
    wants_full = F.lit(full) | F.col("cursor").isNull() | (F.col("cursor") == "")
    if since is not None:
        planned = planned.withColumn("mode", F.lit("incremental")).withColumn("since", F.lit(since))
    else:
        mode = F.when(wants_full, F.lit("full")).otherwise(F.lit("incremental"))
        planned = planned.withColumn("mode", mode).withColumn("since", F.when(~wants_full, F.col("cursor")))
    if skip_younger_than is None:
        return planned
    keys = ["profile", "company_id"] if by_target else []
    good = F.max(F.when(F.col("last_status") == "ok", F.col("last_sync_at"))).alias("_last")
    newest = sync_state.groupBy(*keys).agg(good)
    last = F.col("_last") if by_target else newest.scalar()
    known = planned.join(newest, keys, "left") if by_target else planned
    age = F.unix_millis(now if now is not None else F.current_timestamp()) - millis(last)
    return known.withColumn("skipped", F.coalesce(age < duration_ms(F.lit(skip_younger_than)), F.lit(False))).drop("_last")


def fallback_rows(primary: DataFrame, fallback: DataFrame, key: str = "id") -> DataFrame:
    """Primary rows, plus fallback rows of keys the primary source did not give."""
    return primary.unionByName(fallback.join(primary.select(key), key, "left_anti"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
