"""Counts, summaries, freshness and status roll-ups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.functions.text import label
from boardlake.functions.timing import duration_ms, freshness_state, iso_from_millis, millis, relative_time
from boardlake.operators.grouping import with_positions
from boardlake.operators.reads import with_columns_of
from boardlake.schemas import ACTIVE_STATUSES, SYNC_STATE_FIELDS, SYNC_STATE_KEYS, STALE_AFTER_MS


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table with a display label."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("id"), "value") for name, rows in tables.items()
    ]
    return _union(counts).select("id", label(F.col("id")).alias("label"), "value")


def company_summary(companies: DataFrame, issues: DataFrame, sync_state: DataFrame) -> DataFrame:
    """Issues, open issues and last good issue sync per company; both sides are reduced before the joins."""
    counted = issues.groupBy(F.col("company_id").alias("id")).agg(
        F.count(F.lit(1)).alias("issues"), F.count_if(F.col("status").isin(*ACTIVE_STATUSES)).alias("open_issues")
    )
    synced = (
        sync_state.filter((F.col("entity") == "issues") & (F.col("last_status") == "ok"))
        .groupBy(F.col("company_id").alias("id"))
        .agg(F.max("last_sync_at").alias("last_sync_at"))
    )
    return (
        companies.select("id", "name", "issue_prefix")
        .join(counted, "id", "left")
        .join(synced, "id", "left")
        .select(
            "id", "name", "issue_prefix",
            F.coalesce("issues", F.lit(0)).alias("issues"),
            F.coalesce("open_issues", F.lit(0)).alias("open_issues"),
            "last_sync_at",
        )
        .orderBy("name", "id")
    )


def last_sync_at(sync_state: DataFrame) -> DataFrame:
    """Newest stamp of any good step: one row, NULL when there is none."""
    return sync_state.agg(F.max(F.when(F.col("last_status") == "ok", F.col("last_sync_at"))).alias("last_sync_at"))


def freshness(
    sync_state: DataFrame, now: Column, stale_after_ms: int = STALE_AFTER_MS, skip_younger_than: str = "5m"
) -> DataFrame:
    """State of the mirror as a whole, and whether a sync may be skipped."""
    last = F.col("last_sync_at")
    age = F.unix_millis(now) - millis(last)
    return last_sync_at(sync_state).select(
        "last_sync_at",
        age.alias("age_ms"),
        freshness_state(last, now, stale_after_ms).alias("state"),
        relative_time(last, now).alias("last_sync"),
        F.coalesce(age < duration_ms(F.lit(skip_younger_than)), F.lit(False)).alias("skip"),
    )


def freshness_by_entity(sync_state: DataFrame, now: Column, stale_after_ms: int = STALE_AFTER_MS) -> DataFrame:
    """The same per entity, since a good step of one entity says nothing about the others."""
    good = F.when(F.col("last_status") == "ok", F.col("last_sync_at"))
    last = sync_state.groupBy("entity").agg(F.max(good).alias("last_sync_at"))
    return last.withColumn("state", freshness_state(F.col("last_sync_at"), now, stale_after_ms))


def freshness_of_commits(ledger: DataFrame, scope: list[str], now: Column, stale_after_ms: int = STALE_AFTER_MS) -> DataFrame:
    """State of a streamed mirror from its commit ledger: per ``scope`` and entity the newest commit, its batch and the rows of all commits."""
    newest = F.max(F.struct("committed_at", "batch"))
    found = ledger.groupBy(*scope, "entity").agg(newest.alias("_newest"), F.sum("rows").alias("rows"))
    last = F.col("_newest.committed_at")
    return found.select(*scope, "entity", "rows", F.col("_newest.batch").alias("batch"), last.alias("last_commit_at"), relative_time(last, now).alias("last_commit"), freshness_state(last, now, stale_after_ms).alias("state"))


def list_sync_state(sync_state: DataFrame) -> DataFrame:
    return with_columns_of(sync_state, SYNC_STATE_FIELDS).select(*SYNC_STATE_KEYS, *SYNC_STATE_FIELDS).orderBy(*SYNC_STATE_KEYS)


def sync_errors(sync_state: DataFrame) -> DataFrame:
    """Steps whose last status is known and not ok."""
    return sync_state.filter(F.col("last_status").isNotNull() & (F.col("last_status") != "ok")).select(
        *SYNC_STATE_KEYS, "last_status", "last_error"
    )


def max_stamp(tables: list[DataFrame], now: Column) -> DataFrame:
    """Newest stored stamp over all tables, and a run stamp strictly after it.

    A clock at or behind the newest stamp steps past it by a millisecond.
    """
    floor = _union([t.agg(F.max("synced_at").alias("stamp")) for t in tables]).agg(F.max("stamp").alias("max_stamp"))
    stepped = F.greatest(F.unix_millis(now), millis(F.col("max_stamp")) + 1)
    return floor.select(
        "max_stamp", iso_from_millis(stepped).alias("run_stamp")
    )


def _all_ok(status: Column) -> Column:
    return F.coalesce(F.bool_and(status == "ok"), F.lit(True))


def run_status(status: Column) -> Column:
    """Aggregate: all ok (or nothing at all) is ok; anything that is no error makes it partial; else error."""
    return (
        F.when(_all_ok(status), F.lit("ok"))
        .when(F.coalesce(F.bool_or(status != "error"), F.lit(False)), F.lit("partial"))
        .otherwise(F.lit("error"))
    )


def run_rollup(results: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Run status from company results, overall or per ``keys``."""
    return results.groupBy(*(keys or [])).agg(run_status(F.col("status")).alias("status"), F.count(F.lit(1)).alias("companies"))


def entity_rollup(entities: DataFrame, keys: list[str]) -> DataFrame:
    """Company status from its entity steps: any failed step makes it partial.

    A comment step has failed only when threads failed and none was read, although its stored
    state then says partial.
    """
    failed = F.bool_or(F.col("status") == "error")
    return entities.groupBy(*keys).agg(
        F.when(failed, F.lit("partial")).otherwise(F.lit("ok")).alias("status"), F.count(F.lit(1)).alias("steps")
    )


def comment_step_status(hydrated: Column, failed: Column) -> Column:
    return F.when((failed > 0) & (hydrated == 0), F.lit("error")).otherwise(F.lit("ok"))


def comment_state_status(failed: Column) -> Column:
    return F.when(failed > 0, F.lit("partial")).otherwise(F.lit("ok"))


def run_ledger(starts: DataFrame, results: DataFrame, page_size: int = 500) -> DataFrame:
    """Ledger rows per run: status, profile list and summary of its company results.

    ``starts`` holds (run_id, started_at, mode), ``results`` (run_id, place, profile, company_id,
    status, issues_changed, comments_hydrated, finished_at). A run has one row; the lists of runs
    with more than ``page_size`` companies go on in further pages.
    """
    totals = results.groupBy("run_id").agg(run_status(F.col("status")).alias("status"), F.max("finished_at").alias("finished_at"))
    placed = with_positions(results, ["run_id"], [F.col("place"), F.col("company_id"), F.col("profile")], F.floor(F.col("place") / 1000))
    item = F.struct("position", "profile", F.col("company_id").alias("companyId"), "status",
                    F.col("issues_changed").alias("issuesChanged"), F.col("comments_hydrated").alias("commentsHydrated"))
    lists = (
        placed.withColumn("page", F.floor(F.col("position") / page_size).cast("bigint"))
        .groupBy("run_id", "page")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
    )
    # A run without results, as one that stopped early, is ok by the roll-up rule.
    return (
        starts.join(totals, "run_id", "left")
        .join(lists, "run_id", "left")
        .select(
            "run_id", "started_at", "finished_at", "mode",
            F.coalesce("page", F.lit(0)).cast("bigint").alias("page"),
            F.coalesce("status", F.lit("ok")).alias("status"),
            F.coalesce(F.array_join(F.col("items.profile"), ","), F.lit("")).alias("profiles"),
            F.coalesce(F.to_json(F.transform("items", lambda i: i.dropFields("position"))), F.lit("[]")).alias("summary_json"),
        )
    )


def status_report(
    tables: dict[str, DataFrame], sync_state: DataFrame, now: Column, stale_after_ms: int = STALE_AFTER_MS
) -> DataFrame:
    """Status document as rows (section, item, value): state, counts, companies, sync steps, errors.

    Rows instead of one nested value: nothing is gathered in one task however many companies exist.
    """
    counts = table_counts(tables)

    def rows(section: str, frame: DataFrame, item: Column, value: Column) -> DataFrame:
        return frame.select(F.lit(section).alias("section"), item.alias("item"), value.alias("value"))

    issues = tables["issues"].agg(F.count(F.lit(1)).alias("n")).scalar()
    companies = tables["companies"].agg(F.count(F.lit(1)).alias("n")).scalar()
    fresh = freshness(sync_state, now, stale_after_ms)
    noun = F.when(companies == 1, F.lit(" company")).otherwise(F.lit(" companies"))
    headline = F.concat(
        issues.cast("string"), F.lit(" issues across "), companies.cast("string"), noun, F.lit("; last sync "), F.col("last_sync")
    )
    state = fresh.select(
        F.explode(
            F.create_map(
                F.lit("state"), F.col("state"),
                F.lit("summary"), headline,
                F.lit("last_sync_at"), F.coalesce("last_sync_at", F.lit("never")),
                F.lit("next_step"), F.when(F.col("state") == "current", F.lit("none")).otherwise(F.lit("sync")),
            )
        ).alias("item", "value")
    )
    steps = list_sync_state(sync_state)
    step = F.concat_ws("/", "profile", "company_id", "entity")
    summary = company_summary(tables["companies"], tables["issues"], sync_state)
    keep_nulls = {"ignoreNullFields": "false"}
    return _union(
        [
            rows("status", state, F.col("item"), F.col("value")),
            rows("count", counts, F.col("id"), F.col("value").cast("string")),
            rows("company", summary, F.col("id"), F.to_json(F.struct(*summary.columns), keep_nulls)),
            rows("sync_state", steps, step, F.coalesce("last_status", F.lit(""))),
            rows("error", sync_errors(sync_state), step, F.coalesce("last_error", F.lit(""))),
        ]
    )


def missing_report(spark) -> DataFrame:
    """Status document of a mirror that does not exist yet."""
    return spark.createDataFrame(
        [("status", "state", "missing"), ("status", "next_step", "sync")], "section string, item string, value string"
    )
