"""One whole sync run over landed pages, for all companies at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.functions.timing import instant
from boardlake.operators.grouping import latest_of_repeated, latest_per_key, repeated_keys
from boardlake.operators.projection import project_all
from boardlake.operators.rollups import comment_state_status, comment_step_status, run_ledger
from boardlake.operators.upsert import (
    advance_cursor,
    dedupe_targets,
    detect_changes,
    drop_orphans,
    drop_rows,
    hydration_candidates,
    orphaned,
    partial_upsert,
    plan_sync,
    put_values,
    replace_threads,
    stale_rows,
    stamp_threads,
    union_all,
    upsert,
    upsert_issues,
)
from boardlake.schemas import DIRECTORY_ENTITIES, ENTITIES, META, SYNC_RUNS
from boardlake.session import staged
from boardlake.sources.landing import company_records, page_errors, record_rows, with_records

TARGET = ["profile", "company_id"]
LISTINGS = [*DIRECTORY_ENTITIES, "issues"]
ARRIVAL = ["position", "page_no", "item"]


@dataclass(frozen=True)
class SyncResult:
    """New tables, entity steps, company results and quarantined records of a run, as frames over the staged batches.

    ``changes`` has, per board table, the rows the run wrote and the keys it removed (``deltas.write_changes`` takes them).
    """

    tables: dict[str, DataFrame]
    entities: DataFrame
    results: DataFrame
    quarantine: DataFrame
    changes: dict[str, tuple[DataFrame, DataFrame]]


def _control(pages: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per target: its plan, and for each listing the error that makes it unusable, if any.

    A company record is there if any of its answers is good; a listing needs all of its pages, from the first to the
    marked end. What was not landed at all is an error as well, so no target and no listing can vanish. All of it takes
    one pass over the pages, which are parsed already.
    """
    states = page_errors(pages.filter(F.col("entity") != "comments"), [*TARGET, "entity"])
    record = F.col("entity") == "companies"
    error = F.when(record, F.when(~F.col("answered"), F.col("page_error"))).otherwise(F.col("error"))
    facts = []
    for entity in ["companies", *LISTINGS]:
        mine = F.col("entity") == entity
        facts += [F.bool_or(mine).alias(f"{entity}_seen"), F.max(F.when(mine, error)).alias(f"{entity}_error")]
    joined = plan.join(states.groupBy(*TARGET).agg(*facts), TARGET, "left")
    missing = {e: F.when(F.coalesce(f"{e}_seen", F.lit(False)), F.col(f"{e}_error")).otherwise(F.lit("no response")) for e in ["companies", *LISTINGS]}
    return joined.select(*plan.columns, *[error.alias(f"{entity}_error") for entity, error in missing.items()])


def _good(entity: str) -> Column:
    """Whether a target's listing is complete; without its company record nothing of it counts."""
    return F.col("companies_error").isNull() & F.col(f"{entity}_error").isNull()


def _attempted(entity: str) -> Column:
    return F.lit(True) if entity == "companies" else F.col("companies_error").isNull()


def _step(control: DataFrame, entity: str, counts: DataFrame, pruned: DataFrame | None = None) -> DataFrame:
    """Entity step per target: (profile, company_id, entity, count, pruned, status, error)."""
    step = control.filter(_attempted(entity)).select(*TARGET, F.col(f"{entity}_error").alias("error")).join(counts, TARGET, "left")
    if pruned is not None:
        step = step.join(pruned, "company_id", "left")
    else:
        step = step.withColumn("pruned", F.lit(None).cast("bigint"))
    return step.select(
        *TARGET, F.lit(entity).alias("entity"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        F.when(F.col("error").isNull(), F.coalesce("pruned", F.lit(0))).cast("bigint").alias("pruned"),
        F.when(F.col("error").isNull(), F.lit("ok")).otherwise(F.lit("error")).alias("status"),
        "error",
    )


def _listed(landed: DataFrame, entity: str, *more: str) -> DataFrame:
    """Records of a complete listing, with the target they came for."""
    pages = landed.filter((F.col("entity") == entity) & _good(entity))
    return record_rows(pages.select("profile", F.col("company_id").alias("target_company"), *more, "position", "page_no", "records"))


def _count_by_target(batch: DataFrame, *more: Column) -> DataFrame:
    target = [F.col("profile"), F.col("target_company").alias("company_id")]
    return batch.groupBy(*target).agg(F.count(F.lit(1)).alias("count"), *more)


def _unique(batch: DataFrame, repeated: DataFrame, *drop: str) -> DataFrame:
    """Last arrival per id, without the columns of the arrival."""
    return latest_of_repeated(batch.drop("profile", "target_company", *drop), ["id"], ARRIVAL, repeated).drop(*ARRIVAL)


def _runs(control: DataFrame, condition: Column, started_at: Column) -> DataFrame:
    return control.filter(condition).select("company_id").distinct().withColumn("started_at", started_at)


def _set_aside(projected: DataFrame, entity: str) -> DataFrame:
    """Records that lack a required id, redacted: (profile, company_id, entity, id, raw)."""
    return projected.filter("NOT _whole").select(
        "profile", F.col("target_company").alias("company_id"), F.lit(entity).alias("entity"), F.get_json_object("raw_json", "$.id").alias("id"),
        F.col("raw_json").alias("raw"),
    )


def _stale(stored: DataFrame, batch: DataFrame, runs: DataFrame, protected: DataFrame) -> DataFrame:
    """Id and company of the stored rows that a run prunes: rows the batch brings carry its stamp and are never among them."""
    rows = stored.select("id", "company_id", "synced_at")
    return staged(stale_rows(rows, runs, protected.unionByName(batch.select("id"))).select("id", "company_id"), "stale")


def _stale_counts(stale: DataFrame) -> DataFrame:
    return stale.groupBy("company_id").agg(F.count(F.lit(1)).alias("pruned"))


def sync_run(
    tables: dict[str, DataFrame],
    pages: DataFrame,
    targets: DataFrame,
    started_at: str,
    full: bool = False,
    since: str | None = None,
    comments: str = "changed",
    finished_at: str | None = None,
    skip_younger_than: str | None = None,
    by_target: bool = False,
) -> SyncResult:
    """Apply landed pages to the mirror.

    Steps per company: its record, directory tables, issues, threads. A listing that failed, was not landed or has
    pages missing keeps the stored rows and records its error. Without the company record the company's other pages are
    ignored; without its issues, its threads are. ``started_at`` is the run stamp of ``max_stamp``.
    A response of unknown shape counts as failed: taking it for an empty listing would prune everything.
    Records without a required id are returned in ``quarantine``, and the stored rows of their ids stay.

    ``skip_younger_than`` leaves out targets that are fresh at ``started_at`` (see ``plan_sync``): their pages are not read, and results
    and state know nothing of them. If all are left out the tables stay as they are, without a ledger row.

    Pages are staged by entity with their lists parsed, so that each step reads its own records instead of all JSON text. The
    control rows and the projected batches, with what is set aside, are staged too: records are parsed and redacted once
    although upserts, counts, cursors and threads all need them. The stored tables are not; ids that are stale or came more than
    once are, so that only rows of the latter are gathered and no stored row is compared twice.
    """
    stamp = F.lit(started_at)
    pages = pages.filter(F.col("entity").isin("companies", *LISTINGS, "comments"))
    plan = plan_sync(dedupe_targets(targets), tables["sync_state"], full, since, skip_younger_than, instant(stamp), by_target)
    if skip_younger_than is not None:
        plan = staged(plan.filter("NOT skipped").drop("skipped"), "plan")
        pages = pages.join(plan.select(*TARGET), TARGET, "left_semi")
        if plan.isEmpty():
            return _unchanged(tables, plan, started_at)
    pages = staged(with_records(pages, F.col("entity") == "companies"), "pages", "entity")
    control = staged(_control(pages, plan), "control")
    landed = pages.join(control, TARGET)
    arrived = ["profile", "target_company", *ARRIVAL]
    new = dict(tables)
    changes = {}
    steps = []

    def written(entity: str, rows: DataFrame) -> DataFrame:
        return rows.select(*tables[entity].columns)

    records = company_records(landed.filter(F.col("entity") == "companies"))
    records = records.join(control.select(*TARGET, "api_base", "position"), TARGET).withColumnRenamed("company_id", "target_company")
    read = {"companies": staged(project_all(records, "companies", stamp, F.col("api_base"), keep=["profile", "target_company", "position"]), "companies")}
    for entity in DIRECTORY_ENTITIES:
        read[entity] = staged(project_all(_listed(landed, entity), entity, stamp, keep=arrived), entity)
    projected = project_all(_listed(landed, "issues", "since"), "issues", stamp, keep=["since", *arrived])
    moment, bound = instant(F.col("updated_at")), instant(F.col("since"))
    read["issues"] = staged(projected.filter(~F.col("_whole") | bound.isNull() | moment.isNull() | (moment >= bound)), "issues")
    apart = staged(union_all([_set_aside(rows, entity) for entity, rows in read.items()]), "quarantine")
    batches = {entity: rows.filter("_whole").drop("_whole") for entity, rows in read.items()}

    def protected(entity: str) -> DataFrame:
        return apart.filter((F.col("entity") == entity) & F.col("id").isNotNull()).select("id")

    # Company records: of several targets with one company the last in order counts.
    batch = batches["companies"]
    new["companies"] = upsert(tables["companies"], batch.drop("profile", "target_company"), ["id"], ["position"])
    changes["companies"] = (written("companies", latest_per_key(batch, ["id"], ["position"])), tables["companies"].select("id").limit(0))
    steps.append(_step(control, "companies", _count_by_target(batch)))

    # Directory tables: complete listings, stale rows pruned.
    for entity in DIRECTORY_ENTITIES:
        batch = batches[entity]
        unique = _unique(batch, staged(repeated_keys(batch, ["id"]), "repeated"))
        stale = _stale(tables[entity], batch, _runs(control, _good(entity), stamp), protected(entity))
        new[entity] = upsert(drop_rows(tables[entity], stale), unique, ["id"])
        changes[entity] = (written(entity, unique), stale.select("id"))
        steps.append(_step(control, entity, _count_by_target(batch), _stale_counts(stale)))

    # Issues: the changed ones are told from the stored rows before these are replaced.
    batch = batches["issues"]
    flagged = staged(detect_changes(tables["issues"], batch.select("id", "company_id", "profile", "target_company", "updated_at")), "flagged")
    listed = staged(_count_by_target(flagged, F.count_if("changed").alias("issues_changed")), "listed")
    unique = _unique(batch, staged(repeated_keys(batch, ["id"]), "repeated"), "since")
    stale = _stale(tables["issues"], batch, _runs(control, _good("issues") & (F.col("mode") == "full"), stamp), protected("issues"))
    pruned = staged(_stale_counts(stale), "pruned")
    issues = upsert_issues(drop_rows(tables["issues"], stale), unique)
    # Steps that ask for an issue's company and status only do not need the stamps that an upsert keeps.
    brief = ["id", "company_id", "status"]
    present = upsert(drop_rows(tables["issues"].select(*brief), stale), unique.select(*brief), ["id"])
    steps.append(_step(control, "issues", listed.drop("issues_changed"), pruned))
    kept_comments = drop_orphans(tables["comments"], present, pruned.select("company_id"))
    seen = batch.select("profile", F.col("target_company").alias("company_id"), "updated_at")
    cursors = advance_cursor(control.filter(_good("issues")).select(*TARGET, "cursor"), seen, TARGET)

    # Threads of changed and active issues, of every issue in full runs.
    companies = control.filter(_good("issues")).groupBy("company_id").agg(F.bool_or(F.col("mode") == "full").alias("_full"))
    changed = flagged.filter("changed").select("id", "company_id")
    wanted = hydration_candidates(present.join(companies, "company_id"), changed, comments, F.col("_full"))
    threads = landed.filter((F.col("entity") == "comments") & _good("issues"))
    threads = threads.select(*TARGET, "issue_id", "position", "page_no", "records", "error", "last")
    asked = threads.join(wanted.select("issue_id"), "issue_id", "left_semi")
    answers = staged(page_errors(asked, [*TARGET, "issue_id"]).select(*TARGET, "issue_id", "error"), "threads")
    hydrated = answers.filter(F.col("error").isNull()).select("issue_id").distinct().withColumn("at", stamp)
    good_pages = threads.withColumnRenamed("company_id", "target_company").join(hydrated, "issue_id", "left_semi")
    sent = record_rows(good_pages.select("profile", "target_company", "position", "page_no", "records"))
    sent = staged(project_all(sent, "comments", stamp, keep=arrived), "comments")
    fetched = sent.filter("_whole").drop("_whole")
    left_out = staged(_set_aside(sent, "comments"), "quarantine")
    apart = apart.unionByName(left_out)
    thread_rows = _unique(fetched, staged(repeated_keys(fetched, ["id"]), "repeated"))
    new["comments"] = replace_threads(kept_comments, hydrated, thread_rows, protected=left_out.filter(F.col("id").isNotNull()))
    new["issues"] = stamp_threads(issues, hydrated)
    touched = batch.select("id").unionByName(hydrated.select(F.col("issue_id").alias("id")))
    changes["issues"] = (new["issues"].join(touched, "id", "left_semi"), stale.select("id"))
    # Comments go with their issue, or because their thread was read again without them.
    orphans = orphaned(tables["comments"], present, pruned.select("company_id"))
    replaced = tables["comments"].join(hydrated.select("issue_id"), "issue_id", "left_semi")
    gone = orphans.select("id").unionByName(replaced.select("id").join(left_out.select("id"), "id", "left_anti"))
    changes["comments"] = (written("comments", thread_rows), gone)
    tally = answers.groupBy(*TARGET).agg(
        F.count_if(F.col("error").isNull()).alias("hydrated"), F.count_if(F.col("error").isNotNull()).alias("failed")
    )
    message = F.when(F.col("failed") > 0, F.concat(F.col("failed").cast("string"), F.lit(" failed")))
    steps.append(
        tally.select(
            *TARGET, F.lit("comments").alias("entity"), F.col("hydrated").alias("count"),
            F.lit(None).cast("bigint").alias("pruned"),
            comment_step_status(F.col("hydrated"), F.col("failed")).alias("status"), message.alias("error"),
        )
    )

    # Results per company: a failed company record is an error, any other failed step makes it partial.
    entities = staged(union_all(steps), "steps")
    failed = F.col("status") == "error"
    status = (
        F.when(F.bool_or(failed & (F.col("entity") == "companies")), F.lit("error"))
        .when(F.bool_or(failed), F.lit("partial"))
        .otherwise(F.lit("ok"))
    )
    results = (
        control.select(*TARGET, "api_base", "mode", "position")
        .join(entities.groupBy(*TARGET).agg(status.alias("status")), TARGET)
        .join(listed.select(*TARGET, "issues_changed"), TARGET, "left")
        .join(tally.select(*TARGET, F.col("hydrated").alias("comments_hydrated")), TARGET, "left")
        .join(apart.groupBy(*TARGET).agg(F.count(F.lit(1)).alias("quarantined")), TARGET, "left")
        .fillna(0, ["issues_changed", "comments_hydrated", "quarantined"])
        .withColumn("started_at", stamp)
    )
    new["sync_state"] = partial_upsert(tables["sync_state"], _state_patches(entities, tally, cursors, control, started_at))
    new["sync_runs"] = tables["sync_runs"].unionByName(_ledger(tables["sync_runs"], results, started_at, finished_at or started_at, full))
    new["meta"] = put_values(tables["meta"], pages.sparkSession.createDataFrame([("last_sync_at", finished_at or started_at)], META))
    return SyncResult(new, entities, results, apart, changes)


def _unchanged(tables: dict[str, DataFrame], plan: DataFrame, started_at: str) -> SyncResult:
    """The result of a run that had nothing to do."""
    none = plan.limit(0)

    def empty(*columns: str) -> DataFrame:
        return none.select(*TARGET, *[F.lit(None).cast("bigint" if c in ("count", "pruned") else "string").alias(c) for c in columns])

    counts = [F.lit(0).cast("bigint").alias(c) for c in ("issues_changed", "comments_hydrated", "quarantined")]
    results = none.select(*TARGET, "api_base", "mode", "position", F.lit("ok").alias("status"), *counts, F.lit(started_at).alias("started_at"))
    changes = {e: (tables[e].limit(0), tables[e].select("id").limit(0)) for e in ENTITIES}
    return SyncResult(dict(tables), empty("entity", "count", "pruned", "status", "error"), results, empty("entity", "id", "raw"), changes)


def _ledger(runs: DataFrame, results: DataFrame, started_at: str, finished_at: str, full: bool) -> DataFrame:
    """The run's ledger row, numbered after the last; one with very many companies goes on in further rows of its number."""
    number = runs.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("run_id"))
    start = number.select("run_id", F.lit(started_at).alias("started_at"), F.lit("full" if full else "incremental").alias("mode"))
    done = results.withColumnRenamed("position", "place").withColumn("finished_at", F.lit(finished_at)).withColumn("run_id", number.scalar())
    return run_ledger(start, done).select(F.col("run_id").alias("id"), *[c for c in SYNC_RUNS.names if c != "id"])


def _state_patches(
    entities: DataFrame, tally: DataFrame, cursors: DataFrame, plan: DataFrame, started_at: str
) -> DataFrame:
    """Fields each step sets in ``sync_state``: errors leave stamps, counts and cursors alone."""
    ok = F.col("status") == "ok"
    directory = F.col("entity").isin(*DIRECTORY_ENTITIES)
    full_issues = (F.col("entity") == "issues") & (F.col("mode") == "full")
    good_fields = F.concat(
        F.array(*[F.lit(f) for f in ("last_sync_at", "last_status", "last_error", "last_count")]),
        F.when(directory | full_issues, F.array(F.lit("last_full_at"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("entity") == "issues", F.array(F.lit("cursor"))).otherwise(F.array().cast("array<string>")),
    )
    known = (
        entities.join(plan.select(*TARGET, "mode"), TARGET)
        .join(cursors.withColumn("entity", F.lit("issues")), [*TARGET, "entity"], "left")
        .join(tally.withColumn("entity", F.lit("comments")), [*TARGET, "entity"], "left")
    )
    # Threads keep their own rule: the step is stored even when some of them failed.
    threads = F.col("entity") == "comments"
    stamp = F.lit(started_at)
    return known.select(
        *TARGET, "entity",
        F.lit(1).alias("seq"),
        "cursor",
        stamp.alias("last_sync_at"),
        stamp.alias("last_full_at"),
        F.when(threads, comment_state_status(F.col("failed"))).otherwise(F.col("status")).alias("last_status"),
        F.col("error").alias("last_error"),
        F.col("count").alias("last_count"),
        F.when(threads | ok, good_fields).otherwise(F.array(F.lit("last_status"), F.lit("last_error"))).alias("fields_set"),
    )
