"""Registered streaming queries: change logs and index maintenance, run to the end of their input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.operators.index import CODEC, ISSUE_TEXT, TextIndex, fold_index, term_stats
from boardlake.plans.search_queries import ORACLE_VIEWS as TOKEN_VIEWS
from boardlake.plans.search_queries import stored_index
from boardlake.operators.rollups import freshness_of_commits
from boardlake.plans.views import NOW, STAMP_1, STAMP_2, table, view
from boardlake.schemas import ACTIVE_STATUSES
from boardlake.session import freeing_shuffles, remove_folder, scratch_path
from boardlake.streaming.feeds import CANDIDATE, index_log_schema, merge_index, merge_newest, stream_candidates, stream_index, stream_upsert
from boardlake.streaming.log import fold_log, ledger_schema, low_water_mark, read_log

QUERIES = {}
ORACLES = {}
ORACLE_VIEWS = TOKEN_VIEWS


def register(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


def landed(rows: DataFrame, label: str, files: int = 4) -> str:
    """Rows landed as several files in arrival order, as a stream finds them."""
    path = scratch_path(rows.sparkSession, label)
    rows.repartition(files).write.parquet(path)
    return path


def _changes(spark, sf) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return table(spark, sf, "events").select(
        F.concat(F.lit("us-"), F.col("user_id").cast("string")).alias("id"), F.col("event_type").alias("status"),
        stamp.alias("updated_at"), F.col("event_id").alias("seq"),
    )


_STORED = "SELECT 'us-' || c_custkey AS id, c_mktsegment AS status, '2024-01-29T00:00:00.000Z' AS updated_at, -1 AS seq FROM customer"


def _stored(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.concat(F.lit("us-"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_mktsegment").alias("status"),
        F.lit("2024-01-29T00:00:00.000Z").alias("updated_at"), F.lit(-1).cast("bigint").alias("seq"),
    )


def _streamed(spark, sf, cursor: str | None = None, fold: bool = False) -> DataFrame:
    changes = _changes(spark, sf)
    source = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(landed(changes, "changes"))
    log = scratch_path(spark, "change-log")
    stream_upsert(source, log, scratch_path(spark, "change-progress"), ["id"], ["updated_at", "seq"], cursor, fold_every=2 if fold else None).awaitTermination()
    if fold:
        fold_log(spark, log, changes.schema, ["id"], ["updated_at", "seq"])
        assert low_water_mark(spark, log) >= 0
    return merge_newest(_stored(spark, sf), read_log(spark, log, changes.schema).drop("batch"), ["id"], ["updated_at", "seq"])


_FEED = "SELECT 'us-' || user_id AS id, event_type AS status, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS updated_at, event_id AS seq FROM events"


@register(
    "stream_upsert",
    f"""SELECT id, max_by(status, (updated_at, seq)) AS status, max(updated_at) AS updated_at, max_by(seq, (updated_at, seq)) AS seq
FROM ({_STORED} UNION ALL {_FEED}) AS rows GROUP BY id""",
)
def streamed_upsert(spark, sf):
    return _streamed(spark, sf)


@register(
    "stream_cursor",
    f"""SELECT id, max_by(status, (updated_at, seq)) AS status, max(updated_at) AS updated_at, max_by(seq, (updated_at, seq)) AS seq
FROM ({_STORED} UNION ALL SELECT * FROM ({_FEED}) AS feed WHERE updated_at >= '2024-01-20T00:00:00.000Z') AS rows GROUP BY id""",
)
def streamed_cursor(spark, sf):
    return _streamed(spark, sf, "2024-01-20T00:00:00.000Z")


@register("stream_fold_rows", ORACLES["stream_upsert"])
def folded_upsert(spark, sf):
    """The same feed, its log folded while the stream runs and after it: read from the base and the last batch."""
    return _streamed(spark, sf, fold=True)


_BATCHES = {
    0: ("1 = 1", "status", "updated_at"),
    # Every tenth issue is closed or opened again, every seventh sent as it was; then rows from before arrive late.
    1: ("doc_id % 10 = 0 OR doc_id % 7 = 3", "CASE WHEN doc_id % 10 = 0 THEN CASE WHEN doc_id % 20 = 0 THEN 'done' ELSE 'in_progress' END ELSE status END", f"CASE WHEN doc_id % 10 = 0 THEN '{STAMP_1}' ELSE updated_at END"),
    2: ("doc_id % 15 = 0 OR doc_id % 11 = 0", "CASE WHEN doc_id % 11 = 0 THEN 'in_review' ELSE 'todo' END", f"CASE WHEN doc_id % 11 = 0 THEN '{STAMP_2}' ELSE '2020-01-01T00:00:00.000Z' END"),
}


def _board_rows(spark, sf, batch: int) -> DataFrame:
    wanted, status, stamp = _BATCHES[batch]
    issues = view(spark, sf, "issues").withColumn("doc_id", F.substring("id", 4, 20).cast("bigint"))
    return issues.filter(wanted).selectExpr("id", "company_id", f"{status} AS status", f"{stamp} AS updated_at")


def board_stream(spark, sf, start, batches=tuple(_BATCHES)) -> None:
    """Land the board's rows as a batch each and let the stream ``start`` makes of them take it whole, whatever its files."""
    path = scratch_path(spark, "board-rows")
    for batch in batches:
        rows = _board_rows(spark, sf, batch)
        rows.write.mode("append").parquet(path)
        start(spark.readStream.schema(rows.schema).parquet(path)).awaitTermination()


def _board_sql(batch: int) -> str:
    wanted, status, stamp = _BATCHES[batch]
    return f"SELECT {batch} AS batch, id, company_id, {status} AS status, {stamp} AS updated_at FROM (SELECT *, CAST(substr(id, 4) AS BIGINT) AS doc_id FROM issues) AS i{batch} WHERE {wanted}"


_ACTIVE = ", ".join(f"'{s}'" for s in ACTIVE_STATUSES)


def _candidates_sql() -> str:
    """Batch by batch: the state after it, and what was changed by it or is active after it."""
    parts = [f"s0 AS ({_board_sql(0)})", "c0 AS (SELECT batch, id, company_id, status, updated_at, 'changed' AS reason, CAST(NULL AS BIGINT) AS read_before FROM s0)", "known0 AS (SELECT id, company_id, status, updated_at, 0 AS last_read FROM s0)"]
    for n in (1, 2):
        parts += [
            f"s{n} AS ({_board_sql(n)})",
            f"m{n} AS (SELECT k.id, k.company_id, s.id IS NOT NULL AND s.updated_at > k.updated_at AS later, CASE WHEN s.updated_at > k.updated_at THEN s.status ELSE k.status END AS status, greatest(k.updated_at, coalesce(s.updated_at, k.updated_at)) AS updated_at, last_read FROM known{n - 1} k LEFT JOIN s{n} s ON k.id = s.id)",
            f"c{n} AS (SELECT {n} AS batch, id, company_id, status, updated_at, CASE WHEN later THEN 'changed' ELSE 'active' END AS reason, CAST(last_read AS BIGINT) AS read_before FROM m{n} WHERE later OR status IN ({_ACTIVE}))",
            f"known{n} AS (SELECT id, company_id, status, updated_at, CASE WHEN later OR status IN ({_ACTIVE}) THEN {n} ELSE last_read END AS last_read FROM m{n})",
        ]
    return f"WITH {', '.join(parts)} " + " UNION ALL ".join(f"SELECT CAST(batch AS BIGINT) AS batch, id, company_id, status, updated_at, reason, read_before FROM c{n}" for n in range(3))


@register("stream_candidates", _candidates_sql())
def streamed_candidates(spark, sf):
    """Threads each of three micro-batches asks for."""
    log, progress = scratch_path(spark, "thread-log"), scratch_path(spark, "thread-progress")
    board_stream(spark, sf, lambda source: stream_candidates(source, log, progress))
    return read_log(spark, log, CANDIDATE)


def _commit_time(batch: int):
    return F.lit(f"2024-02-09T2{batch}:40:00.000Z")


@register(
    "stream_freshness",
    f"""WITH {', '.join(f"b{n} AS ({_board_sql(n)})" for n in _BATCHES)},
commits AS (SELECT company_id, batch, count(DISTINCT id) AS n, '2024-02-09T2' || batch || ':40:00.000Z' AS stamped FROM ({' UNION ALL '.join(f'SELECT * FROM b{n}' for n in _BATCHES)}) AS fed GROUP BY company_id, batch)
SELECT company_id, 'issues' AS entity, CAST(sum(n) AS BIGINT) AS rows, CAST(max(batch) AS BIGINT) AS batch, max(stamped) AS last_commit_at,
  CASE max(batch) WHEN 2 THEN '1h ago' WHEN 1 THEN '2h ago' ELSE '3h ago' END AS last_commit, 'stale' AS state FROM commits GROUP BY company_id""",
)
def streamed_freshness(spark, sf):
    """How fresh each company's issues are, from the ledger of the stream's commits."""
    log, progress, ledger = (scratch_path(spark, name) for name in ("board-log", "board-progress", "board-ledger"))
    start = lambda source: stream_upsert(source, log, progress, ["id"], ["updated_at"], ledger=ledger, entity="issues", scope=["company_id"], clock=_commit_time)
    board_stream(spark, sf, start)
    schema = ledger_schema(_board_rows(spark, sf, 0).select("company_id").schema)
    return freshness_of_commits(read_log(spark, ledger, schema), ["company_id"], F.lit(NOW).cast("timestamp"))


_INDEXED = """WITH tokens AS (SELECT p.doc_id, p.token FROM issue_postings p LEFT JOIN labels l ON p.doc_id = 'is-' || l.doc_id
  WHERE coalesce(l.toxic, 0) = 0 AND NOT (p.col = 'title' AND l.quality IS NOT NULL)
UNION ALL SELECT 'is-' || doc_id, CASE WHEN quality = 1 THEN 'approved' ELSE 'rejected' END FROM labels WHERE toxic = 0)
SELECT token, count(DISTINCT doc_id) AS docs, count(*) AS hits FROM tokens GROUP BY token"""


def _indexed(spark, sf) -> TextIndex:
    """Labelled issues are renamed twice, toxic ones deleted; the older rows arrive last and must not count."""
    labels = table(spark, sf, "labels").select(F.concat(F.lit("is-"), F.col("doc_id").cast("string")).alias("id"), "quality", "toxic")
    issues = view(spark, sf, "issues").join(labels, "id").select("id", "identifier", "description", "quality", "toxic")
    final = issues.withColumns({"title": F.when(F.col("quality") == 1, "approved").otherwise("rejected"), "updated_at": F.lit(STAMP_2), "gone": F.col("toxic") == 1})
    final = final.drop("quality", "toxic")
    path, schema = scratch_path(spark, "renames"), final.schema
    draft = {"title": F.lit("draft"), "updated_at": F.lit(STAMP_1), "gone": F.lit(False)}
    with freeing_shuffles(spark):
        # The older rows have the same texts, so these are joined once and read from what landed first.
        final.write.option("compression", CODEC).parquet(path)
        landed_first = spark.read.schema(schema).parquet(path)
        files = len(landed_first.inputFiles())
        landed_first.withColumns(draft).write.option("compression", CODEC).mode("append").parquet(path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, files // 2)).parquet(path)
    log = scratch_path(spark, "token-log")
    stream_index(source, log, scratch_path(spark, "token-progress"), list(ISSUE_TEXT), ["updated_at"], deleted="gone").awaitTermination()
    remove_folder(spark, path)  # the log has what the stream took
    base = stored_index(spark, sf, "issues")
    return merge_index(base, read_log(spark, log, index_log_schema(base)))


@register("stream_index", _INDEXED)
def streamed_index(spark, sf):
    return term_stats(_indexed(spark, sf))


@register("stream_fold", _INDEXED)
def folded_index(spark, sf):
    """The streamed index, written anew with its log applied."""
    return term_stats(fold_index(_indexed(spark, sf), scratch_path(spark, "folded-index")))
