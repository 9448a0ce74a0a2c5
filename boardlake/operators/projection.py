"""Typed rows from raw payload records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.functions.payload import time_text
from boardlake.operators.redaction import redact_json
from boardlake.schemas import ENTITY_FIELDS, entity_schema, payload_ddl


def _typed(parsed: Column, key: str, rule: str, default: str | None = None) -> Column:
    value = parsed.getField(key)
    if rule == "time":
        value = time_text(value)
    return value if default is None else F.coalesce(value, F.lit(default))


def _parsed(records: DataFrame, entity: str, raw: str) -> DataFrame:
    """Records with their text redacted and parsed: every typed column comes from the redacted text."""
    redacted = records.withColumn(raw, redact_json(F.col(raw), entity))
    # Taken out of a list of one, a record is parsed once: filters on its fields are not moved below, where they would parse it again.
    return redacted.withColumn("_record", F.explode_outer(F.array(F.from_json(F.col(raw), payload_ddl(entity)))))


def _has_ids(entity: str) -> Column:
    required = [F.col("_record").getField(key).isNotNull() for _, key, rule, *_ in ENTITY_FIELDS[entity] if rule == "id"]
    keep = required[0]
    for condition in required[1:]:
        keep = keep & condition
    return F.coalesce(keep, F.lit(False))


def project_records(
    records: DataFrame,
    entity: str,
    synced_at: Column | str,
    api_base: Column | str | None = None,
    raw: str = "raw",
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of the stored schema from records holding one JSON object each in ``raw``.

    Records without a required id are left out here and listed by ``quarantined``. ``keep`` names
    further input columns to carry along, such as the arrival order.
    """
    projected = project_all(records, entity, synced_at, api_base, raw, keep)
    return projected.filter("_whole").drop("_whole")


def project_all(
    records: DataFrame,
    entity: str,
    synced_at: Column | str,
    api_base: Column | str | None = None,
    raw: str = "raw",
    keep: list[str] | None = None,
) -> DataFrame:
    """The same for all records in one parse: ``_whole`` tells those with all required ids from those for quarantine."""
    stamp = F.lit(synced_at) if isinstance(synced_at, str) else synced_at
    fields = [_typed(F.col("_record"), key, rule, *default).alias(name) for name, key, rule, *default in ENTITY_FIELDS[entity]]
    if entity == "companies":
        base = F.lit(api_base) if api_base is None or isinstance(api_base, str) else api_base
        fields.append(F.coalesce(base, F.lit("")).alias("api_base"))
    fields.append(stamp.cast("string").alias("synced_at"))
    if entity == "issues":
        fields.append(F.lit(None).cast("string").alias("comments_synced_at"))
    fields.append(F.col(raw).alias("raw_json"))
    projected = _parsed(records, entity, raw).select(*fields, *(keep or []), _has_ids(entity).alias("_whole"))
    assert projected.columns[: len(entity_schema(entity))] == entity_schema(entity).names
    return projected


def quarantined(records: DataFrame, entity: str, raw: str = "raw") -> DataFrame:
    """Input records that lack a required id, their text redacted."""
    return _parsed(records, entity, raw).filter(~_has_ids(entity)).drop("_record")
