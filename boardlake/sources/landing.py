"""Landed API pages: raw responses on storage, read in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions.payload import envelope_records, is_known_envelope, listed_records
from boardlake.schemas import LANDED_PAGE

UNKNOWN_SHAPE = "unknown response shape"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages from JSON lines; the payload is the response as text."""
    return spark.read.schema(LANDED_PAGE).json(path)


def stream_pages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LANDED_PAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def page_records(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per record of every page: the page's columns, ``raw`` and its place ``item`` on the page."""
    return _record_rows(pages, payload, envelope_records(F.col(payload)))


def record_rows(pages: DataFrame) -> DataFrame:
    """The same from pages whose payload is parsed already (``with_records``)."""
    return _record_rows(pages, "records", F.col("records"))


def _record_rows(pages: DataFrame, source: str, records: Column) -> DataFrame:
    rest = [c for c in pages.columns if c != source]
    # The outer form makes the list once; an inner explode would make it again to filter empty pages.
    exploded = pages.select(*rest, F.posexplode_outer(records).alias("item", "raw"))
    return exploded.filter(F.col("raw").isNotNull())


def with_records(pages: DataFrame, direct: Column) -> DataFrame:
    """Pages with their ``records`` in place of the payload, parsed once for all steps that read them; no list is an error, as in ``with_shape``.

    Pages that are ``direct`` answers keep their payload and have no records.
    """
    parsed = pages.withColumn("records", F.when(~direct, listed_records(F.col("payload"))))
    unknown = ~direct & F.col("error").isNull() & F.col("records").isNull()
    error = F.when(unknown, F.lit(UNKNOWN_SHAPE)).otherwise(F.col("error"))
    return parsed.withColumn("error", error).withColumn("payload", F.when(direct, F.col("payload")))


def with_shape(pages: DataFrame) -> DataFrame:
    """Give pages without a list an error, so that an unknown shape never passes for an empty listing."""
    unknown = F.col("error").isNull() & ~is_known_envelope(F.col("payload"))
    return pages.withColumn("error", F.when(unknown, F.lit(UNKNOWN_SHAPE)).otherwise(F.col("error")))


def page_errors(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Per ``keys`` the error of its pages: that of a page, or ``incomplete`` if a page number or the end is missing.

    Also ``answered``: whether a page came without an error. Repeated pages, as of a retry, do no harm.
    """
    number = F.col("page_no")
    found = pages.groupBy(*keys).agg(
        F.max("error").alias("_error"), F.bool_or(F.col("error").isNull()).alias("answered"),
        F.min(number).alias("_first"), F.count_distinct(number).alias("_n"),
        F.max(F.struct(number, F.coalesce("last", F.lit(False)).alias("last"))).alias("_end"),
    )
    whole = (F.col("_first") == 0) & (F.col("_n") == F.col("_end.page_no") + 1) & F.col("_end.last")
    error = F.coalesce("_error", F.when(~F.coalesce(whole, F.lit(False)), F.lit("incomplete: a page or the end is missing")))
    return found.select(*keys, "answered", F.col("_error").alias("page_error"), error.alias("error"))


def company_records(pages: DataFrame) -> DataFrame:
    """One company record per target: the direct answer, else the row of that id in a listing; of several the last to arrive.

    A direct answer is an object with an id; a listing is anything with a list in it.
    """
    answered = pages.filter(F.col("error").isNull())
    direct = answered.filter(F.get_json_object("payload", "$.id").isNotNull()).select(
        "profile", "company_id", F.struct("page_no", F.lit(0).alias("item")).alias("place"), F.col("payload").alias("raw")
    )
    listed = page_records(answered).filter(F.get_json_object("raw", "$.id") == F.col("company_id"))
    fallback = listed.select("profile", "company_id", F.struct("page_no", "item").alias("place"), "raw").join(direct, ["profile", "company_id"], "left_anti")
    return direct.unionByName(fallback).groupBy("profile", "company_id").agg(F.max_by("raw", F.struct("place", "raw")).alias("raw"))
