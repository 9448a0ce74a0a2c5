"""Values inside upstream JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boardlake.schemas import ENVELOPE_KEYS


def time_text(value: Column) -> Column:
    """A JSON string as it is; numbers, objects and arrays give NULL."""
    return F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))


def listed_records(payload: Column) -> Column:
    """Records of one response: a bare array, or the first array among the known envelope keys; NULL if it holds no list at all.

    Taken out of a list of one, a response is parsed once, whatever the number of keys that are tried.
    """
    paths = ["$", *[f"$.{key}" for key in ENVELOPE_KEYS]]

    def records(document: Column) -> Column:
        return F.coalesce(*[F.try_variant_get(document, path, "array<variant>") for path in paths])

    found = F.transform(F.array(F.try_parse_json(payload)), records).getItem(0)
    return F.transform(found, lambda record: F.to_json(record))


def envelope_records(payload: Column) -> Column:
    """Records of one response; none if it holds no list."""
    return F.coalesce(listed_records(payload), F.array().cast("array<string>"))


def is_known_envelope(payload: Column) -> Column:
    """Whether a response holds a list at all; tells an empty listing from an unknown shape."""
    return listed_records(payload).isNotNull()
