"""Redaction of payloads: withheld keys and the recursive sweep over secret-looking keys."""

from __future__ import annotations

import json
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.schemas import ALLOWED_KEYS, MAX_SWEEP_DEPTH, REDACTED, SECRET_KEY_PATTERN, WITHHELD_KEYS

_SECRET = re.compile(SECRET_KEY_PATTERN, re.IGNORECASE)
_ALLOWED = frozenset(ALLOWED_KEYS)


def is_secret_key(key: str) -> bool:
    return key not in _ALLOWED and _SECRET.search(key) is not None


def _swept(value, depth: int = 0):
    if depth > MAX_SWEEP_DEPTH:
        return REDACTED
    if isinstance(value, list):
        return [_swept(item, depth + 1) for item in value]
    if isinstance(value, dict):
        return {
            key: REDACTED if item is not None and is_secret_key(key) else _swept(item, depth + 1)
            for key, item in value.items()
        }
    return value


def redact_text(raw: str | None, withheld: frozenset[str]) -> str | None:
    """Redacted form of one JSON text: verbatim if there is nothing to withhold, else written anew.

    What does not parse, or could not be written as JSON again, is withheld as a whole.
    """
    if raw is None:
        return None
    try:
        document = json.loads(raw)
        swept = document
        if isinstance(document, dict):
            swept = {key: REDACTED if key in withheld else item for key, item in document.items()}
        swept = _swept(swept)
        if swept == document and not _doubled(raw):
            return raw
        text = json.dumps(swept, ensure_ascii=False, separators=(",", ":"), allow_nan=False)
        return text if _encodes(text) else json.dumps(swept, separators=(",", ":"), allow_nan=False)
    except (ValueError, RecursionError):
        return json.dumps(REDACTED)


def _doubled(raw: str) -> bool:
    """Whether an object repeats a key: parsing keeps the last one only, the text would show the first."""
    doubled = False

    def pairs(items: list) -> dict:
        nonlocal doubled
        found = dict(items)
        doubled |= len(found) < len(items)
        return found

    json.loads(raw, object_pairs_hook=pairs)
    return doubled


def _encodes(text: str) -> bool:
    """Whether a text has no lone surrogate."""
    try:
        text.encode()
    except UnicodeEncodeError:
        return False
    return True


def _may_change(raw: Column, withheld: tuple[str, ...]) -> Column:
    """Whether a text may hold something to withhold, from the shape of its parsed value: all keys and types, however they are nested.

    So texts are parsed once and only keys are matched. Lists whose items differ in type hide their keys in the shape, a doubled key or
    no JSON gives no shape: such texts may hold something. The whole test names ``raw`` once, since every mention would parse it again.
    """
    doubtful = ["VARIANT", f"(?i:{SECRET_KEY_PATTERN})", f"(?:<[^<]*){{{MAX_SWEEP_DEPTH},}}"]
    if withheld:
        doubtful.append(rf"\b(?:{'|'.join(map(re.escape, withheld))})\b")
    shape = F.schema_of_variant(F.try_parse_json(raw))
    return F.coalesce(shape.rlike("|".join(doubtful)), F.lit(True))


def redact_json(raw: Column, entity: str) -> Column:
    """Redact opaque JSON text of any shape. Texts without anything to withhold stay in the JVM, verbatim."""
    keys = tuple(WITHHELD_KEYS[entity])
    withheld = frozenset(keys)

    @F.pandas_udf(T.StringType())
    def redacted(batch: pd.Series) -> pd.Series:
        return batch.map(lambda raw: redact_text(raw, withheld))

    # The function gives null for null only, so what it gives replaces the text.
    return F.coalesce(redacted(F.when(_may_change(raw, keys), raw)), raw)


def redact_typed(value: Column, dtype: T.DataType, withheld: tuple[str, ...] = (), depth: int = 0) -> Column:
    """The same rules for a value of declared type, as a plain expression that stays in the JVM."""
    if depth > MAX_SWEEP_DEPTH:
        return F.lit(REDACTED)
    if isinstance(dtype, T.StructType):
        fields = []
        for field in dtype.fields:
            item = value.getField(field.name)
            if field.name in withheld:
                clean = F.lit(REDACTED)
            elif is_secret_key(field.name):
                clean = F.when(item.isNotNull(), F.lit(REDACTED))
            else:
                clean = redact_typed(item, field.dataType, (), depth + 1)
            fields.append(clean.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: redact_typed(item, dtype.elementType, (), depth + 1))
    if isinstance(dtype, T.MapType):
        nested = isinstance(dtype.valueType, (T.StructType, T.ArrayType, T.MapType))

        def entry(key: Column, item: Column) -> Column:
            secret = key.rlike(f"(?i){SECRET_KEY_PATTERN}") & ~key.isin(*ALLOWED_KEYS)
            kept = redact_typed(item, dtype.valueType, (), depth + 1)
            kept = F.to_json(kept) if nested else kept.cast("string")
            return F.when(secret & item.isNotNull(), F.lit(REDACTED)).otherwise(kept)

        return F.transform_values(value, entry)
    return value


def redact_columns(frame: DataFrame, entity: str) -> DataFrame:
    """Redact every column of a typed frame."""
    row = redact_typed(F.struct(*frame.columns), frame.schema, tuple(WITHHELD_KEYS[entity]))
    return frame.select(row.alias("row")).select("row.*")


def still_readable(raw_json: Column, keys: list[str]) -> Column:
    """Whether stored text holds anything but the sentinel under one of the withheld keys."""
    values = [F.get_json_object(raw_json, f"$.{key}") for key in keys]
    return reduce(lambda a, b: a | b, [value.isNotNull() & (value != REDACTED) for value in values])
