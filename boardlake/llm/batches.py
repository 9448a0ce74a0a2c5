"""Arrow batches in tasks: the shape all Python-backed operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def as_schema(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def map_rows(frame: DataFrame, rows: Callable[[Iterator[dict[str, list]]], Iterator[tuple]], ddl: str, size: int = 8192) -> DataFrame:
    """Run ``rows`` in each task: it takes dictionaries of column lists and yields output tuples.

    Spark bounds an input batch by rows and bytes; the output is cut into batches of ``size`` rows.
    """
    schema = as_schema(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)} for batch in batches if batch.num_rows)
        held: list[tuple] = []
        for row in rows(columns):
            held.append(row)
            if len(held) >= size:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    return frame.mapInArrow(run, schema)


def map_arrays(frame: DataFrame, arrays: Callable[[Iterator[pa.RecordBatch]], Iterator[list]], ddl: str) -> DataFrame:
    """Like :func:`map_rows` for code on whole columns: ``arrays`` yields a list of column arrays per output batch."""
    schema = as_schema(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in arrays(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return frame.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, type=f.type) for column, f in zip(zip(*rows), schema)], schema=schema)
