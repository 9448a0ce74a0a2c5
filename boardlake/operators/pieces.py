"""Token lists of documents, turned over in tasks: what a piece of the documents holds per token, as few rows with lists.

A piece is a run of documents with about ``PIECE_TOKENS`` tokens. One row per token and column of a piece stands for all its occurrences there,
so that shuffles, sorts and files carry lists instead of a row per occurrence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE_TOKENS = 1_000_000
PIECE_DOCS = 65_536

Table = list[pa.RecordBatch]


def joined_fields(forward: DataFrame) -> DataFrame:
    """``forward`` with the tokens of each field as one text. Tokens hold no blanks; arrays of short strings are four times as large."""
    lines = F.transform("fields", lambda f: F.struct(f["col"].alias("col"), F.array_join(f["tokens"], " ").alias("line")))
    return forward.withColumn("fields", lines)


def split_fields(joined: DataFrame) -> DataFrame:
    """The token lists that ``joined_fields`` has joined."""
    tokens = F.transform("fields", lambda f: F.struct(f["col"].alias("col"), F.array_remove(F.split(f["line"], " "), "").alias("tokens")))
    return joined.withColumn("fields", tokens)


def _runs(batches: Iterator[pa.RecordBatch], tokens: int, docs: int, whole_ids: bool) -> Iterator[Table]:
    """Runs of neighbouring documents, cut where ``tokens`` or ``docs`` are reached; with ``whole_ids`` never between rows of one id."""
    held, size, count, last = [], 0, 0, None
    for batch in batches:
        start, lengths = 0, batch.column("doc_tokens").to_pylist()
        ids = batch.column("doc_id")
        for row, length in enumerate(lengths):
            if count and (size >= tokens or count >= docs):
                before = ids[row - 1] if row else last
                if not (whole_ids and before.as_py() == ids[row].as_py()):
                    yield [*held, batch.slice(start, row - start)]
                    held, size, count, start = [], 0, 0, row
            size, count = size + length, count + 1
        held.append(batch.slice(start))
        last = ids[len(lengths) - 1] if lengths else last
    if count:
        yield held


class Occurrences:
    """All occurrences in a run of documents, sorted by token, then as they stand: their ``field``, ``doc`` (row) and ``pos``."""

    def __init__(self, run: Table):
        self.table = pa.Table.from_batches(run).combine_chunks()
        fields = pa.concat_arrays([b.column("fields") for b in run])
        self.doc_of_field = pc.list_parent_indices(fields).to_numpy()
        names, lines = pc.list_flatten(fields).flatten()
        self.names = names.dictionary_encode()
        lists = pc.split_pattern(pc.fill_null(lines, ""), " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.list_flatten(lists)
        field = np.repeat(np.arange(len(counts)), counts)
        pos = np.arange(len(field)) - np.repeat(np.cumsum(counts) - counts, counts)
        kept = pc.not_equal(flat, "")  # an empty line is cut in one empty token
        if not pc.all(kept).as_py():
            chosen = kept.to_numpy(zero_copy_only=False)
            flat, field, pos = flat.filter(kept), field[chosen], pos[chosen]
        coded = flat.dictionary_encode()
        self.tokens = coded.dictionary
        code = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(code, kind="stable")
        self.code, self.field, self.pos = code[order].astype(np.int64), field[order], pos[order]
        self.doc = self.doc_of_field[self.field]


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the sorted keys begins."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])]))


def _lists(starts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def _pack(run: Table) -> pa.RecordBatch:
    found = Occurrences(run)
    column = found.names.indices.to_numpy(zero_copy_only=False)[found.field]
    order = np.argsort(found.code * max(1, len(found.names.dictionary)) + column, kind="stable")
    code, column, field, pos = found.code[order], column[order], found.field[order], found.pos[order]
    at = _starts(code, column, field)  # one entry per token, column and document
    rows = _starts(code[at], column[at])
    doc = found.doc_of_field[field[at]]
    ids = found.table.column("doc_id").combine_chunks()
    same = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, first = np.unique(code[at] * (len(ids) + 1) + same[doc], return_index=True)
    new = np.zeros(len(at), np.int32)
    new[first] = 1
    lengths = found.table.column("doc_tokens").to_numpy()
    ends = np.append(at, len(pos))[1:] - np.repeat(at[rows], np.diff(np.append(rows, len(at))))
    return pa.RecordBatch.from_arrays(
        [
            found.tokens.take(pa.array(code[at][rows])),
            found.names.dictionary.take(pa.array(column[at][rows])),
            pa.array(np.add.reduceat(new, rows) if len(rows) else new, pa.int32()),
            _lists(rows, ids.take(pa.array(doc))),
            _lists(rows, pa.array(lengths[doc], pa.int32())),
            _lists(rows, pa.array(ends, pa.int32())),
            _lists(at[rows], pa.array(pos, pa.int32())),
        ],
        names=["token", "col", "first", "docs", "lengths", "ends", "places"],
    )


def _mapper(tokens: int, whole_ids: bool) -> Callable:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, tokens, PIECE_DOCS, whole_ids):
            yield _pack(run)

    return packed


def packed_documents(forward: DataFrame, whole_ids: bool = False) -> DataFrame:
    """One row per piece, token and column: (token, col, first, docs, lengths, ends, places).

    ``docs`` and ``lengths`` list the documents and their tokens, ``places`` all positions, of document i up to ``ends[i]``. ``first`` counts
    the documents that no row of the token and piece has counted. With ``whole_ids`` the rows of one id are brought together and count as one document.
    """
    lines = joined_fields(forward.select("doc_id", "doc_tokens", "fields"))
    if whole_ids:
        lines = lines.repartition("doc_id").sortWithinPartitions("doc_id")
    return packed_lines(lines, whole_ids)


def packed_lines(lines: DataFrame, whole_ids: bool = False) -> DataFrame:
    """``packed_documents`` of documents whose fields are joined; with ``whole_ids`` the rows of one id lie together."""
    kind = lines.schema["doc_id"].dataType.simpleString()
    schema = f"token string, col string, first int, docs array<{kind}>, lengths array<int>, ends array<int>, places array<int>"
    return lines.mapInArrow(_mapper(PIECE_TOKENS, whole_ids), schema)


def entries_of(packed: DataFrame, *more: str) -> DataFrame:
    """One row per token, document and column: (token, doc_id, col, doc_tokens, hits, places), with the columns ``more``. Conditions on ``token`` reach the scan."""
    one = packed.select("token", "col", "ends", "places", *more, F.posexplode(F.arrays_zip("docs", "lengths")).alias("no", "doc"))
    before = F.coalesce(F.get("ends", F.col("no") - 1), F.lit(0))
    hits: Column = F.get("ends", F.col("no")) - before
    return one.select(
        "token", F.col("doc.docs").alias("doc_id"), "col", F.col("doc.lengths").cast("bigint").alias("doc_tokens"),
        hits.cast("bigint").alias("hits"), F.slice("places", before + 1, hits).alias("places"), *more,
    )


def counted(packed: DataFrame) -> DataFrame:
    """Documents and occurrences per token: (token, docs, hits)."""
    return packed.groupBy("token").agg(F.sum("first").cast("bigint").alias("docs"), F.sum(F.size("places")).cast("bigint").alias("hits"))


def _block_mapper(size: int, weights: dict[str, float], kind: pa.DataType) -> Callable:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for no, run in enumerate(_runs(batches, PIECE_TOKENS, size, False)):
            yield _block(run, no, weights, kind)

    return blocks


def _block(run: Table, no: int, weights: dict[str, float], kind: pa.DataType) -> pa.RecordBatch:
    found = Occurrences(run)
    at = _starts(found.code, found.doc)
    rows = _starts(found.code[at])
    of_column = np.array([weights[n] for n in found.names.dictionary.to_pylist()] or [0.0])
    weight = of_column[found.names.indices.to_numpy(zero_copy_only=False)][found.field]
    lengths = found.table.column("doc_tokens").to_numpy()[found.doc[at]].astype(np.int64)
    f = np.add.reduceat(weight, at) if len(at) else np.zeros(0)
    n = np.diff(np.append(rows, len(at)))
    hits = np.diff(np.append(at[rows], len(found.code)))

    def best(by, values):
        return by.reduceat(values, rows) if len(rows) else values

    block = (int(found.table.column("part")[0].as_py()) << 32) + no
    ids = found.table.column("doc_id").combine_chunks()
    empty = pa.array([None], pa.null())

    def and_names(values: pa.Array) -> pa.Array:
        return pa.concat_arrays([values, empty.cast(values.type)])

    count = len(rows) + 1
    docs = pa.ListArray.from_arrays(pa.array([None] * len(rows) + [0, len(ids)], pa.int32()), ids)
    return pa.RecordBatch.from_arrays(
        [
            and_names(found.tokens.take(pa.array(found.code[at][rows]))),
            pa.array(np.full(count, block), pa.int64()),
            and_names(pa.array(n, pa.int32())),
            and_names(pa.array(hits, pa.int64())),
            and_names(pa.array(best(np.maximum, f), pa.float64())),
            and_names(pa.array(best(np.minimum, lengths), pa.int64())),
            and_names(_lists(rows, pa.array(found.doc[at], pa.int32()))),
            and_names(_lists(rows, pa.array(f, pa.float64()))),
            and_names(_lists(rows, pa.array(lengths, pa.int64()))),
            docs.cast(pa.list_(kind)),
        ],
        names=["token", "block", "n", "hits", "max_f", "min_tokens", "places", "f", "lengths", "docs"],
    )


def blocked_documents(ordered: DataFrame, size: int, weights: dict[str, float]) -> DataFrame:
    """Blocks of at most ``size`` neighbouring documents of ``ordered`` (doc_id, doc_tokens, joined fields, part: its partition).

    One row per token and block, and one without a token that lists the block's documents in ``docs``, by place.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = ordered.schema["doc_id"].dataType
    schema = (
        "token string, block bigint, n int, hits bigint, max_f double, min_tokens bigint, places array<int>, f array<double>, "
        f"lengths array<bigint>, docs array<{id_type.simpleString()}>"
    )
    return ordered.mapInArrow(_block_mapper(size, dict(weights), to_arrow_type(id_type)), schema)
