"""Approximate nearest neighbours by cosine with an inverted multi-index.

Unit vectors are cut into two halves, each quantised by its own codebook, so K + K centroids make K * K cells. A
query walks the pairs of centroids by summed distance with a heap (each pop opens its two neighbours in the
sorted lists) until the cells it passed hold ``probe_share`` of all distinct vectors, and reranks what they hold by the
exact cosine of the original vectors.

The codebooks come from a bounded sample (``SAMPLE_VECTORS`` vectors, the smallest by hash, the same at every size);
every vector is indexed. Codebooks and cell counts (K * K numbers) are all that is sent to tasks. Equal vectors are one
entry with their ``k + 1`` smallest ids, which is all that an answer can hold, so a vector that a third of
the rows share costs one comparison. Buckets are rows of cells (one first centroid), cut into blocks of about
``BLOCK_VECTORS``; the queries of a block pass by as a stream.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardlake.llm.batches import map_arrays, map_rows
from boardlake.session import staged

CENTROIDS = 32
SAMPLE_VECTORS = 10_000
PROBE_SHARE = 0.6
LEAST_PROBED = 1_000
BLOCK_VECTORS = 4_096
QUERY_CHUNK = 512
ROUNDS = 12


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """In double precision, scaled first so that neither tiny nor huge components lose the norm."""
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b)))


def train(sample: np.ndarray, centroids: int) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks of both halves by Lloyd rounds from evenly spaced sample rows."""
    cut = sample.shape[1] // 2
    return _codebook(sample[:, :cut], centroids), _codebook(sample[:, cut:], centroids)


def _codebook(points: np.ndarray, centroids: int) -> np.ndarray:
    if not points.shape[1]:
        return np.zeros((1, 0))
    book = points[np.linspace(0, len(points) - 1, min(centroids, len(points))).astype(int)].copy()
    for _ in range(ROUNDS):
        near = _distances(points, book).argmin(axis=1)
        for c in np.unique(near):
            book[c] = points[near == c].mean(axis=0)
    return np.unique(book, axis=0)


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ book.T + (book**2).sum(axis=1)[None, :]


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: int) -> Iterator[tuple[int, int]]:
    """Pairs of centroids by summed distance until their cells hold ``enough`` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    da, db = first[a].tolist(), second[b].tolist()
    heap, seen, held = [(da[0] + db[0], 0, 0)], {(0, 0)}, 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        here = int(counts[a[i], b[j]])
        if here:
            held += here
            yield int(a[i]), int(b[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(da) and y < len(db) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (da[x] + db[y], x, y))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def valid_vectors(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``v`` and ``key`` (of the components) of the vectors that take part.

    Left out: null ids, null, empty and zero vectors, null or non-finite components, and vectors whose dimension is
    not the most frequent one (of equally frequent ones, the largest).
    """
    # Huge and infinite values, NaN included, are not below the largest double.
    largest = 1.7976931348623157e308
    fine = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x) <= largest) & ~F.isnan(x)) & F.exists(vector_col, lambda x: x != 0)
    rows = frame.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    width = sizes.orderBy(F.desc("rows"), F.desc("n")).first()
    rows = rows.filter(F.size("v") == (width["n"] if width else 0))
    # 0.0 turns -0.0 into 0.0, so that equal vectors have equal keys.
    return rows.withColumn("key", F.md5(F.concat_ws(",", F.transform("v", lambda x: (x + 0.0).cast("string")))))


def nearest(frame: DataFrame, is_query: Column, k: int = 5, centroids: int = CENTROIDS, probe_share: float = PROBE_SHARE, least_probed: int = LEAST_PROBED, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id_col`` and ``score`` of the ``k`` nearest found for the rows where ``is_query`` holds.

    Largest cosine first, ties to the smaller id; a row's own id is no candidate of it. Rows of one id with equal
    vectors are one; with unequal ones each is a query and a candidate, and its best score per neighbour counts. Vectors that
    take no part (see :func:`valid_vectors`) neither ask nor answer. An empty table gives none.
    """
    spark = frame.sparkSession
    rows = staged(valid_vectors(frame, id_col, vector_col), "index-vectors")
    kind, element = rows.schema["id"].dataType.simpleString(), rows.schema["v"].dataType.simpleString()
    order = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    distinct_ids = rows.select("key", "id").distinct().withColumn("_n", order).filter(F.col("_n") <= k + 1).groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    ones = rows.join(distinct_ids.select("key", "ids", F.element_at("ids", 1).alias("id")), ["key", "id"]).dropDuplicates(["key"])
    ones = staged(ones.select("key", "ids", "v"), "index-distinct")
    sample = [r.v for r in ones.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_VECTORS).select("v").collect()]
    answer = f"query_id {kind}, id {kind}, score double"
    if not sample:
        return spark.createDataFrame([], answer).select("query_id", F.lit(1).alias("rank"), F.col("id").alias(id_col), "score")
    width = len(sample[0])
    books = train(unit(np.array(sample, np.float64)), centroids)

    def places(batches):
        for batch in batches:
            own = unit(_matrix(batch.column(2), width))
            cut = width // 2
            yield [batch.column(0), batch.column(1), batch.column(2), _distances(own[:, :cut], books[0]).argmin(axis=1).astype(np.int32), _distances(own[:, cut:], books[1]).argmin(axis=1).astype(np.int32)]

    index = staged(map_arrays(ones, places, f"key string, ids array<{kind}>, v {element}, a int, b int"), "index-cells")
    counts = np.zeros((len(books[0]), len(books[1])), np.int64)
    for r in index.groupBy("a", "b").count().collect():  # K * K rows at most
        counts[r.a, r.b] = r["count"]
    enough = max(least_probed, int(np.ceil(probe_share * counts.sum())))
    blocks = np.maximum(1, -(-counts.sum(axis=1) // BLOCK_VECTORS)).tolist()

    def ask(batches):
        for batch in batches:
            own = unit(_matrix(batch.column(1), width))
            cut = width // 2
            first, second = _distances(own[:, :cut], books[0]), _distances(own[:, cut:], books[1])
            ids, vectors = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[list] = [[], [], [], [], []]
            for i, key in enumerate(ids):
                cells: dict[int, list[int]] = {}
                for a, b in walk(first[i], second[i], counts, enough):
                    cells.setdefault(a, []).append(b)
                for a, bs in cells.items():
                    for block in range(blocks[a]):
                        for column, value in zip(out, (a, block, key, bs, vectors[i])):
                            column.append(value)
            yield out

    asked = rows.join(frame.filter(is_query).select(F.col(id_col).alias("id")), "id", "left_semi").select("id", "v").distinct()
    questions = map_arrays(asked, ask, f"a int, block int, id {kind}, cells array<int>, v {element}")
    of = F.element_at(F.array(*[F.lit(int(n)) for n in blocks]), F.col("a") + 1)
    entries = index.select("a", F.pmod(F.xxhash64("key"), of).cast("int").alias("block"), F.lit(None).cast(kind).alias("id"), F.array("b").alias("cells"), "v", "ids")
    both = entries.unionByName(questions.withColumn("ids", F.lit(None).cast(f"array<{kind}>")))
    dealt = both.withColumn("asks", F.col("ids").isNull()).repartition("a", "block").sortWithinPartitions("a", "block", "asks")
    found = map_rows(dealt.select("a", "block", "id", "cells", "v", "ids"), _Rerank(k), answer)
    best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


class _Rerank:
    """The ``k`` best entries of a block for each query that passes by; entries come first in a block."""

    def __init__(self, k: int):
        self.k = k

    def __call__(self, batches):
        at, entries, waiting, ready = None, [], [], None
        for batch in batches:
            for a, block, key, cells, v, ids in zip(*(batch[c] for c in ("a", "block", "id", "cells", "v", "ids"))):
                if (a, block) != at:
                    yield from self._answers(ready, waiting)
                    at, entries, waiting, ready = (a, block), [], [], None
                if ids is not None:
                    entries.append((cells[0], v, ids))
                    continue
                if ready is None:
                    ready = self._prepared(entries)
                waiting.append((key, cells, v))
                if len(waiting) >= QUERY_CHUNK:
                    yield from self._answers(ready, waiting)
                    waiting = []
        yield from self._answers(ready, waiting)

    @staticmethod
    def _prepared(entries):
        if not entries:
            return None
        vectors = np.array([v for _, v, _ in entries], np.float64)
        return np.array([b for b, _, _ in entries]), vectors, unit(vectors), [ids for _, _, ids in entries]

    def _answers(self, ready, waiting):
        if not ready or not waiting:
            return
        cell, vectors, units, ids = ready
        queries = np.array([v for _, _, v in waiting], np.float64)
        scores = unit(queries) @ units.T
        for row, (key, cells, _), query in zip(scores, waiting, queries):
            row[~np.isin(cell, cells)] = -np.inf
            # One more than k, as the query's own entry may be among them; near ties are all looked at.
            n = min(self.k + 1, len(row))
            level = np.partition(row, -n)[-n]
            near = np.flatnonzero((row >= level - 1e-9) & np.isfinite(row))
            best = sorted((-cosine(query, vectors[i]), other) for i in near for other in ids[i] if other != key)
            for score, other in best[: self.k]:
                yield key, other, -score
