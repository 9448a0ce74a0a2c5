"""Language of a text: nearest centroid among TF-IDF vectors of character n-grams, with rejection by distance.

A text's grams are runs of 1 to 3 characters over its lower-cased letters, every stretch of other characters counting as
one gap. Grams hash into a fixed number of buckets, so a vector, the document frequencies and a centroid have the same
size for any alphabet. Vectors are tf (log-damped) times idf, brought to length 1. Each language has several
centroids, found by spherical k-means among a bounded sample of its texts, as one language may be written in several ways; a text takes
the language of the centroid with the largest cosine. Each language has a radius, from the distances of its sample to their centroids: texts
outside it are marked as rejected.

Document frequencies count every text that may be learned. The sample that centroids are fitted on has at most
``per_language`` distinct texts of a language and ``sample_rows`` in all, both parameters.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardlake.llm.batches import map_rows
from boardlake.session import staged

BUCKETS = 4096
PER_LANGUAGE = 400
SAMPLE_ROWS = 4_000
CENTROIDS = 4  # of a language
SHIFTS = 12  # rounds of k-means
PARTS = 64
SLACK = 0.5  # a language's radius ends at this share of the smallest cosine of its sample with their centroids
CHUNK = 1 << 18  # characters taken at a time, so that memory does not grow with a text
UNKNOWN = "und"
_KINDS: list[np.ndarray] = []
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _kinds() -> np.ndarray:
    """Per code point: 2 for letters, 1 for marks (they stay with their letters), 0 for the rest. Built once a process."""
    if not _KINDS:
        _KINDS.append(np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8))
    return _KINDS[0]


def gram_counts(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, bool]:
    """Counts of the grams of 1 to 3 characters per bucket, and whether the text has a letter."""
    kinds, counts, lettered = _kinds(), np.zeros(buckets, np.int64), False
    before = np.zeros(1, np.uint64)  # a gap opens the text
    for start in range(0, len(text), CHUNK):
        points = np.frombuffer(text[start : start + CHUNK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = kinds[points]
        lettered = lettered or bool((kind == 2).any())
        kept = np.where(kind > 0, points, 0).astype(np.uint64)
        before = _count(before, kept, counts)
    _count(before, np.zeros(1, np.uint64), counts)
    return counts, lettered


def _count(before: np.ndarray, new: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Add the grams that end in ``new``; the last two characters go on to the next chunk."""
    line = np.concatenate([before, new])
    line = line[np.concatenate([[True], (line[1:] > 0) | (line[:-1] > 0)])]  # gaps of any length are one
    fresh, buckets = len(before), np.uint64(len(counts))
    own = np.zeros(len(line), np.uint64)
    for back, mix in enumerate(_MIX):
        shifted = line[: len(line) - back] if back else line
        own[back:] = (own[back:] ^ shifted) * mix
        ends = own[max(fresh, back) :]
        if back or len(ends):
            here = ends[line[max(fresh, back) :] > 0] if not back else ends
            counts += np.bincount(((here ^ (here >> np.uint64(29))) % buckets).astype(np.int64), minlength=len(counts))
    return line[-2:]


def gram_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of length 1 (all zeros stay): damped counts times idf."""
    vectors = (np.log1p(counts) * idf).astype(np.float32)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    """``languages[i]`` is that of row i of ``centroids``, ``radii[i]`` the least cosine it accepts."""

    languages: list[str]
    centroids: np.ndarray
    radii: np.ndarray
    idf: np.ndarray


def may_learn(id_column: Column) -> Column:
    """Rows a model may learn from: the checksum of the id (of the empty text for a null one) has not remainder 1."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 3 != 1


def _document_frequencies(texts: DataFrame, buckets: int) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts. Each task sends one row a bucket at most."""

    def run(batches: Iterator[dict[str, list]]) -> Iterator[tuple]:
        seen, n = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                seen += gram_counts(text, buckets)[0] > 0
                n += 1
        yield -1, n
        for bucket in np.flatnonzero(seen).tolist():
            yield bucket, int(seen[bucket])

    rows = map_rows(texts.select("text"), run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # buckets + 1 rows
    found = {r.bucket: r.n for r in rows}
    return np.array([found.get(b, 0) for b in range(buckets)], float), found.get(-1, 0)


def _sample(texts: DataFrame, per_language: int, rows: int) -> DataFrame:
    """``lang``, ``text``: the distinct texts of each language whose hashes are smallest, languages taking turns up to ``rows``."""
    hashed = texts.select("lang", F.xxhash64("text").alias("h")).distinct()
    # A language that has most rows is cut in parts first, each by a task of its own.
    part = F.row_number().over(Window.partitionBy("lang", F.pmod("h", F.lit(PARTS))).orderBy("h"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = hashed.withColumn("part", part).filter(F.col("part") <= per_language).withColumn("turn", turn).filter(F.col("turn") <= per_language)
    chosen = chosen.orderBy("turn", "h", "lang").limit(rows)
    last = chosen.groupBy("lang").agg(F.max("h").alias("last"))
    # Repeated texts merge in each task, so a text that fills the table travels once a task.
    return texts.withColumn("h", F.xxhash64("text")).join(last, "lang").filter("h <= last").groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")


def spherical_means(vectors: np.ndarray, k: int, shifts: int = SHIFTS) -> tuple[np.ndarray, np.ndarray]:
    """At most ``k`` unit centroids of unit rows, and each row's centroid. Starts from the mean's nearest row, then the farthest of all."""
    mean = vectors.sum(axis=0)
    starts = [int((vectors @ mean).argmax())]
    best = vectors @ vectors[starts[0]]
    while len(starts) < min(k, len(vectors)) and best.min() < 1 - 1e-6:
        starts.append(int(best.argmin()))
        best = np.maximum(best, vectors @ vectors[starts[-1]])
    centroids = vectors[starts]
    own = (vectors @ centroids.T).argmax(axis=1)
    for _ in range(shifts):
        for c in range(len(centroids)):
            members = vectors[own == c]
            if len(members):
                total = members.sum(axis=0)
                centroids[c] = total / max(float(np.linalg.norm(total)), 1e-12)
        moved = (vectors @ centroids.T).argmax(axis=1)
        if (moved == own).all():
            break
        own = moved
    return centroids, own


def fit(
    docs: DataFrame, per_language: int = PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS, buckets: int = BUCKETS,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model:
    """Learn from text and language of the rows that :func:`may_learn` leaves and whose text and language are not null.

    Texts without a letter teach nothing. Without a usable row the model has no centroid. Each language is clustered in a task of
    its own, from ``per_language`` texts at most; to the driver come ``sample_rows`` centroids at most.
    """
    known = docs.filter(may_learn(F.col(id_col)) & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    texts = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter(F.col("text").rlike(r"\p{L}"))
    frequencies, n = _document_frequencies(texts, buckets)
    idf = np.log((1 + n) / (1 + frequencies)) + 1

    def clustered(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        vectors = gram_vectors(np.stack([gram_counts(t, buckets)[0] for t in sorted(group["text"])]), idf)
        means, own = spherical_means(vectors, centroids)
        cosines = (vectors * means[own]).sum(axis=1)
        radius = SLACK * float(cosines.min())
        return pd.DataFrame([(key[0], c, radius, mean.tolist()) for c, mean in enumerate(means)], columns=["lang", "c", "radius", "centroid"])

    sample = staged(_sample(texts, per_language, sample_rows), "language-sample")
    found = sample.groupBy("lang").applyInPandas(clustered, "lang string, c int, radius double, centroid array<float>").collect()
    found.sort(key=lambda r: (r.lang, r.c))
    return Model([r.lang for r in found], np.array([r.centroid for r in found], np.float32).reshape(-1, buckets), np.array([r.radius for r in found]), idf)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``lang`` (null: none), ``nearest``, ``score`` (cosine, 0 to 1) and ``rejected`` per row, judged by its text alone.

    ``nearest`` is the language of the nearest centroid, of equal ones the first by code points; it is null for null texts, texts
    without a letter and an empty model, and then ``score`` is 0. ``lang`` is the same unless the text lies outside the radius
    of that centroid (``rejected``). Null and repeated ids and repeated rows are judged each for itself, whole texts always. An empty table
    gives no rows. Other columns are not read.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[dict[str, list]]) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, len(batch["text"]), 256):
                yield from _judged(model, batch["id"][start : start + 256], batch["text"][start : start + 256])

    return map_rows(picked, run, f"id {picked.schema['id'].dataType.simpleString()}, lang string, nearest string, score double, rejected boolean")


def _judged(model: Model, keys: list, texts: list[str | None]) -> Iterator[tuple]:
    counted = [gram_counts(t or "", len(model.idf)) for t in texts]
    cosines = gram_vectors(np.stack([c for c, _ in counted]), model.idf) @ model.centroids.T
    for key, (_, lettered), row in zip(keys, counted, cosines):
        if not lettered or not len(row):
            yield key, None, None, 0.0, False
            continue
        best = int(row.argmax())
        rejected = bool(row[best] < model.radii[best])
        language = model.languages[best]
        yield key, None if rejected else language, language, min(1.0, max(0.0, float(row[best]))), rejected
