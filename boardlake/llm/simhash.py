"""SimHash near-duplicates found by anchor-point covering.

Fingerprints have 64 bits. The anchors are the words of the perfect Hamming code of length 63 (all bits but the
lowest): its covering radius is 1, so every fingerprint has an anchor within 1. Two fingerprints t bits apart have a
point between them within ceil(t / 2) of both, and that point an anchor within the radius; so each fingerprint is
copied to the anchors within 1 + ceil(t / 2) (32 of them for t = 2), and every linked pair meets at one anchor. No
pair is missed, whatever the data. As distinct fingerprints alone travel, an anchor has at most
2 (1 + 63 + 1953) of them, by geometry: no group grows with the data.

Links of an anchor go on as a spanning forest, never as all pairs, and components come from repeated contraction
over checkpointed edges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.llm.batches import map_arrays, map_rows
from boardlake.llm.components import component_labels
from boardlake.session import remove_folder, scratch_path, staged

SEED = 42
DISTANCE = 2
BANDS = 20
BAND_SHINGLES = 5
SHORT = 24  # shingles; sets up to this size have keys that every similar set shares
BINS = 256
DEVIATIONS = 4  # by which the bins' estimate may fall short before a pair is out
BLOCK_ROWS = 8_192
BLOCK_BYTES = 64 << 20
REMEMBERED = 1 << 18  # shingle sets a task knows again
_SALTS = [np.uint64(xxhash.xxh64_intdigest(b"order", t)) for t in range(BANDS)]
_ODD, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of a text's word shingles: a bit is 1 if set in over half of their hashes. No words: 0."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - width + 1)
    last = ends[width - 1 :] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())], np.uint64)
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 65_536):
        counts += np.unpackbits(hashes[k : k + 65_536].view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(counts * 2 > n)
    return int(sum(1 << int(b) for b in bits))


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``id`` and ``fp`` (the 64 bits as a signed long) per row; null texts are empty."""
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            for key, text in zip(batch["id"], batch["text"]):
                value = fingerprint(text, width)
                yield key, value - (1 << 64) if value >> 63 else value

    return map_rows(picked, run, f"id {picked.schema['id'].dataType.simpleString()}, fp bigint")


_POSITIONS = np.arange(1, 64, dtype=np.uint64)


def anchors(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for all code words within 2 of each point: unsigned 64-bit values, bit i of the code at bit i, i = 1..63."""
    words = points & ~np.uint64(1)
    syndrome = np.zeros(len(points), np.uint64)
    for i in _POSITIONS:
        syndrome ^= np.where((words >> i) & np.uint64(1) == 1, i, np.uint64(0))
    one = np.uint64(1)
    # Flipping the position named by the syndrome corrects to a word within 1; flipping i and syndrome ^ i to those within 2.
    rows = [np.arange(len(points))]
    out = [np.where(syndrome > 0, words ^ (one << syndrome), words)]
    for i in _POSITIONS:
        other = syndrome ^ i
        pick = np.flatnonzero((syndrome > 0) & (other > i))
        rows.append(pick)
        out.append(words[pick] ^ (one << i) ^ (one << other[pick]))
    return np.concatenate(rows), np.concatenate(out)


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    for batch in batches:
        points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(0, len(points), 20_000):
            part = points[k : k + 20_000]
            row, anchor = anchors(part)
            yield [anchor.view(np.int64), part[row].view(np.int64)]


def _links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[list]:
    """Spanning links of every anchor's points, from rows sorted by anchor; the last anchor of a batch waits for the next."""
    held_a, held_p = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        a = np.concatenate([held_a, batch.column(0).to_numpy(zero_copy_only=False)])
        p = np.concatenate([held_p, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        cut = int(np.searchsorted(a, a[-1])) if len(a) else 0  # sorted: the start of the last anchor
        yield from _linked(a[:cut], p[:cut], distance)
        held_a, held_p = a[cut:], p[cut:]
    yield from _linked(held_a, held_p, distance)


def _linked(a: np.ndarray, p: np.ndarray, distance: int) -> Iterator[list]:
    if len(a) < 2:
        return
    edges = np.flatnonzero(np.diff(a)) + 1
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(a)]])
    many = np.flatnonzero(ends - starts > 1)
    left, right = [], []
    for s, e in zip(starts[many].tolist(), ends[many].tolist()):
        own = p[s:e]
        if e - s == 2:
            if int(own[0] ^ own[1]).bit_count() <= distance:
                left.append(int(own[0]))
                right.append(int(own[1]))
            continue
        # Grow each tree over the points not yet reached: one comparison row per point, one link per point.
        todo = own
        while len(todo) > 1:
            queue, todo = [todo[0]], todo[1:]
            while queue and len(todo):
                x = queue.pop()
                near = np.bitwise_count(todo ^ x) <= distance
                if near.any():
                    found = todo[near]
                    todo = todo[~near]
                    queue.extend(found)
                    left.extend([int(x)] * len(found))
                    right.extend(found.tolist())
    if left:
        yield [np.array(left, np.uint64).view(np.int64), np.array(right, np.uint64).view(np.int64)]


def linked_points(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a`` and ``b``: links that span all groups of distinct ``fp`` values at ``distance`` (2 at most) or fewer bits."""
    if not 0 < distance <= 2:
        raise ValueError("the anchors cover distances 1 and 2")
    covered = map_arrays(points.select("fp"), _cover, "anchor bigint, fp bigint")
    dealt = covered.repartition("anchor").sortWithinPartitions("anchor")
    return map_arrays(dealt, lambda batches: _links(batches, distance), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` (the smallest id of the group) per row.

    Null and empty texts have fingerprint 0 and link like any other. Repeated rows stay rows. Null ids are never a
    group's smallest; a group of null ids only has component null. An empty table gives none. Other columns are not read.
    """
    rows = staged(with_fingerprints(docs, id_col, text_col, width), "simhash-rows")
    points = rows.groupBy("fp").agg(F.min("id").alias("least"))
    links = staged(linked_points(points, distance), "simhash-links")
    labels = component_labels(links, "a", "b")
    grouped = points.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    smallest = grouped.groupBy("label").agg(F.min("least").alias("component_id"))
    components = grouped.select("fp", "label").join(smallest, "label").select("fp", "component_id")
    return rows.join(components, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Distinct hashes of a text's word shingles (fewer words: of the whole sequence; none: no hash)."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(words[i : i + width]), SEED) for i in range(max(1, len(words) - width + 1))], np.uint64))


def short_keys(hashes: np.ndarray, similarity: float) -> list[int]:
    """Keys of a set (ascending) of which two sets as similar as that share one, whatever they hold.

    They have at least ``similarity`` of either in common, of n hashes o. So the n - o + 1 smallest of both have one in
    common, and with one more of each, two: the keys are the pairs of these (one hash or the pair, if o is 1).
    """
    n = len(hashes)
    least = max(1, math.ceil(similarity * n - 1e-9))
    together = min(2, least)
    return [xxhash.xxh64_intdigest(np.array(own, np.uint64).tobytes(), BANDS) - (1 << 63) for own in combinations(hashes[: n - least + together].tolist(), together)]


def sketch(hashes: np.ndarray, similarity: float = 0.8) -> tuple[list[int], bytes]:
    """Band keys and bins of a shingle set.

    A band key is the SimHash-like mix of the smallest shingles under one of ``BANDS`` orders, so two texts of similarity s
    share one with probability about s to the power of ``BAND_SHINGLES``. Sets of up to ``SHORT`` shingles have
    :func:`short_keys` instead, and larger ones that may be similar to such a set have both. A bin holds 16 bits of the
    smallest hash in its share of all hashes, 0 if empty; equal bins among those in use estimate the similarity.
    """
    bins = np.zeros(BINS, np.uint16)
    if not len(hashes):
        return [], bins.tobytes()
    least = np.sort(hashes)[::-1]
    bins[(least & np.uint64(BINS - 1)).astype(np.int64)] = ((least >> np.uint64(16)) % np.uint64(65_535)).astype(np.uint16) + np.uint16(1)  # the last written is the smallest
    keys = short_keys(least[::-1], similarity) if len(hashes) * similarity <= SHORT + 1e-9 else []
    if len(hashes) > SHORT:
        for t, salt in enumerate(_SALTS):
            # Mixed twice: a hash that is small under one order must not tend to be small under the next.
            order = (hashes ^ salt) * _ODD
            order = (order ^ (order >> np.uint64(32))) * _OTHER
            chosen = np.sort(np.partition(order, BAND_SHINGLES - 1)[:BAND_SHINGLES])
            keys.append(xxhash.xxh64_intdigest(chosen.tobytes(), t) - (1 << 63))
    return keys, bins.tobytes()


def packed(hashes: np.ndarray) -> bytes:
    """A shingle set as sorted 32-bit values: equal ones of unlike shingles are rarer than one in 100,000 even for 20,000 of either."""
    return np.unique((hashes >> np.uint64(32)).astype(np.uint32)).tobytes()


def _jaccard(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Jaccard similarity of a sorted set to each of the others; empty sets are alike."""
    sizes = np.array([len(o) for o in others])
    if not len(own):
        return (sizes == 0).astype(float)
    every = np.concatenate(others)
    equal = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
    until, ends = np.concatenate([[0], np.cumsum(equal)]), np.cumsum(sizes)
    both = until[ends] - until[ends - sizes]
    return both / (len(own) + sizes - both)


def _similar_links(batches, similarity: float) -> Iterator[tuple[str, str]]:
    """Spanning links of the texts of every part of a bucket, from rows sorted by band key and part."""

    def parts():
        at, keys, bins, sets = None, [], [], []
        for batch in batches:
            for band, first, second, key, own, shingles in zip(batch["band"], batch["first"], batch["second"], batch["key"], batch["bins"], batch["shingles"]):
                if (band, first, second) != at:
                    yield keys, bins, sets
                    at, keys, bins, sets = (band, first, second), [], [], []
                keys.append(key)
                bins.append(own)
                sets.append(shingles)
        yield keys, bins, sets

    for keys, bins, sets in parts():
        if len(keys) < 2:
            continue
        table = np.frombuffer(b"".join(bins), np.uint16).reshape(-1, BINS)
        used, todo = table > 0, np.arange(len(keys))
        sets = None if sets[0] is None else [np.frombuffer(x, np.uint32) for x in sets]
        while len(todo):
            queue, todo = [todo[0]], todo[1:]
            while queue and len(todo):
                x = queue.pop()
                equal, either = ((table[todo] == table[x]) & used[x]).sum(axis=1), np.maximum(1, (used[todo] | used[x]).sum(axis=1))
                if sets is None:
                    near = equal >= similarity * either
                else:
                    # The bins only rule out; what they leave is settled by the sets.
                    near = equal >= similarity * either - DEVIATIONS * np.sqrt(similarity * (1 - similarity) * either)
                    if near.any():
                        near[near] = _jaccard(sets[x], [sets[y] for y in todo[near]]) >= similarity - 1e-9
                queue.extend(todo[near])
                for y in todo[near]:
                    yield keys[x], keys[y]
                todo = todo[~near]


def similar_links(rows: DataFrame, similarity: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``x`` and ``y``: links that span the groups of similar texts among those that share a band (``key``, ``bands``, ``bins``, ``shingles``).

    The shingle sets decide (without that column, the estimate of the bins). A bucket of more than ``block_rows`` texts,
    or ``BLOCK_BYTES`` of shingles, is dealt into blocks of about that size by a hash, and every two blocks
    meet in a part of their own. So no two texts of a bucket are left uncompared, and a part holds about two
    blocks at most, however many texts share a band.
    """
    rows = rows if "shingles" in rows.columns else rows.withColumn("shingles", F.lit(None).cast("binary"))
    kind = rows.schema["key"].dataType.simpleString()
    bands = rows.select("key", F.coalesce(F.length("shingles"), F.lit(0)).alias("size"), F.explode("bands").alias("band"))
    counted = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).filter("n > 1")
    blocks = F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("bytes") / BLOCK_BYTES))
    shared = staged(counted.select("band", blocks.cast("int").alias("blocks")), "copies-bands")
    own = F.pmod(F.xxhash64("key", "band"), F.col("blocks")).cast("int")
    met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(own, j).alias("first"), F.greatest(own, j).alias("second")))
    # Texts of a band in several blocks take part in each pair of blocks with their own.
    carried = rows.select("key", "bins", "shingles", F.explode("bands").alias("band")).join(shared, "band")
    place = ["band", "first", "second"]
    members = carried.select("key", "bins", "shingles", "band", F.explode(met).alias("part")).select("band", "part.first", "part.second", "key", "bins", "shingles")
    dealt = members.repartition(*place).sortWithinPartitions(*place, "key")
    return map_rows(dealt, lambda batches: _similar_links(batches, similarity), f"x {kind}, y {kind}").distinct()


def _sketched(texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """``key``, ``set`` (digest of the shingle set), ``fp``, ``bands``, ``bins``, ``shingles`` per row.

    A task writes the last four once for each set it meets (null after that; what it remembers is bounded), so exact copies and copies that differ in
    spaces or case only are not carried on.
    """

    def run(batches):
        known: set[bytes] = set()
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"]):
                hashes = shingle_hashes(text, width)
                digest = xxhash.xxh128_digest(hashes.tobytes())
                # Fingerprints count repeats, so equal sets may have several.
                value = fingerprint(text, width)
                value -= (1 << 64) if value >> 63 else 0
                if (digest, value) in known:
                    yield key, digest, None, None, None, None
                    continue
                if len(known) >= REMEMBERED:
                    known.clear()
                known.add((digest, value))
                yield key, digest, value, *sketch(hashes, similarity), packed(hashes)

    return map_rows(texts.select("key", F.col("text").cast("binary").alias("text")), run, "key string, set binary, fp bigint, bands array<bigint>, bins binary, shingles binary", size=512)


def _units(bands: DataFrame, block_rows: int) -> DataFrame:
    """``set`` and ``units``: where each set that shares a band with another meets the others.

    Sets joined by shared bands, directly or through others, are a cluster. Those of a cluster that fits a block meet once, as one unit:
    near copies share most of their bands, and would meet again in each. Those of a larger cluster meet by their bands.
    """
    first = bands.groupBy("band").agg(F.min("set").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "first")
    shared = staged(bands.join(first, "band"), "copies-shared")
    clusters = component_labels(shared, "set", "first").withColumnRenamed("node", "set")
    sizes = clusters.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    placed = staged(clusters.join(sizes, "label").select("set", "label", (F.col("n") <= block_rows).alias("small")), "copies-clusters")
    small = placed.filter("small").select("set", F.array(F.xxhash64(F.lit("cluster"), "label")).alias("units"))
    large = shared.join(placed.filter("NOT small"), "set", "left_semi").groupBy("set").agg(F.collect_set("band").alias("units"))
    return small.unionByName(large)


def near_copy_groups(texts: DataFrame, width: int = 5, similarity: float = 0.8, distance: int = DISTANCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``key`` and ``label`` of texts (``key``, ``text``): equal labels for near copies. A key stands for one text; rows may repeat.

    SimHash fingerprints at ``distance`` or fewer bits propose texts by the anchors above. At 64 bits that reaches
    copies with very few edits only, as a similarity of 0.8 leaves about ten bits apart. For the others, smaller
    fingerprints of samples of the shingles (bands) propose texts. Whoever proposes, the Jaccard similarity of their shingle sets decides; bins rule out most others before.
    Texts of equal shingle sets are one from the start, and a set travels to where it is compared once, not once for each of its bands.
    Texts without words are alike. Null texts are not expected here.
    """
    spark, path = texts.sparkSession, scratch_path(texts.sparkSession, "copies-sketches")
    sketches = _sketched(texts, width, similarity)
    sketches.write.parquet(path)
    sketches = spark.read.schema(sketches.schema).parquet(path)
    sketched = sketches.filter("fp IS NOT NULL")
    links = staged(linked_points(sketched.select("fp").distinct(), distance), "copies-links")
    # Linked fingerprints are one more band: they count repeats, so texts that share a filler only may have them too.
    linked = component_labels(links, "a", "b").select(F.col("node").alias("fp"), F.col("label").alias("bits"))
    by_bits = F.xxhash64(F.lit("bits"), F.coalesce("bits", "fp"))
    bands = sketched.select("set", F.explode("bands").alias("band")).unionByName(sketched.select("set", "fp").join(linked, "fp", "left").select("set", by_bits.alias("band")))
    units = _units(bands.distinct(), block_rows)
    # Tasks that met the same set wrote it each for itself: one is taken.
    carried = sketched.select("set", "bins", "shingles").join(units, "set").groupBy("set").agg(F.first("units").alias("bands"), F.first("bins").alias("bins"), F.first("shingles").alias("shingles"))
    members = scratch_path(spark, "copies-members")
    carried = carried.withColumnRenamed("set", "key")
    carried.write.parquet(members)
    edges = staged(similar_links(spark.read.schema(carried.schema).parquet(members), similarity, block_rows), "copies-edges")
    labels = component_labels(edges, "x", "y").withColumnRenamed("node", "set")
    named = sketches.select("key", "set").distinct().join(labels, "set", "left").select("key", F.coalesce("label", "set").alias("group"))
    least = named.groupBy("group").agg(F.min("key").alias("label"))
    found = staged(named.join(least, "group").select("key", "label"), "copies-groups")
    for folder in (path, members):
        remove_folder(spark, folder)
    return found
