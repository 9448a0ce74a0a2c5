"""Removal of repeated word windows by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the smallest hash of the k-word runs in it; consecutive
windows that share a minimiser's place travel as one packed string to the bucket of that hash, where the windows
are unpacked and sorted, so equal ones lie side by side and the smallest document id of each is exact.

What keeps it bounded: equal texts are one from the start; only minimisers that two texts or more have are
packed; a bucket is read as a stream of groups sorted by minimiser. A minimiser of more than ``group_limit`` windows
(of a passage a large share of all documents has, or of a phrase that one text repeats very often) is spread instead: each of its windows becomes a row keyed by a
128-bit digest of its words, of which an aggregate, reduced in each task before the shuffle, finds the smallest id.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.llm.batches import map_rows
from boardlake.session import staged

WINDOW = 50
MINIMISER_WORDS = 8
GROUP_LIMIT = 100_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def minimisers(words: list[bytes], window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the minimiser of each window, by window start; of equal hashes the leftmost counts."""
    count = len(words) - window + 1
    if count < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    digest = xxhash.xxh64_intdigest
    own = np.array([digest(w) for w in words], np.uint64)
    runs = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        runs = runs * _BASE + own[j : j + len(runs)]
    runs = (runs ^ (runs >> np.uint64(32))) * _MIX
    runs ^= runs >> np.uint64(32)
    width = window - k + 1
    places = np.empty(count, np.int64)
    for s in range(0, count, 65_536):
        part = runs[s : min(s + 65_536, count) + width - 1]
        places[s : s + 65_536] = np.lib.stride_tricks.sliding_window_view(part, width).argmin(axis=1) + np.arange(s, s + len(part) - width + 1)
    return runs[places].view(np.int64), places


def super_kmers(words: list[bytes], window: int, k: int) -> Iterator[tuple[int, int, int]]:
    """(minimiser, first window, last window) of each run of windows that share a minimiser's place."""
    hashes, places = minimisers(words, window, k)
    if len(places):
        cuts = np.flatnonzero(np.diff(places)) + 1
        starts = np.concatenate([[0], cuts])
        yield from zip(hashes[starts].tolist(), starts.tolist(), np.concatenate([cuts, [len(places)]]).tolist())


def _profiles(docs: DataFrame, window: int, k: int, kind: str) -> DataFrame:
    """Per row its id, number of words, SHA-256 of the words joined by spaces, and its distinct minimisers with their windows."""

    def run(batches):
        for batch in batches:
            for key, text in zip(batch["id"], batch["text"]):
                words, windows = text.split(), Counter()
                for m, start, end in super_kmers(words, window, k):
                    windows[m] += end - start
                yield key, len(words), hashlib.sha256(b" ".join(words)).digest(), [{"minimiser": m, "windows": n} for m, n in windows.items()]

    return map_rows(docs, run, f"id {kind}, n_words bigint, digest binary, minimisers array<struct<minimiser:bigint,windows:bigint>>", size=512)


def _pack(texts: DataFrame, window: int, k: int, kind: str) -> DataFrame:
    """Packed super-k-mers of the wanted minimisers; equal ones of a text are one row with all their places."""

    def run(batches):
        for batch in batches:
            for digest, key, text, wanted in zip(batch["digest"], batch["id"], batch["text"], batch["wanted"]):
                words, wanted = text.split(), set(wanted)
                packs: dict[tuple[int, bytes], list[int]] = {}
                for m, start, end in super_kmers(words, window, k):
                    if m in wanted:
                        packs.setdefault((m, b" ".join(words[start : end + window - 1])), []).append(start)
                for (m, pack), starts in packs.items():
                    yield m, key, digest, starts, pack

    return map_rows(texts, run, f"minimiser bigint, id {kind}, digest binary, starts array<int>, pack binary", size=1024)


def _windows(pack: bytes, window: int) -> list[bytes]:
    ends = [i for i, c in enumerate(pack) if c == 32]
    begins = [0] + [e + 1 for e in ends]
    ends.append(len(pack))
    return [pack[a:b] for a, b in zip(begins, ends[window - 1 :])]


def _count(packs: DataFrame, window: int) -> DataFrame:
    """``digest``, ``start``, ``end``: words covered by windows that a smaller id has. Rows come sorted by minimiser."""

    def members(batches):
        for batch in batches:
            yield from zip(batch["minimiser"], batch["id"], batch["digest"], batch["starts"], batch["pack"])

    def run(batches):
        for _, group in groupby(members(batches), key=lambda row: row[0]):
            group = list(group)
            if len(group) < 2:
                continue
            rows = sorted((w, key, i, j) for i, (_, key, _, _, pack) in enumerate(group) for j, w in enumerate(_windows(pack, window)))
            later: dict[int, list[int]] = {}
            first_window, first_id = None, None
            for w, key, i, j in rows:
                if w != first_window:
                    first_window, first_id = w, key
                elif key > first_id:
                    later.setdefault(i, []).append(j)
            for i, found in later.items():
                _, _, digest, starts, _ = group[i]
                for a, b in _runs(sorted(found), window):
                    for s in starts:
                        yield digest, s + a, s + b

    return map_rows(packs, run, "digest binary, start int, end int")


def _runs(starts: list[int], window: int) -> Iterator[tuple[int, int]]:
    """Words covered by windows at the sorted ``starts``, as maximal half-open runs."""
    begin = end = None
    for s in starts:
        if end is None or s > end:
            if end is not None:
                yield begin, end
            begin = s
        end = s + window
    if end is not None:
        yield begin, end


def _spread(texts: DataFrame, window: int, k: int, kind: str) -> DataFrame:
    """The same as :func:`_count` for minimisers that too many texts share: one row per window, keyed by its digest."""

    def run(batches):
        for batch in batches:
            for digest, key, text, hot in zip(batch["digest"], batch["id"], batch["text"], batch["hot"]):
                words, hot = text.split(), set(hot)
                for m, start, end in super_kmers(words, window, k):
                    if m in hot:
                        for j in range(start, end):
                            yield hashlib.blake2b(b" ".join(words[j : j + window]), digest_size=16).digest(), key, digest, j

    rows = map_rows(texts, run, f"window binary, id {kind}, digest binary, start int")
    firsts = rows.groupBy("window").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("window", "first")
    # Written first: the join below then has plain exchanges on both sides, and a window of very many texts can be split.
    firsts = staged(firsts, "superkmer-firsts")
    later = rows.join(firsts, "window").filter(F.col("id") > F.col("first"))
    return later.select("digest", "start", (F.col("start") + window).alias("end"))


def _kept(texts: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for digest, text, spans in zip(batch["digest"], batch["text"], batch["spans"]):
                words, kept, last, removed = text.split(), [], 0, 0
                for start, end in sorted((s["start"], s["end"]) for s in spans):
                    kept.extend(words[last:start])
                    removed += max(0, end - max(start, last))
                    last = max(last, end)
                kept.extend(words[last:])
                yield digest, removed, hashlib.sha256(b" ".join(kept)).hexdigest()

    return map_rows(texts, run, "digest binary, n_removed bigint, kept_sha256 string")


def remove_repeated_windows(docs: DataFrame, window: int = WINDOW, k: int = MINIMISER_WORDS, group_limit: int = GROUP_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``n_removed`` and ``kept_sha256`` per row of ``docs``.

    A word goes if a window over it also starts in a row with a smaller id. Null texts have no words. A null id is
    neither smaller nor larger than any: such rows lose nothing and take nothing. Rows of one id never take from
    each other. An empty table gives none. Other columns are not read.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    rows = staged(_profiles(picked, window, k, kind), "superkmer-profiles")
    # Equal word sequences are one text, standing for its smallest id.
    texts = rows.filter(F.col("id").isNotNull() & (F.size("minimisers") > 0)).groupBy("digest").agg(F.min("id").alias("id"), F.any_value("minimisers").alias("minimisers"))
    texts = staged(texts, "superkmer-texts")
    held = texts.select("digest", "id", F.inline("minimisers"))
    # What a task would hold of a minimiser are its windows, in however many texts they are.
    shared = held.groupBy("minimiser").agg(F.count(F.lit(1)).alias("texts"), F.sum("windows").alias("n")).filter("texts > 1").drop("texts")
    # Written first, so that the join below has plain exchanges on both sides and a hot key can be split.
    shared = staged(shared, "superkmer-shared")
    hot = F.col("n") > group_limit
    wanted = held.drop("windows").join(shared, "minimiser").groupBy("digest", "id").agg(
        F.collect_list(F.when(~hot, F.col("minimiser"))).alias("wanted"), F.collect_list(F.when(hot, F.col("minimiser"))).alias("hot")
    )
    joined = picked.join(wanted, "id")
    # An id may stand for several rows: only the one with the very words counts.
    sources = staged(_own(joined, kind), "superkmer-sources")
    packs = _pack(sources, window, k, kind).repartition("minimiser").sortWithinPartitions("minimiser")
    spans = _count(packs, window).unionByName(_spread(sources.filter(F.size("hot") > 0), window, k, kind))
    merged = spans.groupBy("digest").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    results = _kept(sources.select("digest", "text").join(merged, "digest")).dropDuplicates(["digest"])
    firsts = texts.select("digest", F.col("id").alias("first")).join(results, "digest", "left")
    joined = rows.drop("minimisers").join(firsts, "digest", "left")
    copy, own = F.col("id") > F.col("first"), F.col("id") == F.col("first")
    removed = F.when(copy, F.col("n_words")).when(own, F.coalesce("n_removed", F.lit(0))).otherwise(F.lit(0))
    kept = F.when(copy, F.lit(EMPTY_SHA256)).otherwise(F.coalesce(F.when(own, F.col("kept_sha256")), F.lower(F.hex("digest"))))
    return joined.select(F.col("id").alias(id_col), "n_words", removed.cast("bigint").alias("n_removed"), kept.alias("kept_sha256"))


def _own(joined: DataFrame, kind: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in zip(batch["id"], batch["digest"], batch["text"], batch["wanted"], batch["hot"]):
                if hashlib.sha256(b" ".join(row[2].split())).digest() == row[1]:
                    yield row

    columns = joined.select("id", "digest", "text", "wanted", "hot")
    return map_rows(columns, run, f"id {kind}, digest binary, text binary, wanted array<bigint>, hot array<bigint>", size=256)
