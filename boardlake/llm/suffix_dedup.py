"""Removal of repeated byte strings with a hash-compared suffix sort.

Every window of ``window`` bytes names an anchor: the leftmost smallest hash of the ``GRAM``-byte strings in it. Equal
windows name anchors at the same place in them, so repeats meet in the group of an anchor's hash, and only hashes
that occur twice or more are followed. An occurrence brings its context, all that the windows of its anchor span.

In a group the suffixes that start at the anchors are sorted. Polynomial hashes of the prefixes of both sides, kept
for every ``_STEP`` bytes, give the common extension of two of them by binary search, so a comparison in the merge sort
takes logarithmic time; every extension is verified on the bytes, and its last step read there. Then sorted neighbours
are merged from the longest common right side to the shortest, the smaller set into the larger one, which is kept in
order of the left sides. When a suffix enters, its two neighbours there have the longest common left side, and no other
pair reaches further; each extension of ``window`` bytes or more marks both places. That finds every repeat in m log^2 m
steps for m contexts, instead of comparing all pairs. All spans of a context hold its anchor, so their union is one span.

What keeps it bounded: equal texts are one from the start; equal contexts of a group are one and take about 2 KB each; a
bucket is read as a stream of groups. A hash with more than ``group_limit`` occurrences is spread instead: each of its windows becomes a
row keyed by a 128-bit digest, counted by an aggregate that reduces in each task before the shuffle.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_left
from collections.abc import Sequence
from functools import cmp_to_key, lru_cache
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.llm.batches import map_rows
from boardlake.session import staged

WINDOW = 400
GRAM = 64
GROUP_LIMIT = 20_000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_SEGMENT = 1 << 18  # bytes hashed at a time
_STEP = 32  # bytes between the prefixes of a side that have a hash
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hash of the gram that starts at each place, from prefix sums modulo 2^64."""
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, _SEGMENT * 2)[:n], out=prefix[1:])
    hashes = (prefix[gram:] - prefix[:-gram]) * _powers(_INVERSE, _SEGMENT * 2)[: n - gram + 1]
    hashes = (hashes ^ (hashes >> np.uint64(32))) * _MIX
    return hashes ^ (hashes >> np.uint64(29))


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, from running minima of blocks of that width, forward and backward."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def anchors(text: bytes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the anchors that the windows of a text name, each once, by place."""
    width, bits = window - gram + 1, np.uint64(20)
    low = np.uint64((1 << 20) - 1)
    hashes, places = [], []
    for s in range(0, len(text) - window + 1, _SEGMENT):
        data = np.frombuffer(text, np.uint8, min(_SEGMENT + window - 1, len(text) - s), s)
        own = _gram_hashes(data, gram)
        least = _sliding_least((own & ~low) | np.arange(len(own), dtype=np.uint64), width)
        at = np.unique(least & low).astype(np.int64)
        hashes.append(own[at].view(np.int64) >> np.int64(bits))
        places.append(at + s)
    if not hashes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    places, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first], places


class _Context:
    """The bytes around an anchor with prefix hashes of its right side and of its reversed left side."""

    __slots__ = ("left", "right", "left_hash", "right_hash")

    def __init__(self, context: bytes, at: int):
        self.left, self.right = context[:at][::-1], context[at:]
        self.left_hash, self.right_hash = _prefix_hashes(self.left), _prefix_hashes(self.right)


def _prefix_hashes(side: bytes) -> array:
    """Hashes of the prefixes of 0, 1, 2, ... whole steps."""
    data = np.frombuffer(side, np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.cumsum(data * _powers(_BASE, _SEGMENT * 2)[: len(side)])
    return array("Q", [0, *sums[_STEP - 1 :: _STEP].tolist()])


def _alike(x: bytes, y: bytes) -> int:
    """Length of the longest common prefix of strings of equal length, read on the bytes."""
    unlike = int.from_bytes(x, "little") ^ int.from_bytes(y, "little")
    return ((unlike & -unlike).bit_length() - 1) // 8 if unlike else len(x)


def common(x: bytes, y: bytes, x_hash: Sequence[int], y_hash: Sequence[int]) -> int:
    """Length of the longest common prefix: binary search over hashes of whole steps, verified, and the next step on the bytes."""
    shorter = min(len(x), len(y))
    low, high = 0, shorter // _STEP
    while low < high:
        middle = (low + high + 1) // 2
        if x_hash[middle] == y_hash[middle]:
            low = middle
        else:
            high = middle - 1
    low *= _STEP
    if x[:low] != y[:low]:  # a collision: equal hashes of unequal strings
        return _alike(x[:low], y[:low])
    end = min(low + _STEP, shorter)
    return low + _alike(x[low:end], y[low:end])


def repeated_spans(contexts: list[tuple[bytes, int]], window: int) -> dict[int, list[tuple[int, int]]]:
    """For distinct contexts (bytes, place of the anchor): the bytes, relative to the anchor, of all spans of ``window``
    bytes or more around it that another one shares."""
    if len(contexts) < 2:
        return {}
    own = [_Context(c, at) for c, at in contexts]

    def rights(i: int, j: int) -> int:
        return common(own[i].right, own[j].right, own[i].right_hash, own[j].right_hash)

    def lefts(i: int, j: int) -> int:
        return common(own[i].left, own[j].left, own[i].left_hash, own[j].left_hash)

    def by(side, length):
        def compare(i: int, j: int) -> int:
            n = length(i, j)
            a, b = side(own[i])[n : n + 1], side(own[j])[n : n + 1]
            return (a > b) - (a < b)

        return sorted(range(len(own)), key=cmp_to_key(compare))

    order = by(lambda c: c.right, rights)
    left_order = by(lambda c: c.left, lefts)
    rank = [0] * len(own)
    for r, i in enumerate(left_order):
        rank[i] = r
    spans: dict[int, tuple[int, int]] = {}
    reach = [rights(a, b) for a, b in zip(order, order[1:])]
    members: list[list[int]] = [[rank[i]] for i in order]  # ranks by left side, at the root of each set
    root = list(range(len(order)))

    def find(p: int) -> int:
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    for p in sorted(range(len(reach)), key=lambda p: -reach[p]):
        a, b = find(p), find(p + 1)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large = members[a]
        for r in members[b]:
            at = bisect_left(large, r)
            i = left_order[r]
            for near in large[max(0, at - 1) : at + 1]:
                j = left_order[near]
                n = lefts(i, j)
                if n + reach[p] >= window:
                    for k in (i, j):
                        start, end = spans.get(k, (0, 0))
                        spans[k] = (min(start, -n), max(end, reach[p]))
            large.insert(at, r)
        members[b] = []
        root[b] = a
    return {i: [span] for i, span in spans.items()}


def merged(spans) -> list[tuple[int, int]]:
    """Union of half-open spans. Touching ones become one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _with_anchors(texts: DataFrame, window: int, gram: int, kind: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for key, text in zip(batch["id"], batch["text"]):
                hashes, places = anchors(text, window, gram)
                yield key, len(text), hashlib.sha256(text).digest(), [{"hash": h, "at": p} for h, p in zip(hashes.tolist(), places.tolist())]

    return map_rows(texts, run, f"id {kind}, n_bytes bigint, digest binary, anchors array<struct<hash:bigint,at:int>>", size=256)


def _contexts(sources: DataFrame, window: int, gram: int) -> DataFrame:
    """Contexts of the wanted anchors; equal ones of a text are one row with all their places."""

    def run(batches):
        for batch in batches:
            for digest, text, wanted in zip(batch["digest"], batch["text"], batch["wanted"]):
                held: dict[tuple[int, int, bytes], list[int]] = {}
                for anchor in wanted:
                    at = anchor["at"]
                    begin = max(0, at - (window - gram))
                    held.setdefault((anchor["hash"], at - begin, text[begin : at + window]), []).append(at)
                for (h, before, context), places in held.items():
                    yield h, digest, places, before, context

    return map_rows(sources, run, "hash bigint, digest binary, places array<int>, before int, context binary", size=1024)


def _sorted_spans(contexts: DataFrame, window: int) -> DataFrame:
    """``digest``, ``start``, ``end`` of repeated bytes. Rows come sorted by hash."""

    def members(batches):
        for batch in batches:
            yield from zip(batch["hash"], batch["digest"], batch["places"], batch["before"], batch["context"])

    def run(batches):
        for _, group in groupby(members(batches), key=lambda row: row[0]):
            held: dict[tuple[bytes, int], set[tuple[bytes, int]]] = {}
            for _, digest, places, before, context in group:
                held.setdefault((context, before), set()).update((digest, at) for at in places)
            distinct = list(held)
            spans = repeated_spans(distinct, window)
            for i, key in enumerate(distinct):
                context, before = key
                own = spans.get(i, [])
                if len(held[key]) > 1 and len(context) >= window:
                    own = [(-before, len(context) - before)]
                for start, end in own:
                    for digest, at in held[key]:
                        yield digest, at + start, at + end

    return map_rows(contexts, run, "digest binary, start int, end int")


def _spread_spans(sources: DataFrame, window: int, gram: int) -> DataFrame:
    """The same for hashes with too many occurrences: one row per window, keyed by its digest."""

    def run(batches):
        for batch in batches:
            for digest, text, hot in zip(batch["digest"], batch["text"], batch["hot"]):
                places = (anchor["at"] for anchor in hot)
                for begin, end in merged((max(0, at - (window - gram)), min(at, len(text) - window) + 1) for at in places):
                    for s in range(begin, end):
                        yield hashlib.blake2b(text[s : s + window], digest_size=16).digest(), digest, s

    rows = map_rows(sources, run, "key binary, digest binary, start int").distinct()
    again = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    # Written first: the join below then has plain exchanges on both sides, and a window of very many texts can be split.
    again = staged(again, "suffix-again")
    return rows.join(again, "key").select("digest", "start", (F.col("start") + window).alias("end"))


def _kept(texts: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for digest, text, spans in zip(batch["digest"], batch["text"], batch["spans"]):
                kept, last, removed = hashlib.sha256(), 0, 0
                runs = merged((s["start"], s["end"]) for s in spans)
                for start, end in runs:
                    kept.update(text[last:start])
                    removed += end - start
                    last = end
                kept.update(text[last:])
                yield digest, removed, len(runs), kept.hexdigest()

    return map_rows(texts, run, "digest binary, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_limit: int = GROUP_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` per row of ``docs``.

    Bytes are those of the UTF-8 text. Every byte in a ``window``-byte string that starts twice or more anywhere goes, all
    occurrences alike. Null texts are empty. Rows are documents of their own, also with null or repeated ids. An empty
    table gives none. Other columns are not read.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    rows = staged(_with_anchors(picked, window, gram, kind), "suffix-anchors")
    # Equal texts are one, fetched by the smallest of their ids; a null id only where there is no other.
    texts = rows.filter(F.size("anchors") > 0).groupBy("digest").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.any_value("anchors").alias("anchors"))
    texts = staged(texts, "suffix-texts")
    held = texts.select("digest", "id", F.inline("anchors"))
    shared = held.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Written first, so that the join below has plain exchanges on both sides and a hot key can be split.
    shared = staged(shared, "suffix-shared")
    hot, anchor = F.col("n") > group_limit, F.struct("hash", "at")
    wanted = held.join(shared, "hash").groupBy("digest", "id").agg(
        F.collect_list(F.when(~hot, anchor)).alias("wanted"), F.collect_list(F.when(hot, anchor)).alias("hot")
    )
    fetched = picked.withColumn("digest", F.unhex(F.sha2("text", 256))).alias("t").join(wanted.alias("w"), (F.col("t.digest") == F.col("w.digest")) & F.col("t.id").eqNullSafe(F.col("w.id")))
    sources = staged(fetched.select("w.digest", "t.text", "w.wanted", "w.hot"), "suffix-sources")
    grouped = _contexts(sources, window, gram).repartition("hash").sortWithinPartitions("hash")
    spans = _sorted_spans(grouped, window).unionByName(_spread_spans(sources.filter(F.size("hot") > 0), window, gram))
    own = spans.groupBy("digest").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    results = _kept(sources.select("digest", "text").join(own, "digest")).dropDuplicates(["digest"])
    known = texts.select("digest", "copies").join(results, "digest", "left")
    joined = rows.drop("anchors").join(known, "digest", "left")
    many = F.col("copies") > 1  # a text with an anchor has a window at least
    return joined.select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.when(many, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(many, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(many, F.lit(EMPTY_SHA256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
    )
