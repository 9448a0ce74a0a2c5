"""Benchmark decontamination: shared n-grams join documents to test items, alignment scores the copies.

Words are runs of letters and digits, lower-cased. A document is a suspect if one of its n-grams may be an item's, by
a bit table of fixed size (false hits fall out in the join). Every gram of an item is a seed, whatever other documents
hold, and an item's grams are as long as the run of equal words that any copy must have (:func:`seed_length`), so no
copy is left out. Seeds give the places where an item may lie in a document; where enough of its words are there too,
Smith-Waterman alignment over words scores each. A copy has as many aligned equal words as ``similarity`` of the item
asks (of ``ENOUGH`` words for longer items), and that share of the alignment's columns too.

Equal texts are one from the start, so a leaked page in a third of the rows is aligned once.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.llm.batches import map_rows
from boardlake.session import staged

GRAM = 5
SIMILARITY = 0.8
ENOUGH = 50
TABLE_BITS = 26
GAP = 1  # a match scores 1, a mismatch -1, a gap -1
WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def word_hashes(words: list[str]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in words], np.uint64)


def mixed(own: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on, from the hashes of the words."""
    if len(own) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(own) - n + 1, np.uint64)
    for j in range(n):
        out = out * _BASE + own[j : j + len(out)]
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return out ^ (out >> np.uint64(29))


def gram_hashes(words: list[str], n: int) -> np.ndarray:
    """Hash of the n words from each place on."""
    return mixed(word_hashes(words), n)


def seed_length(words: int, n: int, similarity: float) -> int:
    """The longest run of equal words, ``n`` at most, that every copy of an item of so many words has.

    A copy with k equal words has at most k (1 - similarity) / similarity other columns, which part them into one run
    more than that; the longest run has the mean length at least.
    """
    if similarity <= 0:
        return 1
    least, most = max(1, math.ceil(similarity * min(words, ENOUGH) - 1e-9)), max(words, 1)

    def run(k: int) -> int:
        return -(-k // (math.floor(k * (1 - similarity) / similarity + 1e-9) + 1))

    return min([n, *map(run, range(min(least, most), most + 1))])


def align(item: list[int], passage: list[int]) -> tuple[int, int, int, int, int]:
    """Best local alignment: score, equal words, columns, and the passage's first and end place.

    One row of the matrix per item word; gaps within a row come from a running maximum.
    """
    a, b = np.array(item, np.int64), np.array(passage, np.int64)
    if not len(a) or not len(b):
        return 0, 0, 0, 0, 0
    table = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    slope = GAP * np.arange(len(b) + 1, dtype=np.int32)
    for i, word in enumerate(a, 1):
        above = table[i - 1]
        row = np.zeros(len(b) + 1, np.int32)
        row[1:] = np.maximum(above[:-1] + np.where(b == word, 1, -1), above[1:] - GAP)
        table[i] = np.maximum.accumulate(np.maximum(row, 0) + slope) - slope
    i, j = np.unravel_index(table.argmax(), table.shape)
    score, end, equal, columns = int(table[i, j]), int(j), 0, 0
    while table[i, j] > 0:
        columns += 1
        same = a[i - 1] == b[j - 1]
        if table[i, j] == table[i - 1, j - 1] + (1 if same else -1):
            equal += bool(same)
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] - GAP:
            i -= 1
        else:
            j -= 1
    return score, equal, columns, int(j), end


def _items(benchmark: DataFrame, n: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """Distinct items of n words or more with the length and hashes of their grams."""
    picked = benchmark.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).distinct()

    def run(batches):
        for batch in batches:
            for key, text in zip(batch["item_id"], batch["text"]):
                words = words_of(text)
                if len(words) >= n:
                    line = " ".join(words)
                    width = seed_length(len(words), n, similarity)
                    yield key, hashlib.sha256(line.encode()).digest(), line, width, gram_hashes(words, width).view(np.int64).tolist()

    return map_rows(picked, run, f"item_id {picked.schema['item_id'].dataType.simpleString()}, item binary, line string, width int, grams array<bigint>", size=512)


def _bit_table(items: DataFrame) -> np.ndarray:
    """2^TABLE_BITS bits, set at the grams of all items. At most 2^TABLE_BITS / 64 rows come to the driver."""
    bit = F.pmod("gram", F.lit(1 << TABLE_BITS))
    cells = items.select(F.explode("grams").alias("gram")).select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    for r in cells.collect():
        table[r.cell] = r.bits
    return table.view(np.uint64)


def _suspects(docs: DataFrame, table: np.ndarray, widths: list[int], kind: str) -> DataFrame:
    """Rows with a gram that may be an item's: id, key of the text, words, and the hits (hash and place)."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    mask = np.uint64((1 << TABLE_BITS) - 1)

    def run(batches):
        bits = shared.value
        for batch in batches:
            for key, text in zip(batch["id"], batch["text"]):
                words, found = words_of(text), []
                own = word_hashes(words)
                for width in widths:
                    grams = mixed(own, width)
                    place = grams & mask
                    hits = np.flatnonzero((bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1))
                    found += [{"hash": h, "at": p} for h, p in zip(grams[hits].view(np.int64).tolist(), hits.tolist())]
                if found:
                    yield key, hashlib.sha256(text.encode()).digest(), " ".join(words), found

    return map_rows(docs, run, f"id {kind}, key binary, line string, hits array<struct<hash:bigint,at:int>>", size=256)


def _seeds(items: DataFrame) -> DataFrame:
    """``item``, ``hash`` and the first and last place of each seed."""
    grams = items.dropDuplicates(["item"]).select("item", F.posexplode("grams").alias("at", "hash"))
    return grams.groupBy("item", "hash").agg(F.min("at").alias("first"), F.max("at").alias("last"))


def find_copies(docs: DataFrame, benchmark: DataFrame, n: int = GRAM, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``id_col``, ``text_key`` (SHA-256), ``item_col``, ``similarity``, ``equal_words``, ``first_word`` and ``end_word`` of every copy found.

    One row per document row and item it has a copy of (its best place). Null texts are empty. Items with null or fewer
    than ``n`` words of text take no part. Rows with null or repeated ids are judged by their own text; repeated item
    rows are one. An empty table on either side gives no rows. Other columns are not read.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    items = staged(_items(benchmark, n, similarity, item_col, item_text_col), "leak-items")
    widths = sorted(r.width for r in items.select("width").distinct().collect())
    # Hits that are no item's gram have no partner in the join.
    suspects = staged(_suspects(picked, _bit_table(items), widths, kind), "leak-suspects")
    seeds = _seeds(items)
    texts = suspects.dropDuplicates(["key"])
    places = texts.select("key", F.inline("hits")).join(seeds, "hash")
    spans = places.groupBy("key", "item").agg(F.collect_set(F.struct((F.col("at") - F.col("last")).alias("low"), (F.col("at") - F.col("first")).alias("high"))).alias("spans"))
    lines = items.dropDuplicates(["item"]).select("item", F.col("line").alias("item_line"))
    asked = spans.join(lines, "item").groupBy("key").agg(F.collect_list(F.struct("item", "item_line", "spans")).alias("asked"))
    aligned = map_rows(texts.select("key", "line").join(asked, "key"), _Align(similarity), "key binary, item binary, similarity double, equal_words int, first_word int, end_word int")
    named = aligned.join(items.select("item", "item_id"), "item").join(suspects.select("key", "id"), "key")
    return named.select(F.col("id").alias(id_col), F.lower(F.hex("key")).alias("text_key"), F.col("item_id").alias(item_col), "similarity", "equal_words", "first_word", "end_word")


class _Align:
    def __init__(self, similarity: float):
        self.similarity = similarity

    def __call__(self, batches):
        for batch in batches:
            for key, line, asked in zip(batch["key"], batch["line"], batch["asked"]):
                numbers: dict[str, int] = {}
                words = [numbers.setdefault(w, len(numbers)) for w in line.split(" ")]
                for one in asked:
                    item = [numbers.get(w, -1) for w in one["item_line"].split(" ")]
                    regions = [(low, high) for low, high in self._regions(item, one["spans"]) if self._may_hold(item, words[max(0, low) : high])]
                    best = max((self._at(item, words, low, high) for low, high in regions), key=lambda r: (r[0], -r[2]), default=(-1.0, 0, 0, 0))
                    if best[0] >= self.similarity:
                        yield key, one["item"], *best

    def _may_hold(self, item, passage):
        """Whether the passage has as many of the item's words, in any order, as a copy must have."""
        return (Counter(item) & Counter(passage)).total() >= self.similarity * min(len(item), ENOUGH) - 1e-9

    @staticmethod
    def _regions(item, spans):
        """Places of the document where the item may begin and end, with room for edits; overlapping ones are one."""
        room = max(4, len(item) // 4)
        out: list[list[int]] = []
        for low, high in sorted((s["low"] - room, s["high"] + len(item) + room) for s in spans):
            if out and low <= out[-1][1]:
                out[-1][1] = max(out[-1][1], high)
            else:
                out.append([low, high])
        return out

    @staticmethod
    def _at(item, words, low, high):
        low = max(0, low)
        # A long joined region is aligned in overlapping parts, so that the table stays a few items wide.
        width = max(2_000, 4 * len(item))
        best = (-1.0, 0, 0, 0)
        for start in range(low, max(low + 1, min(high, len(words))), width // 2):
            _, equal, columns, first, end = align(item, words[start : min(start + width, high)])
            share = min(1.0, equal / min(len(item), ENOUGH), equal / columns if columns else 0.0)
            best = max(best, (share, equal, start + first, start + end), key=lambda r: (r[0], -r[2]))
        return best
