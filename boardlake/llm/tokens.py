"""Token counts of whole texts with overlap resynchronisation.

Texts of up to a few thousand characters are encoded as they are. A longer one is encoded in overlapping chunks, so
that no task holds the tokens of all of it. Neighbouring chunks are spliced at a boundary that both found in their
overlap and that is proven stable: the pre-tokeniser only looks ahead, one character past a piece, so two scans that
meet at a piece boundary go on alike. If the overlap has no such boundary it is widened, at last to the whole rest.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.llm.batches import map_rows

CHUNK_CHARS = 8_192
OVERLAP_CHARS = 400
# Characters at either end of a chunk where a boundary proves nothing: look-ahead and cut special strings.
MARGIN_CHARS = 64
# Token counts of pieces are remembered per worker, for texts of characters whose classes all Unicode versions share.
REMEMBERED_PIECES = 400_000
PLAIN_TEXT = regex.compile(r"[\t\n\r\x20-\x7e\xa1-\u024f]*+")
# Fixed value: the published piece pattern of byte-level BPE vocabularies.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


@lru_cache(maxsize=4)
def load_tokenizer(name: str):
    """A tokenizer file (a name known to the public tokenizer folder, or a path), once per worker process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(name if os.path.sep in name else public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    longest = max((len(t.content) for t in tokenizer.get_added_tokens_decoder().values()), default=0)
    if longest >= MARGIN_CHARS:
        raise ValueError(f"special strings of {longest} characters need a wider margin")
    return tokenizer


@lru_cache(maxsize=4)
def remembered(name: str) -> dict[str, int] | None:
    """The worker's memory of piece counts, if the file has this very piece pattern and no normaliser; else None."""
    described = json.loads(load_tokenizer(name).to_str())
    split = described["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    return {} if plain and described["normalizer"] is None and described["model"]["type"] == "BPE" else None


def _boundaries(encoding, base: int) -> dict[int, int]:
    """Start of each pre-token (character offset in the document) -> number of tokens before it.

    A start counts only if a pre-token ends right there, so that no character is shared between the two.
    """
    found, last_word, last_end = {}, object(), None
    for i, (word, (start, end)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word != last_word and (last_end is None or last_end == start):
            found[base + start] = i
        last_word, last_end = word, end
    return found


def learn(tokenizer, known: dict[str, int], pieces: set[str]) -> None:
    """Have the counts of all ``pieces`` in the memory, which is emptied first when it is full."""
    if len(known) > REMEMBERED_PIECES:
        known.clear()
    new = [p for p in pieces if p not in known]
    for piece, encoded in zip(new, tokenizer.encode_batch_fast(new, add_special_tokens=False)):
        known[piece] = len(encoded)


def chunk_encoder(tokenizer, text: str, known: dict[str, int] | None) -> Callable[[int, int], tuple[int, dict[int, int]]]:
    """What :func:`count_long` calls for chunks of ``text``. With a memory of pieces (plain texts only) known ones are not encoded again."""

    def encode(start: int, end: int) -> tuple[int, dict[int, int]]:
        encoding = tokenizer.encode(text[start:end], add_special_tokens=False)
        return len(encoding), _boundaries(encoding, start)

    def encode_plain(start: int, end: int) -> tuple[int, dict[int, int]]:
        pieces = PIECES.findall(text, start, end)
        learn(tokenizer, known, set(pieces))
        before = list(accumulate(map(known.__getitem__, pieces), initial=0))
        return before[-1], dict(zip(accumulate(map(len, pieces), initial=start), before))

    return encode if known is None else encode_plain


def count_long(encode: Callable[[int, int], tuple[int, dict[int, int]]], length: int, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, margin: int = MARGIN_CHARS) -> tuple[int, int]:
    """Tokens of one text of ``length`` characters, from overlapping chunks spliced at common stable boundaries, and the number of splices.

    ``encode`` gives the tokens of the text from a start to an end, and how many of them lie before each boundary there.
    """
    total, splices, start, end = 0, 0, 0, min(chunk, length)
    current, bounds = encode(start, end)
    first = 0  # tokens of the chunk already counted
    while end < length:
        width = overlap
        while True:
            next_start, next_end = max(start, end - width), min(length, end + chunk)
            following, theirs = encode(next_start, next_end)
            low = next_start + (margin if next_start > start else 0)
            splice = max((p for p in bounds.keys() & theirs.keys() if low <= p <= end - margin and bounds[p] >= first), default=None)
            if splice is not None or next_start == start:  # else the overlap is the whole chunk: encode it together with the next one
                break
            width *= 2
        if splice is None:
            end = next_end
            current, bounds = following, theirs
            continue
        total, splices = total + bounds[splice] - first, splices + 1
        current, bounds, start, end, first = following, theirs, next_start, next_end, theirs[splice]
    return total + current - first, splices


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``n_splices`` per row of ``docs``.

    ``n_splices`` tells at how many boundaries chunks of the text were joined: 0 for texts of one chunk. No begin, end or added special tokens; no truncation. Null texts count as empty (0 bytes, 0 tokens). Every
    row, repeated or with a null id, gives one row. Other columns are not read. An empty table gives none.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    counted = map_rows(picked.select("id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text"), _Counter(tokenizer, chunk, overlap), f"id {kind}, n_bytes bigint, n_tokens bigint, n_splices bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_splices")


class _Counter:
    """Encodes short texts in groups and longer ones in chunks."""

    def __init__(self, name: str, chunk: int, overlap: int):
        self.name, self.chunk, self.overlap = name, chunk, overlap

    def __call__(self, batches):
        tokenizer, known = load_tokenizer(self.name), remembered(self.name)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        for batch in batches:
            texts = batch["text"]
            counts, splices = [0] * len(texts), [0] * len(texts)
            plain, group, chars = [], [], 0
            for i, text in enumerate(texts):
                simple = known is not None and PLAIN_TEXT.fullmatch(text) and not any(s in text for s in special)
                if len(text) > self.chunk:
                    counts[i], splices[i] = count_long(chunk_encoder(tokenizer, text, known if simple else None), len(text), self.chunk, self.overlap)
                    continue
                (plain if simple else group).append(i)
                chars += len(text)
                if chars > 1_000_000:
                    self._encode(tokenizer, texts, group, counts)
                    self._sum_pieces(tokenizer, texts, plain, counts, known)
                    plain, group, chars = [], [], 0
            self._encode(tokenizer, texts, group, counts)
            self._sum_pieces(tokenizer, texts, plain, counts, known)
            yield from zip(batch["id"], batch["n_bytes"], counts, splices)

    @staticmethod
    def _encode(tokenizer, texts, group, counts):
        for i, encoded in zip(group, tokenizer.encode_batch_fast([texts[i] for i in group], add_special_tokens=False)):
            counts[i] = len(encoded)

    @staticmethod
    def _sum_pieces(tokenizer, texts, group, counts, known):
        """A piece is encoded on its own as within its text, so each distinct one is encoded once."""
        pieces = [PIECES.findall(texts[i]) for i in group]
        learn(tokenizer, known, {p for own in pieces for p in own})
        for i, own in zip(group, pieces):
            counts[i] = sum(map(known.__getitem__, own))
