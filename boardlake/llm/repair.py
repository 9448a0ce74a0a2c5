"""Repair of conversations as a lightest derivation in a weighted hypergraph.

A conversation is legal if the first letters of its roles read ``(s?(ua)+)?``: an automaton of four states. A deduction
takes the repair of the rows after row i that starts in one state, and an edit of row i, to a repair of the rows from i on. Items
("the rest from row i, in state p") wait in an agenda ordered by (cost, rows read, edits as text) and are final when
popped, as every deduction is monotone and never yields less than it takes (Knuth's condition): costs do not fall, and
an edit without cost reads a row. The search ends when its goals are final.

A conversation's rows are read in sorted order from range partitions, which split it anywhere, and cut into segments. A
segment yields the best edits for every pair of entry and exit state; two neighbouring segments join to one by the same agenda. Edits
of a segment end with that of a row (inserts go before a row, or after the last one of the conversation), so of two edit texts for the
same rows none begins with the whole other one, and the lesser stays the lesser whatever is joined to it. Segments carry no texts:
these are read once more, beside the final edits, as a stream in the order of the conversation.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.llm.batches import map_rows
from boardlake.session import staged

RUN = 512  # rows of a segment
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ACCEPTED = (START, ASSISTANT)
LEGAL_PAIRS = ("su", "ua", "au")
SPACE = r"[\x20\x09-\x0D]"

Weight = tuple[int, int, str]  # cost, rows read, edits
Item = tuple


def lightest(axioms: Iterable[tuple[Weight, Item]], deduce: Callable[[Item, Weight, dict], Iterable[tuple[Weight, Item]]], goals: set[Item]) -> dict[Item, Weight]:
    """Knuth's agenda: the lightest weight of every item of ``goals`` that has a derivation.

    ``deduce(item, weight, done)`` gives what follows from an item that is final now and those that were before (``done``).
    """
    agenda, done, open_goals = list(axioms), {}, set(goals)
    heapq.heapify(agenda)
    while agenda and open_goals:
        weight, item = heapq.heappop(agenda)
        if item in done:
            continue
        done[item] = weight
        open_goals.discard(item)
        for found in deduce(item, weight, done):
            if found[1] not in done:
                heapq.heappush(agenda, found)
    return {g: done[g] for g in goals if g in done}


def row_edits(initial: str, doomed: bool, truncated: bool, more: int) -> list[tuple[int, int, int, str]]:
    """(from state, to state, cost, edits) for one row and ``more`` repeats of it, which can only be deleted.

    A role without a letter adds none to the roles' letters.
    """
    tail, cost = "D" * more, DELETE * more
    found = [(p, p, cost + DELETE, "D" + tail) for p in STATES]
    if doomed:
        return found
    cost += TRUNCATED if truncated else 0
    for p in STATES:
        q = STEP.get((p, initial)) if initial else p
        if q is not None:
            found.append((p, q, cost + KEEP, "K" + tail))
        found += [(p, STEP[p, r], cost + REROLE, "R" + tail) for r in ROLES if (p, r) in STEP]
    return found


def _inserted(item: Item, weight: Weight) -> Iterator[tuple[Weight, Item]]:
    """What one insert before ``item`` gives."""
    i, p = item
    for role in ROLES:
        for before in STATES:
            if STEP.get((before, role)) == p:
                yield (weight[0] + INSERT, weight[1], "I" + weight[2]), (i, before)


def segment_edits(rows: list[list[tuple[int, int, int, str]]], opens: bool = False, closes: bool = False) -> dict[tuple[int, int], tuple[int, str]]:
    """Best (cost, edits) of a segment for every entry and exit state, from the edits of its rows.

    A segment that is known to open its conversation is entered in ``START`` only. One that is known to close it has its last
    inserts in its edits, and its exit is named ``START``, from where nothing is left to do.
    """
    n, best = len(rows), {}
    into = [{q: [e for e in edits if e[1] == q] for q in STATES} for edits in rows]
    entries = {(0, p) for p in ((START,) if opens else STATES)}

    def deduce(item: Item, weight: Weight, done: dict) -> Iterator[tuple[Weight, Item]]:
        i, p = item
        cost, read, edits = weight
        if i < n or closes:
            yield from _inserted(item, weight)
        if i:
            for before, _, more, letters in into[i - 1][p]:
                yield (cost + more, read + 1, letters + edits), (i - 1, before)

    for exits in [ACCEPTED] if closes else [(q,) for q in STATES]:
        for (_, entry), (cost, _, edits) in lightest([((0, 0, ""), (n, q)) for q in exits], deduce, entries).items():
            best[entry, exits[0]] = cost, edits
    return best


def joined(left: dict, right: dict) -> dict[tuple[int, int], tuple[int, str]]:
    """The best edits of two neighbouring segments as one: a deduction needs one item of either side."""
    axioms = [((c, n, e), (side, *states)) for side, n, some in (("left", 1, left), ("right", 1, right)) for states, (c, e) in some.items()]

    def deduce(item: Item, weight: Weight, done: dict) -> Iterator[tuple[Weight, Item]]:
        side, p, q = item
        if side == "left":
            for r in STATES:
                if ("right", q, r) in done:
                    yield _both(weight, done["right", q, r]), ("both", p, r)
        elif side == "right":
            for o in STATES:
                if ("left", o, p) in done:
                    yield _both(done["left", o, p], weight), ("both", o, q)

    return {(p, q): (c, e) for (_, p, q), (c, _, e) in lightest(axioms, deduce, {("both", p, q) for p in STATES for q in STATES}).items()}


def _both(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def whole_edits(segments: list[dict]) -> tuple[int, str]:
    """Best (cost, edits) of a conversation from those of its segments; neighbours join pairwise, level by level."""
    while len(segments) > 1:
        segments = [joined(*segments[i : i + 2]) if i + 1 < len(segments) else segments[i] for i in range(0, len(segments), 2)]

    def close(item: Item, weight: Weight, done: dict) -> Iterator[tuple[Weight, Item]]:
        kind, p = item
        cost, read, edits = weight
        if kind == "rest":
            yield from _inserted(item, weight)
            for (entry, exit_), (more, letters) in (segments[0] if segments else {}).items():
                if exit_ == p and entry == START:
                    yield (cost + more, read + 1, letters + edits), ("whole", START)

    goal = ("whole" if segments else "rest", START)
    found = lightest([((0, 0, ""), ("rest", p)) for p in ACCEPTED], close, {goal})
    return found[goal][0], found[goal][2]


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``id``, ``turn``, ``role``, ``text``, ``n``: rows damaged by the checksum of ``id:turn`` modulo 20, repeated ``n`` times (dropped: 0).

    Null roles and texts become one space, and so do null ids and turns in the checksum's text.
    """
    blank = F.lit(" ")
    key = F.concat(*[F.coalesce(c.cast("string"), blank) for c in (F.col(id_col),)], F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))
    kind = F.crc32(key) % 20
    role, text = F.coalesce(F.col(role_col), blank), F.coalesce(F.col(text_col), blank)
    return rows.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("n"),
    )


def _content(role: Column, text: Column) -> Column:
    """What tells rows apart: lengths keep role and text from running together."""
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)


def _distinct_rows(rows: DataFrame) -> DataFrame:
    """One small row per (id, turn, role, text) with its repeats ``n`` and its faults; equal rows merge in each task."""
    text = F.col("text")
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    truncated = ~F.right(F.regexp_replace(text, rf"{SPACE}+\z", ""), F.lit(1)).isin(".", "!", "?")
    small = rows.select("id", "turn", "n", "role", _content(F.col("role"), text).alias("content"), blank.alias("blank"), (~blank & truncated).alias("truncated"))
    merged = small.groupBy("id", "turn", "role", "content", "blank", "truncated").agg(F.sum("n").alias("n"))
    # A row's role and text were seen earlier if they stand at an earlier turn. Nulls come first.
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    seen = merged.filter("n > 0").groupBy("id", "content").agg(first.alias("first"), F.count(F.lit(1)).alias("turns")).filter("turns > 1")
    seen = seen.select(F.col("id").alias("seen_id"), F.col("content").alias("seen_content"), F.col("first.turn").alias("first_turn"))
    known = merged.join(seen, F.col("id").eqNullSafe(F.col("seen_id")) & (F.col("content") == F.col("seen_content")), "left")
    again = F.col("seen_content").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    return known.select("id", "turn", "role", "content", F.substring("role", 1, 1).alias("initial"), "n", "blank", again.alias("again"), "truncated")


ORDER = ["turn_known", "turn", "role", "content"]
_SEGMENT = "part int, seq bigint, low {turn}, high {turn}, turns bigint, opens string, closes string, rows bigint, blank bigint, again bigint, truncated bigint, illegal bigint, entries array<int>, exits array<int>, costs array<bigint>, edits array<string>"


def _segment(number: int, rows: list[tuple], is_first: bool, is_last: bool) -> tuple:
    """Counts and best edits of neighbouring rows of one conversation: (turn, initial, n, blank, again, truncated)."""
    low = high = opens = closes = None
    turns = total = blank = again = cut = illegal = 0
    edits = []
    for turn, initial, n, is_blank, is_again, is_cut in rows:
        if not n:
            continue
        if turn is not None and turn != high:
            turns, high, low = turns + 1, turn, turn if low is None else low
        if closes is not None:
            illegal += closes + initial not in LEGAL_PAIRS
        illegal += n - 1  # a letter beside itself
        opens, closes, total = initial if opens is None else opens, initial, total + n
        if is_blank:
            blank += n
        else:
            again += n if is_again else n - 1
            cut += is_cut and not is_again
        edits.append(row_edits(initial, is_blank or is_again, is_cut, n - 1))
    best = segment_edits(edits, is_first, is_last) if edits else {}
    states = sorted(best)
    return (
        TaskContext.get().partitionId(), number, low, high, turns, opens, closes, total, blank, again, cut, illegal,
        [p for p, _ in states], [q for _, q in states], [best[s][0] for s in states], [best[s][1] for s in states],
    )


def _segments(batches: Iterator[dict[str, list]], run: int) -> Iterator[tuple]:
    number, held, at = 0, [], None
    is_first = False  # the first conversation of a task may have begun in another one, its last may go on
    for batch in batches:
        for key, *row in zip(*(batch[c] for c in ("id", "turn", "initial", "n", "blank", "again", "truncated"))):
            if held and (key != at or len(held) >= run):
                yield at, *_segment(number, held, is_first, key != at)
                number, held, is_first = number + 1, [], key != at
            at = key
            held.append(tuple(row))
    if held:
        yield at, *_segment(number, held, is_first, False)


def _combined(batches: Iterator[dict[str, list]]) -> Iterator[tuple]:
    """One row per conversation from its segments in order."""
    rows = (dict(zip(batch, row)) for batch in batches for row in zip(*batch.values()))
    for key, own in groupby(rows, key=lambda r: r["id"]):
        low = high = closes = None
        turns = blank = again = cut = illegal = 0
        best: list[dict] = []
        for s in own:
            if not s["rows"]:
                continue
            if s["low"] is not None:
                turns += s["turns"] - (s["low"] == high)
                low, high = s["low"] if low is None else low, s["high"]
            illegal += s["illegal"] + (closes is not None and closes + s["opens"] not in LEGAL_PAIRS)
            closes, blank, again, cut = s["closes"], blank + s["blank"], again + s["again"], cut + s["truncated"]
            best.append({(p, q): (c, e) for p, q, c, e in zip(s["entries"], s["exits"], s["costs"], s["edits"])})
        cost, audit = whole_edits(best)
        yield key, 0 if low is None else high - low + 1 - turns, blank, again, cut, illegal, cost, audit


def _repaired(batches: Iterator[dict[str, list]]) -> Iterator[tuple]:
    """Digest of every repaired conversation from a stream of its final row and then its rows in order; holds the edits and one batch."""
    final, edits, state, digest, empty = None, iter(()), START, None, True

    def put(role: str, text: str) -> None:
        nonlocal empty
        digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        empty = False

    def inserts(letter: str | None) -> str | None:
        """Write the inserts that are due, and give the next other edit."""
        nonlocal state
        while letter == "I":
            role = "a" if state == USER else "u"
            put(ROLES[role], "")
            state = STEP[state, role]
            letter = next(edits, None)
        return letter

    def closed() -> tuple:
        inserts(next(edits, None))
        return *final, digest.hexdigest()

    for batch in batches:
        for key, is_row, role, text, n, *counts in zip(*(batch[c] for c in ("id", "is_row", "role", "text", "n", *COUNTS, "audit"))):
            if not is_row:
                if final is not None:
                    yield closed()
                final, edits, state, digest, empty = (key, *counts), iter(counts[-1]), START, hashlib.sha256(), True
                continue
            for _ in range(n):
                letter = inserts(next(edits, None))
                if letter == "K":
                    put(role, text)
                    state = STEP[state, role[0]] if role else state
                elif letter == "R":
                    other = "a" if state == USER else "u"
                    put(ROLES[other], text)
                    state = STEP[state, other]
    if final is not None:
        yield closed()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_conversations(rows: DataFrame, run: int = RUN) -> DataFrame:
    """``id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256`` per id.

    ``rows`` has ``id``, ``turn``, ``role``, ``text`` and ``n`` (how often the row stands there; 0 only names the id), as :func:`damage` gives
    them; role and text are not null. Rows of an id go by turn, nulls first; rows of one turn by role, then by a digest of their content,
    so repeated rows stand together. A null id is an id like any other. An id without rows has zeros, no edits and the digest of the empty text. An
    empty table gives none. Only the last step reads an id's rows in one task, as a stream, since a SHA-256 over all of them is asked for.
    """
    id_type, turn_type = rows.schema["id"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString()
    order = [F.col("turn").isNotNull().alias("turn_known"), F.col("turn"), F.col("role"), F.col("content")]
    small = _distinct_rows(rows).select("id", *order, "initial", "n", "blank", "again", "truncated")
    sorted_rows = small.repartitionByRange("id", *ORDER).sortWithinPartitions("id", *ORDER)
    segments = map_rows(sorted_rows, lambda b: _segments(b, run), f"id {id_type}, {_SEGMENT.format(turn=turn_type)}", size=256)
    by_id = segments.repartition("id").sortWithinPartitions("id", "part", "seq")
    totals = staged(map_rows(by_id, _combined, f"id {id_type}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string", size=64), "repair-edits")

    nothing = {c: F.lit(None).cast("bigint") for c in COUNTS} | {"audit": F.lit(None).cast("string")}
    texts = rows.filter("n > 0").withColumn("content", _content(F.col("role"), F.col("text")))
    texts = texts.select("id", F.lit(True).alias("is_row"), *order, "text", "n", *[v.alias(k) for k, v in nothing.items()])
    empty = {"turn_known": "boolean", "turn": turn_type, "role": "string", "content": "string", "text": "string", "n": "bigint"}
    heads = totals.select("id", F.lit(False).alias("is_row"), *[F.lit(None).cast(t).alias(c) for c, t in empty.items()], *COUNTS, "audit")
    stream = heads.unionByName(texts).repartition("id").sortWithinPartitions("id", "is_row", *ORDER)
    out = f"id {id_type}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string, repaired_sha256 string"
    return map_rows(stream.drop("turn_known", "turn", "content"), _repaired, out, size=256)
