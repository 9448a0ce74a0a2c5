"""Conversation repair against a search over all edits and a plain dynamic programme."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from boardlake.llm import repair

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, id string, audit int"
NONE_LEFT = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def cheapest(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Best (cost, edits) of (initial, doomed, truncated) rows among all edits with at most two inserts in a place."""
    gaps = ["", "u", "a", "ua", "au"]
    options = []
    for initial, doomed, truncated in rows:
        extra = 3 if truncated else 0
        options.append([("", "D", 4)] + ([] if doomed else [(initial, "K", extra), ("u", "R", 3 + extra), ("a", "R", 3 + extra)]))
    found = []
    for places in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product(*options):
            roles = places[0] + "".join(e[0] + g for e, g in zip(edits, places[1:]))
            if re.fullmatch("(s?(ua)+)?", roles):
                letters = "I" * len(places[0]) + "".join(e[1] + "I" * len(g) for e, g in zip(edits, places[1:]))
                found.append((sum(e[2] for e in edits) + 3 * sum(map(len, places)), letters))
    return min(found)


@pytest.mark.parametrize("seed", range(12))
def test_edits_are_the_cheapest_and_least_whatever_the_cuts(seed):
    dice = random.Random(seed)
    rows = [(dice.choice(["s", "u", "a", "t", ""]), dice.random() < 0.2, dice.random() < 0.3) for _ in range(3)]
    edits = [repair.row_edits(i, d, t, 0) for i, d, t in rows]
    for cuts in ([3], [1, 3], [2, 3], [1, 2, 3]):
        segments = [repair.segment_edits(edits[a:b]) for a, b in zip([0, *cuts], cuts)]
        assert repair.whole_edits(segments) == cheapest(rows)


def expected(rows: list[tuple]) -> dict:
    """All columns of every conversation, from its last row to its first with one best way per state."""
    out: dict = {}
    for key, turn, role, text, *_ in rows:
        own = out.setdefault(key, [])
        named = " " if key is None else key, " " if turn is None else turn
        kind = zlib.crc32("{}:{}".format(*named).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {key: judged(own) for key, own in out.items()}


def judged(rows: list[tuple]) -> tuple:
    def content(row):
        return hashlib.sha256(f"{len(row[1])}:{row[1]}{row[2]}".encode()).hexdigest()

    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], content(r)))
    seen, kinds = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACES)
        kinds.append("blank" if not bare else "again" if (role, text) in seen else "cut" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}
    best = {"0": (0, "", []), "a": (0, "", []), "u": (3, "I", ["assistant:"]), "s": (6, "II", ["user:", "assistant:"])}
    for (_, role, text), kind in zip(reversed(rows), reversed(kinds)):
        extra, new = 3 * (kind == "cut"), {}
        for p in best:
            ways = [(best[p][0] + 4, "D" + best[p][1], best[p][2])]
            if kind not in ("blank", "again"):
                if not role or (p, role[0]) in step:
                    c, e, lines = best[step[p, role[0]] if role else p]
                    ways.append((c + extra, "K" + e, [f"{role}:{text}", *lines]))
                for r, name in names.items():
                    if (p, r) in step:
                        c, e, lines = best[step[p, r]]
                        ways.append((c + extra + 3, "R" + e, [f"{name}:{text}", *lines]))
            new[p] = min(ways)
        for _ in range(2):
            for p, r in itertools.product(new, names):
                if (p, r) in step:
                    c, e, lines = new[step[p, r]]
                    new[p] = min(new[p], (c + 3, "I" + e, [f"{names[r]}:", *lines]))
        best = new
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, edits, lines = best["0"]
    return gaps, kinds.count("blank"), kinds.count("again"), kinds.count("cut"), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def repaired(spark, rows, **how) -> dict:
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = repair.repair_conversations(repair.damage(frame), **how).collect()
    assert len({r.id for r in found}) == len(found)
    return {r.id: tuple(r)[1:] for r in found}


def invented(seed: int, conversations: int, most: int) -> list[tuple]:
    dice = random.Random(seed)
    rows = []
    for key in [None, *range(conversations)]:
        for turn in range(dice.randint(1, most)):
            role = dice.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None])
            text = dice.choice(["Yes.", "no", "", " \x0b", None, "Élan?", "x" * 30_000, f"own {key} {turn}.", f"Open {turn} "])
            rows.append((key, dice.choice([turn, turn, turn, turn + 3, None]), role, text, "other", 7))
    return rows + dice.choices(rows, k=len(rows) // 6)


@pytest.mark.parametrize("run", [512, 2])
def test_random_conversations_with_nulls_repeats_and_ties(spark, run):
    rows = invented(run, 40, 9)
    assert repaired(spark, rows, run=run) == expected(rows)


def test_conversation_that_holds_most_rows_is_split_and_joined(spark):
    dice = random.Random(5)
    rows = [(1, t, dice.choice(["user", "assistant", "system"]), dice.choice([f"A {t}.", "Same.", "cut"]), None, None) for t in range(900)]
    rows += [(1, 400, "user", "Same.", None, None)] * 300 + invented(1, 3, 4)
    assert repaired(spark, rows, run=16) == expected(rows)


def test_conversation_without_rows_left_and_empty_table(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert repaired(spark, [(gone, 0, "user", "Hello.", None, None)]) == {gone: NONE_LEFT}
    assert repaired(spark, []) == {}
