"""Base spans against the plain rule, the battery on random and ordinary tokens."""

import base64
import hashlib
import random
import re
import string

from pyspark.sql import functions as F

from boardlake.llm import secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def plain(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found)]


def texts():
    rng = random.Random(1)
    parts = ["password", "Secret", "API_KEY", "apikey", "token", "paſsword", "toKen", '"', "'", " ", "  ", ":", "=", "abc123def456", "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef", "x", "\n", "é", "😀", "ABCDEFGH", "-", "plain words here"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(250)]
    return made + [None, "", "token=secret: abcdefghijklmnop", "password = " + "a" * 12, "password=" + "a" * 11, "no " * 30_000 + "token: abcdefabcdefabcd", "token=abcdefghijkl " * 2_000, "AKIA" * 9]


def test_base_spans(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, base string, spans int")
    got = {r.doc_id: r for r in secrets.scan_secrets(docs).collect()}
    for i, text, *_ in rows:
        base, row = plain(text), got[i]
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (text or "")[:200]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in secrets.KINDS[:3])
        assert [s for s in row.spans.split(",") if s and not s.startswith("random")] == base


def test_battery(spark):
    rng = random.Random(2)
    keys = [base64.b64encode(rng.randbytes(36)).decode() for _ in range(150)]
    words = ["internationalization", "counterrevolutionaries", "thisisalongidentifiername", "path/to/some/file/name/here", "some_long_snake_case_name", "SOME_CONSTANT_NAME_HERE", "aaaaaaaaaaaaaaaaaaaaaaaaaa", "2021-01-01-2021-01-02-2021", "========================", "enheitlichverungstchkeiten", "CamelCaseNameOfSomeClassThere", "abcdefghijklmnopqrstuvwxyz"]
    rows = [(t, int(t in keys)) for t in keys + words]
    scored = spark.createDataFrame(rows, "t string, key int").select("t", "key", secrets.battery(F.col("t")).alias("b")).select("t", "key", "b.*")
    found = {r.t for r in scored.collect() if r.p_random >= secrets.BATTERY_LEVEL and r.p_text <= 1e-4}
    assert not found & set(words)
    assert len(found & set(keys)) >= 140


def test_spans_added_and_masked(spark):
    key = "q7Zp2Lx9Vt4Bn8Rk1Wm5Yd3Hs6Jc0GfTaUeQ"
    text = f"so the key is {key} in the middle, token=abcdefghijklmnop and on it goes"
    docs = spark.createDataFrame([(1, text), (2, "nothing"), (3, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in secrets.scan_secrets(docs).collect()}
    assert got[1].n_random == 1 and f"random:14:{14 + len(key)}" in got[1].spans.split(",")
    assert got[3].spans == "" and got[2].n_random == 0
    kept = {r.doc_id: r.t for r in secrets.with_spans(docs, F.coalesce("text", F.lit("")), "b", "s").select("doc_id", secrets.masked(F.col("text"), F.col("s")).alias("t")).collect()}
    assert kept == {1: "so the key is [secret] in the middle, [secret] and on it goes", 2: "nothing", 3: None}
    assert secrets.scan_secrets(docs.limit(0)).collect() == []


def test_values_joined_to_names(spark):
    rng = random.Random(4)
    plain = string.ascii_uppercase + string.ascii_lowercase + string.digits
    alphabets = {"upper hex": "0123456789ABCDEF", "base32": string.ascii_uppercase + "234567", "base62": plain, "base64url": plain + "-_"}
    names = ["", "key=", "sessionid=", "SESSION_KEY=", "AWS_SECRET_ACCESS_KEY=", "sk_live_", "path/to/the/", "https://example.org/some/path/"]
    rows, placed = [], {}
    for name in names:
        for kind, alphabet in alphabets.items():
            for _ in range(50):
                value = "".join(rng.choice(alphabet) for _ in range(40))
                rows.append((len(rows), f"é so {name}{value} is it"))
                placed[len(rows) - 1] = name, kind, 5 + len(name), 5 + len(name) + 40
    ordinary = ["AWS_SECRET_ACCESS_KEY=some_long_snake_case_name", "path/to/internationalization/counterrevolutionaries", "SOME_CONSTANT_NAME_HERE=ANOTHER_CONSTANT_NAME_HERE", "-" * 30_000, "a_" * 15_000, "=" * 100]
    rows += [(-1 - i, t) for i, t in enumerate(ordinary)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found, count = {}, {}
    for r in secrets.scan_secrets(docs).collect():
        spans = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("random")]
        if r.doc_id < 0:
            assert not spans, ordinary[-1 - r.doc_id]
            continue
        name, kind, start, end = placed[r.doc_id]
        count[name, kind] = count.get((name, kind), 0) + 1
        assert len(spans) < 2
        # Of a value with separators, letters before the first or behind the last may stay outside.
        room = 8 if kind == "base64url" else 0
        found[name, kind] = found.get((name, kind), 0) + any(s <= start + room and e >= end - room for s, e in spans)
    assert not {k: found[k] for k in count if found[k] < 0.86 * count[k]}


def test_running_ends(spark):
    values = [random.Random(3).randint(0, 9) for _ in range(1000)]
    row = spark.createDataFrame([(values,), ([],)], "v array<bigint>").select(secrets.running_ends(F.col("v")).alias("e")).collect()
    ends, total = [], 0
    for v in values:
        total += v
        ends.append(total)
    assert row[0].e == ends and row[1].e == []
