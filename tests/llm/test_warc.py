"""Archives: exact round trips."""

import base64
import gzip
import hashlib

from boardlake.llm import warc

SCHEMA = "page_id bigint, url string, html string, capture string, payload string"
ROWS = [
    (3, "http://a/3", "same"), (1, "http://a/1", "same"), (9, "http://a/9", "same"), (4, None, None), (2, "http://a/2", ""),
    (5, "http://a/\r\n5", "WARC/1.1\r\nWARC-Type: response\r\n\r\nin the payload\r\n\r\n\r\n"), (6, "http://é", "ünï \x00   😀"),
    (7, "http://a/7", "long " * 200_000), (8, "http://a/8", "\r\n\r\n"), (None, "http://a/n", "same"), (11, "http://a/11", "twice"), (11, "http://a/11", "twice"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "x", "y") for r in ROWS], SCHEMA)
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path)
    records = warc.read_records(spark, path, payloads=True)
    captures = warc.assemble(records)
    got = sorted(map(tuple, warc.page_captures(captures).collect()), key=str)
    first = {"same": 1, "": 2, "twice": 11}
    expected, seen = [], set()
    for page_id, _, html in sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0)):
        html = html or ""
        again = html in seen
        seen.add(html)
        expected.append((page_id, len(html.encode()), digest(html), "revisit" if again else "response", first[html] if again else None))
    assert got == sorted(expected, key=str)
    assert records.count() == 3 * len(ROWS)
    payloads = {bytes(r.payload).decode() for r in records.collect() if r.type == "response"}
    assert payloads == {h or "" for _, _, h in ROWS}
    assert all(r.request and r.main and r.metadata for r in captures.collect())


def test_archives_end_by_bytes(spark, tmp_path):
    sizes = [200_000] * 6 + [10] * 300 + [3_000_000] + [70_000] * 9
    rows = [(i, f"http://a/{i}", f"{i} " + "é" * (n // 2)) for i, n in enumerate(sizes)]
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA.split(", capture")[0]).coalesce(1), path, archive_bytes=500_000)
    held = []
    for file in (tmp_path / "w").glob("*.gz"):
        content = gzip.decompress(file.read_bytes())
        held.append((len(content), sum(h["warc-type"] == "response" for h, _ in warc.parse_archive(content))))
    assert sum(n for _, n in held) == len(rows)
    assert all(size <= 501_000 or n == 1 for size, n in held) and max(n for _, n in held) > 50 and len(held) < 40
    assert warc.read_records(spark, path).count() == 3 * len(rows)


def test_rows_alike_and_shuffled_pages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "REPEATS", 7)
    rows = [(1, "u", "hot")] * 40 + [(1, None, "hot"), (None, "1", "hot"), (1, "v", "hot"), (2, None, ""), (None, "u", "")] + [(3, "u", "x")] * 2
    pages = spark.createDataFrame(rows, SCHEMA.split(", capture")[0])
    for least in (0, 2):
        path = str(tmp_path / f"w{least}")
        warc.write_archives(pages.repartition(5), path, least_bytes=least)
        captures = warc.assemble(warc.read_records(spark, path)).collect()
        assert len(captures) == len(rows) and all(c.request and c.main and c.metadata for c in captures)
        stored = {c.main.record_id for c in captures if c.main.type == "response"}
        again = [c.main for c in captures if c.main.type == "revisit"]
        assert len(stored) == (3 if least == 0 else 5) and all(m.refers_to in stored for m in again)


def test_plain_and_many_member_archives():
    record = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\na\r\n\r\n\r\n"
    many = gzip.compress(record) + gzip.compress(record)
    assert [b for _, b in warc.parse_archive(many)] == [b for _, b in warc.parse_archive(record * 2)] == [b"a\r\n"] * 2


def test_least_bytes_and_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "same"), (2, "u", "same")], "page_id bigint, url string, html string")
    warc.write_archives(pages, str(tmp_path / "a"), least_bytes=5)
    assert {r.type for r in warc.read_records(spark, str(tmp_path / "a")).collect()} == {"request", "response", "metadata"}
    warc.write_archives(pages.limit(0), str(tmp_path / "b"))
    assert warc.assemble(warc.read_records(spark, str(tmp_path / "b"))).count() == 0
