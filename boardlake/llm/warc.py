"""WARC archives of pages, and the transaction assembly that turns their records into captures.

Writing: every page becomes a request, a response or revisit, and a metadata record. Equal payloads are stored
once, with the smallest page id; the others are revisits that refer to it. Identifiers come from a capture's content
and its number among repeated rows, so a retried task writes the same ones. Captures are packed into archives by their
running bytes; Spark's text writer makes a gzip file of each.

Reading: archives are parsed by content length into record rows, and the records of a capture are joined through
their concurrent-to identifiers into one nested row.
"""

from __future__ import annotations

import base64
import functools
import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.llm.batches import map_rows
from boardlake.session import staged

# Fixed values of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 8 * 2**20
CAPTURE_DATE = "2020-01-01T00:00:00Z"
# Repeated rows are counted, and numbered anew in parts of so many.
REPEATS = 4096


def _record_id(kind: str, page_id: str = "page_id", url: str = "url", copy: Column | None = None) -> Column:
    """Identifier of a capture's record: of its page id, URL, payload and number among rows alike."""
    named = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (page_id, url)]
    digest = F.md5(F.concat_ws("\n", F.lit(kind), "same", (F.col("copy") if copy is None else copy).cast("string"), *named))
    cut = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(fields: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its closing blank lines. Fields with a null value are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in fields]
    head = F.concat_ws("", F.lit(VERSION + CRLF), *lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF))
    return F.concat(head, block)


def _header_value(text: Column) -> Column:
    """A header value holds no line breaks; a URL that has some is percent-encoded there."""
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


CAPTURE = ("page_id", "url", "same", "copy", "payload", "length", "sha1", "refers_to", "refers_url")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` as often as ``n`` says, with ``copy`` from 0; a row of very many is dealt over tasks in parts before that."""
    begin = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(REPEATS).cast("bigint")))
    parts = rows.filter(F.col("n") > 0).withColumn("_begin", begin).repartition("same", "page_id", "url", "_begin")
    return parts.withColumn("copy", F.explode(F.sequence("_begin", F.least(F.col("n"), F.col("_begin") + REPEATS) - 1))).drop("_begin", "n")


def stored_payloads(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """A row per page: those whose payload is stored have it, the others have null there and ``refers_to`` and ``refers_url``.

    Payloads move only where they are stored, and equal ones meet before the shuffle. The revisits come from counts of
    small rows (payload digest, page id, URL), so a page that very many others repeat is no group of payloads anywhere.
    """
    named = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    keyed = named.withColumn("length", F.octet_length("payload").cast("bigint")).withColumn("same", F.sha2("payload", 256))
    shared = keyed.filter(F.col("length") >= least_bytes)
    order = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("url"))
    sha1 = F.sha1(F.encode("payload", "UTF-8"))

    stored = shared.groupBy("same").agg(F.first("payload").alias("payload"), F.first("length").alias("length"), F.min(order).alias("first"))
    stored = stored.select("same", "payload", "length", F.col("first.page_id").alias("page_id"), F.col("first.url").alias("url"), sha1.alias("sha1"), F.lit(0).cast("bigint").alias("copy"))

    small = shared.groupBy("same", "page_id", "url").agg(F.count(F.lit(1)).alias("n"), F.first("length").alias("length"), F.first(sha1).alias("sha1"))
    small = staged(small, "warc-rows")
    firsts = small.groupBy("same").agg(F.min(order).alias("first"))
    leads = F.when(order.eqNullSafe(F.col("first")), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    rest = small.join(firsts, "same").withColumn("lead", leads).withColumn("n", F.col("n") - F.col("lead"))
    again = _numbered(rest).withColumn("copy", F.col("copy") + F.col("lead"))
    again = again.withColumn("refers_to", F.col("first.page_id")).withColumn("refers_url", F.col("first.url"))
    none = {"payload": F.lit(None).cast("string"), "refers_to": F.lit(None).cast(pages.schema["page_id"].dataType), "refers_url": F.lit(None).cast("string")}
    rows = [stored, again]
    if least_bytes > 0:
        short = keyed.filter(F.col("length") < least_bytes).groupBy("same", "page_id", "url").agg(F.count(F.lit(1)).alias("n"), F.first("payload").alias("payload"), F.first("length").alias("length"))
        rows.append(_numbered(short).withColumn("sha1", sha1))
    full = [r.select(*[F.col(c) if c in r.columns else none[c].alias(c) for c in CAPTURE]) for r in rows]
    return functools.reduce(DataFrame.unionByName, full)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the records of all pages (``page_id``, ``url``, ``html``) below ``path``.

    Null html is an empty payload, a null url an empty target, a null page id is kept as one and sorts last.
    Repeated rows are captures of their own; of equal ones one is the response. Payloads under ``least_bytes`` are
    never revisits. An empty table writes no records. An archive ends before the capture that would take it over
    ``archive_bytes`` (before compression); only a capture larger than that fills one alone, so a reader can take any whole.
    """
    rows = stored_payloads(pages, least_bytes)
    repeat = F.col("payload").isNull()
    main = _record_id("main")
    date, target = ("WARC-Date", F.lit(CAPTURE_DATE)), ("WARC-Target-URI", _header_value(F.coalesce("url", F.lit(""))))
    earlier = F.when(repeat, _record_id("main", "refers_to", "refers_url", F.lit(0)))
    head = F.lit(HTTP_HEAD)
    response = _record(
        [
            ("WARC-Type", F.when(repeat, F.lit("revisit")).otherwise(F.lit("response"))), ("WARC-Record-ID", main), date, target,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
            ("WARC-Profile", F.when(repeat, F.lit(REVISIT_PROFILE))), ("WARC-Refers-To", earlier),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(repeat, head).otherwise(F.concat(head, F.col("payload"))),
    )
    ask = F.concat(F.lit("GET / HTTP/1.1\r\nX-Target: "), target[1], F.lit(CRLF + CRLF))
    request = _record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", _record_id("request")), date, target, ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/http; msgtype=request"))], ask)
    known = F.concat_ws("", *[F.concat(F.lit(f"{name}: "), F.col(column).cast("string"), F.lit(CRLF)) for name, column in (("page-id", "page_id"), ("refers-to-page", "refers_to"), ("payload-length", "length"))])
    metadata = _record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _record_id("metadata")), date, target, ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/warc-fields"))], known)
    whole = rows.select(F.concat_ws(CRLF * 2, request, response, metadata).alias("value"))
    packed = map_rows(whole.select("value", F.octet_length("value").alias("size")), _Packer(archive_bytes), "value string", size=1)
    packed.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)


class _Packer:
    """Joins captures to archives of so many bytes at most, a larger capture alone."""

    def __init__(self, archive_bytes: int):
        self.archive_bytes = archive_bytes

    def __call__(self, batches):
        held, size = [], 0
        for batch in batches:
            for value, n in zip(batch["value"], batch["size"]):
                if held and size + n > self.archive_bytes:
                    yield (CRLF * 2).join(held),
                    held, size = [], 0
                held.append(value)
                size += n
        if held:
            yield (CRLF * 2).join(held),


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every record of a plain or gzip archive, unpacked as it is read."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    yield from _records(stream)


def _records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts at byte {stream.tell() - len(line)}")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("the last record is cut off")
        yield headers, block


RECORD = "record_id string, type string, concurrent_to string, refers_to string, url string, date string, content_type string, fields map<string,string>, payload_bytes bigint, payload_digest string, payload binary"


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record below ``path``. A response's length and SHA-1 (bare base32) come from its payload as read;
    a revisit has the digest of its header. ``payload`` itself is null unless asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def parse(batches):
        for batch in batches:
            while batch["content"]:
                for headers, block in parse_archive(batch["content"].pop()):
                    yield _row(headers, block, payloads)

    return map_rows(files, parse, RECORD, size=1024 if payloads else 8192)


def _row(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind = headers["warc-type"]
    fields = length = digest = payload = None
    if kind == "metadata":
        fields = dict(line.split(": ", 1) for line in block.decode("utf-8").split(CRLF) if line)
    elif kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        length, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    elif kind == "revisit":
        digest = base64.b32encode(bytes.fromhex(headers["warc-payload-digest"].removeprefix("sha1:"))).decode()
    get = headers.get
    return (get("warc-record-id"), kind, get("warc-concurrent-to"), get("warc-refers-to"), get("warc-target-uri"), get("warc-date"), get("content-type"), fields, length, digest, payload if payloads else None)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``request``, ``main`` (response or revisit) and ``metadata`` as structs, null where none is there.

    Records point to the main record of their capture by concurrent-to; main records stand for themselves. The
    join is one grouping by that identifier, of three records each.
    """
    capture = records.withColumn("capture_id", F.coalesce("concurrent_to", "record_id"))
    row = F.struct(*records.columns)

    def one(*kinds: str) -> Column:
        return F.any_value(F.when(F.col("type").isin(*kinds), row), ignoreNulls=True)

    return capture.groupBy("capture_id").agg(one("request").alias("request"), one("response", "revisit").alias("main"), one("metadata").alias("metadata"))


def page_captures(captures: DataFrame, id_type: str = "bigint") -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` of assembled captures."""
    field = F.col("metadata.fields")
    return captures.select(
        F.element_at(field, F.lit("page-id")).cast(id_type).alias("page_id"),
        F.coalesce(F.col("main.payload_bytes"), F.element_at(field, F.lit("payload-length")).cast("bigint")).alias("payload_bytes"),
        F.col("main.payload_digest").alias("payload_digest"),
        F.col("main.type").alias("record_type"),
        F.element_at(field, F.lit("refers-to-page")).cast(id_type).alias("refers_to"),
    )
