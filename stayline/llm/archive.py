"""Legacy web archives (ARC, versions 1 and 2) written, converted to WARC and read back.

Archive files are written by Spark's text writer (bytes as they are, gzip) and read by its binary reader, so they
may lie in any store that Spark reaches. A task writes one file, and no file is larger than what one input
partition holds.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import Staged, table

# -- fixed values: header lines of the two ARC versions, names of WARC fields --------------------------
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
# -------------------------------------------------------------------------------------------------------
CAPTURED = "20240101000000"
#: Level of the archives' gzip; the usual one takes three times as long for files 4 % smaller.
GZIP_LEVEL = "FOUR"
ROWS = 512
CONVERTED = "page_id long, url string, archive_date string, content_type string, payload binary, payload_bytes long, payload_digest string, record_id string"
READ_BACK = "page_id long, record_id string, record_type string, refers_record string, payload_bytes long, payload_digest string, url string, warc_date string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _unzipped(content: bytes) -> bytes:
    """Plain bytes of a file of any number of gzip members."""
    parts = []
    while content:
        stream = zlib.decompressobj(31)
        parts += [stream.decompress(content), stream.flush()]
        content = stream.unused_data
    return b"".join(parts)


def _rows(found: Iterable[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``ROWS`` rows and about 8 MB."""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kinds[kind]) for column, (_, kind) in zip(zip(*held, strict=True), fields, strict=True)], [n for n, _ in fields]
        )

    for row in found:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes | str))
        if len(held) >= ROWS or size > 8 << 20:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


# -- ARC -------------------------------------------------------------------------------------------------


def _header_url(url: str | None) -> str:
    """A URL as one field of a header line; a missing one gets a placeholder."""
    return "".join(f"%{ord(c):02X}" if c <= " " else c for c in url or "") or "about:blank"


def arc_record(version: int, page_id: int | None, url: str | None, html: str | None, captured: str = CAPTURED) -> bytes:
    """One record: header line, then an HTTP response of exactly the declared length, then a line break."""
    body = (html or "").encode("utf-8")
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    head += f"Content-Length: {len(body)}\r\n" + (f"X-Page-Id: {page_id}\r\n" if page_id is not None else "") + "\r\n"
    block = head.encode() + body
    fields = [_header_url(url), "0.0.0.0", captured, "text/html"]
    if version == 2:
        fields += ["200", "-", "-", "0", "-"]
    return " ".join([*fields, str(len(block))]).encode() + b"\n" + block + b"\n"


def arc_head(version: int, captured: str = CAPTURED) -> bytes:
    """The version block that opens a file and names the fields of its header lines."""
    block = f"{version} 0 stayline\n{ARC_FIELDS[version]}\n\n".encode()
    extra = ["200", "-", "-", "0", "-"] if version == 2 else []
    line = " ".join(["filedesc://pages.arc", "0.0.0.0", captured, "text/plain", *extra, str(len(block))])
    return line.encode() + b"\n" + block + b"\n"


def write_arc(pages: DataFrame, folder: str, version: int = 1) -> None:
    """Pages as ARC files. A null page_id or url is left out or replaced, a null html is an empty payload."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            yield (arc_head(version)[:-1],)
            for batch in batches:
                for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    yield (arc_record(version, page_id, url, html)[:-1],)

        yield from _rows(found(), "value binary")

    read = pages.select(F.col("page_id").cast("long"), "url", "html")
    texts = read.mapInArrow(lines, "value binary").select(F.col("value").cast("string"))
    texts.write.option("lineSep", "\n").option("compression", "gzip").option("zlib.compress.level", GZIP_LEVEL).text(folder)


def arc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields by name and block of every record of an ARC file, as the file's own version block declares them."""
    at, names = 0, ARC_FIELDS[1].split()
    while at < len(content):
        line_end = content.find(b"\n", at)
        if line_end < 0:
            line_end = len(content)
        line = content[at:line_end].decode("utf-8", "replace").rstrip("\r")
        at = line_end + 1
        if not line.strip():
            continue
        values = line.split(" ")
        if values[0].startswith("filedesc://"):
            length = int(values[-1])
            described = content[at : at + length].decode("utf-8", "replace").split("\n")
            names = described[1].split() if len(described) > 1 and described[1].strip() else ARC_FIELDS[int(described[0].split()[0])].split()
            fields = dict(zip(ARC_FIELDS[1].split(), [*values[:4], values[-1]], strict=True))
        else:
            if len(values) != len(names) or not values[-1].isdigit():
                raise ValueError(f"not an ARC header line of {len(names)} fields: {line[:200]}")
            fields, length = dict(zip(names, values, strict=True)), int(values[-1])
        yield fields, content[at : at + length]
        at += length


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and body of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, body


def record_id(url: str, date: str, page_id: int | None, digest: str) -> str:
    """Identifier of a converted record: the same for every attempt of a task."""
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{url} {date} {page_id} {digest}").urn


def read_arc(spark: SparkSession, folder: str, payload: bool) -> DataFrame:
    """The response records of ARC files with their synthesised identifier and payload digest."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                for content in batch.column(0):
                    for fields, block in arc_records(_unzipped(content.as_py())):
                        if fields["URL"].startswith("filedesc://"):
                            continue
                        http, body = split_http(block)
                        page_id = int(http["x-page-id"]) if "x-page-id" in http else None
                        digest, date = payload_digest(body), fields["Archive-date"]
                        name = record_id(fields["URL"], date, page_id, digest)
                        yield page_id, fields["URL"], date, fields["Content-type"], body if payload else None, len(body), digest, name

        yield from _rows(found(), CONVERTED)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInArrow(parse, CONVERTED)


# -- WARC ------------------------------------------------------------------------------------------------


def decide(records: DataFrame, minimum: int = 0) -> DataFrame:
    """``record_id``, ``refers_record``: of records with equal payloads of at least ``minimum`` bytes all but the one
    with the largest page_id (null: smallest; ties by identifier) refer to that one; the others refer to none."""
    last = F.max(F.struct(F.col("page_id"), F.col("record_id"))).alias("last")
    firsts = records.where(F.col("payload_bytes") >= minimum).groupBy("payload_digest", "payload_bytes").agg(last)
    refers = F.when(F.col("last.record_id") != F.col("record_id"), F.col("last.record_id"))
    return records.join(firsts, ["payload_digest", "payload_bytes"], "left").select("record_id", refers.alias("refers_record")).distinct()


def warc_record(kind: str, block: bytes, **fields: str | None) -> bytes:
    """One record without the two line breaks that end it."""
    lines = [WARC_VERSION, f"WARC-Type: {kind}"]
    lines += [f"{name.replace('_', '-')}: {value}" for name, value in fields.items() if value is not None]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block


def warc_date(date: str) -> str:
    """``yyyyMMddHHmmss``, with parts at its end possibly missing, as an ISO instant."""
    full = date[:14].ljust(8, "0").ljust(14, "0") if len(date) >= 8 else (date + "0101")[:8].ljust(14, "0")
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def write_warc(records: DataFrame, folder: str) -> None:
    """Converted records as WARC files, each opened by a warcinfo record. A revisit has the HTTP head alone as block."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            info = b"software: stayline\r\nformat: WARC File Format 1.0\r\n"
            yield (warc_record("warcinfo", info, WARC_Record_ID=f"<{uuid.uuid5(uuid.NAMESPACE_URL, folder).urn}>", WARC_Date=warc_date(CAPTURED), Content_Type="application/warc-fields"),)
            for batch in batches:
                for r in batch.to_pylist():
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: {r['content_type']}\r\nContent-Length: {r['payload_bytes']}\r\n"
                    head += (f"X-Page-Id: {r['page_id']}\r\n" if r["page_id"] is not None else "") + "\r\n"
                    again = r["refers_record"]
                    block = head.encode() + (b"" if again else r["payload"])
                    yield (
                        warc_record(
                            "revisit" if again else "response",
                            block,
                            WARC_Record_ID=f"<{r['record_id']}>",
                            WARC_Date=warc_date(r["archive_date"]),
                            WARC_Target_URI=r["url"],
                            WARC_Payload_Digest=f"sha1:{r['payload_digest']}",
                            WARC_Block_Digest=f"sha1:{payload_digest(block)}",
                            WARC_Refers_To=f"<{again}>" if again else None,
                            WARC_Profile=REVISIT_PROFILE if again else None,
                            Content_Type="application/http; msgtype=response",
                        ),
                    )

        yield from _rows(found(), "value binary")

    texts = records.mapInArrow(lines, "value binary").select(F.col("value").cast("string"))
    texts.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("zlib.compress.level", GZIP_LEVEL).text(folder)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of a WARC file, by declared lengths."""
    at = 0
    while at < len(content):
        if content[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = content.find(b"\r\n\r\n", at)
        if end < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        at = end + 4 + int(fields["content-length"])
        yield fields, content[end + 4 : at]


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Response and revisit records; a response's digest is computed from its payload and must be the one declared."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                for content in batch.column(0):
                    for fields, block in warc_records(_unzipped(content.as_py())):
                        kind = fields["warc-type"]
                        if kind not in ("response", "revisit"):
                            continue
                        http, body = split_http(block)
                        declared = fields["warc-payload-digest"].removeprefix("sha1:")
                        size = int(http["content-length"])
                        if kind == "response" and (payload_digest(body), len(body)) != (declared, size):
                            raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest or length")
                        refers = fields.get("warc-refers-to", "").strip("<>") or None
                        page_id = int(http["x-page-id"]) if "x-page-id" in http else None
                        yield page_id, fields["warc-record-id"].strip("<>"), kind, refers, size, declared, fields["warc-target-uri"], fields["warc-date"]

        yield from _rows(found(), READ_BACK)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInArrow(parse, READ_BACK)


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, minimum: int = 0) -> None:
    """ARC files to WARC files. Only the payloads of the last shuffle move; decisions are made on digests."""
    decisions = decide(read_arc(spark, arc_folder, payload=False), minimum)
    write_warc(read_arc(spark, arc_folder, payload=True).join(decisions, "record_id"), warc_folder)


def round_trip(pages: DataFrame, version: int = 2, minimum: int = 0) -> DataFrame:
    """Pages through ARC and WARC: page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, url, warc_date.

    Repeated rows with one page_id, url and html become one record identifier: the first is the response or
    revisit as their payload asks, and all of them are read back. No page gives no record.
    """
    spark = pages.sparkSession
    staged = Staged(spark, "archive")
    arc, warc = staged.path("arc"), staged.path("warc")
    write_arc(pages, arc, version)
    convert(spark, arc, warc, minimum)
    staged.drop("arc")
    records = read_warc(spark, warc)
    originals = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_record"), F.col("page_id").alias("refers_to")).distinct()
    return records.join(originals, "refers_record", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url", "warc_date"
    )


def web_archive(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), h AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, body, sha1(body) AS hex FROM p
), b AS (
  SELECT *, array_to_string(list_transform(string_split(hex, ''), lambda c: substr(
    '0000000100100011010001010110011110001001101010111100110111101111', (instr('0123456789abcdef', c) - 1) * 4 + 1, 4)), '') AS bits
  FROM h
), d AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + 16 * substr(bits, i * 5 + 1, 1)::INT + 8 * substr(bits, i * 5 + 2, 1)::INT + 4 * substr(bits, i * 5 + 3, 1)::INT
    + 2 * substr(bits, i * 5 + 4, 1)::INT + substr(bits, i * 5 + 5, 1)::INT, 1)), '') AS payload_digest
  FROM b
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM d WINDOW w AS (PARTITION BY body)
"""
