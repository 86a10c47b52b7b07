"""Legacy archives to WARC: ARC headers of version 1 and 2 are parsed and equivalent WARC records made.

Pages become ARC archives (a version block, then records of a header line, the
declared number of bytes and a line end), the converter reads them by their own
version's header line and declared lengths and makes the record id, time stamp,
type and digests of a WARC record. Records whose payload is that of a record with
a smaller id are written as revisits, without the payload. The archives are
written by Spark into a shared folder, gzipped, in files of a bounded number of
records, and read back record by record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, functions as F, types as T

from ..session import scratch_path
from .common import map_texts

#: Records of a file, and of an ARC archive within a task.
RECORDS_PER_FILE = 1000
RECORDS_PER_ARC = 100
#: The field lists that the version block of an archive names.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
END = b"\r\n\r\n"


def write_arc(records: list[tuple[str, str, bytes]], version: int, name: str = "pages.arc") -> bytes:
    """An archive of (url, 14-digit date, content) records."""
    block = f"{version} 0 sparkloom\n{ARC_FIELDS[version]}\n".encode()
    middle = {1: "", 2: f"200 - - 0 {name} "}[version]
    out = [f"filedesc://{name} 0.0.0.0 {records[0][1] if records else '0' * 14} text/plain {middle}{len(block)}\n"
           .encode(), block, b"\n"]
    for url, date, content in records:
        where = quote(url, safe="%/:=&?~#+!$,;'@()*[]") or "-"
        out += [f"{where} 0.0.0.0 {date} text/html {middle}{len(content)}\n".encode(), content, b"\n"]
    return b"".join(out)


def read_arc(data: bytes) -> Iterator[dict]:
    """Records of an archive: the header fields by name, and ``content``."""
    fields, at = ARC_FIELDS[1].split(), 0
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"no header line at byte {at}")
        values = data[at:end].decode().rstrip("\r").split(" ")
        first = values[0].startswith("filedesc://")
        length = int(values[-1])
        content = data[end + 1:end + 1 + length]
        if len(content) != length:
            raise ValueError(f"record at byte {at} declares {length} bytes, has {len(content)}")
        at = end + 1 + length + 1
        if first:
            lines = content.decode().split("\n")
            fields = lines[1].split()
            if fields != ARC_FIELDS.get(int(lines[0].split()[0]), "").split():
                raise ValueError(f"unknown archive version: {lines[0]}")
        else:
            if len(values) != len(fields):
                raise ValueError(f"{len(values)} header fields at byte {end}, the version has {len(fields)}")
            yield dict(zip(fields, values, strict=True)) | {"content": content}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(url: str, row: str | None, date: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {row} {date}')}>"


def to_warc(record: dict, row: str | None, first: str | None) -> bytes:
    """A WARC record without its closing blank lines; ``first``: the row whose payload this one repeats."""
    date = record["Archive-date"]
    payload = record["content"]
    head = [b"WARC/1.0", b"WARC-Type: " + (b"revisit" if first is not None else b"response"),
            f"WARC-Target-URI: {record['URL']}".encode(),
            f"WARC-Date: {date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z".encode(),
            f"WARC-Record-ID: {record_id(record['URL'], row, date)}".encode(),
            f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}".encode(),
            f"X-Payload-Length: {len(payload)}".encode()]
    if row is not None:
        head.append(f"X-Row: {row}".encode())
    http = (f"HTTP/1.0 {record.get('Result-code', '200')} OK\r\nContent-Type: {record['Content-type']}\r\n"
            f"Content-Length: {len(payload)}").encode()
    block = http + END
    if first is None:
        block += payload
    else:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                 f"X-Refers-To-Row: {first}".encode()]
    head += [f"WARC-Block-Digest: sha1:{base32_sha1(block)}".encode(),
             b"Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(head) + END + block


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, gzipped or not; lengths and block digests are checked."""
    if data[:2] == b"\x1f\x8b":
        out = []
        while data:
            member = zlib.decompressobj(31)
            out.append(member.decompress(data) + member.flush())
            data = member.unused_data
        data = b"".join(out)
    at = 0
    while at < len(data):
        end = data.index(END, at)
        lines = data[at:end].split(b"\r\n")
        if lines[0] != b"WARC/1.0":
            raise ValueError(f"no record at byte {at}")
        head = {k.decode(): v.decode() for k, _, v in (x.partition(b": ") for x in lines[1:])}
        at = end + 4 + int(head["Content-Length"])
        block = data[end + 4:at]
        if data[at:at + 4] != END or head["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
            raise ValueError(f"damaged record {head.get('WARC-Record-ID')}")
        at += 4
        yield head, block


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", date: str = "20000101000000", min_bytes: int = 0) -> None:
    """Convert pages by way of ARC archives of both versions and write gzipped WARC files."""
    html = F.coalesce(pages[html_col], F.lit(""))
    rows = pages.select(pages[id_col].alias("row"), F.coalesce(pages[url_col].cast("string"), F.lit("")).alias("url"),
                        html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    # the ids of a digest's rows, pre-aggregated in the map tasks; most digests occur once and need no join row
    twins = rows.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(
        F.min("row").alias("first"), F.count("*").alias("c")).where("c > 1 AND first IS NOT NULL").drop("c")
    joined = rows.join(twins, "digest", "left").select(F.struct("row", "url", "first").alias("k"), "html")

    def made(kept: list, texts: list) -> list:
        records, out = kept[0].to_pylist(), []
        for n, at in enumerate(range(0, len(texts), RECORDS_PER_ARC)):
            part = records[at:at + RECORDS_PER_ARC]
            arc = write_arc([(r["url"], date, (t or "").encode("utf-8", "surrogatepass")) for r, t in
                             zip(part, texts[at:at + RECORDS_PER_ARC], strict=True)], 1 + n % 2)
            for r, record in zip(part, read_arc(arc), strict=True):
                repeat = r["first"] is not None and r["row"] != r["first"]
                out.append(to_warc(record, None if r["row"] is None else str(r["row"]),
                                   str(r["first"]) if repeat else None).decode())
        return [out]

    # the text writer ends every record with the separator, which is how WARC records end
    map_texts(joined, ["k", "html"], T.StructType.fromDDL("value string"), made).write.option(
        "lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def read_archives(spark, path: str, id_type: T.DataType | None = None, with_payload: bool = False) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to (and url, payload)."""
    fields = ("page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string"
              + (", url string, payload binary" if with_payload else ""))

    def made(kept: list, files: list) -> list:
        out: list[list] = [[] for _ in range(7)]
        for data in files:
            for head, block in read_warc(data):
                payload = block[block.index(END) + 4:]
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if head["WARC-Type"] == "response" and (base32_sha1(payload), str(len(payload))) != (
                        digest, head["X-Payload-Length"]):
                    raise ValueError(f"payload of {head['WARC-Record-ID']} is not what its digest says")
                for column, value in zip(out, (head.get("X-Row"), int(head["X-Payload-Length"]), digest,
                                               head["WARC-Type"], head.get("X-Refers-To-Row"),
                                               head["WARC-Target-URI"], payload), strict=True):
                    column.append(value)
        return out[:7 if with_payload else 5]

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    out = map_texts(files, ["content"], T.StructType.fromDDL(fields), made)
    kind = id_type or T.LongType()
    return out.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


def roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              min_bytes: int = 0) -> DataFrame:
    """Write the archives into the shared folder and read them back.

    A record whose payload (of at least ``min_bytes``) is also that of a row with a
    smaller id is a revisit of the smallest; repeated rows of the smallest id are
    all responses. Null html is an empty payload, a null url an empty one, rows
    with a null id have no name in the archive and are responses unless a row with
    an id has their payload. Urls are percent-encoded where ARC needs it. One row
    per input row; other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, html_col, min_bytes=min_bytes)
    return read_archives(spark, path, pages.schema[id_col].dataType).withColumnRenamed("page_id", id_col)
