"""Legacy archive converter: ARC (version 1 and 2) to WARC, and a WARC reader.

Parsing. An ARC file starts with a version block, `filedesc://name ip date type length` and then a line with the version and one
naming the fields; every record is a header line with the fields of that version and `Archive-length` bytes of content. Lengths are
obeyed; a header line that does not fit or a content that is cut short ends the file with a row in `error`. From each record the converter makes
a WARC identifier (a name-based UUID of target, date and digest), a timestamp in the newer form, type, SHA-1 digest and length.
Records whose payload (of `revisit_bytes` or more) equals that of another one, by length and SHA-256, become `revisit`s of the one with the largest id.

Files are gzipped by Spark's text writer (the record separator is the line separator), one for each task, to any store that Spark writes.
Reading holds one compressed file in a task, inflates it piece by piece, obeys Content-Length and never searches payloads for separators.

Defined cases. Null html: empty payload. Null or odd url: `-` and percent escapes in the ARC header; the given url, if any, in the WARC
target. Repeated rows: one record each; those of the largest id are all `response`. Null id: record kept, id null; it revisits a page
with an id whose payload equals its own, else it is a `response`; never a target of revisits. Urls and header lines of any length. Very long payloads: one
record of any length below 2 GB. A record that does not parse, or a number of records that differs from that of the pages, fails the conversion. Empty table: no rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, land, pick, remove, scratch_path, slices, spread_join

#: Fixed values of the ARC format: the fields of a record's header line, by version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}

EMPTY_SHA1 = hashlib.sha1(b"").hexdigest()


@dataclass(frozen=True)
class Params:
    revisit_bytes: int = 1_000
    archive_date: str = "20240101000000"
    #: Up to so many groups of equal payloads (some 60 bytes each) are broadcast to the records; above, that join is a shuffle.
    broadcast_groups: int = 100_000


# --- ARC ---------------------------------------------------------------------------------------------------------------


def arc_record(url: str | None, payload: bytes, version: int, date: str, page: int | None) -> bytes:
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if page is not None:
        head += b"X-Page-Id: %d\r\n" % page
    if url:
        head += b"X-Page-Url: " + quote(url, safe=":/?#[]@!$&'()*+,;=%").encode() + b"\r\n"
    content = head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    target = quote(url or "-", safe=":/?#[]@!$&'()*+,;=%")
    if version == 1:
        fields = [target, "0.0.0.0", date, "text/html", str(len(content))]
    else:
        fields = [target, "0.0.0.0", date, "text/html", "200", hashlib.md5(content).hexdigest(), "-", "0", "pages.arc", str(len(content))]
    return " ".join(fields).encode() + b"\n" + content + b"\n"


def arc_version_block(version: int, date: str) -> bytes:
    block = f"{version} 0 tapewright\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return f"filedesc://pages.arc 0.0.0.0 {date} text/plain {len(block)}\n".encode() + block + b"\n"


def parse_arc(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of one ARC file, in order; a last row with `error` where the file breaks off or does not parse."""
    version: int | None = None
    while True:
        line = stream.readline()
        while line in (b"\n", b"\r\n"):
            line = stream.readline()
        if not line:
            return
        fields = line.rstrip(b"\r\n").split(b" ")
        if version is None:
            if not line.startswith(b"filedesc:") or not fields[-1].isdigit():
                yield {"error": "no version block"}
                return
            block = stream.read(int(fields[-1])).split(b"\n")
            number = block[0].split(b" ")[0]
            if number not in (b"1", b"2"):
                yield {"error": "unknown version"}
                return
            version = int(number)
            continue
        names = ARC_FIELDS[version]
        if len(fields) != len(names) or not fields[-1].isdigit():
            yield {"error": "header line does not fit the version"}
            return
        header = dict(zip(names, (x.decode("latin-1") for x in fields), strict=True))
        length = int(header["Archive-length"])
        content = stream.read(length)
        if len(content) < length:
            yield {"error": "content cut short"}
            return
        head, gap, payload = content.partition(b"\r\n\r\n")
        if not gap or not head.startswith(b"HTTP/"):
            head, payload = b"", content
        yield {"header": header, "http": head, "payload": payload, "error": None}


def archive(pages: DataFrame, path: str, p: Params = Params()) -> None:
    """Write pages (page_id, url, html) as gzipped ARC files, one a task; tasks alternate between the versions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version, first = 1 + TaskContext.get().partitionId() % 2, True
        for part in slices(batches, 2):
            rows = [] if not first else [arc_version_block(version, p.archive_date)[:-1]]
            first = False
            for page, url, html in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                rows.append(arc_record(url, (html or "").encode("utf-8", "surrogatepass"), version, p.archive_date, page)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])

    _write(pages.mapInArrow(run, "record binary"), path, "\n")


def _write(records: DataFrame, path: str, end: str) -> None:
    """Records, each ended by `end`, as gzipped files; the cast keeps every byte."""
    records.select(F.col("record").cast("string")).write.option("lineSep", end).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


# --- WARC --------------------------------------------------------------------------------------------------------------


def warc_date(archive_date: str) -> str:
    d = re.sub(r"\D", "", archive_date).ljust(14, "0")[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(target: str, date: str, digest: str, page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{target} {date} {digest} {page}')}>"


def converted(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """ARC files to rows: page_id, target, date, record_id, payload (or null), digest, payload_bytes, print (SHA-256), error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "target", "date", "record_id", "payload", "digest", "payload_bytes", "print", "error"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.binary(), pa.string()]
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                rows: list[list] = [[] for _ in names]
                size = 0
                for r in parse_arc(gzip.GzipFile(fileobj=io.BytesIO(packed))):
                    if r["error"]:
                        values = [None] * 8 + [r["error"]]
                    else:
                        page = re.search(rb"(?mi)^X-Page-Id: (-?\d+)\r?$", r["http"])
                        url = re.search(rb"(?mi)^X-Page-Url: (.*?)\r?$", r["http"])
                        target = url[1].decode() if url else r["header"]["URL"]
                        digest, date = hashlib.sha1(r["payload"]).hexdigest(), warc_date(r["header"]["Archive-date"])
                        number = int(page[1]) if page else None
                        values = [number, target, date, record_id(target, date, digest, number), r["payload"] if with_payload else None, digest, len(r["payload"]), hashlib.sha256(r["payload"]).digest(), None]
                    for row, x in zip(rows, values, strict=True):
                        row.append(x)
                    size += len(r.get("payload", b"")) if with_payload else 0
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names=names)
                        rows, size = [[] for _ in names], 0
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names=names)

    schema = "page_id long, target string, date string, record_id string, payload binary, digest string, payload_bytes long, print binary, error string"
    return _files(spark, path).mapInArrow(run, schema)


def warc_record(row: dict) -> bytes:
    """One WARC record. A revisit has no payload of its own; its headers keep digest and length of the full one."""
    revisit = row["refers_to"] is not None
    block = b"" if revisit else row["payload"]
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Date: {row['date']}",
        f"WARC-Target-URI: {row['target']}", "Content-Type: text/html; charset=utf-8", f"WARC-Payload-Digest: sha1:{row['digest']}",
        f"X-Payload-Length: {row['payload_bytes']}", f"Content-Length: {len(block)}",
    ]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {row['refers_to']}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of one WARC file; raises ValueError where a record breaks off."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC version line")
        headers: dict[str, str] = {}
        for line in iter(lambda: stream.readline(), b""):
            if line in (b"\r\n", b"\n"):
                break
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("record cut short")
        yield headers, block


def write_warc(records: DataFrame, path: str) -> None:
    """Rows with refers_to as gzipped WARC files, one a task."""
    order = ["page_id", "target", "date", "record_id", "payload", "digest", "payload_bytes", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, order.index("payload")):
            rows = [warc_record(dict(zip(order, values, strict=True)))[:-4] for values in zip(*(part.column(i).to_pylist() for i in range(len(order))), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])

    _write(records.select(*order).mapInArrow(run, "record binary"), path, "\r\n\r\n")


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Rows of WARC files: page_id, record_type, target, date, record_id, payload_digest, payload_bytes, refers_to, digest_ok, payload."""
    names = ["page_id", "record_type", "target", "date", "record_id", "payload_digest", "payload_bytes", "refers_to", "digest_ok", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = lambda h, k: int(h[k]) if k in h else None
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                rows: list[list] = [[] for _ in names]
                size = 0
                for h, block in parse_warc(gzip.GzipFile(fileobj=io.BytesIO(packed))):
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    ok = h["warc-type"] == "revisit" or hashlib.sha1(block).hexdigest() == digest
                    length = whole(h, "x-payload-length") if h["warc-type"] == "revisit" else len(block)
                    values = [whole(h, "x-page-id"), h["warc-type"], h["warc-target-uri"], h["warc-date"], h["warc-record-id"], digest, length, whole(h, "x-refers-to-page"), ok, block if with_payload else None]
                    for row, x in zip(rows, values, strict=True):
                        row.append(x)
                    size += len(block) if with_payload else 0
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names=names)
                        rows, size = [[] for _ in names], 0
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names=names)

    schema = "page_id long, record_type string, target string, date string, record_id string, payload_digest string, payload_bytes long, refers_to long, digest_ok boolean, payload binary"
    return _files(spark, path).mapInArrow(run, schema)


def targets(records: DataFrame, p: Params = Params()) -> DataFrame:
    """print, payload_bytes, best: the largest page_id of every group of equal payloads that has more than one record and an id."""
    big = records.where(F.col("payload_bytes") >= p.revisit_bytes)
    best = big.groupBy("print", "payload_bytes").agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n"))
    return best.where("n > 1 and best is not null").drop("n")


def with_targets(records: DataFrame, best: DataFrame, p: Params = Params()) -> DataFrame:
    """records with refers_to; best is a landed table. Payloads are not shuffled where the groups are few enough to broadcast."""
    rows = spread_join(records, best, ["print", "payload_bytes"], p.broadcast_groups, ["record_id"], "left")
    return rows.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("best")), F.col("best"))).drop("best")


def convert_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", p: Params = Params(), with_payload: bool = False) -> DataFrame:
    """pages to ARC files, ARC to WARC files, and the WARC files read back; the WARC files stay in the shared folder."""
    spark = pages.sparkSession
    arcs, warcs = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    archive(pick(pages, page_id=id_col, url=url_col, html=html_col).withColumn("page_id", F.col("page_id").cast("long")), arcs, p)
    light = land(converted(spark, arcs, with_payload=False).select("page_id", "payload_bytes", "print", "error"), "warc-records")
    found = light.agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("failed"), F.min("error").alias("first")).first()
    if found["failed"] or found["n"] != pages.count():
        raise ValueError(f"{found['n']} records of {pages.count()} pages, {found['failed']} of them with an error: {found['first']}")
    best = land(targets(light, p), "warc-targets")
    write_warc(with_targets(converted(spark, arcs), best, p), warcs)
    remove(spark, arcs)
    discard(light, best)
    return read_warc(spark, warcs, with_payload)
