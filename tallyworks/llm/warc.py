"""WARC archives: a writer that stores equal payloads once, and a Spark data source that reads them.

The writer's records are gzip members of their own whose extra field ``sl`` gives their compressed and plain
lengths, so the reader can decompress a record's headers and pass over the rest. It reads other archives too: plain ones, where it
seeks past what isn't wanted, and gzip ones without that field, where it inflates but doesn't keep it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from tallyworks.llm.files import filesystem, finished_files, write_file
from tallyworks.llm.shared import new_folder, staged
from tallyworks.llm.streams import HEAD, Plain, opened
from tallyworks.operators.skew import group_apart

_DATE = "1970-01-01T00:00:00Z"  # archives of equal pages are equal
#: The digits of base 32 as Spark's ``conv`` and as digests write them.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Columns that come from a header each.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_bytes long, payload binary"


def payload_digest(data: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_of(data: Column) -> Column:
    """The same for a binary column; ten hexadecimal digits are eight of base 32."""
    parts = [F.lpad(F.conv(F.substring(F.sha1(data), k * 10 + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), *_DIGITS)


def _clean(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, number: int) -> bytes:
    """One compressed record; ``first`` is the page that a revisit refers to, whose payload it leaves out."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http + (b"" if first is not None else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page if page is not None else f'none-{number}'}>",
        f"WARC-Date: {_DATE}",
        *([f"WARC-Target-URI: {_clean(url)}"] if url and url.strip() else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        *(
            []
            if first is None
            else [
                f"WARC-Refers-To: <urn:page:{first}>",
                "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            ]
        ),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    plain = "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    data = deflate.compress(plain) + deflate.flush()
    size = HEAD.size + len(data) + 8
    head = HEAD.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, ord("s"), ord("l"), 8, size, len(plain) & 0xFFFFFFFF)
    return head + data + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> int:
    """Write a record per page into archives in ``folder``; returns their number.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with the smallest page_id becomes a response,
    and the others revisit it. Pages that share that page_id are all responses, and so are equal pages that
    all lack an id.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        count = [0]

        def records(out) -> None:
            for batch in (b for source in ([first], batches) for b in source):
                for page, url, html, digest, refers in zip(*batch.columns, strict=True):
                    out.write(record(page.as_py(), url.as_py(), html.as_py() or b"", digest.as_py(), refers.as_py(), count[0]))
                    count[0] += 1

        write_file(folder, f"part-{context.partitionId():06d}.warc.gz", context.taskAttemptId(), records)
        yield pa.RecordBatch.from_pydict({"records": pa.array([count[0]], pa.int64())})

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("binary").alias("html")
    )
    known = rows.withColumn("digest", digest_of(F.coalesce("html", F.lit(b""))))
    firsts = group_apart(known.select("digest", "page_id"), ["digest"], {"first": F.min("page_id")})
    equal = F.coalesce(F.octet_length("html"), F.lit(0)) >= least_bytes
    marked = known.join(firsts, "digest").select(
        "page_id", "url", "html", "digest",
        F.when(equal & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers"),
    )
    done = staged(marked.mapInArrow(write, "records long"), "warc-files")
    return done.count()


@dataclass
class Archive(InputPartition):
    path: str

    def __init__(self, path: str):
        self.path = path


def fields(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name, the first of each; a line that begins with white space goes on with the one before."""
    out: dict[str, str] = {}
    lines: list[str] = []
    for line in block.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")[1:]:
        if line[:1] in (" ", "\t") and lines:
            lines[-1] += " " + line.strip()
        else:
            lines.append(line)
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


class WarcReader(DataSourceReader):
    """Plans a partition per archive, and tests pushed predicates on headers before a payload is decoded."""

    def __init__(self, options: dict):
        self.folder = options["path"]
        self.payloads = options.get("payloads", "true").lower() == "true"
        self.verify = options.get("verify", "true").lower() == "true"
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802 (Spark's name)
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                values = set(f.value if isinstance(f, In) else [f.value])
                column = f.attribute[0]
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def partitions(self) -> list[Archive]:
        return [Archive(path) for path, _ in finished_files(self.folder)] or [Archive("")]

    def read(self, partition: Archive) -> Iterator[tuple]:
        if not partition.path:
            return
        system, name = filesystem(partition.path)
        with system.open_input_file(name) as file:
            stream = opened(file)
            while stream.next_record():
                if (row := self._record(stream)) is not None:
                    yield row

    def _record(self, stream: Plain) -> tuple | None:
        """The next record's row, if it is wanted; the stream then stands behind the record's block."""
        head = stream.head()
        if head is None or not head[0].startswith(b"WARC/"):
            raise ValueError(f"no record's headers where one should begin: {bytes(stream.held[:40])!r}")
        stream.skip(head[1])
        headers = fields(head[0])
        row = {c: self._value(c, headers.get(h)) for c, h in HEADERS.items()}
        size = int(headers["content-length"])
        if any(row[c] not in values for c, values in self.wanted.items()):
            stream.skip(size)
            return None
        http = headers.get("content-type", "").replace(" ", "").lower().startswith("application/http")
        inner = stream.head(size) if http else None
        inner, body = ({}, 0 if not http else size) if inner is None else (fields(inner[0]), inner[1])
        declared = inner.get("content-length", "")
        if row["record_type"] == "revisit":
            stream.skip(size)
            return (*row.values(), int(declared) if declared.isdecimal() else None, None)
        if not self.payloads:
            stream.skip(size)
            return (*row.values(), size - body, None)
        stream.skip(body)
        payload = stream.take(size - body)
        digest = headers.get(HEADERS["payload_digest"], "")
        # digests of other kinds, and of payloads as they were before their transfer, aren't compared
        if digest.lower().startswith("sha1:") and len(digest) == 37 and "transfer-encoding" not in inner:
            if self.verify and payload_digest(payload) != row["payload_digest"].upper():
                raise ValueError(f"the payload of {row['record_id']} differs from its headers")
        return (*row.values(), size - body, payload)

    @staticmethod
    def _value(column: str, value: str | None) -> str | None:
        if value is None:
            return None
        if column == "payload_digest":
            return value[5:] if value[:5].lower() == "sha1:" else value
        return value.removeprefix("<").removesuffix(">") if column == "target_uri" else value


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; options ``payloads``: whether to decode payloads, and ``verify``: whether to compare their SHA-1.

    The folder may hold archives of other writers, plain or in gzip, or be a single file. A payload is what follows the
    HTTP headers of a response or request, and the whole block of other records; revisits have none, and their
    ``payload_bytes`` is the length that their HTTP headers give, if any.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the archives in a folder, one row each; equality filters on header columns reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payloads", str(payloads).lower()).load(folder)


def archive_digest(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back from written archives.

    A null html counts as empty; an address is stored on one line. Records of pages without a page_id have a null one.
    Further columns are ignored; no rows give no archives and no rows.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archives(pages, folder, least_bytes)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    long = lambda c: F.when(number(c) != "", number(c).cast("long"))
    return read_archives(spark, folder).select(
        long("record_id").alias("page_id"),
        F.when(F.col("record_type") == "response", F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        long("refers_to").alias("refers_to"),
    )
