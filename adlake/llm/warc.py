"""Operator 6: legacy ARC archives, and their conversion to WARC.

``write_arc`` writes pages as ARC files of version 1 or 2. ``read_arc`` parses them: the
version block names the version, whose URL-record lines have their own fields; a record's
declared length alone tells where it ends. ``to_warc`` gives each record what WARC asks for:
a record id, an ISO 8601 date, a type (warcinfo, response, resource or revisit), target
URI, and block and payload digests. ``write_warc`` writes the archives, ``read_warc`` reads
them back.

Archives are made by Spark's text sink, one row per archive of about ARCHIVE_BYTES, the
record end as line end, gzip as compression. So tasks write through the commit protocol to
any file system Spark knows, and no archive is larger than ARCHIVE_BYTES and one record,
which bounds what a reading task holds. The table of payloads that occur more than once, a row per page
id, is joined to the records: broadcast while it is small, beyond that by a shuffle of the records
by payload and page id, so that copies of one payload are spread.
"""
from __future__ import annotations

import base64
import hashlib
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.llm.common import materialize, slices, text_column
from adlake.session import scratch_path

ARCHIVE_BYTES = 16 * 1024 * 1024
#: Crawl date for tables without one (14 digits, as in ARC).
CRAWL_DATE = "20240101000000"
#: Fixed values of the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_VERSION_LINE = {1: "1 0 Origin", 2: "2 0 Origin"}
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_HEADER = b"X-Page-Id"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- ARC ------------------------------------------------------------------------------------

def version_block(version: int, name: str, date: str) -> bytes:
    body = f"{ARC_VERSION_LINE[version]}\n{ARC_FIELDS[version]}\n".encode()
    fields = {1: ["filedesc://" + name, "0.0.0.0", date, "text/plain"],
              2: ["filedesc://" + name, "0.0.0.0", date, "text/plain", "200", "-", "-", "0", name]}[version]
    return " ".join([*fields, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_record(version: int, url: str, date: str, block: bytes, offset: int, name: str) -> bytes:
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m.group()), url or "about:blank")
    fields = {1: [url, "0.0.0.0", date, "text/html"],
              2: [url, "0.0.0.0", date, "text/html", "200", hashlib.md5(block).hexdigest(), "-", str(offset), name]}[version]
    return " ".join([*fields, str(len(block))]).encode() + b"\n" + block + b"\n"


def http_response(page_id: int | None, payload: bytes) -> bytes:
    head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=UTF-8", b"Content-Length: %d" % len(payload)]
    if page_id is not None:
        head.append(ID_HEADER + b": %d" % page_id)
    return b"\r\n".join([*head, b"", payload])


def _bundles(records: Iterator[bytes], head, end: bytes, limit: int) -> Iterator[pa.RecordBatch]:
    """Archives as single rows, without the last record's end, which the sink adds."""
    parts, held = [], 0
    for make in records:
        if not parts:
            parts = [head()]
            held = len(parts[0])
        record = make(held)
        parts.append(record)
        held += len(record)
        if held >= limit:
            yield _row(b"".join(parts).removesuffix(end))
            parts = []
    if parts:
        yield _row(b"".join(parts).removesuffix(end))


def _row(value: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], names=["value"])


def _sink(rows: DataFrame, path: str, end: str) -> None:
    (rows.select(F.col("value").cast("string")).write.option("lineSep", end).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1).text(path))


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = CRAWL_DATE, versions: tuple[int, ...] = (1, 2), archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write every page as an ARC record; tasks take the given versions in turn. Null html is
    an empty payload, a null url becomes ``about:blank``, a null id is left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        version, name = versions[task % len(versions)], f"part-{task:05d}.arc"

        def records():
            for part in slices(batches, "html"):
                for page_id, url, html in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                    block = http_response(page_id, html.encode())
                    yield lambda offset: arc_record(version, url, date, block, offset, name)

        yield from _bundles(records(), lambda: version_block(version, name, date), b"\n", archive_bytes)

    source = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                          text_column(pages, html_col).alias("html"))
    _sink(source.mapInArrow(run, "value binary"), path, "\n")


class _Input:
    """Reads from the bytes of one gzip file; holds a part of the plain text at a time."""

    def __init__(self, data: bytes, name: str):
        self.plain, self.data, self.at, self.name = zlib.decompressobj(31), memoryview(data), 0, name
        self.buffer, self.offset = b"", 0

    def _more(self) -> bool:
        chunk = bytes(self.data[self.at:self.at + (1 << 18)])
        self.at += len(chunk)
        out = self.plain.decompress(chunk) if chunk else self.plain.flush()
        self.buffer += out
        return bool(chunk)

    def line(self, end: bytes) -> bytes | None:
        while (k := self.buffer.find(end)) < 0:
            if not self._more():
                if self.buffer.strip():
                    raise ValueError(f"{self.name}: cut header at byte {self.offset}")
                return None
        return self._take(k + len(end))[:k]

    def read(self, n: int) -> bytes:
        parts, held = [], len(self.buffer)
        while held < n:
            parts.append(self.buffer)
            self.buffer = b""
            if not self._more():
                raise ValueError(f"{self.name}: the declared length passes the end at byte {self.offset}")
            held += len(self.buffer)
        self.buffer = b"".join([*parts, self.buffer])
        return self._take(n)

    def _take(self, n: int) -> bytes:
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        self.offset += n
        return out


def arc_records(data: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of one ARC file, its version block first.

    Raises ValueError for an unknown version, a header line that lacks fields, or a declared
    length that isn't a number or passes the end of the file."""
    source, names = _Input(data, name), ARC_FIELDS[1].split()
    first = True
    while (line := source.line(b"\n")) is not None:
        if not line.strip():
            continue
        # the URL comes first and may hold spaces in old archives, so fields are cut from the right
        if first:
            names = (ARC_FIELDS[2] if len(line.split()) == 10 else ARC_FIELDS[1]).split()
        values = line.decode().rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].strip().isdigit():
            raise ValueError(f"{name}: not a record header at byte {source.offset}: {line[:100]!r}")
        block = source.read(int(values[-1]))
        if first:
            version = block[:1].decode()
            if version not in "12" or not version:
                raise ValueError(f"{name}: unknown ARC version {version!r}")
            yield dict(zip(names, values)), block
            names, first = ARC_FIELDS[int(version)].split(), False
            continue
        yield dict(zip(names, values)), block


ARC_ROW = ("page_id long, url string, date string, kind string, http binary, payload binary, digest string, sha256 string, "
           "size long, archive string, place long")


def _split_http(block: bytes) -> tuple[bytes, bytes]:
    head, end, payload = block.partition(b"\r\n\r\n")
    return head + end, payload


def _header(head: bytes, name: bytes) -> bytes | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*(.*?)[ \t]*\r?$", head)
    return found.group(1) if found else None


def read_arc(spark: SparkSession, path: str, with_blocks: bool = True) -> DataFrame:
    """The records of all ARC files under ``path`` but the version blocks: ARC_ROW, http and
    payload empty unless ``with_blocks``. kind is response, or resource where the record
    has no HTTP head (as dns: records); archive and place name the record among all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for data, name in _files(batches):
            for place, (fields, block) in itertools.islice(enumerate(arc_records(data, name)), 1, None):
                http, payload = _split_http(block) if block.startswith(b"HTTP/") else (b"", block)
                page_id = _header(http, ID_HEADER)
                rows.append((int(page_id) if page_id else None, fields["URL"], fields["Archive-date"],
                             "response" if http else "resource", http if with_blocks else b"",
                             payload if with_blocks else b"", base32_sha1(payload), hashlib.sha256(payload).hexdigest(),
                             len(payload), name.rsplit("/", 1)[-1], place))
                held += len(block) if with_blocks else 200
                if held >= 1 << 22:
                    yield _batch(rows, ARC_KINDS, ARC_ROW)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, ARC_KINDS, ARC_ROW)

    return _archives(spark, path).mapInArrow(run, ARC_ROW)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per archive; so few to an Arrow batch that a task holds one archive's worth."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content")


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, str]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column("content")[i].as_py(), batch.column("path")[i].as_py()


ARC_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string(), pa.string(), pa.int64(),
             pa.string(), pa.int64()]


def _batch(rows: list[tuple], kinds: list[pa.DataType], ddl: str) -> pa.RecordBatch:
    names = [f.split()[0] for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


# --- WARC -----------------------------------------------------------------------------------

def record_id(page_id: int | None, payload: str, copy: str | None = None) -> str:
    """A version 8 UUID: 57 hashed bits, and the page id with nothing lost. ``payload`` names the payload;
    ``copy`` tells records of one page id and payload apart."""
    digest = hashlib.sha256((payload if copy is None else f"{payload} {copy}").encode()).digest()
    seed = int.from_bytes(digest[:8], "big") >> 7  # 57 bits, then whether there is an id
    bits = ((seed << 1 | (page_id is not None)) << 64) | ((page_id or 0) & (1 << 64) - 1)
    high, middle, low = bits >> 74, bits >> 62 & 0xFFF, bits & (1 << 62) - 1
    return f"urn:uuid:{uuid.UUID(int=high << 80 | 8 << 76 | middle << 64 | 2 << 62 | low)}"


def page_of(urn: str) -> int | None:
    n = uuid.UUID(urn.removeprefix("urn:uuid:")).int
    bits = (n >> 80) << 74 | (n >> 64 & 0xFFF) << 62 | n & (1 << 62) - 1
    if not bits >> 64 & 1:
        return None
    low = bits & (1 << 64) - 1
    return low - (1 << 64) if low >> 63 else low


def iso_date(digits: str) -> str:
    """ARC dates have up to 14 digits; what lacks is the start of the period."""
    d = (digits + "00000101000000"[len(digits):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(kind: str, urn: str, date: str, content_type: str, block: bytes, extra: list[tuple[str, str]]) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{urn}>"), ("WARC-Date", date), *extra,
            ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in head), "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


#: What equal payloads share: SHA-1, SHA-256 and length.
PAYLOAD = ("kind", "digest", "sha256", "size")


def repeated_payloads(records: DataFrame) -> DataFrame:
    """For payloads of several records, per page id: response_id (the largest page id of HTTP records
    with that payload) and the first record of that page id, by archive and place."""
    same = records.groupBy(*PAYLOAD, "page_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("archive", "place")).alias("first"))
    payloads = same.groupBy(*PAYLOAD).agg(F.max(F.when(F.col("kind") == "response", F.col("page_id"))).alias("response_id"),
                                          F.sum("n").alias("n")).filter("n > 1").drop("n")
    return same.join(payloads, list(PAYLOAD)).select(*PAYLOAD, "page_id", "response_id", "first")


def to_warc(records: DataFrame, repeated: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """Records with ``revisits``, the page id of the response that a record revisits, or null, and ``copy``, which
    tells records of one page id and payload apart but for the first, or null."""
    other = repeated.select(*[F.col(c).alias(f"of_{c}") for c in (*PAYLOAD, "page_id")], "response_id", "first")
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in (*PAYLOAD, "page_id")]
    shared = records.join(other, same, "left")
    later = (F.col("size") >= min_revisit_bytes) & (F.col("response_id").isNotNull()) & (
        F.col("page_id").isNull() | (F.col("page_id") < F.col("response_id")))
    own = F.struct("archive", "place")
    return shared.withColumn("revisits", F.when(later & (F.col("kind") == "response"), F.col("response_id"))).withColumn(
        "copy", F.when(F.col("first").isNotNull() & (own != F.col("first")), F.concat_ws("#", "archive", "place"))).drop(
        *[f"of_{c}" for c in (*PAYLOAD, "page_id")], "response_id", "first")


def write_warc(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write converted records (ARC_ROW, ``revisits`` and ``copy``) as WARC files, a warcinfo record first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def info() -> bytes:
            body = b"format: WARC File Format 1.1\r\nconformsTo: ARC archives, converted\r\n"
            return warc_record("warcinfo", f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'part-{task:05d}.warc')}",
                               iso_date(CRAWL_DATE), "application/warc-fields", body, [("WARC-Filename", f"part-{task:05d}.warc")])

        def records():
            names = ("page_id", "url", "date", "kind", "http", "payload", "digest", "revisits", "sha256", "copy")
            for part in slices(batches, "payload"):
                for row in zip(*(part.column(c).to_pylist() for c in names)):
                    yield lambda _: convert(*row)

        yield from _bundles(records(), info, b"\r\n\r\n", archive_bytes)

    _sink(records.mapInArrow(run, "value binary"), path, "\r\n\r\n")


def convert(page_id, url, date, kind, http, payload, digest, revisits, sha256, copy) -> bytes:
    extra = [("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}")]
    own = record_id(page_id, sha256, copy)
    if revisits is None:
        content = "application/http; msgtype=response" if kind == "response" else "text/plain"
        return warc_record(kind, own, iso_date(date), content, http + payload, extra)
    extra += [("WARC-Refers-To", f"<{record_id(revisits, sha256)}>"), ("WARC-Profile", IDENTICAL_PAYLOAD)]
    return warc_record("revisit", own, iso_date(date), "application/http; msgtype=response", http, extra)


WARC_ROW = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, date string, "
            "record_id string, refers_to_id string")


def warc_records(data: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; names of headers in lower case."""
    source = _Input(data, name)
    while (head := source.line(b"\r\n\r\n")) is not None:
        version, *lines = head.lstrip(b"\r\n").decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"{name}: no WARC record before byte {source.offset}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        block = source.read(int(headers["content-length"]))
        source.read(4)
        if headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
            raise ValueError(f"{name}: wrong block digest before byte {source.offset}")
        yield headers, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record but warcinfo, as WARC_ROW. Lengths and digests are those of full payloads:
    a revisit record's are its HTTP head's length and its payload digest. Blocks are checked
    against their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for data, name in _files(batches):
            for headers, block in warc_records(data, name):
                kind = headers["warc-type"]
                if kind == "warcinfo":
                    continue
                http, payload = _split_http(block) if kind != "resource" else (b"", block)
                own, first = headers["warc-record-id"].strip("<>"), headers.get("warc-refers-to", "").strip("<>") or None
                size, refers = len(payload), None
                if kind == "revisit":
                    size, refers = int(_header(http, b"Content-Length")), page_of(first)
                rows.append((page_of(own), size, headers["warc-payload-digest"].removeprefix("sha1:"),
                             kind, refers, headers["warc-target-uri"], headers["warc-date"], own, first))
            if rows:
                yield _batch(rows, WARC_KINDS, WARC_ROW)
                rows = []

    return _archives(spark, path).mapInArrow(run, WARC_ROW)


WARC_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]


def convert_archives(spark: SparkSession, arc_path: str, warc_path: str, min_revisit_bytes: int = 0,
                     archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Convert the ARC files under ``arc_path`` to WARC files under ``warc_path``; read them back.

    Payloads are equal if their SHA-1, SHA-256 and length are. Of HTTP records with equal payloads of at
    least ``min_revisit_bytes``, those with the largest page id
    are responses and the others revisit them; shorter ones are all responses. Records
    without a page id revisit one that has it, and are responses where none has. Repeated
    records with the largest id are all responses; a revisit refers to the first of them, by archive and
    place there. Every record has an id of its own. No records give an empty result."""
    repeated = materialize(repeated_payloads(read_arc(spark, arc_path, with_blocks=False)), "warc-repeated")
    write_warc(to_warc(read_arc(spark, arc_path), repeated, min_revisit_bytes), warc_path, archive_bytes)
    return read_warc(spark, warc_path)


def pages_to_warc(pages: DataFrame, min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, **columns: str) -> DataFrame:
    """Pages written as ARC files in the shared scratch folder, converted, read back as WARC_ROW.

    One row per page: repeated rows are repeated records; null html counts as empty; columns
    other than id, url and html are not read."""
    spark = pages.sparkSession
    arc = scratch_path(spark, "arc")
    write_arc(pages, arc, archive_bytes=archive_bytes, **columns)
    return convert_archives(spark, arc, scratch_path(spark, "warc"), min_revisit_bytes, archive_bytes)
