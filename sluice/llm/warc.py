"""WARC archives as a PySpark data source: format("warc").

A reader plans one partition per archive file, parses headers first, applies pushed predicates on record type and on
header columns to them, and passes over the payload of unwanted records. Three forms are read: `.warc.gz` files of
members whose gzip header carries an `sl` extra field with the member's compressed and the record's plain length (the
form written here), where unwanted payloads are sought over and never inflated; other `.warc.gz` files, which have to be
inflated in order but whose unwanted payloads are dropped unparsed; and plain `.warc` files, where they are sought over.
"""

from __future__ import annotations

import gzip
import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from ..plans.ship import ship
from .common import filesystem, fresh_path, written

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, payload_digest string, "
    "refers_to string, http_length long, payload binary"
)
WRITTEN = ["record_id", "record_type", "target_uri", "warc_date", "payload_digest", "refers_to", "http_length", "payload"]
HEADER_OF = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
}
#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MEMBER = struct.Struct("<4sI2sH2sHII")  # magic+flags, mtime, xfl+os, xlen, 'sl', 8, compressed, plain
LEVEL = 4
#: A headers-only read inflates so much of a record first, and more only where the headers are longer.
HEAD_BYTES = 2_048


def member(record: bytes) -> bytes:
    """One gzip member with skip lengths."""
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(record) + deflate.flush()
    size = _MEMBER.size + len(body) + 8
    head = _MEMBER.pack(b"\x1f\x8b\x08\x04", 0, b"\x00\xff", 12, b"sl", 8, size, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def clean(value: str) -> str:
    """A header value keeps to its line."""
    return value.replace("\r", " ").replace("\n", " ")


def record_bytes(row: dict) -> bytes:
    """A whole record from its columns; a revisit has the HTTP headers alone, with the length of the full payload."""
    payload = row["payload"] or b""
    length = row["http_length"] if row["http_length"] is not None else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (b"" if row["record_type"] == "revisit" else payload)
    lines = [VERSION, *(f"{h}: {clean(row[c])}" for c, h in HEADER_OF.items() if row[c] is not None)]
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_lines(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def header_columns(fields: dict[str, str]) -> dict[str, str | None]:
    return {c: fields.get(h.lower()) for c, h in HEADER_OF.items()}


def is_http(fields: dict[str, str]) -> bool:
    return fields.get("content-type", "").lower().startswith("application/http")


def row_of(fields: dict[str, str], block: bytes, payload: bool) -> dict:
    """A record's columns. The payload of an HTTP record is what follows its HTTP headers, else the whole block, which
    may be cut behind those headers where no payload is asked for."""
    http, _, content = block.partition(b"\r\n\r\n") if is_http(fields) else (b"", b"", block)
    length = parse_lines(http).get("content-length", "") if is_http(fields) else fields["content-length"]
    return header_columns(fields) | {"http_length": int(length) if length.isdigit() else None, "payload": content if payload else None}


def read_members(handle, wanted=lambda columns: True, payload: bool = True) -> Iterator[dict]:
    """Records of an archive of members with skip lengths that `wanted` admits by their header columns; the rest is sought
    over."""
    while head := handle.read(_MEMBER.size):
        if len(head) < _MEMBER.size or head[12:14] != b"sl":
            raise ValueError("not an archive of skippable members")
        left = _MEMBER.unpack(head)[6] - _MEMBER.size - 8
        inflate = zlib.decompressobj(-zlib.MAX_WBITS)
        start = b""

        def inflated_to_blank_line(text: bytes) -> bytes:
            nonlocal left
            while b"\r\n\r\n" not in text and (inflate.unconsumed_tail or left):
                more = inflate.unconsumed_tail or handle.read(min(left, HEAD_BYTES))
                left -= 0 if inflate.unconsumed_tail else len(more)
                if not more:
                    raise ValueError("archive ends within a record")
                text += inflate.decompress(more, HEAD_BYTES)
            return text

        start = inflated_to_blank_line(start)
        lines, _, rest = start.partition(b"\r\n\r\n")
        fields = parse_lines(lines)
        if not wanted(header_columns(fields)):
            handle.seek(left + 8, io.SEEK_CUR)
            continue
        if payload:
            rest += inflate.decompress(inflate.unconsumed_tail + handle.read(left))
            if zlib.crc32(rest, zlib.crc32(lines + b"\r\n\r\n")) != struct.unpack("<I", handle.read(8)[:4])[0]:
                raise ValueError(f"damaged record {fields.get('warc-record-id')}")
        else:
            rest = inflated_to_blank_line(rest) if is_http(fields) else rest
            handle.seek(left + 8, io.SEEK_CUR)
        yield row_of(fields, rest[: int(fields["content-length"])], payload)


def read_plain(handle, wanted=lambda columns: True, payload: bool = True) -> Iterator[dict]:
    """The same of a stream of plain records, one after the other."""
    while line := handle.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        lines = [line]
        while (line := handle.readline()).strip():
            lines.append(line)
        fields = parse_lines(b"".join(x.rstrip(b"\r\n") + b"\r\n" for x in lines))
        left = int(fields["content-length"])
        if not wanted(header_columns(fields)):
            handle.seek(left, io.SEEK_CUR)
            continue
        block = handle.read(left if payload else min(left, HEAD_BYTES if is_http(fields) else 0))
        left -= len(block)
        while not payload and is_http(fields) and left and b"\r\n\r\n" not in block:
            more = handle.read(min(left, HEAD_BYTES))
            if not more:
                break
            block, left = block + more, left - len(more)
        if payload and left:
            raise ValueError(f"archive ends within record {fields.get('warc-record-id')}")
        handle.seek(left, io.SEEK_CUR)
        yield row_of(fields, block, payload)


def read_archive(handle, wanted=lambda columns: True, payload: bool = True) -> Iterator[dict]:
    """Records of a seekable archive in any of the three forms."""
    head = handle.read(_MEMBER.size)
    handle.seek(0)
    if head[:2] != b"\x1f\x8b":
        yield from read_plain(handle, wanted, payload)
    elif head[12:14] == b"sl" and head[3] & 4:
        yield from read_members(handle, wanted, payload)
    else:
        yield from read_plain(gzip.GzipFile(fileobj=handle), wanted, payload)


def test_of(f: ds.Filter):
    """(column, test) of a predicate on one header column, or None if headers can't decide it."""
    name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
    if name not in HEADER_OF:
        return None
    if isinstance(f, ds.EqualTo):
        return name, lambda v, x=f.value: v == x
    if isinstance(f, ds.In):
        return name, lambda v, x=frozenset(f.value): v in x
    if isinstance(f, ds.IsNotNull):
        return name, lambda v: v is not None
    if isinstance(f, ds.IsNull):
        return name, lambda v: v is None
    if isinstance(f, ds.StringStartsWith):
        return name, lambda v, x=f.value: v is not None and v.startswith(x)
    if isinstance(f, ds.StringContains):
        return name, lambda v, x=f.value: v is not None and x in v
    return None


class WarcFile(ds.InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.tests: list = []

    def pushFilters(self, filters):
        for f in filters:
            test = test_of(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self):
        from pyarrow import fs

        store, path = filesystem(self.folder)
        found = store.get_file_info(fs.FileSelector(path, recursive=True))
        names = sorted(x.path for x in found if x.is_file and x.path.endswith((".warc.gz", ".warc")) and "/_temporary/" not in x.path)
        return [WarcFile(n) for n in names] or [WarcFile("")]

    def read(self, partition):
        if not partition.path:
            return
        store, _ = filesystem(self.folder)
        tests = self.tests

        def wanted(columns):
            return all(test(columns[name]) for name, test in tests)

        schema = pa.schema([(c, pa.int64() if c == "http_length" else pa.binary() if c == "payload" else pa.string()) for c in WRITTEN])
        rows, held = [], 0
        with store.open_input_file(partition.path) as file, io.BufferedReader(file, 1 << 20) as handle:
            for row in read_archive(handle, wanted, self.payload):
                rows.append(row)
                held += len(row["payload"] or b"") + 500
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class Written(ds.WriterCommitMessage):
    def __init__(self, temporary: str, name: str):
        self.temporary, self.name = temporary, name


class WarcWriter(ds.DataSourceArrowWriter):
    """One archive per task, renamed into place when all tasks have ended well."""

    def __init__(self, options: dict):
        self.folder, self.job = options["path"], uuid.uuid4().hex

    def write(self, iterator):
        store, path = filesystem(self.folder)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        store.create_dir(f"{path}/_temporary/{self.job}", recursive=True)
        temporary = f"{path}/_temporary/{self.job}/{name}"
        with store.open_output_stream(temporary, compression=None, buffer_size=1 << 20) as out:
            for batch in iterator:
                for row in batch.to_pylist():
                    out.write(member(record_bytes(row)))
        return Written(temporary, name)

    def commit(self, messages):
        store, path = filesystem(self.folder)
        for m in messages:
            if m is not None:
                store.move(m.temporary, f"{path}/{m.name}")
        self.abort(messages)

    def abort(self, messages):
        from pyarrow import fs

        store, path = filesystem(self.folder)
        if store.get_file_info(f"{path}/_temporary/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{path}/_temporary/{self.job}")


class WarcDataSource(ds.DataSource):
    """format("warc"). Options: path; payload=false reads headers alone."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


#: Fixed value: the base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: every 5 hex digits make 4 base32 digits."""
    digits = F.sha1(payload)
    numbers = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(digits, i * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    letters = lambda n: F.concat(*(F.substring(F.lit(BASE32), (F.shiftright(n, s).bitwiseAND(F.lit(31))) + 1, F.lit(1)) for s in (15, 10, 5, 0)))
    return F.array_join(F.transform(numbers, letters), "")


RECORD_PREFIX = "urn:page:"
DATE = "2024-01-01T00:00:00Z"


#: A payload of at least one in so many records is common; there can't be more than so many of those.
COMMON = 1_000


def to_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """WARC columns of pages (page_id, url, html).

    Among records whose payloads are equal and have at least least_bytes bytes, the one with the largest page_id is the
    response and the others revisit it; smaller payloads are all responses. Null html is the empty payload. Rows that
    repeat a page_id with the same payload are all responses; a null page_id never revisits. The newest page of a payload
    that at least one record in COMMON has is broadcast, as there are at most COMMON of them, so that no task gets all
    copies of an error page.
    """
    page = pages.select("page_id", F.col("url").alias("target_uri"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    page = page.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("http_length", F.octet_length("payload").cast("long"))
    newest = page.filter(F.col("http_length") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("newest"), F.count("*").alias("_n"))
    repeated = written(newest.filter("_n > 1"), "repeated")
    common = pages.count() / COMMON
    first = F.broadcast(repeated.filter(F.col("_n") > common).select("digest", F.col("newest").alias("newest_common"), F.lit(True).alias("_common")))
    page = page.join(first, "digest", "left")
    # a page with a common payload is decided here: it needs no partner any more, and a revisit has no payload to move
    decided = F.coalesce("_common", F.lit(False))
    page = page.withColumn("payload", F.when(F.coalesce(F.col("newest_common") > F.col("page_id"), F.lit(False)), F.lit(None)).otherwise(F.col("payload")))
    page = page.withColumn("partner", F.when(decided, F.concat_ws("/", "digest", F.xxhash64("page_id", "target_uri"))).otherwise(F.col("digest")))
    rest = repeated.filter(F.col("_n") <= common).select(F.col("digest").alias("partner"), "newest")
    page = page.join(rest, "partner", "left").withColumn("newest", F.coalesce("newest_common", "newest"))
    revisit = F.coalesce((F.col("http_length") >= least_bytes) & (F.col("newest") > F.col("page_id")), F.lit(False))
    uri = lambda c: F.concat(F.lit(f"<{RECORD_PREFIX}"), c.cast("string"), F.lit(">"))
    return page.select(
        F.coalesce(uri(F.col("page_id")), F.lit(f"<{RECORD_PREFIX}>")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.lit(DATE).alias("warc_date"), F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.when(revisit, uri(F.col("newest"))).alias("refers_to"), "http_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.select(*WRITTEN).write.format("warc").option("path", path).mode("append").save()


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("path", path).option("payload", str(payload).lower()).load()


def archive_and_read(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from the archives read back.

    Of a response, size and digest are those of the payload bytes read; of a revisit, those its headers state.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_warc(to_records(pages), path)
    back = read_warc(spark, path)
    response = F.col("record_type") == "response"
    number = lambda c: F.nullif(F.regexp_extract(c, "(-?\\d+)>$", 1), F.lit("")).cast("long")
    return back.select(
        number("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(response, base32_sha1(F.col("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


_GROUP = "('0x' || substr(hex, {i} * 5 + 1, 5))::INTEGER"
_LETTERS = " || ".join(f"substr('{BASE32}', (({_GROUP} >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0))
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT *, {" || ".join(_LETTERS.format(i=i) for i in range(8))} AS payload_digest, max(page_id) OVER (PARTITION BY hex) AS newest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < newest THEN newest END AS refers_to
FROM d
"""
