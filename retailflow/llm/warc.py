"""WARC archives of pages with a two-level capture index.

Archives are written by Spark's text writer, one record a row; its line separator is the end
of a WARC record, so the files are ordinary WARC. Records are dealt by length into files of about
ARCHIVE_BYTES at most (a longer record has a file of its own), which are read back whole, one
file at a time, by the length each record states.

The index has two levels. Captures are sorted by their URL with the host reversed and put
into compressed blocks; a sparse directory keeps the first key of each block. A lookup
searches the directory, then the block, and only then reads its range of one archive.
"""

import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm.shared import shared_table
from retailflow.sources.scratch import scratch_dir

REVISIT_BYTES = 1000  # smaller payloads are stored again rather than revisited
ARCHIVE_BYTES = 64 << 20
# Records up to so many bytes share files; a file holds as many as fit at that length.
ARCHIVE_STEPS = [1 << 16, 1 << 20, 1 << 24]
BLOCK_LINES = 1000
END = "\r\n\r\n"
# Fixed values of the WARC 1.0 format.
VERSION = "WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def reversed_host_key(url: str | None) -> str:
    """http://www.Example.com:80/a?b -> com,example)/a?b; other URLs sort by themselves."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return text
    if not host:
        return text
    host = re.sub(r"^www\d*\.", "", host)
    usual = port is None or (parts.scheme.lower(), port) in (("http", 80), ("https", 443))
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + ("" if usual else f":{port}") + ")" + (parts.path or "/") + query


def planned_records(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, bytes, refers_to: which pages repeat an earlier payload."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
    )
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn(
        "bytes", F.octet_length("html").cast("long")
    )
    repeated = (
        rows.where(F.col("bytes") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("last"))
        .where("n > 1")
        .select(F.col("digest").alias("last_digest"), "last")
    )
    # Stored, so that Spark knows its size: broadcast if small, else joined by digest with hot
    # digests split. With few repeats the pages are not shuffled.
    repeated = shared_table(repeated, "warc_repeated")
    joined = rows.join(repeated, rows["digest"] == repeated["last_digest"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return joined.withColumn("refers_to", refers).drop("last", "last_digest")


def write_archives(pages: DataFrame, path: str) -> None:
    rows = planned_records(pages)
    revisit = F.col("refers_to").isNotNull()
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))
    # No control character or space may end a header early.
    uri = F.regexp_replace(F.url_encode(F.coalesce("url", F.lit(""))), r"\+", "%20")
    for plain in (":", "/", "?", "=", "&", "#", ",", ";", "@"):
        uri = F.replace(uri, F.lit(f"%{ord(plain):02X}"), F.lit(plain))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    head = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name,
        F.lit("\r\nWARC-Target-URI: "), uri,
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Payload-Digest: "), digest,
        F.lit("\r\nPage-Payload-Length: "), F.col("bytes").cast("string"),
        F.when(
            revisit,
            F.concat(
                F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: <urn:page:"),
                F.col("refers_to").cast("string"), F.lit(">"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string")), F.lit(END),
        F.when(revisit, F.lit("")).otherwise(F.col("html")),
    )
    step = F.lit(len(ARCHIVE_STEPS))
    for i in reversed(range(len(ARCHIVE_STEPS))):
        step = F.when(F.col("bytes") <= ARCHIVE_STEPS[i], i).otherwise(step)
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("long")
    present = pages.select(size.alias("bytes")).groupBy(step.alias("step")).count().collect()
    for turn, i in enumerate(sorted(r["step"] for r in present) or [0]):
        records = ARCHIVE_BYTES // ARCHIVE_STEPS[i] if i < len(ARCHIVE_STEPS) else 1
        writer = rows.where(step == i).select(head.alias("value")).write.option("lineSep", END)
        writer.option("maxRecordsPerFile", records).mode("append" if turn else "error").text(path)


def parse_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """offset, length, headers and payload of each record of an archive."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = stop + 4
        end = start + int(headers["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield at, end + 4 - at, headers, data[start:end]
        at = end + 4


def _page(name: str | None) -> int | None:
    number = name[len("<urn:page:") : -1] if name else "null"
    return None if number == "null" else int(number)


_ENTRY = (
    "key string, url string, file string, position long, length long, "
    "page_id long, kind string, digest string, bytes long, refers_to long"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, with its place; digests of responses are those of the bytes read."""
    from urllib.parse import unquote

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _ENTRY.split(", ")]
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = {n: [] for n in names}
                for position, length, headers, payload in parse_records(data.as_py()):
                    kind = headers["WARC-Type"]
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{file}: the payload at byte {position} is damaged")
                    url = unquote(headers["WARC-Target-URI"])
                    size = len(payload) if kind == "response" else int(headers["Page-Payload-Length"])
                    values = (
                        reversed_host_key(url), url, file, position, length, _page(headers["WARC-Record-ID"]),
                        kind, digest, size, _page(headers.get("WARC-Refers-To")),
                    )
                    for n, v in zip(names, values):
                        rows[n].append(v)
                yield pa.RecordBatch.from_pydict(rows, schema)

    kinds = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in _ENTRY.split(", "))])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(read, _ENTRY)


_FIELDS = ("key", "page_id", "url", "file", "position", "length", "kind", "digest", "bytes", "refers_to")


def _field(value) -> str:
    if value is None:
        return "\\N"
    return str(value).replace("\\", "\\\\").replace("\t", "\\t").replace("\n", "\\n")


def _pack(rows: list[tuple]) -> bytes:
    lines = ("\t".join(map(_field, r)) for r in rows)
    return zlib.compress("\n".join(lines).encode())


_NUMBERS = {"page_id", "position", "length", "bytes", "refers_to"}
_ESCAPES = {"\\\\": "\\", "\\t": "\t", "\\n": "\n"}


def _unpack(block: bytes) -> list[tuple]:
    rows = []
    for line in zlib.decompress(block).decode().split("\n"):
        values = [None if v == "\\N" else re.sub(r"\\[\\tn]", lambda m: _ESCAPES[m[0]], v) for v in line.split("\t")]
        pairs = zip(_FIELDS, values)
        rows.append(tuple(int(v) if v is not None and n in _NUMBERS else v for n, v in pairs))
    return rows


def build_index(captures: DataFrame) -> DataFrame:
    """Blocks of captures in key order: first_key, last_key, n, block (compressed).

    The page id is part of the sort key: captures of one URL, however many, fill as many
    blocks and partitions as they need.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in _FIELDS)))
            parts = [rows[i : i + BLOCK_LINES] for i in range(0, len(rows), BLOCK_LINES)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p[0][0] for p in parts], pa.string()),
                    pa.array([p[-1][0] for p in parts], pa.string()),
                    pa.array([len(p) for p in parts], pa.int64()),
                    pa.array([_pack(p) for p in parts], pa.binary()),
                ],
                ["first_key", "last_key", "n", "block"],
            )

    ordered = captures.repartitionByRange("key", "page_id", "position").sortWithinPartitions("key", "page_id", "position")
    return ordered.mapInArrow(pack, "first_key string, last_key string, n long, block binary")


def index_captures(index: DataFrame) -> DataFrame:
    """All captures of an index, read from its blocks."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = dict(x.split() for x in _ENTRY.split(", "))
        schema = pa.schema([(n, pa.int64() if kinds[n] == "long" else pa.string()) for n in _FIELDS])
        for batch in batches:
            for block in batch.column(0):
                columns = zip(*_unpack(block.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

    kinds = dict(x.split() for x in _ENTRY.split(", "))
    return index.select("block").mapInArrow(unpack, ", ".join(f"{n} {kinds[n]}" for n in _FIELDS))


@dataclass
class CaptureIndex:
    """Lookups of single URLs.

    The driver holds the key range of each index file, as many as the index has partitions. A
    lookup searches them, then the first keys of that file's blocks, then the block.
    """

    blocks: DataFrame
    files: list[tuple[str, str, str]]

    @classmethod
    def open(cls, blocks: DataFrame) -> "CaptureIndex":
        ranges = blocks.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.min("first_key").alias("first"), F.max("last_key").alias("last")
        )
        return cls(blocks, sorted((r["first"], r["last"], r["file"]) for r in ranges.collect()))

    def lookup(self, url: str) -> list[dict]:
        """The captures of a URL, by page id."""
        key = reversed_host_key(url)
        found = []
        # Files are in key order; a key with many captures may fill several of them.
        at = bisect.bisect_left(self.files, key, key=lambda f: f[1])
        while at < len(self.files) and self.files[at][0] <= key:
            file = self.blocks.where(F.col("_metadata.file_path") == self.files[at][2])
            directory = sorted(r.first_key for r in file.select("first_key").collect())
            first = directory[max(bisect.bisect_left(directory, key) - 1, 0)]
            near = file.where(F.col("first_key").between(first, key) & (F.col("last_key") >= key))
            for row in near.select("block").collect():
                rows = _unpack(row.block)
                keys = [r[0] for r in rows]
                found += rows[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
            at += 1
        return sorted((dict(zip(_FIELDS, r)) for r in found), key=lambda r: (r["page_id"] is not None, r["page_id"] or 0))

    def read(self, capture: dict) -> bytes:
        """The payload of a response: one range of one archive, through Spark's file systems."""
        session = self.blocks.sparkSession
        jvm = session._jvm
        path = jvm.org.apache.hadoop.fs.Path(capture["file"])
        stream = path.getFileSystem(session._jsc.hadoopConfiguration()).open(path)
        try:
            stream.seek(capture["position"])
            data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, capture["length"]))
        finally:
            stream.close()
        return next(parse_records(data))[3]


def archive_pages(pages: DataFrame, path: str | None = None) -> tuple[DataFrame, str]:
    """Write pages as archives and index them; returns the index and the archives' path.

    Of records with one payload of REVISIT_BYTES or more, that with the largest page id is the
    response and others revisit it; rows that repeat that id are responses too. Null html is an
    empty payload, a null URL an empty one, null ids stay null (a null id revisits any other).
    Extra columns are ignored; an empty table gives an empty index.
    """
    spark = pages.sparkSession
    path = path or f"{scratch_dir(spark)}/archives"
    write_archives(pages, path)
    index = shared_table(build_index(read_archives(spark, path)), "warc_index")
    return index, path
