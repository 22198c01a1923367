"""WARC archives of pages: an index first, then reads of the byte ranges it names.

Writing deals pages by the digest of their payload, so that equal payloads meet and all
but one become short revisit records. Each task writes archives of its own, one gzip
member per record, and returns an index row (archive, offset, length, url, digest) for
each. Reading needs the index alone: the ranges of the selected records are sorted,
ranges that lie close are joined into one read, and each member is unpacked by itself.

A task that is repeated writes new archives. Only those of the attempt whose index rows
were committed are ever named, so a lost executor or a speculative copy does no harm.

Defined results: a null html is an empty payload; the null page_id comes before all
others; a null url gives a record without target; of rows equal in page_id and payload,
the one with the greatest url is the response, and of wholly equal rows any one. Other
columns are ignored. Pages of any length are whole records. An empty table gives no
archives and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmatch.llm.ship import ship
from tagmatch.sources.shared import shared_folder, stored

#: A new archive is begun beyond this size.
ARCHIVE_BYTES = 1 << 30
#: An archive is read by one task per so many bytes.
READ_BLOCK = 64 << 20
#: Ranges at most this far apart are read at once, up to the second number of bytes.
MAX_GAP, MAX_READ = 64 << 10, 8 << 20

#: Groups of more equal payloads than this may be dealt to SALTS tasks, namely the
#: MAX_HOT largest. Any other group holds less than 1 / MAX_HOT of all rows.
HOT_COPIES, MAX_HOT, SALTS = 1000, 10_000, 64

# Formats of the archive.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
PAGE_ID, REFERS_TO_PAGE = "X-Page-ID", "X-Refers-To-Page-ID"
HTTP_TYPE = "application/http; msgtype=response"

INDEX = (
    "archive string, offset long, length long, url string, digest string, page_id string, "
    "record_type string"
)
RECORD = (
    "archive string, offset long, url string, page_id string, record_type string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_FLUSH_BYTES = 4 << 20


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def base32_digest(payload: bytes) -> str:
    """SHA-1 as WARC files have it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path; ``file:/x`` and plain paths are local ones."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/*", "/", path))


def _record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{name}: {value}" for name, value in headers if value is not None)]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    return head + block + b"\r\n\r\n"


def _record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(parts))}>"


def _target(url: str | None) -> str | None:
    """The url without characters that would end or split a header."""
    return None if url is None else _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)


class _Archives:
    """Archives of one task attempt, begun when first needed."""

    def __init__(self, folder: str, archive_bytes: int) -> None:
        task = TaskContext.get()
        self.folder, self.limit = folder, archive_bytes
        self.name = f"{task.partitionId():06d}-{task.taskAttemptId()}" if task else "0"
        self.count, self.out, self.path, self.offset = 0, None, "", 0

    def append(self, record: bytes) -> tuple[str, int, int]:
        """Write one member; (archive, offset, length)."""
        if self.out is None or self.offset > self.limit:
            self._begin()
        member = gzip.compress(record, mtime=0)
        at = self.offset
        self.out.write(member)
        self.offset += len(member)
        return self.path, at, len(member)

    def _begin(self) -> None:
        self.close()
        self.path = f"{self.folder}/{self.name}-{self.count:04d}.warc.gz"
        self.count += 1
        system, path = _place(self.path)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.offset = system.open_output_stream(path, compression=None), 0
        info = b"software: tagmatch\r\nformat: WARC File Format 1.1\r\n"
        headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(self.path)), ("WARC-Date", DATE)]
        self.append(_record([*headers, ("Content-Type", "application/warc-fields")], info))

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


class _Page(NamedTuple):
    page_id: str | None
    url: str | None
    payload: bytes
    digest: str
    hot: bool
    keeper_id: str | None
    keeper_url: str | None


def _page_record(page: _Page, refers_to: str | None, is_response: bool, folder: str, record_id: str) -> bytes:
    digest = f"sha1:{base32_digest(page.payload)}"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(page.payload)}\r\n\r\n"
    ).encode()
    headers = [
        ("WARC-Type", "response" if is_response else "revisit"),
        ("WARC-Record-ID", _response_id(folder, page.digest) if is_response else record_id),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _target(page.url)),
        ("WARC-Payload-Digest", digest),
        (PAGE_ID, page.page_id),
    ]
    if not is_response:
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _response_id(folder, page.digest)),
            (REFERS_TO_PAGE, refers_to),
        ]
    headers.append(("Content-Type", HTTP_TYPE))
    return _record(headers, http + page.payload if is_response else http)


def _response_id(folder: str, digest: str) -> str:
    """Of equal payloads only one is a response, so its name needs no look-up."""
    return _record_id(folder, digest)


def _pages(batches: Iterable[pa.RecordBatch]) -> Iterator[list[_Page]]:
    for batch in batches:
        yield [_Page(*row) for row in zip(*(column.to_pylist() for column in batch.columns))]


def _writer(folder: str, archive_bytes: int):
    """Function that writes sorted pages and returns their index rows."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, archives = _arrow(INDEX), _Archives(folder, archive_bytes)
        group = keeper = None
        held = False  # the response of this group has been written
        try:
            for pages in _pages(batches):
                rows = []
                for n, page in enumerate(pages):
                    if page.digest != group:
                        group, held = page.digest, False
                        keeper = page.keeper_id if page.hot else page.page_id
                    own = not page.hot or (page.page_id, page.url) == (page.keeper_id, page.keeper_url)
                    is_response = own and not held
                    held |= is_response
                    name = _record_id(archives.path, archives.name, str(archives.offset), str(n))
                    record = _page_record(page, keeper, is_response, folder, name)
                    kind = "response" if is_response else "revisit"
                    rows.append((*archives.append(record), page.url, base32_digest(page.payload), page.page_id, kind))
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        finally:
            archives.close()

    return write


def _largest_groups(pages: DataFrame) -> DataFrame:
    """(digest, keeper): the response of each of the largest groups of equal payloads."""
    return (
        pages.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("members"), F.max(F.struct("page_id", "url")).alias("keeper"))
        .filter(F.col("members") > HOT_COPIES)
        .orderBy(F.col("members").desc(), "digest")
        .limit(MAX_HOT)
        .select("digest", "keeper")
    )


def write_archives(
    pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the stored index.

    Of equal payloads, that with the largest page_id is a response record and the others
    revisit it. Index: archive, offset, length, url, digest, page_id, record_type. The
    text is shuffled once. Groups of very many equal payloads are dealt to several tasks,
    which all know the group's response beforehand.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = folder or shared_folder(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    hot = _largest_groups(rows.select("page_id", "url", "digest"))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    is_hot = F.col("keeper").isNotNull()
    dealt = (
        rows.join(F.broadcast(hot), "digest", "left")
        .withColumn("salt", F.when(is_hot, salt).otherwise(F.lit(0)))
        .repartition("digest", "salt")
        .sortWithinPartitions("digest", F.desc_nulls_last("page_id"), F.desc_nulls_last("url"))
        .select(
            F.col("page_id").cast("string"),
            "url",
            "payload",
            "digest",
            is_hot.alias("hot"),
            F.col("keeper.page_id").cast("string").alias("keeper_id"),
            F.col("keeper.url").alias("keeper_url"),
        )
    )
    index = dealt.mapInArrow(_writer(folder, archive_bytes), INDEX)
    return stored(index.withColumn("page_id", _as_id(pages, "page_id")), "warc-index")


def _as_id(pages: DataFrame, name: str) -> Column:
    return F.col(name).cast(pages.schema["page_id"].dataType)


class _Entry(NamedTuple):
    archive: str
    offset: int
    length: int
    url: str | None
    digest: str


def _runs(entries: Iterable[_Entry]) -> Iterator[list[_Entry]]:
    """Entries in order of place, in lists that are read at once."""
    run: list[_Entry] = []
    for entry in entries:
        if run:
            end = run[-1].offset + run[-1].length
            near = entry.archive == run[0].archive and entry.offset - end <= MAX_GAP
            if not near or entry.offset + entry.length - run[0].offset > MAX_READ:
                yield run
                run = []
        run.append(entry)
    if run:
        yield run


def _parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    record = gzip.decompress(member)
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {headers.get('WARC-Record-ID')} is cut")
    return headers, rest[:size]


def _read_record(entry: _Entry, member: bytes) -> tuple:
    headers, block = _parsed(member)
    http, _, payload = block.partition(b"\r\n\r\n")
    is_response = headers["WARC-Type"] == "response"
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if digest != entry.digest or (is_response and digest != base32_digest(payload)):
        raise ValueError(f"{entry.archive}, {entry.offset}: the payload is not that of the index")
    size = int(re.search(rb"(?m)^Content-Length: ([0-9]+)\r?$", http)[1])
    return (
        entry.archive,
        entry.offset,
        entry.url,
        headers.get(PAGE_ID),
        headers["WARC-Type"],
        headers.get(REFERS_TO_PAGE),
        digest,
        size,
        payload if is_response else None,
    )


def _entries(batches: Iterable[pa.RecordBatch]) -> Iterator[_Entry]:
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            yield _Entry(*row)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read the records of index rows that come in order of archive and offset."""
    schema = _arrow(RECORD)
    opened, source = None, None
    rows, size = [], 0

    def packed() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for run in _runs(_entries(batches)):
        if run[0].archive != opened:
            if source is not None:
                source.close()
            system, path = _place(run[0].archive)
            opened, source = run[0].archive, system.open_input_file(path)
        start = run[0].offset
        source.seek(start)
        data = source.read(run[-1].offset + run[-1].length - start)
        for entry in run:
            at = entry.offset - start
            row = _read_record(entry, data[at : at + entry.length])
            rows.append(row)
            size += len(row[-1] or b"") + 200
            if size > _FLUSH_BYTES:
                yield packed()
                rows, size = [], 0
    if source is not None:
        source.close()
    if rows:
        yield packed()


def read_records(index: DataFrame) -> DataFrame:
    """The records that rows of an index name, all or any selection of them.

    Columns: archive, offset, url, page_id, record_type, refers_to, payload_digest,
    payload_bytes, payload (null for revisits; the two before it are those of the full
    payload). A record whose digest is not that of the index makes the read fail.
    """
    ship(index.sparkSession)
    block = F.expr(f"offset div {READ_BLOCK}")
    ordered = (
        index.select("archive", "offset", "length", "url", "digest")
        .repartition("archive", block)
        .sortWithinPartitions("archive", "offset")
    )
    return ordered.mapInArrow(_read, RECORD).withColumns(
        {name: _as_id(index, name) for name in ("page_id", "refers_to")}
    )
