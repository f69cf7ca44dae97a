"""WARC archives: written from a table of pages, and read back by a sequential reader.

Every record is a gzip member of its own. The reader goes through an archive once, in pieces of ``CHUNK`` bytes: it inflates member
after member, cuts the header off at the first empty line, counts the block by its Content-Length and hashes it on the way. So
a record of any size needs little memory unless its payload is asked for. What is wrong with a record is said in its
``error`` column, and reading goes on with the next member; after damaged bytes that is the next place where a member starts.

Of pages with equal payloads of at least ``least`` bytes, the one with the smallest id is a response (null ids come last; of rows
that share payload and id, one), the others are revisits without payload that refer to it. Payloads are compared by length and
SHA-256. A null payload is the empty one, a null id or address has no header field. Line breaks and other control characters of an
address are percent-encoded, since they would end the field. Other columns are not read, whatever their names.

Each task writes its records into archives of about ``ARCHIVE`` bytes in the given folder, under names that no other attempt uses.
The list of archives is a table that Spark commits, so archives of a lost or repeated task are in no list and never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidegate.session import qualified, scratch_path, written

ARCHIVE = 64 << 20
CHUNK = 1 << 18
HEADER = 1 << 20  # a header field block that is longer does not end
ROWS = 256  # records that are passed on together; fewer if they hold many bytes
BYTES = 4 << 20
DATE = "2000-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the name space of addresses
# The format's version line, profile of equal payloads and media types.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP, FIELDS = "application/http; msgtype=response", "application/warc-fields"
ABOUT = b"format: WARC File Format 1.1\r\n"
PAGE = "Page-Id"  # an extension field
MEMBER = b"\x1f\x8b\x08"

RECORD = (
    "archive string, position long, record_id string, record_type string, uri string, page_id long, refers_to_record string, "
    "payload_bytes long, payload_digest string, payload binary, error string"
)


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = [VERSION, *[f"{name}: {value}" for name, value in fields if value is not None], f"Content-Length: {len(block)}"]
    return _member("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _address(uri: str | None) -> str | None:
    return uri if uri is None else "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in uri)


def _urn(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, name)}>"


def page_record(name: str, page: str | None, uri: str | None, payload: bytes, first: str | None) -> bytes:
    """The record of a page: a response, or a revisit of the record called ``first``."""
    digest = "sha1:" + _digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if first is None else head
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", _urn(name)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _address(uri)),
        ("WARC-Refers-To", None if first is None else _urn(first)),
        ("WARC-Profile", None if first is None else PROFILE),
        ("WARC-Block-Digest", "sha1:" + _digest(block)),
        ("WARC-Payload-Digest", digest),
        (PAGE, page),
        ("Content-Type", HTTP),
    ]
    return _record(fields, block)


def _store(folder: str):
    """The file system of a folder or file, and its path there."""
    from pyarrow import fs

    if folder.startswith(("/", "file:")):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", folder)
    return fs.FileSystem.from_uri(folder)


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0, archive: int = ARCHIVE) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives into ``folder``; returns their list: archive, n_records, n_bytes."""
    spark = pages.sparkSession
    folder = qualified(spark, folder or scratch_path(spark, "warc"))
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("uri"), html.alias("payload"))
    # A number tells equal rows apart. It is written with the rows, so that both uses below see the same one.
    rows = rows.withColumns({"row": F.monotonically_increasing_id(), "hash": F.sha2("payload", 256), "size": F.octet_length("payload")})
    rows = written(rows, "payloads")
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    equal = rows.where(F.col("size") >= least).groupBy("hash", "size").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))
    firsts = written(equal.where("n > 1").select(F.col("hash").alias("_h"), F.col("size").alias("_s"), F.col("first.row").alias("first")), "firsts")
    joined = rows.join(firsts, (F.col("hash") == F.col("_h")) & (F.col("size") == F.col("_s")), "left")
    names = [F.col(c).cast("string").alias(c) for c in ("row", "page_id")]  # pandas has no whole numbers with nulls
    first = F.when(F.col("first") != F.col("row"), F.col("first").cast("string")).alias("first")
    placed = joined.select(*names, "uri", "payload", first)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        out, done = None, []
        for frame in frames:
            for row, page, uri, payload, first in zip(*[frame[c] for c in frame.columns]):
                if out is None:
                    name, count = f"{path}/{uuid.uuid4().hex}.warc.gz", 0
                    member = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn(name)), ("WARC-Date", DATE), ("Content-Type", FIELDS)], ABOUT)
                    out, size = store.open_output_stream(name, compression=None), len(member)
                    out.write(member)
                member = page_record(row, page, uri, payload, first)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= archive:
                    out.close()
                    done.append((f"{folder}/{name.rsplit('/', 1)[1]}", count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name.rsplit('/', 1)[1]}", count, size))
        yield pd.DataFrame(done, columns=["archive", "n_records", "n_bytes"])

    return written(placed.mapInPandas(write, "archive string, n_records long, n_bytes long"), "archives")


class Member:
    """What one gzip member says, taken up as its bytes come."""

    def __init__(self, keep: bool):
        self.keep, self.head, self.fields, self.size, self.left = keep, b"", None, 0, 0
        self.block, self.payload, self.http = hashlib.sha1(), hashlib.sha1(), None
        self.n_payload, self.parts, self.tail, self.error = 0, [], b"", None

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0 and len(self.head) <= HEADER:
                return
            if end < 0:
                self.fields, self.error = {}, "the header does not end"
            else:
                self._header(self.head[:end].decode("utf-8", "replace"))
            data, self.head = self.head[end + 4 if end >= 0 else 0 :], b""
        block, rest = data[: self.left], data[self.left :]
        self.left -= len(block)
        if rest:
            self.tail = (self.tail + rest)[:5]
        if not block:
            return
        self.block.update(block)
        if self.http is not None:  # the payload follows the header of the transfer
            self.http += block
            end = self.http.find(b"\r\n\r\n")
            if end < 0 and len(self.http) <= HEADER:
                return
            block, self.http = self.http[end + 4 if end >= 0 else 0 :], None
        self.payload.update(block)
        self.n_payload += len(block)
        if self.keep:
            self.parts.append(block)

    def _header(self, text: str) -> None:
        version, *lines = text.split("\r\n")
        pairs = [line.partition(":") for line in lines]
        self.fields = {name.strip().lower(): value.strip(" \t") for name, _, value in pairs}
        length = self.fields.get("content-length", "")
        if not version.startswith("WARC/"):
            self.error = "no record starts here"
        elif not (length.isascii() and length.isdigit()):
            self.error = "no valid Content-Length"
        else:
            self.size = self.left = int(length)
        if self.fields.get("content-type", "").startswith("application/http"):
            self.http = b""

    def row(self, archive: str, position: int, whole: bool) -> tuple:
        """The record as a row of ``RECORD``; ``whole`` if the member came to its end."""
        fields = self.fields or {}
        kind, mine = fields.get("warc-type"), base64.b32encode(self.payload.digest()).decode()
        said = {k: fields.get(f"warc-{k}-digest") for k in ("block", "payload")}
        wrong = self.error or (None if whole else "the member is cut off or damaged")
        if not wrong and self.fields is None:
            wrong = "the header does not end"
        if not wrong and (self.left or self.tail != b"\r\n\r\n"):
            wrong = "the block is not as long as its Content-Length"
        if not wrong and said["block"] and said["block"] != "sha1:" + base64.b32encode(self.block.digest()).decode():
            wrong = "the block's digest differs"
        if not wrong and kind != "revisit" and said["payload"] and said["payload"] != "sha1:" + mine:
            wrong = "the payload's digest differs"
        page = fields.get(PAGE.lower())
        digest = said["payload"].removeprefix("sha1:") if said["payload"] else mine
        n, payload = (None, None) if kind == "revisit" else (self.n_payload, b"".join(self.parts) if self.keep else None)
        page = int(page) if page is not None and page.lstrip("-").isdigit() else None
        return archive, position, fields.get("warc-record-id"), kind, fields.get("warc-target-uri"), page, fields.get("warc-refers-to"), n, digest, payload, wrong


def _next_member(stream, data: bytes, at: int) -> tuple[bytes, int]:
    """Bytes from the next place on where a member may start, and that place; ``data`` is what was read already, from ``at`` on."""
    while (found := data.find(MEMBER)) < 0:
        end = data[-2:]
        at += len(data) - len(end)
        more = stream.read(CHUNK)
        if not more:
            return b"", at
        data = end + more
    return data[found:], at + found


def records(stream, archive: str, keep: bool) -> Iterator[tuple]:
    """The records of an open archive in their order, as rows of ``RECORD``; ``position`` is where the member starts."""
    data, at, searched = b"", 0, False  # bytes not used yet, and their place in the archive
    while data := data or stream.read(CHUNK):
        inflate, member, start = zlib.decompressobj(31), Member(keep), at
        try:
            while data and not inflate.eof:
                member.feed(inflate.decompress(data, CHUNK))
                left = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                at += len(data) - len(left)
                data = left or (b"" if inflate.eof else stream.read(CHUNK))
        except zlib.error:
            if not searched or member.fields is not None:  # a place found by search need not be a member
                yield member.row(archive, start, False)
            skip = int(at == start)
            data, at = _next_member(stream, data[skip:], at + skip)
            searched = True
            continue
        yield member.row(archive, start, inflate.eof)
        searched = False


def read_archives(archives: DataFrame, keep: bool = True) -> DataFrame:
    """All records of the listed archives (column ``archive``): columns of ``RECORD``. Without ``keep`` payloads stay unread in memory."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in RECORD.split(", ")]

        def frame(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "payload_bytes": "Int64"})

        for listed in frames:
            for archive in listed["archive"]:
                store, path = _store(archive)
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for row in records(stream, archive, keep):
                        rows.append(row)
                        size += len(row[9] or b"")
                        if len(rows) >= ROWS or size >= BYTES:
                            yield frame(rows)
                            rows, size = [], 0
                if rows:
                    yield frame(rows)

    spark = archives.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return archives.select("archive").repartition(parts, "archive").mapInPandas(read, RECORD)


def round_trip(pages: DataFrame, least: int = 0, archive: int = ARCHIVE) -> DataFrame:
    """Write the pages, read the archives back, and resolve revisits: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A record that cannot be read whole, or a revisit whose response is missing or has another digest, has its reason in ``error``.
    """
    archives = write_archives(pages, None, least, archive)
    read = read_archives(archives, keep=False).where("record_type IS DISTINCT FROM 'warcinfo' OR error IS NOT NULL").drop("payload")
    found = written(read, "records")
    asked = written(found.where("record_type = 'revisit'").select(F.col("refers_to_record").alias("_id")).distinct(), "asked")
    response = found.where("record_type = 'response'").join(asked, F.col("record_id") == F.col("_id"), "left_semi")
    response = written(response.select(F.col("record_id").alias("_id"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_n"), F.col("payload_digest").alias("_digest")), "responses")
    out = found.join(response, F.col("refers_to_record") == F.col("_id"), "left")
    revisit = F.col("record_type") == "revisit"
    unresolved = F.when(revisit & F.col("_id").isNull(), "the record it refers to is missing").when(
        revisit & (F.col("_digest") != F.col("payload_digest")), "the record it refers to has another digest"
    )
    return out.select(
        "page_id", F.coalesce("payload_bytes", "_n").alias("payload_bytes"), "payload_digest", "record_type",
        F.when(revisit, F.col("_page")).alias("refers_to"), F.coalesce("error", unresolved).alias("error"),
    )
