"""WARC archives: written as one gzip member for each record, read back by byte ranges.

A reading task is given a file and a range of bytes. It scans the range for the gzip magic, takes
a place for the start of a record only if what unpacks there is a WARC record with a right checksum and
length, and owns the records that start inside its range; the last one is read to its end, past the
range if need be. The first record of a range is believed if a few more follow it without a break; if
not, the records before it decide. What is damaged costs itself alone, and is given as a row of its own.

Archives of others are read as well: any record type and record id, digests in hex or base 32, several
records in a member, and files that are not packed (``.warc``), by their version lines.

Edge cases: null payloads are stored as empty ones. Payloads of fewer than ``least`` bytes are
always responses. Rows that repeat the smallest id of their payload are responses too; a row
without an id revisits the smallest id there is, or is a response if there is none. An empty table
gives an empty archive and no rows; an empty file has no records. Very large records are read in time
linear in their length, and one is held at a time. Columns besides the id and the payload are not kept.
An archive that lies unpacked within a record, more than four records long, can deceive a range that
begins within it; UTF-8 text cannot, as it never contains the gzip magic.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftrail.llm.common import col, map_batches, new_path, written

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGEST_BYTES = {"md5": 16, "sha1": 20, "sha256": 32, "sha512": 64}
PLAIN_MAGIC = b"WARC/"
WHEN = "2024-01-01T00:00:00Z"
NAME = "urn:page:"
CHUNK, HEAD_BYTES = 1 << 20, 1 << 20


def mark_revisits(pages: DataFrame, key: str, payload: str, least: int = 100) -> DataFrame:
    """Rows as (key, payload, digest, first): ``first`` is the id of the response a row revisits.

    Digests are grouped before anything is joined, so a payload that a third of the pages share
    costs one row; then only the ids of revisits meet the pages, by their own id.
    """
    data = F.coalesce(col(payload), F.lit(""))
    rows = pages.select(col(key).alias("key"), data.alias("payload"), F.sha2(data.cast("binary"), 256).alias("digest"))
    long = rows.where(F.octet_length("payload") >= least).select("key", "digest")
    firsts = long.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    seen = long.join(firsts.select("digest", "first"), "digest").where("NOT key <=> first")
    again = seen.select(F.col("key").alias("again"), F.col("digest").alias("same"), "first").distinct()
    return rows.join(again, F.expr("key <=> again AND digest = same"), "left").select("key", "payload", "digest", "first")


def record(key: int | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    head = [
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <{_name(key)}>",
        f"WARC-Date: {WHEN}",
        f"WARC-Target-URI: {_name(key)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if first is not None:
        head += [f"WARC-Refers-To: <{_name(first)}>", f"WARC-Profile: {SAME_PAYLOAD}"]
    return VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _name(key: int | None) -> str:
    return NAME + ("none" if key is None else str(key))


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(marked: DataFrame, where: str) -> DataFrame:
    """Write what ``mark_revisits`` gave; returns the archives as (path, length, records).

    A task writes under a name of its own and hands the name on when the file is closed, so
    files of tasks that were lost or run twice are never read. The list is a written table.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(where)
        files.create_dir(base, recursive=True)
        name, n, length = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
        with files.open_output_stream(name, compression=None) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    member = gzip_member(record(row["key"], row["payload"].encode(), row["digest"], row["first"]))
                    out.write(member)
                    length += len(member)
                    n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"path": [name], "length": [length], "records": [n]})
        else:
            files.delete_file(name)

    return written(map_batches(marked, run, "path string, length bigint, records bigint"), "warc-list")


class _Window:
    """A file's bytes, read forward and kept only as far back as they are needed."""

    def __init__(self, file: pa.NativeFile, start: int) -> None:
        self.file, self.start, self.data, self.ended = file, start, bytearray(), False
        file.seek(start)

    def more(self) -> bool:
        got = b"" if self.ended else self.file.read(CHUNK)
        self.ended = not got
        self.data += got
        return bool(got)

    def reaches(self, upto: int) -> bool:
        """Whether the file has the bytes before ``upto``; they are read if so."""
        while self.start + len(self.data) < upto:
            if not self.more():
                return False
        return True

    def piece(self, at: int, upto: int) -> bytes:
        return bytes(self.data[at - self.start : upto - self.start])

    def drop(self, upto: int) -> None:
        n = min(upto - self.start, len(self.data))
        del self.data[:n]
        self.start += n


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The gzip member that starts at ``at``, unpacked, and the place behind it; None if it is no intact WARC record.

    Its checksum and length hold, its header can be read and its block is as long as that says.
    """
    unpacker, out, pos, checked = zlib.decompressobj(31), bytearray(), at, False
    while not unpacker.eof:
        if not window.reaches(pos + 1):
            return None
        piece = window.piece(pos, pos + (CHUNK if checked else 4096))
        try:
            out += unpacker.decompress(piece)
        except zlib.error:
            return None
        if not checked and len(out) >= len(PLAIN_MAGIC):
            if not out.startswith(PLAIN_MAGIC):
                return None
            checked = True
        pos += len(piece) - len(unpacker.unused_data)
    return (bytes(out), pos) if next(records_of(out), None) else None


def _plain(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The same of a record that is not packed: two line ends or the end of the file must follow its block."""
    window.reaches(at + HEAD_BYTES)
    end = window.data.find(b"\r\n\r\n", at - window.start, at - window.start + HEAD_BYTES)
    length = _length(header(window.piece(at, window.start + end))) if end >= 0 else None
    if length is None:
        return None
    stop = window.start + end + 4 + length
    if not window.reaches(stop):
        return None
    window.reaches(stop + 4)
    tail = window.piece(stop, stop + 4)
    return (window.piece(at, stop), stop + len(tail)) if tail in (b"", b"\r\n\r\n") else None


def _next(window: _Window, at: int, plain: bool, limit: int | None = None) -> tuple[int, bytes, int] | None:
    """The next intact record at or behind ``at`` and before ``limit``: its place, bytes, and the place behind it."""
    magic, read = (PLAIN_MAGIC, _plain) if plain else (MAGIC, _member)
    while True:
        window.drop(at)
        place = window.data.find(magic, at - window.start)
        if place < 0:
            at = max(at, window.start + len(window.data) - len(magic) + 1)
            if limit is not None and at >= limit or not window.more():
                return None
            continue
        at = window.start + place
        if limit is not None and at >= limit:
            return None
        found = read(window, at)
        if found:
            return at, *found
        at += 1


def _leads_on(window: _Window, at: int, plain: bool, ahead: int = 4) -> bool:
    """Whether the bytes at ``at`` are the end of the file, or a few intact records one behind the other."""
    for _ in range(ahead):
        if not window.reaches(at + 1):
            return True
        found = (_plain if plain else _member)(window, at)
        if found is None:
            return False
        at = found[1]
    return True


def _first(file: pa.NativeFile, start: int, end: int, plain: bool) -> int | None:
    """The place of the first record of the archive itself that begins in [start, end).

    What looks like one may lie within another record, as those of a stored archive do, or stand right
    before damage: then nothing tells them apart but the records before. They are walked through from
    further and further back, from the file's beginning at worst.
    """
    if start == 0:
        return 0
    window = _Window(file, start)
    found = _next(window, start, plain, end)
    if found is None or _leads_on(window, found[2], plain):
        return found[0] if found else None
    back = max(end - start, CHUNK)
    while True:
        begin = max(0, start - back)
        window = _Window(file, begin)
        found = _next(window, begin, plain)
        if begin == 0 or found and _leads_on(window, found[2], plain):
            while found and found[0] < start:
                found = _next(window, found[2], plain)
            return found[0] if found and found[0] < end else None
        back *= 2


def read_range(file: pa.NativeFile, start: int, end: int, plain: bool = False) -> Iterator[tuple[int, int, bytes | None]]:
    """(place, place behind, bytes) of the records that start in [start, end) of a file, in order.

    Bytes that are no record are given too, as None, by the range that owns the record before them or
    by the first range.
    """
    at = _first(file, start, end, plain)
    if at is None:
        return
    window = _Window(file, at)
    while True:
        found = _next(window, at, plain)
        stop = found[0] if found else window.start + len(window.data)
        if stop > at:
            yield at, stop, None
        if found is None or stop >= end:
            return
        yield found[0], found[2], found[1]
        at = found[2]


def header(data: bytes | bytearray) -> dict[str, str]:
    """The fields of a record's header, with names in lower case; folded lines are joined."""
    fields: dict[str, str] = {}
    last = ""
    for line in bytes(data).decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if colon:
            last = name.strip().lower()
            fields[last] = value.strip()
    return fields


def _length(fields: dict[str, str]) -> int | None:
    value = fields.get("content-length", "")
    return int(value) if value.isascii() and value.isdigit() and "warc-type" in fields else None


def records_of(data: bytes | bytearray) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of the records in what one member holds; some writers put several into one."""
    at = 0
    while data.startswith(PLAIN_MAGIC, at):
        end = data.find(b"\r\n\r\n", at)
        fields = header(data[at:end]) if end >= 0 else {}
        length = _length(fields)
        if length is None or end + 4 + length > len(data):
            return
        at = end + 4 + length
        yield fields, bytes(data[end + 4 : at])
        while data[at : at + 2] == b"\r\n":
            at += 2


ROW = "record_id string, record_type string, target_uri string, date string, payload_bytes bigint, payload_digest string, refers_to string, payload binary, path string, start bigint, bytes bigint"


def read_archives(archives: DataFrame, split_bytes: int = 16 << 20, parallel: int | None = None) -> DataFrame:
    """The records of (path, length) archives, read in ranges of ``split_bytes``.

    ``start`` and ``bytes`` are the place and the stored length of a record. A stretch of bytes that is
    no intact record is a row with these and no record type. A payload is what follows the HTTP header of
    a response or request, and the block of any other record; revisits have none, and give the
    payload's length and digest as their headers have them.
    """
    spark = archives.sparkSession
    ranges = archives.where("length > 0").select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split_bytes).cast("bigint"))).alias("start"))
    parallel = parallel or max(spark.sparkContext.defaultParallelism * 4, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                files, base = _files(path)
                with files.open_input_file(base) as file:
                    held: list[tuple] = []
                    size = 0
                    for place, stop, data in read_range(file, start, start + split_bytes, base.endswith(".warc")):
                        where = (path, place, stop - place)
                        if data is None:
                            held.append((*[None] * 8, *where))
                            continue
                        for fields, block in records_of(data):
                            held.append((*_row(fields, block), *where))
                            size += len(block)
                        if len(held) >= 512 or size > 8 << 20:
                            yield _batch(held)
                            held, size = [], 0
                    if held:
                        yield _batch(held)

    return map_batches(ranges.repartition(parallel, "path", "start"), run, ROW)


def _files(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    kind = fields["warc-type"].lower()
    http, payload = b"", block
    if fields.get("content-type", "").lower().startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
    plain = [fields.get("warc-record-id", "").strip("<>") or None, kind, fields.get("warc-target-uri", "").strip("<>") or None, fields.get("warc-date")]
    if kind == "revisit":
        size = header(http).get("content-length", "")
        return *plain, int(size) if size.isascii() and size.isdigit() else None, _hex(fields.get("warc-payload-digest")), fields.get("warc-refers-to", "").strip("<>") or None, None
    return *plain, len(payload), hashlib.sha256(payload).hexdigest(), None, payload


def _hex(digest: str | None) -> str | None:
    """The bare hex form of a labelled digest, which archives write in hex or in base 32."""
    label, _, value = (digest or "").rpartition(":")
    size = DIGEST_BYTES.get(label.lower())
    if not value:
        return None
    if size and len(value) == -(-size * 8 // 5) or size and len(value.rstrip("=")) == -(-size * 8 // 5):
        try:
            value = value.rstrip("=").upper()
            return base64.b32decode(value + "=" * (-len(value) % 8)).hex()
        except ValueError:
            return None
    return value.lower()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[f.split(" ")[0] for f in ROW.split(", ")])


def round_trip(spark: SparkSession, pages: DataFrame, key: str = "page_id", payload: str = "html", least: int = 100, split_bytes: int = 16 << 20) -> DataFrame:
    """Archive every row in the shared folder and read the archives back, with ``key`` and ``refers_to`` as ids again."""
    where = new_path(spark, "warc")
    read = read_archives(write_archives(mark_revisits(pages, key, payload, least), where), split_bytes)
    ids = {name: F.regexp_extract(name, f"^{NAME}(-?[0-9]+)$", 1) for name in ("record_id", "refers_to")}
    ids = {name: F.when(x != "", x).cast("bigint") for name, x in ids.items()}
    return read.where("record_type IS NOT NULL").select(ids["record_id"].alias("key"), "record_type", "payload_bytes", "payload_digest", ids["refers_to"].alias("refers_to"), "payload")
