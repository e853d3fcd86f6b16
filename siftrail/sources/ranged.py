"""Sizes of images from the few bytes that tell them, read by ranges.

JPEG segments and TIFF directories are followed by seeks, so of a file of any length only some pages of 4 KB are
read. Files are opened where Arrow knows their store; elsewhere Spark reads them whole.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftrail.functions.session import importable

PAGE = 4096
FALLBACK = (1280, 720)


class Pages:
    """A file read in pages as they are asked for; ``read`` gives the bytes of a range, fewer at the end."""

    def __init__(self, read: Callable[[int, int], bytes], length: int) -> None:
        self._read, self.length, self.bytes_read = read, length, 0
        self._pages: dict[int, bytes] = {}

    def at(self, start: int, size: int) -> bytes:
        end = min(start + size, self.length)
        out = []
        for page in range(start // PAGE, -(-end // PAGE)):
            if page not in self._pages:
                self._pages[page] = self._read(page * PAGE, min(PAGE, self.length - page * PAGE))
                self.bytes_read += len(self._pages[page])
            out.append(self._pages[page])
        skip = start - start // PAGE * PAGE
        return b"".join(out)[skip : skip + max(0, end - start)]


def tiff_size(file: Pages) -> tuple[int, int] | None:
    """Width and height of the first page of a TIFF or BigTIFF file; its directory may stand anywhere."""
    head = file.at(0, 16)
    order = "<" if head[:2] == b"II" else ">"
    number = lambda kind, at: struct.unpack(order + kind, file.at(at, struct.calcsize(kind)))[0]
    try:
        big = number("H", 2) == 43
        at, wide = (number("Q", 8), 20) if big else (number("I", 4), 12)
        first, n = (at + 8, number("Q", at)) if big else (at + 2, number("H", at))
        found = {}
        for entry in range(first, min(first + n * wide, file.length), wide):
            tag, kind = number("H", entry), number("H", entry + 2)
            if tag in (256, 257) and kind in (3, 4, 16):
                found[tag] = number({3: "H", 4: "I", 16: "Q"}[kind], entry + (12 if big else 8))
            if tag > 257:  # entries stand in order of their tags
                break
    except struct.error:
        return None
    return (found[256], found[257]) if len(found) == 2 else None


def jpeg_size(file: Pages) -> tuple[int, int] | None:
    """From the first start-of-frame segment, behind whatever else."""
    at = 2
    while len(mark := file.at(at, 4)) == 4 and mark[0] == 0xFF:
        if mark[1] == 0xFF:  # a fill byte
            at += 1
            continue
        if 0xC0 <= mark[1] <= 0xCF and mark[1] not in (0xC4, 0xC8, 0xCC):
            body = file.at(at + 4, 5)
            return struct.unpack(">HH", body[1:5])[::-1] if len(body) == 5 else None
        at += 2 + struct.unpack(">H", mark[2:])[0]
    return None


def image_size(file: Pages) -> tuple[int, int] | None:
    """Width and height of a PNG, JPEG, BMP, WebP, TIFF or GIF file."""
    head = file.at(0, 32)
    if head[:8] == b"\x89PNG\r\n\x1a\n" and len(head) >= 24:
        return struct.unpack(">II", head[16:24])
    if head[:2] == b"BM" and len(head) >= 26:
        w, h = struct.unpack("<ii", head[18:26])
        return w, abs(h)
    if head[:3] == b"GIF" and len(head) >= 10:
        return struct.unpack("<HH", head[6:10])
    if head[:4] == b"RIFF" and head[8:16] == b"WEBPVP8 " and len(head) >= 30:
        w, h = struct.unpack("<HH", head[26:30])
        return w & 0x3FFF, h & 0x3FFF
    if head[:4] == b"RIFF" and head[8:16] == b"WEBPVP8L" and len(head) >= 25 and head[20] == 0x2F:
        bits = struct.unpack("<I", head[21:25])[0]
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if head[:4] == b"RIFF" and head[8:16] == b"WEBPVP8X" and len(head) >= 30:
        return int.from_bytes(head[24:27], "little") + 1, int.from_bytes(head[27:30], "little") + 1
    if head[:4] in (b"II*\0", b"MM\0*", b"II+\0", b"MM\0+"):
        return tiff_size(file)
    return jpeg_size(file) if head[:2] == b"\xff\xd8" else None


def opened(path: str | None) -> tuple[Pages, Callable[[], None]]:
    """A file's pages, and what closes it."""
    if path is None:
        raise OSError("no path")
    store, name = fs.FileSystem.from_uri(path.replace(" ", "%20") if ":/" in path else f"file://{path}")
    stream = store.open_input_file(name)

    def read(start: int, size: int) -> bytes:
        stream.seek(start)
        return stream.read(size)

    return Pages(read, stream.size()), stream.close


def reachable(folder: str) -> bool:
    """Whether Arrow knows the store of a folder."""
    try:
        fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")
    except (pa.ArrowInvalid, OSError):
        return False
    return True


def sizes(files: DataFrame, path: str = "path", content: str | None = None, tasks: int | None = None) -> DataFrame:
    """``files`` with width, height and bytes_read; images that cannot be read count as 1280 x 720.

    With ``content``, a column of whole files, these are read instead and left out. Paths are dealt to ``tasks`` tasks, as many as
    the session shuffles to if not given: a listing comes in few partitions, and each file costs a call to the store.
    """
    importable(files.sparkSession)
    kept = [c for c in files.columns if c != content]
    frame = files.select(*kept, *([content] if content else []))
    if content is None:
        frame = frame.repartition(*([tasks] if tasks else []), path)
    at = kept.index(path)

    def measure(where: str | None, data: bytes | None) -> tuple[int, int, int]:
        close = lambda: None
        try:
            if content:
                data = data or b""
                file = Pages(lambda start, size: data[start : start + size], len(data))
            else:
                file, close = opened(where)
            try:
                found = image_size(file)
            finally:
                close()
        except (OSError, pa.ArrowInvalid):  # the file has gone, or there is no path
            return (*FALLBACK, 0)
        known = found and 0 < found[0] < 1 << 31 and 0 < found[1] < 1 << 31
        return (*(found if known else FALLBACK), file.bytes_read)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(len(kept)).to_pylist() if content else [None] * batch.num_rows
            got = [measure(p, d) for p, d in zip(batch.column(at).to_pylist(), data, strict=True)]
            more = [pa.array([g[i] for g in got], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *more], names=[*kept, "width", "height", "bytes_read"])

    added = files.select(*kept, F.lit(0).alias("width"), F.lit(0).alias("height"), F.lit(0).cast("bigint").alias("bytes_read"))
    return frame.mapInArrow(run, added.schema)
