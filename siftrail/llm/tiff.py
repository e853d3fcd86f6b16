"""TIFF as a media column: one row for each page, and a lossless way to store bytes as pages.

The reader walks the chain of image directories, joins strips or tiles, undoes PackBits, LZW and
deflate and the horizontal predictor, and yields the samples of every page. It is written for
unsigned samples of 8 or 16 bits, in either byte order, chunky or planar.

Edge cases: null media give no page. A file that is no TIFF, is cut off, or whose directories run
in a circle gives the pages before the fault and then one row with ``error`` set. Empty payloads
are stored as 64 zero bytes. Repeated rows give repeated pages. Very long texts become several pages,
whose files are read one at a time. Other columns pass through; those named as an output are replaced.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siftrail.llm.common import add_columns, col, map_batches

# Fixed values of the format: tag numbers, field type sizes, compression schemes.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR = 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 317, 322, 323, 324, 325
FIELD_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
RAW, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773


class TiffError(ValueError):
    """The bytes are no TIFF that this reader understands."""


@dataclass
class Page:
    index: int
    width: int
    height: int
    bits: int
    samples: int
    compression: int
    predictor: int
    pixels: bytes


# Compression schemes.


def unpack_bits(data: bytes, expected: int) -> bytes:
    out, at = bytearray(), 0
    while at < len(data) and len(out) < expected:
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += 2 + n
        elif n > 128:
            out += data[at + 1 : at + 2] * (257 - n)
            at += 2
        else:
            at += 1
    return bytes(out)


def pack_bits(data: bytes) -> bytes:
    """Runs of three and more as repeats, all else as literals."""
    out, literal, at = bytearray(), bytearray(), 0

    def flush() -> None:
        for i in range(0, len(literal), 128):
            part = literal[i : i + 128]
            out.append(len(part) - 1)
            out.extend(part)
        literal.clear()

    while at < len(data):
        end = at + 1
        while end < len(data) and end - at < 128 and data[end] == data[at]:
            end += 1
        if end - at >= 3:
            flush()
            out += bytes((257 - (end - at), data[at]))
        else:
            literal += data[at:end]
        at = end
    flush()
    return bytes(out)


def lzw_decode(data: bytes, expected: int) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first, widened one code early."""
    table: list[bytes] = []
    out, held, n_held, width, before = bytearray(), 0, 0, 9, b""
    for byte in data:
        held, n_held = held << 8 | byte, n_held + 8
        if n_held < width:
            continue
        n_held -= width
        code = held >> n_held
        held &= (1 << n_held) - 1
        if code == 257 or len(out) >= expected:
            break
        if code == 256:
            table = [bytes((i,)) for i in range(256)] + [b"", b""]
            width, before = 9, b""
            continue
        if not table:
            raise TiffError("LZW data must begin with a clear code")
        if code < len(table):
            entry = table[code]
        elif code == len(table) and before:
            entry = before + before[:1]
        else:
            raise TiffError("LZW code out of range")
        out += entry
        if before:
            table.append(before + entry[:1])
        before = entry
        width = max(9, min(12, (len(table) + 1).bit_length()))
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    out, held, n_held, width = bytearray(), 0, 0, 9

    def put(code: int) -> None:
        nonlocal held, n_held
        held, n_held = held << width | code, n_held + width
        while n_held >= 8:
            n_held -= 8
            out.append(held >> n_held)
            held &= (1 << n_held) - 1

    table = {bytes((i,)): i for i in range(256)}
    put(256)
    size, word = 258, b""
    for byte in data:
        longer = word + bytes((byte,))
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = size
        size += 1
        width = max(9, size.bit_length())
        word = longer[-1:]
        if size == 4094:
            put(256)
            table, size, width = {bytes((i,)): i for i in range(256)}, 258, 9
    if word:
        put(table[word])
        size += 1
        width = min(12, max(9, size.bit_length()))
    put(257)
    if n_held:
        out.append(held << (8 - n_held) & 255)
    return bytes(out)


def _unpacked(data: bytes, scheme: int, expected: int) -> bytes:
    if scheme == RAW:
        got = data
    elif scheme == PACKBITS:
        got = unpack_bits(data, expected)
    elif scheme == LZW:
        got = lzw_decode(data, expected)
    elif scheme in (DEFLATE, OLD_DEFLATE):
        try:
            got = zlib.decompressobj().decompress(data, expected)
        except zlib.error as e:
            raise TiffError(f"deflate: {e}") from None
    else:
        raise TiffError(f"compression {scheme} is not read here")
    if len(got) < expected:
        raise TiffError("a strip or tile is too short")
    return got[:expected]


def _packed(data: bytes, scheme: int) -> bytes:
    return {RAW: bytes, PACKBITS: pack_bits, LZW: lzw_encode, DEFLATE: lambda x: zlib.compress(x, 6)}[scheme](data)


# The reader.


def read_pages(media: bytes) -> Iterator[Page]:
    """The pages of one file, in the order of its directories."""
    if media[:4] not in (b"II*\0", b"MM\0*"):
        raise TiffError("no TIFF header")
    order = "<" if media[:1] == b"I" else ">"

    def number(kind: str, at: int) -> int:
        try:
            return struct.unpack_from(order + kind, media, at)[0]
        except struct.error:
            raise TiffError("the file is cut off") from None

    def directory(at: int) -> tuple[dict[int, list[int]], int]:
        tags = {}
        n = number("H", at)
        for i in range(n):
            entry = at + 2 + 12 * i
            tag, kind, count = number("H", entry), number("H", entry + 2), number("I", entry + 4)
            letter = {1: "B", 3: "H", 4: "I"}.get(kind)
            if letter is None:
                continue
            where = entry + 8 if FIELD_BYTES[kind] * count <= 4 else number("I", entry + 8)
            try:
                tags[tag] = list(struct.unpack_from(f"{order}{count}{letter}", media, where))
            except struct.error:
                raise TiffError("the file is cut off") from None
        return tags, number("I", at + 2 + 12 * n)

    seen, at, index = set(), number("I", 4), 0
    if not at:
        raise TiffError("a file without a page")
    while at:
        if at in seen:
            raise TiffError("the directories run in a circle")
        seen.add(at)
        tags, at = directory(at)
        yield _page(media, order, index, tags)
        index += 1


def _page(media: bytes, order: str, index: int, tags: dict[int, list[int]]) -> Page:
    one = lambda tag, default=None: (tags.get(tag) or [default])[0]
    width, height, samples = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
    bits, scheme, predictor = one(BITS, 1), one(COMPRESSION, RAW), one(PREDICTOR, 1)
    if not width or not height:
        raise TiffError("a page has no size")
    if bits not in (8, 16) or set(tags[BITS]) != {bits} or predictor not in (1, 2):
        raise TiffError("only samples of 8 or 16 bits are read here")
    planes, per = (samples, 1) if one(PLANAR, 1) == 2 else (1, samples)
    kind = np.dtype(f"{order}u{bits // 8}")
    if TILE_OFFSETS in tags:
        wide, tall, offsets, counts = one(TILE_WIDTH), one(TILE_HEIGHT), tags[TILE_OFFSETS], tags.get(TILE_COUNTS)
    else:
        wide, tall, offsets, counts = width, min(height, one(ROWS_PER_STRIP, height)), tags.get(STRIP_OFFSETS), tags.get(STRIP_COUNTS)
    if not offsets or not counts or not wide or not tall:
        raise TiffError("a page has no strips or tiles")
    across, down = -(-width // wide), -(-height // tall)
    if len(offsets) < planes * across * down or len(counts) < len(offsets):
        raise TiffError("strips or tiles are missing")
    pixels = np.zeros((planes, height, width, per), kind)
    for k in range(planes * across * down):
        plane, place = divmod(k, across * down)
        row, left = place // across * tall, place % across * wide
        rows = tall if TILE_OFFSETS in tags else min(tall, height - row)
        data = media[offsets[k] : offsets[k] + counts[k]]
        block = np.frombuffer(_unpacked(data, scheme, rows * wide * per * bits // 8), kind).reshape(rows, wide, per)
        if predictor == 2:
            native = kind.newbyteorder("=")
            block = np.add.accumulate(block.astype(native), axis=1, dtype=native)
        pixels[plane, row : row + rows, left : left + wide] = block[: height - row, : width - left]
    flat = pixels.transpose(1, 2, 0, 3) if planes > 1 else pixels
    return Page(index, width, height, bits, samples, scheme, predictor, flat.astype(kind.newbyteorder("<")).tobytes())


# The writer: rows of single 8-bit samples.


def write_pages(payload: bytes, width: int = 64, page_rows: int = 4096, compression: int = DEFLATE, predictor: int = 2, tile: int = 0, strip_rows: int = 1024) -> bytes:
    """``payload``, a multiple of ``width`` long, as a file of pages of at most ``page_rows`` rows.

    With ``tile``, a multiple of 16, pages are cut into square tiles of that side.
    """
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for top in range(0, len(rows), page_rows):
        page = rows[top : top + page_rows]
        blocks = []
        if tile:
            for r in range(0, len(page), tile):
                for c in range(0, width, tile):
                    block = np.zeros((tile, tile), np.uint8)
                    part = page[r : r + tile, c : c + tile]
                    block[: part.shape[0], : part.shape[1]] = part
                    blocks.append(block)
        else:
            blocks = [page[r : r + strip_rows] for r in range(0, len(page), strip_rows)]
        places, sizes = [], []
        for block in blocks:
            if predictor == 2:
                block = np.diff(block, axis=1, prepend=np.zeros((len(block), 1), np.uint8))
            data = _packed(block.tobytes(), compression)
            places.append(len(out))
            sizes.append(len(data))
            out += data + b"\0" * (len(data) % 2)
        fields = [(WIDTH, [width]), (HEIGHT, [len(page)]), (BITS, [8]), (COMPRESSION, [compression]), (PHOTOMETRIC, [1]), (SAMPLES, [1]), (PREDICTOR, [predictor])]
        fields += [(TILE_WIDTH, [tile]), (TILE_HEIGHT, [tile]), (TILE_OFFSETS, places), (TILE_COUNTS, sizes)] if tile else [(STRIP_OFFSETS, places), (ROWS_PER_STRIP, [strip_rows]), (STRIP_COUNTS, sizes)]
        entries = bytearray()
        for tag, values in sorted(fields):
            if len(values) == 1:
                entries += struct.pack("<HHII", tag, 4, 1, values[0])
            else:
                entries += struct.pack("<HHII", tag, 4, len(values), len(out))
                out += struct.pack(f"<{len(values)}I", *values)
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(fields)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def padded(raw: bytes, unit: int = 64) -> bytes:
    """``raw`` with bytes 0 up to a positive multiple of ``unit``."""
    return raw + b"\0" * (-len(raw) % unit or (0 if raw else unit))


def store(raw: bytes) -> bytes:
    """The file in which a text's bytes are kept; tiles follow from their number, the codec from a hash of them."""
    payload = padded(raw)
    codec = (PACKBITS, LZW, DEFLATE)[zlib.crc32(payload) % 3]
    return write_pages(payload, compression=codec, predictor=1 if codec == PACKBITS else 2, tile=64 if len(payload) > 32_768 else 0)


def feature(samples: np.ndarray) -> str:
    """Mean, entropy and a hash of which of 64 equal parts are brighter than the mean."""
    counts = np.bincount(samples, minlength=256) / len(samples)
    entropy = float(-(counts[counts > 0] * np.log2(counts[counts > 0])).sum())
    edges = np.linspace(0, len(samples), 65).astype(np.int64)[:-1]
    parts = np.add.reduceat(samples.astype(np.int64), edges) / np.diff([*edges, len(samples)])
    bright = np.packbits(parts > samples.mean()).tobytes().hex()
    return f"mean={samples.mean():.4f};entropy={entropy:.4f};parts={bright}"


def digest(text: str | None) -> tuple[int, int, str, int, int, str, str]:
    """Store a text, read every page back and describe what was read."""
    raw = (text or "").encode("utf-8")
    media = store(raw)
    payload = b"".join(p.pixels for p in read_pages(media))
    return len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature(np.frombuffer(payload, np.uint8))


def media_digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with the lengths, digests and feature of its text stored as TIFF."""
    names = [("n_bytes", "bigint"), ("payload_bytes", "bigint"), ("payload_sha256", "string"), ("tail_crc32", "bigint"), ("media_bytes", "bigint"), ("media_sha256", "string"), ("feature", "string")]
    return add_columns(docs, text, lambda: digest, names)


def media_column(docs: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """Every row with its text stored as a TIFF file in a binary column."""
    return add_columns(docs, text, lambda: lambda t: (store((t or "").encode("utf-8")),), [(media, "binary")])


def pages(df: DataFrame, media: str = "media", keys: list[str] | None = None) -> DataFrame:
    """One row for each page of each file, with the ``keys`` of the file's row."""
    keys = [c for c in df.columns if c != media] if keys is None else keys
    frame = df.select(*[col(c) for c in keys], col(media)).toDF(*[f"c{i}" for i in range(len(keys))], "m")
    schema = T.StructType(frame.schema.fields[:-1] + T._parse_datatype_string("page int, width int, height int, bits int, samples int, compression int, predictor int, pixels binary, error string").fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(schema)
        for batch in batches:
            for row in range(batch.num_rows):
                rest = [c[row].as_py() for c in batch.columns]
                data = rest.pop()
                if data is None:
                    continue
                n = 0
                try:
                    for p in read_pages(data):
                        n = p.index + 1
                        yield _one(kind, [*rest, p.index, p.width, p.height, p.bits, p.samples, p.compression, p.predictor, p.pixels, None])
                except (TiffError, ValueError, IndexError, KeyError, TypeError, OverflowError, MemoryError, struct.error, zlib.error) as e:
                    yield _one(kind, [*rest, n, *[None] * 7, str(e) or type(e).__name__])

    return map_batches(frame, run, schema, 16).toDF(*keys, *schema.names[len(keys) :])


def _one(kind: pa.Schema, values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, kind, strict=True)], schema=kind)
