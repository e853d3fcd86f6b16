"""TIFF, WARC, HTML and URL lists: edge cases, round trips and brute force."""

from __future__ import annotations

import base64
import dataclasses
import datetime
import gzip
import hashlib
import html
import io
import itertools
import math
import os
import random
import re
import struct
import time
import zlib
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from siftrail.llm import html_text, queries, tiff, url_filters, warc
from siftrail.llm.labelled import PAGES

# TIFF.


@pytest.mark.parametrize("compression", [tiff.RAW, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("tile", [0, 16, 64])
@pytest.mark.parametrize("predictor", [1, 2])
def test_pages_hold_what_was_stored(compression, tile, predictor):
    rng = random.Random(compression + tile)
    for raw in (b"", b"x", os.urandom(700), bytes(5000), bytes(rng.choice(b"abc ") for _ in range(9001))):
        payload = tiff.padded(raw)
        media = tiff.write_pages(payload, compression=compression, predictor=predictor, tile=tile, page_rows=37, strip_rows=5)
        pages = list(tiff.read_pages(media))
        assert b"".join(p.pixels for p in pages) == payload
        assert [p.index for p in pages] == list(range(-(-len(payload) // (37 * 64))))


def test_lzw_over_many_codes():
    rng = random.Random(0)
    for n in (1, 254, 255, 256, 511, 3837, 3838, 3839, 20_000):
        data = bytes(rng.choice(b"ab" if n % 2 else b"abcdefghijkl") for _ in range(n))
        assert tiff.lzw_decode(tiff.lzw_encode(data), n) == data


def test_pack_bits_of_the_published_example():
    packed = bytes.fromhex("feaa028000 2afdaa0380002a22f7aa".replace(" ", ""))
    assert tiff.unpack_bits(packed, 24) == bytes.fromhex("aaaaaa80002aaaaaaaaa80002a22aaaaaaaaaaaaaaaaaaaa")


def big_endian(planar):
    """A 3 x 2 image of three 16-bit samples with predictor, most significant byte first."""
    samples = [[[r * 100 + c * 1000 + s * 7 for s in range(3)] for c in range(3)] for r in range(2)]
    blocks = []
    for plane in range(3) if planar else [None]:
        out = b""
        for row in samples:
            cells = [[c[plane]] if planar else c for c in row]
            before = [0] * len(cells[0])
            for c in cells:
                out += b"".join(struct.pack(">H", (v - b) % 65536) for v, b in zip(c, before, strict=True))
                before = c
        blocks.append(zlib.compress(out))
    body, places = b"MM\0*\0\0\0\0", []
    for b in blocks:
        places.append(len(body))
        body += b
    n = len(blocks)

    def array(values):
        nonlocal body
        at = len(body)
        body += struct.pack(f">{len(values)}I", *values)
        return at

    bits = len(body)
    body += struct.pack(">3H", 16, 16, 16)
    where, sizes = (places[0], len(blocks[0])) if n == 1 else (array(places), array([len(b) for b in blocks]))
    tags = [(256, 4, 1, 3), (257, 4, 1, 2), (258, 3, 3, bits), (259, 4, 1, 8), (262, 4, 1, 2), (273, 4, n, where), (277, 4, 1, 3), (278, 4, 1, 2), (279, 4, n, sizes), (284, 4, 1, 2 if planar else 1), (317, 4, 1, 2)]
    ifd = struct.pack(">H", len(tags)) + b"".join(struct.pack(">HHII", *t) for t in tags) + b"\0\0\0\0"
    return body[:4] + struct.pack(">I", len(body)) + body[8:] + ifd, struct.pack("<18H", *[v for row in samples for c in row for v in c])


@pytest.mark.parametrize("planar", [False, True])
def test_other_byte_order_and_planes(planar):
    media, pixels = big_endian(planar)
    (page,) = tiff.read_pages(media)
    assert page.pixels == pixels and (page.samples, page.bits) == (3, 16)


def test_pages_of_odd_files(spark):
    good = tiff.write_pages(bytes(64 * 10), page_rows=4)
    circle = bytearray(good)
    (first,) = struct.unpack_from("<I", good, 4)
    end = first + 2 + 12 * struct.unpack_from("<H", good, first)[0]
    struct.pack_into("<I", circle, end, first)
    rows = [(1, good), (2, None), (3, b"GIF89a"), (4, good[:60]), (5, bytes(circle)), (None, good), (1, good), (6, b"")]
    df = spark.createDataFrame(rows, "doc_id long, media binary").withColumn("page", F.lit("old"))
    out = tiff.pages(df, keys=["doc_id"]).collect()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append((r["page"], r["height"], r["error"] is None))
    assert by[1] == [(0, 4, True), (1, 4, True), (2, 2, True)] * 2 and by[None] == by[1][:3]
    assert 2 not in by and by[3] == [(0, None, False)] == by[6] and not by[4][-1][2] and [x[2] for x in by[5]] == [True, False]
    assert tiff.pages(df.limit(0)).count() == 0


def test_media_of_texts(spark):
    texts = [None, "", "a", "é" * 40, "x" * 600, "word " * 3000, "z" * 500_000, "a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("feature", F.lit("old"))
    got = tiff.media_digests(df).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert tuple(got[2])[2:] == tuple(got[7])[2:] and got[0]["media_sha256"] == got[1]["media_sha256"]
    stored = tiff.media_column(df.drop("feature")).orderBy("doc_id").collect()
    assert [hashlib.sha256(r["media"]).hexdigest() for r in stored] == [r["media_sha256"] for r in got]


@pytest.mark.parametrize("size", [20, 700, 5000, 60_000])
def test_every_codec_meets_texts_of_every_size(size):
    rng = random.Random(size)
    met = set()
    for _ in range(25):
        raw = bytes(rng.choice(b"some words ") for _ in range(size))
        pages = list(tiff.read_pages(tiff.store(raw)))
        assert b"".join(p.pixels for p in pages) == tiff.padded(raw)
        met |= {p.compression for p in pages}
    assert met == {tiff.PACKBITS, tiff.LZW, tiff.DEFLATE}


def test_malformed_files_give_error_rows(spark):
    rng = random.Random(11)
    good = tiff.write_pages(bytes(range(256)) * 4, compression=tiff.LZW)
    files = [good[:n] for n in range(0, len(good), 7)]
    for _ in range(300):
        hurt = bytearray(good)
        for _ in range(rng.choice([1, 2, 8])):
            hurt[rng.randrange(4, len(hurt))] = rng.choice([0, 1, 255, rng.randrange(256)])
        files.append(bytes(hurt))
    for tag in (tiff.WIDTH, tiff.HEIGHT, tiff.ROWS_PER_STRIP, tiff.STRIP_COUNTS, tiff.BITS):
        for value in ((1, 4_000_000_000), (0, 0), (4_000_000_000, 8), (1, 0)):
            at = good.index(struct.pack("<HH", tag, 4))
            files.append(good[: at + 4] + struct.pack("<II", *value) + good[at + 12 :])
    df = spark.createDataFrame(list(enumerate(files)), "k long, media binary")
    rows = tiff.pages(df).collect()
    assert {r["k"] for r in rows} == set(range(len(files))) and sum(r["error"] is not None for r in rows) > 100
    assert all((r["pixels"] is None) == (r["error"] is not None) for r in rows)


def test_lzw_of_other_writers():
    """Codes laid out by hand: clear, three letters, the pair made of the first two, one made just now, end."""
    codes = [256, 65, 66, 65, 258, 261, 257]
    bits = "".join(f"{c:09b}" for c in codes)
    data = int(bits.ljust(64, "0"), 2).to_bytes(8, "big")
    assert tiff.lzw_decode(data, 100) == b"ABA" + b"AB" + b"ABA"


def test_media_query_by_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op6_tiff_media(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for k, t in texts.items():
        raw = t.encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        r = got[k]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        mean = sum(payload) / len(payload)
        entropy = -sum(c / len(payload) * math.log2(c / len(payload)) for c in Counter(payload).values())
        edges = [i * len(payload) // 64 for i in range(65)]
        parts = [sum(payload[a:b]) / (b - a) for a, b in itertools.pairwise(edges)]
        bright = bytes(sum((parts[8 * i + j] > mean) << (7 - j) for j in range(8)) for i in range(8)).hex()
        found = re.fullmatch(r"mean=(.*);entropy=(.*);parts=(.*)", r["feature"])
        assert float(found[1]) == pytest.approx(mean, abs=1e-4) and float(found[2]) == pytest.approx(entropy, abs=1e-4) and found[3] == bright


# WARC.


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, html string").withColumn("digest", F.lit(1)).withColumn("key", F.lit(2))


def test_round_trip(spark):
    long, other = "x" * 100, "ÿ" * 60_000
    rows = [(5, long), (3, long), (9, long), (1, None), (2, ""), (4, "short"), (6, "short"), (None, long), (7, other), (3, long), (8, "y" * 99), (10, "y" * 99)]
    got = warc.round_trip(spark, pages_of(spark, rows), split_bytes=50).collect()
    assert len(got) == len(rows)
    for r in got:
        html = next(h or "" for k, h in rows if k == r["key"]).encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html), hashlib.sha256(html).hexdigest())
        if r["record_type"] == "response":
            assert r["payload"] == html and r["refers_to"] is None
    assert sorted(((r["key"], r["record_type"], r["refers_to"]) for r in got if r["key"] in (3, 5, 9, None)), key=repr) == sorted([(3, "response", None), (3, "response", None), (5, "revisit", 3), (9, "revisit", 3), (None, "revisit", 3)], key=repr)
    assert all(r["record_type"] == "response" for r in got if r["key"] in (1, 2, 4, 6, 7, 8, 10))
    assert warc.round_trip(spark, pages_of(spark, [])).count() == 0
    assert [r["record_type"] for r in warc.round_trip(spark, pages_of(spark, [(None, long), (None, long)])).collect()] == ["response"] * 2


def test_ranges_own_what_starts_inside(tmp_path):
    inner = warc.gzip_member(warc.record(77, b"inner", "d", None))
    members = []
    for i in range(30):
        body = inner * 2 + os.urandom(50) if i % 3 == 0 else b"\x1f\x8b\x08 no member " * i
        members.append(warc.gzip_member(warc.record(i, body, "d", None), level=0 if i % 3 == 0 else 6))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"junk" + b"".join(members))
    size = path.stat().st_size
    for step in (1, 97, 1000, size):
        keys = []
        with fs.LocalFileSystem().open_input_file(str(path)) as f:
            for start in range(0, size, step) if step > 1 else [0]:
                keys += keys_in(warc.read_range(f, start, start + step if step > 1 else size))
        assert keys == list(range(30)), step
    with gzip.open(io.BytesIO(b"".join(members))) as g:  # any gzip reader can read the whole
        assert g.read().count(b"WARC/1.1") >= 30


def keys_in(found):
    return [int(fields["warc-record-id"].strip("<>").split(":")[-1]) for _, _, data in found if data for fields, _ in warc.records_of(data)]


@pytest.mark.parametrize("step", [150, 1 << 20])
def test_damage_costs_the_damaged_record_alone(tmp_path, step):
    good = [warc.gzip_member(warc.record(i, bytes([65 + i]) * 300, "d", None)) for i in range(5)]
    path, size = tmp_path / "b.warc.gz", sum(map(len, good))
    for at in range(len(good[2])):
        hurt = bytearray(good[2])
        hurt[at] ^= 255
        path.write_bytes(b"".join([*good[:2], bytes(hurt), *good[3:]]))
        keys, lost = [], 0
        with fs.LocalFileSystem().open_input_file(str(path)) as f:
            for start in range(0, size, step):
                found = list(warc.read_range(f, start, start + step))
                keys += keys_in(found)
                lost += sum(stop - place for place, stop, data in found if data is None)
        if keys != list(range(5)):  # a few header bytes, as the time, mean nothing
            assert (keys, lost) == ([0, 1, 3, 4], len(good[2])), at
        else:
            assert at in (4, 5, 6, 7, 8, 9) and lost == 0


@pytest.mark.parametrize("step", [200, 1 << 20])
def test_junk_around_records(spark, tmp_path, step):
    good = [warc.gzip_member(warc.record(i, b"p" * 300, "d", None)) for i in range(4)]
    path = tmp_path / "c.warc.gz"
    path.write_bytes(b"head" + good[0] + b"\x1f\x8b\x08 junk" + good[1] + good[2] + good[3] + b"tail" * 200)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    listed = spark.createDataFrame([(f"file://{path}", path.stat().st_size), (str(tmp_path / "empty.warc.gz"), 0)], "path string, length long")
    rows = warc.read_archives(listed, step).collect()
    assert sorted(r["record_id"] for r in rows if r["record_type"]) == [f"urn:page:{i}" for i in range(4)]
    assert sum(r["bytes"] for r in rows if not r["record_type"]) == 4 + 8 + 800 and sum(r["bytes"] for r in rows) == path.stat().st_size


def foreign(kind, block, *more):
    head = [f"WARC-Type: {kind}", *more, f"Content-Length: {len(block)}"]
    return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


FOREIGN = [
    foreign("warcinfo", b"software: x\r\n", "WARC-Record-ID: <urn:uuid:1>", "Content-Type: application/warc-fields"),
    foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "WARC-Record-ID: <urn:uuid:2>", "Content-Type: application/http;msgtype=request", "WARC-Target-URI: http://a/"),
    foreign("response", b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n" + b"\xff\x1f\x8b\x08 body\r\n\r\n" * 9, "warc-record-id: <urn:uuid:3>", "Content-Type: application/http; msgtype=response", "WARC-Target-URI: <http://a/>", "X-Long: one", " two"),
    foreign("revisit", b"HTTP/1.1 200 OK\r\n\r\n", "WARC-Record-ID: <urn:uuid:4>", "Content-Type: application/http", "WARC-Payload-Digest: sha1:3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ", "WARC-Refers-To: <urn:uuid:3>"),
    foreign("metadata", b"", "WARC-Record-ID: <urn:uuid:5>"),
    foreign("resource", b"WARC/1.0\r\nno record", "WARC-Record-ID: <urn:uuid:6>"),
]


@pytest.mark.parametrize("name", ["a.warc", "a.warc.gz", "b.warc.gz"])
@pytest.mark.parametrize("step", [300, 1 << 20])
def test_archives_of_others(spark, tmp_path, name, step):
    path = tmp_path / name
    if name == "b.warc.gz":  # one member for all
        path.write_bytes(gzip.compress(b"".join(FOREIGN)))
    else:
        path.write_bytes(b"".join(FOREIGN if name == "a.warc" else map(gzip.compress, FOREIGN)))
    listed = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, length long")
    rows = sorted(warc.read_archives(listed, step).collect(), key=lambda r: r["record_id"])
    assert [(r["record_id"][-1], r["record_type"]) for r in rows] == list(zip("123456", ["warcinfo", "request", "response", "revisit", "metadata", "resource"], strict=True))
    assert [r["target_uri"] for r in rows] == [None, "http://a/", "http://a/", None, None, None]
    assert rows[2]["payload"] == b"\xff\x1f\x8b\x08 body\r\n\r\n" * 9 and rows[0]["payload"] == b"software: x\r\n" and rows[4]["payload"] == b""
    assert rows[3]["payload_digest"] == base64.b32decode("3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ").hex() and rows[3]["refers_to"] == "urn:uuid:3" and rows[3]["payload_bytes"] is None


def test_large_records_take_linear_time(tmp_path):
    path = tmp_path / "d.warc.gz"
    path.write_bytes(warc.gzip_member(warc.record(1, os.urandom(100 << 20), "d", None), level=0) + warc.gzip_member(warc.record(2, b"x", "d", None)))
    before = time.process_time()
    with fs.LocalFileSystem().open_input_file(str(path)) as f:
        assert keys_in(warc.read_range(f, 0, 1 << 40)) == [1, 2]
    assert time.process_time() - before < 10


# HTML.


CASES = [
    (None, ""),
    ("", ""),
    ("<div></div>", ""),
    ("plain  text\n only", "plain text only"),
    ("<p>a &lt;i&gt; &amp;amp; b&nbsp;c", "a <i> &amp; b c"),
    ('<nav><ul><li><a href="/x">Menu</a></li></ul></nav><article><h1>Head</h1><p>One <b>two<br>three.<p>Four</article><footer>Foot words here</footer>', "Head\n\nOne two three.\n\nFour"),
    ('<article><p>x</p><script>var a="</p>";</script><style>p{}</style><div class="ad">buy <p>now</p></div><p>y</p><form><input>send</form></article><section class="comments"><p>First of many long reader comments</p></section>', "x\n\ny"),
    ('<div class="sidebar"><p>many many words of the side bar</p></div><div class="post"><h2>Hi</h2><p>there</p></div><div id="cookie-notice">we use cookies and more</div>', "Hi\n\nthere"),
    ("<main><p>In</main><div>outside of the main part, at some length, still not wanted</div>", "In"),
    ("<article><p>a<!-- <p>gone</p> --> b</p><p hidden>secret</p></article>", "a b"),
    ("<article>a<", "a<"),
    ('<main class="has-sidebar"><p>kept</p></main>', "kept"),
    ('<article><p>kept</p><article id="comment-7" class="comment reply odd"><p>a reader says so</p></article></article>', "kept"),
    ('<div class="content with-sidebar"><p>kept</p></div>', "kept"),
    ("<article><p>x</p><!-- never closed <p>y</p>", "x"),
    ("<head><title>T</title></head><body><article>body text</article></body>", "body text"),
]


@pytest.mark.parametrize(("page", "want"), CASES)
def test_main_text(page, want):
    assert html_text.main_text(page, html_text.fitted()) == want


POST = "the post itself goes on for many words " * 5


@pytest.mark.parametrize("page", [
    f'<div class="post"><p>{POST}</p></div><article class="comment"><p>a reader says so</p></article>',
    f"<!-- <article> --><div class='post'><p>{POST}</p></div>",
    f"<script>var a = '<main >';</script><div class='post'><p>{POST}</p></div>",
    f"<main id='app'></main><div class='post'><p>{POST}</p></div>",
    f"<div class='post'><p>{POST}</p></div><footer><article><p>Read this too</p></article></footer>",
])
def test_an_article_elsewhere_does_not_hide_the_text(page):
    assert html_text.main_text(page, html_text.fitted()) == POST.strip()


def test_a_teaser_does_not_hide_the_text():
    page = f"<div class='post'><p>{POST}</p></div><article class='card'><p>Other post</p></article>"
    assert html_text.main_text(page, html_text.fitted()).startswith(POST.strip())


@pytest.mark.parametrize(("page", "want"), [
    ('<article><p>One.</p><p title="a hidden gem">Two words.</p></article>', "One.\n\nTwo words."),
    ("<article><p>Let <math><mi>q</mi><mo>=</mo><mn>5</mn></math> be so.</p></article>", "Let q=5 be so."),
    (f"<article class='teaser'><p>Read this other story</p></article><div class='story'><p>{POST}</p></div>", POST.strip()),
    (f"<article><p>{POST}</p><blockquote class='banner'><p>A pulled quote.</p></blockquote><p>{POST}</p></article>", f"{POST.strip()}\n\nA pulled quote.\n\n{POST.strip()}"),
    (f"<article><p>{POST}</p></article><div>words between the two of them</div><article><p>{POST}</p></article>", f"{POST.strip()}\n\n{POST.strip()}"),
    (f"<main><p>{POST}</p></main><section class='comments'>" + "<div class='comment'><p>a reader says so at some length</p></div>" * 300 + "</section>", POST.strip()),
])
def test_pages_that_went_wrong_before(page, want):
    assert html_text.main_text(page, html_text.fitted()) == want


def parts_by_force(scores, gap):
    """The best sum over all runs and all stretches left out of them, by trying every choice."""
    best = 0.0
    for kept in itertools.product((0, 1), repeat=len(scores)):
        if any(kept):
            first, last = kept.index(1), len(kept) - 1 - kept[::-1].index(1)
            gaps = sum(1 for i in range(first, last) if kept[i] and not kept[i + 1])
            best = max(best, sum(s for s, k in zip(scores, kept, strict=True) if k) - gap * gaps)
    return best


@pytest.mark.parametrize("gap", [0.5, 2, 1e9])
def test_best_run(gap):
    rng = random.Random(5)
    for _ in range(150):
        scores = [rng.choice([-4, -3, -1, 1, 2]) for _ in range(rng.randrange(10))]
        parts = html_text.best_run(scores, gap)
        assert all(a < b <= c for (a, b), (c, _) in zip(parts, parts[1:], strict=False))
        assert sum(sum(scores[a:b]) for a, b in parts) - gap * max(0, len(parts) - 1) == parts_by_force(scores, gap)


def overlap(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return 2 * (a & b).total() / max(1, a.total() + b.total())


def gold(page):
    known = html_text.read_page(page)
    return "\n\n".join(" ".join("".join(known.parts[b]).split()) for b in sorted({t.block for t in known.texts() if t.gold}))


def test_labelled_pages_held_out_one_by_one():
    found = [overlap(html_text.main_text(page, html_text.fit(PAGES[:k] + PAGES[k + 1 :])), gold(page)) for k, page in enumerate(PAGES)]
    assert sum(found) / len(found) >= 0.95 and min(found) >= 0.8


def slow_article(page):
    """The article of a sample page, by its tags alone."""
    inside = re.sub(r"<br>", " ", re.search(r"<article>(.*)</article>", page, re.S)[1])
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
    return "\n\n".join(b for b in blocks if b)


def test_sample_pages_and_what_the_scan_does_for_them(sf_dir, monkeypatch):
    pages = [r["html"] for r in pq.read_table(f"{Path(sf_dir).parent}/sf0.01/pages.parquet", columns=["html"]).to_pylist()]
    want = [slow_article(p) for p in pages]
    assert [html_text.main_text(p, html_text.fitted()) for p in pages] == want
    plain = dataclasses.replace(html_text.fitted(), gap=float("inf"))
    assert [html_text.main_text(p, plain) for p in pages] == want  # one contiguous run is enough here
    monkeypatch.setattr(html_text, "best_run", lambda scores, gap=0.0: [(0, len(scores))])
    assert not any(html_text.main_text(p, html_text.fitted()) == w for p, w in zip(pages, want, strict=True))


def test_query_over_the_sample_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in queries.op9_html_text(spark, sf_dir).collect()}
    assert got == {r["page_id"]: (r["url"], slow_article(r["html"]), len(slow_article(r["html"]))) for r in pages}


def test_pages_keep_their_columns(spark):
    df = spark.createDataFrame([(i, f"u{i}", c[0]) for i, c in enumerate(CASES)] + [(None, None, "<p>" + "w " * 300_000)], "page_id long, url string, html string").withColumn("text", F.lit("old"))
    got = {r["page_id"]: r for r in html_text.extract(df).collect()}
    assert [got[i]["text"] for i in range(len(CASES))] == [c[1] for c in CASES]
    assert got[None]["n_chars"] == 599_999 and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_text.extract(df.limit(0)).count() == 0


# URL lists.


def active(url, when, entries):
    import re

    m = re.match(r"(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)[^/?#]*([^?#]*)", url or "")
    if not m or when is None:
        return []
    host, path = m[1].lower().rstrip("."), m[2]
    out = []
    for name, pattern in {(e[0].lower(), e[1].lower()) for e in entries if None not in e}:
        past = sorted(((at, action == "remove") for n, p, at, action in entries if n and p and at and action and (n.lower(), p.lower()) == (name, pattern) and at <= when), key=lambda e: e)
        covers = host == pattern or host.endswith("." + pattern) or ("/" in pattern and (host + path).startswith(pattern))
        if past and covers and not past[-1][1]:
            out.append((name, pattern))
    return out


def test_lists_over_time(spark):
    rng = random.Random(6)
    start = datetime.datetime(2024, 1, 1)
    moment = lambda: start + datetime.timedelta(hours=rng.randrange(0, 4000, 50))
    hosts = ["a.example.com", "b.example.com", "example.com", "other.org", "x.y.other.org"]
    patterns = [*hosts, "org", "example.com/p/", "a.example.com/p/q/"]
    entries = [(rng.choice(["spam", "Adult"]), rng.choice(patterns), moment(), rng.choice(["add", "remove"])) for _ in range(120)]
    entries += [(None, "org", start, "add"), ("spam", None, start, "add"), ("spam", "org", None, "add"), ("spam", "org", start, None), entries[0]]
    urls = [f"https://{h}{p}" for h in hosts for p in ("", "/", "/p/", "/p/q/r?x=/z/", "/p")] + [None, "", "no url", "http://user@A.EXAMPLE.COM.:80/P/", "http:///x"]
    rows = [(i, rng.choice(urls), rng.choice([None, *[moment() for _ in range(6)]])) for i in range(250)]
    rows += [rows[0], (None, "http://other.org/", start)]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched timestamp").withColumn("list", F.lit("old")).withColumn("host", F.lit("old"))
    log = spark.createDataFrame(entries, "list string, pattern string, at timestamp, action string")
    out = url_filters.judge(captures, log)
    assert out.columns == [*captures.columns, "blocked", "list_", "pattern", "since", "n_entries"]
    got = sorted(((r["page_id"], r["url"], r["blocked"], r["list_"], r["pattern"], r["n_entries"]) for r in out.collect()), key=repr)
    want = []
    for k, url, when in rows:
        hits = sorted(active(url, when, entries), key=lambda h: (-len(h[1]), h))
        want.append((k, url, bool(hits), *(hits[0] if hits else (None, None)), len(hits)))
    assert got == sorted(want, key=repr)
    assert url_filters.judge(captures, log.limit(0)).where("blocked").count() == 0
    assert url_filters.judge(captures.limit(0), log).count() == 0


def test_pages_prefixes_and_letter_case(spark):
    at = datetime.datetime(2024, 5, 1)
    patterns = ["H.com/Ads/", "h.com/one/Page.html", "h.com/pre", "g.com/low/"]
    log = spark.createDataFrame([("l", p, at, "add") for p in patterns], "list string, pattern string, at timestamp, action string")
    want = {"http://H.com/Ads/x": "h.com/Ads/", "http://h.com/ads/x": None, "http://h.com/one/Page.html?q": "h.com/one/Page.html", "http://h.com/one/page.html": None, "http://h.com/one/": None, "http://h.com/pre/x/y": "h.com/pre", "http://h.com/prefix.html": "h.com/pre", "http://h.com/pr": None, "http://g.com/Low/x": None}
    got = url_filters.judge(spark.createDataFrame([(u, at) for u in want], "url string, fetched timestamp"), log).collect()
    assert {r["url"]: r["pattern"] for r in got} == want


def test_one_month_and_one_domain_hold_all_captures(spark):
    at = datetime.datetime(2024, 5, 1)
    captures = spark.range(20_000).selectExpr("id AS page_id", "concat('http://a', id % 7, '.example.com/p', id) AS url").withColumn("fetched", F.lit(at))
    log = spark.createDataFrame([("l", "a3.example.com", at, "add"), ("l", "other.com", at, "add"), ("m", "com", at + datetime.timedelta(days=40), "add")], "list string, pattern string, at timestamp, action string")
    rows = url_filters.judge(captures, log).groupBy("blocked").count().collect()
    assert {r["blocked"]: r["count"] for r in rows} == {True: 20_000 // 7, False: 20_000 - 20_000 // 7}


def test_removal_wins_at_one_moment(spark):
    at = datetime.datetime(2024, 5, 31, 23)
    log = spark.createDataFrame([("l", "h.com", at, "add"), ("l", "h.com", at, "remove"), ("l", "g.com", at, "add")], "list string, pattern string, at timestamp, action string")
    rows = [("http://h.com/", at), ("http://g.com/", at), ("http://g.com/", at - datetime.timedelta(seconds=1)), ("http://g.com/", at + datetime.timedelta(days=900))]
    got = url_filters.judge(spark.createDataFrame(rows, "url string, fetched timestamp"), log).collect()
    assert sorted((r["url"], r["fetched"], r["blocked"]) for r in got) == sorted([(*rows[0], False), (*rows[1], True), (*rows[2], False), (*rows[3], True)])
