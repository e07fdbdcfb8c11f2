import hashlib
import io
import random
import zlib

import pytest
from conftest_llm import unordered
from rentscope.llm import warc
from rentscope.llm.store import new_folder

PAGES = "page_id long, url string, html string, record_type string, payload string"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES)


@pytest.fixture(scope="module")
def rows():
    large = "<p>ü</p>" * 200
    noise = "".join(chr(random.Random(i).randint(32, 0x2FFF)) for i in range(3000))
    return [
        (1, "http://a", large),
        (2, "http://b", large),
        (9, None, large),
        (9, "http://again", large),
        (3, "http://c\r\nX: y", "small"),
        (4, "http://d", "small"),
        (5, "http://e", None),
        (6, "http://f", ""),
        (None, "http://g", large),
        (None, "http://h", "q" * 1000),
        (-7, "http://i", noise),
        (8, "http://j", "WARC/1.1\r\n\r\n\r\n\r\n" + "é" * 500),
    ]


def expected(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [i for i, _, h in rows if h == html and i is not None]
        top = max(same, default=None) if len(payload) >= 1000 else None
        revisit = top is not None and page_id != top
        digest = hashlib.sha1(payload).hexdigest()
        out.append((page_id, "revisit" if revisit else "response", top if revisit else None, len(payload), digest))
    return unordered(out)


def test_round_trip(spark, rows):
    found = warc.round_trip(spark, pages_of(spark, rows)).drop("uri").collect()
    assert unordered(found) == expected(rows)


@pytest.mark.parametrize("split", [1, 37, 500, 1 << 20])
def test_each_record_once_at_any_split(spark, rows, split):
    archives = warc.write_archives(pages_of(spark, rows).coalesce(1), new_folder(spark, "warc")).collect()
    records = []
    for a in archives:
        for start in range(0, a.bytes, split):
            with open(a.path.removeprefix("file:"), "rb") as file:
                records += [f["warc-record-id"] for f, _ in warc.records_in(file, a.bytes, start, start + split)]
    assert sorted(records) == sorted(warc.record_id(i) for i, _, _ in rows)


def test_small_splits_in_spark_and_payloads(spark, rows):
    archives = warc.write_archives(pages_of(spark, rows), new_folder(spark, "warc"))
    found = warc.read_archives(spark, archives, split_bytes=300).collect()
    assert len(found) == len(rows)
    texts = {(i, (h or "").encode()) for i, _, h in rows}
    assert all((r.page_id, r.payload) in texts for r in found if r.record_type == "response")


def test_false_magic_is_no_record():
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    other = packer.compress(b"no record at all") + packer.flush()
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    good = packer.compress(warc.record(5, "u", b"body", None)) + packer.flush()
    data = warc.MAGIC + b"junk" + other + good + warc.MAGIC
    found = list(warc.records_in(io.BytesIO(data), len(data), 0, len(data)))
    assert [f["warc-record-id"] for f, _ in found] == [warc.record_id(5)]


def gz(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def foreign(kind: str, block: bytes, *more: str) -> bytes:
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"Content-Length: {len(block)}", *more]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read(spark, tmp_path, data, split=200):
    path = tmp_path / f"{len(data)}-{zlib.crc32(data)}.warc.gz"
    path.write_bytes(data)
    listed = spark.createDataFrame([(str(path), len(data))], "path string, bytes long")
    return warc.read_archives(spark, listed, split_bytes=split).collect()


def test_records_of_every_type(spark, tmp_path):
    http = "Content-Type: application/http; msgtype=response"
    body = b"<p>x</p>" * 30
    sums = hashlib.sha1(body).hexdigest()
    members = [
        foreign("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "Content-Type: application/http; msgtype=request", "WARC-Target-URI: http://a"),
        foreign("response", b"HTTP/1.1 200 OK\r\n\r\n" + body, http, f"WARC-Payload-Digest: sha1:{sums}", "WARC-Record-ID: <urn:uuid:1>"),
        foreign("response", b"HTTP/1.1 200 OK\r\n\r\n" + body, http, "WARC-Payload-Digest: sha256:00"),
        foreign("response", b"HTTP/1.1 200 OK\r\n\r\n" + body, http, f"WARC-Payload-Digest: sha1:{sums[::-1]}"),
        foreign("metadata", b"", "Content-Type: application/warc-fields"),
        foreign("revisit", b"", "WARC-Refers-To: <urn:uuid:1>"),
        foreign("revisit", b"HTTP/1.1 200 OK\r\nContent-Length: 12\r\n\r\n", http),
        foreign("resource", body, "WARC-Target-URI: file://x"),
        foreign("conversion", body),
        foreign("unheard-of", body),
    ]
    found = read(spark, tmp_path, b"".join(map(gz, members)))
    assert sorted(r.record_type for r in found) == sorted(
        "warcinfo request response response response metadata revisit revisit resource conversion unheard-of".split()
    )
    assert [r.problem is not None for r in found].count(True) == 1
    assert {r.payload_bytes for r in found if r.record_type == "revisit"} == {None, 12}
    assert {r.payload for r in found if r.record_type in ("resource", "conversion", "response")} == {body}
    assert {r.page_id for r in found} == {None}


@pytest.mark.parametrize("split", [64, 300, 1 << 20])
def test_no_record_is_lost_in_silence(spark, tmp_path, split):
    noise = random.Random(4).randbytes(900)
    members = [gz(warc.record(i, "u", noise[i:], None)) for i in range(5)]
    starts = [sum(map(len, members[:k])) for k in range(6)]
    whole = b"".join(members)
    assert [r.problem for r in read(spark, tmp_path, whole, split)] == [None] * 5
    for at in (starts[2], starts[2] + 12, starts[2] + 400, starts[3] - 6, starts[4], starts[0]):
        data = bytearray(whole)
        data[at] ^= 0x55
        found = read(spark, tmp_path, bytes(data), split)
        assert len([r for r in found if r.problem is None]) == 4, at
        assert len([r for r in found if r.problem is not None]) >= 1, at
    cut = read(spark, tmp_path, whole[: starts[4] + 300], split)
    assert sorted(r.page_id for r in cut if r.problem is None) == [0, 1, 2, 3] and any(r.problem for r in cut)
    joined = read(spark, tmp_path, whole[: starts[2]] + b"\0" * 100 + whole[starts[2] :], split)
    assert len([r for r in joined if r.problem is None]) == 5 and any(r.problem for r in joined)


def test_pages_longer_than_a_block(spark):
    large = "".join(chr(random.Random(8).randint(32, 0x2FFF)) for _ in range(1000)) * 3000
    found = warc.round_trip(spark, pages_of(spark, [(1, "u", large), (2, "v", large), (3, "w", "x")])).collect()
    assert sorted((r.page_id, r.record_type, r.payload_bytes) for r in found) == [
        (1, "revisit", len(large.encode())), (2, "response", len(large.encode())), (3, "response", 1)
    ]


def test_empty_table(spark):
    assert warc.round_trip(spark, pages_of(spark, [])).count() == 0
