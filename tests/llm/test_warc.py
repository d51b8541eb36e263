import base64
import hashlib
import zlib

import pytest

from pricedex.llm import warc as W

PAGES = [(3, "http://a/x", "<p>same</p>"), (1, None, "<p>same</p>"), (2, "http://b/ü y\r\nX: 1", "ünï"), (4, "u", None),
         (5, "u", ""), (None, "u", "<p>same</p>"), (None, "u", "no id"), (7, "u", "big " * 200_000), (8, "u", "dup"),
         (8, "u", "dup"), (9, "u", "\x1f\x8b\x08 WARC/1.1 \r\n\r\n not a record")]


def expected(min_bytes):
    out = []
    for page_id, _, text in PAGES:
        body = (text or "").encode()
        same = [i for i, _, t in PAGES if (t or "") == (text or "") and i is not None]
        first = min(same, default=None)
        copy = len(body) >= min_bytes and sum((t or "") == (text or "") for _, _, t in PAGES) > 1 and page_id != first
        out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if copy else "response", first if copy else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split,min_bytes", [(40, 0), (1000, 5), (1 << 25, 0)])
def test_round_trip(spark, tmp_dir, split, min_bytes):
    pages = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, path string, bytes int")
    files = W.write(spark, pages.repartition(3), tmp_dir + "/out", min_bytes)
    got = W.read(spark, files, split)
    rows = got.withColumn("page", W.page_of("record_id")).withColumn("refers", W.page_of("refers_to")).collect()
    assert sorted(((r.page, r.payload_bytes, r.payload_digest, r.record_type, r.refers) for r in rows), key=str) == expected(min_bytes)
    texts = {r.page: bytes(r.payload).decode() for r in rows if r.record_type == "response" and r.page is not None}
    assert texts[7] == "big " * 200_000 and texts[2] == "ünï" and texts[4 if 4 in texts else 5] == ""
    assert all(r.digest_ok for r in rows if r.record_type == "response")
    assert {r.target_uri for r in rows if r.page == 2} == {"http://b/ü%20y%0D%0AX:%201"}
    listed = W.archives(spark, tmp_dir + "/out")
    assert W.read(spark, listed, split).count() == len(PAGES)


def reader(data):
    return lambda at, n: data[at:at + n]


def test_every_split_owns_the_records_that_start_in_it():
    bodies = [W.record(i, f"http://h/{i}", (f"page {i} " * (i * 37 % 91)).encode()) for i in range(40)]
    junk = b"\x1f\x8b\x08junk" + W.member(b"not a record") + b"\x1f\x8b"
    data = junk + b"".join(W.member(b) + (junk if i % 7 == 0 else b"") for i, b in enumerate(bodies))
    for split in (1, 7, 64, 1000, len(data)):
        if split == 1 and len(data) > 8000:
            continue
        got = [r for start in range(0, len(data), split)
               for r in W.records_in(reader(data), start, min(len(data), start + split))]
        assert got == bodies


def test_stored_members_with_magic_inside(monkeypatch):
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored: the payload's own magic stands in the file
    body = W.record(1, "u", b"\x1f\x8b\x08\x00" * 50 + W.member(b"hello"))
    data = packer.compress(body) + packer.flush() + W.member(W.record(2, "u", b"x"))
    for split in (16, 100, 10_000):
        got = [W.parse(r)["record_id"] for s in range(0, len(data), split)
               for r in W.records_in(reader(data), s, min(len(data), s + split))]
        assert got == ["<urn:x-page:1>", "<urn:x-page:2>"]


def test_cut_off_member_is_dropped():
    data = W.member(W.record(1, "u", b"x")) + W.member(W.record(2, "u", b"y" * 999))[:-20]
    assert len(list(W.records_in(reader(data), 0, len(data)))) == 1


def test_empty_table(spark):
    assert W.roundtrip(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
