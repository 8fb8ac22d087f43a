"""Packages: written, read back, and read when others wrote them."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections import Counter

import pytest

from cdmloom.llm import warc_zip as wz

BIG = "x" * 1500
PAGES = [
    (1, "http://a.example/1", BIG),
    (5, "http://a.example/5", BIG),
    (3, None, BIG),
    (None, "http://a.example/null", BIG),
    (7, "bad url\r\nX: y é", "short"),
    (8, "u", "short"),
    (9, "u", None),
    (10, None, ""),
    (11, "u", "é" * 700),
    (12, "u", "é" * 700),
    (12, "u", "é" * 700),
    (13, "u", "WARC/1.1\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" * 100),
    (None, "u", "z" * 2000),
    (14, "u", "y" * 3_000_000),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, payload string, sha1 string")


def brute(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        first = max(same, default=None) if len(data) >= 1000 else None
        refers = first if first is not None and first != i else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return Counter(out)


def test_round_trip(spark):
    packages = wz.write_packages(pages(spark))
    got = wz.read_packages(packages, payloads=True).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == brute(PAGES)
    texts = Counter((i, (h or "").encode()) for i, _, h in PAGES)
    for r in got:
        if r["record_type"] == "response":
            assert (r["page_id"], bytes(r["payload"])) in texts
        else:
            assert r["payload"] is None
    assert {r["url"] for r in got if r["page_id"] in (1, 3, 7)} == {"http://a.example/1", None, "bad%20url%0D%0AX:%20yé".replace("%20yé", "%20y%20é")}


def test_many_packages_and_ranges(spark):
    rows = [(i, f"http://h/{i}", f"page {i % 50} " * 200) for i in range(300)]
    packages = wz.write_packages(pages(spark, rows).repartition(2), package=2000)
    assert packages.count() > 4
    got = wz.read_packages(packages, most=500).collect()
    assert Counter(tuple(r)[:1] + tuple(r)[2:] for r in got) == brute(rows)


def test_empty_table(spark):
    packages = wz.write_packages(pages(spark, []) if False else spark.createDataFrame([], "page_id long, url string, html string"))
    assert wz.read_packages(packages).count() == 0


def package(store=zipfile.ZIP_STORED, index=True, records=3, comment=b""):
    sink = io.BytesIO()
    rows = [wz.compressed(wz.record(i, "u", b"p%d" % i, hashlib.sha1(b"p%d" % i).hexdigest(), None)) for i in range(records)]
    with zipfile.ZipFile(sink, "w", store) as z:
        z.writestr("README", "hello")
        with z.open(wz.ARCHIVE, "w", force_zip64=True) as f:
            for r in rows:
                f.write(r)
        if index:
            at, lines = 0, []
            for r in rows:
                lines.append(f'com,example)/ 2020 {{"offset": "{at}", "length": "{len(r)}"}}\n')
                at += len(r)
            z.writestr(wz.INDEX, "".join(lines))
        z.comment = comment
    return sink.getvalue()


@pytest.mark.parametrize("index", [True, False])
def test_packages_of_others(index):
    data = package(index=index, comment=b"a comment with PK in it")
    file = io.BytesIO(data)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for m in wz.members(file, len(data)):
            assert data[m.begin : m.begin + m.size] == z.read(m.name)
    runs = list(wz.ranges(file, len(data), 1))
    assert len(runs) == (3 if index else 1)
    assert [wz.parsed(r)[0] for a, b in runs for r in wz.record_bytes(file, a, b)] == [0, 1, 2]


def zip64(data: bytes) -> bytes:
    """The same package with its end record's values moved to ZIP64 records."""
    import struct

    at = data.rindex(wz.END)
    entries, length, offset = struct.unpack_from("<HII", data, at + 10)
    end64 = wz.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, entries, entries, length, offset)
    locator = wz.LOCATOR64 + struct.pack("<IQI", 0, at, 1)
    end = wz.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    return data[:at] + end64 + locator + end


def test_zip64_directory():
    data = zip64(package())
    assert [m.name for m in wz.members(io.BytesIO(data), len(data))] == ["README", wz.ARCHIVE, wz.INDEX]


def test_what_cannot_be_read_is_an_error():
    data = package(zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="stored"):
        list(wz.ranges(io.BytesIO(data), len(data)))
    with pytest.raises(ValueError, match="not a ZIP"):
        wz.directory(io.BytesIO(b"x" * 100), 100)
    good = wz.record(1, None, b"abc", hashlib.sha1(b"other").hexdigest(), None)
    with pytest.raises(ValueError, match="digest"):
        wz.parsed(good)
    cut = wz.compressed(good)[:-9]
    with pytest.raises(ValueError, match="cut off"):
        list(wz.record_bytes(io.BytesIO(cut), 0, len(cut)))


def foreign(names, listed, how="plain"):
    """A package of one member a name with five records each; the index lists those of ``listed``, by URL key."""
    import gzip
    import json

    sink, lines, n = io.BytesIO(), [], 0
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as z:
        for name in names:
            at, out = 0, b""
            for i in range(5):
                data = wz.compressed(wz.record(n, "u", b"p%d" % n * (n + 1), hashlib.sha1(b"p%d" % n * (n + 1)).hexdigest(), None))
                if i in listed:
                    place = {"offset": str(at), "length": str(len(data)), "filename": name.rpartition("/")[2]}
                    lines.append(f"com,example)/{n * 7 % 10} 2020 {json.dumps(place)}\n")
                out, at, n = out + data, at + len(data), n + 1
            z.writestr(name, out)
        index = "".join(sorted(lines)).encode()
        if how == "gzip":  # blocks, as a compressed index has them, and a list of the blocks that is no index
            half = index.index(b"\n") + 1
            z.writestr("indexes/index.cdx.gz", gzip.compress(index[:half]) + gzip.compress(index[half:]))
            z.writestr("indexes/index.idx", b'com,example)/ 2020 {"offset": 0, "length": 9, "filename": "index.cdx.gz"}\n')
        else:
            z.writestr(wz.INDEX, index, zipfile.ZIP_DEFLATED if how == "deflated" else zipfile.ZIP_STORED)
    return sink.getvalue()


@pytest.mark.parametrize("how", ["plain", "deflated", "gzip"])
@pytest.mark.parametrize("names", [["archive/a.warc.gz"], ["archive/a.warc.gz", "archive/b.warc.gz"]])
@pytest.mark.parametrize("listed", [(0, 1, 2, 3, 4), (1, 2), (0, 3)])
def test_indexes_in_any_order_and_form(names, listed, how):
    data = foreign(names, listed, how)
    file = io.BytesIO(data)
    for most in (1, 300, 1 << 20):
        runs = list(wz.ranges(file, len(data), most))
        assert [wz.parsed(r)[0] for a, b in runs for r in wz.record_bytes(file, a, b)] == list(range(5 * len(names)))
    assert len(list(wz.ranges(file, len(data), 1))) > 2 * len(names)


def test_an_index_that_lists_too_much_is_an_error():
    short = io.BytesIO()
    with zipfile.ZipFile(short, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/a.warc.gz", b"x" * 10)
        z.writestr(wz.INDEX, '{"offset": 5, "length": 6}\n')
    with pytest.raises(ValueError, match="lists a record"):
        list(wz.ranges(short, len(short.getvalue())))


def test_records_of_other_types():
    def made(kind, block, *more, id="urn:uuid:8d1e3b5c-0000-4000-8000-000000000001"):
        return "\r\n".join(["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{id}>", *more, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"

    sha = lambda x: hashlib.sha1(x).hexdigest()
    http = "Content-Type: application/http"
    assert wz.parsed(made("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields")) == (None, None, 13, sha(b"software: x\r\n"), "warcinfo", None, b"software: x\r\n")
    assert wz.parsed(made("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", http, "WARC-Target-URI: u")) == (None, "u", 0, sha(b""), "request", None, b"")
    assert wz.parsed(made("response", b"HTTP/1.1 200 OK\r\n\r\nabc", http, "WARC-Payload-Digest: sha256:00")) == (None, None, 3, sha(b"abc"), "response", None, b"abc")
    assert wz.parsed(made("response", b"HTTP/1.1 200 OK\r\n\r\nabc", http, f"WARC-Payload-Digest: sha1:{sha(b'abc')}", id="urn:page:7"))[0] == 7
    assert wz.parsed(made("revisit", b"", http, "WARC-Refers-To: <urn:uuid:1>")) == (None, None, None, None, "revisit", None, None)
