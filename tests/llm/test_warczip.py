import base64
import hashlib
import io
import random
import struct
import tempfile
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from tableops.llm import warczip
from tableops.llm.common import Stage

SCHEMA = "page_id long, url string, html string, d string, id string, payload string, part string, n string, best string, sha1 string"
CLASH = ("x",) * 7


def pages():
    rng = random.Random(7)
    texts = [None, "", "a", "<p>é</p>", "x" * 300_000, "same", "\r\n\r\nWARC/1.1\r\n", "日本"]
    rows = [(i, f"http://h{i % 5}.example/ü {i}\n", rng.choice(texts), *CLASH) for i in range(150)]
    rows += [(1000 + i, None, f"page {i}", *CLASH) for i in range(20)]
    rows += [rows[0], rows[3], rows[3], (None, None, None, *CLASH), (None, "u", "only without id", *CLASH), (None, "u", "only without id", *CLASH)]
    return rows + [(5, "http://other", rows[5][2], *CLASH)]


def brute(rows, at_least=0):
    groups = {}
    for page, url, html, *_ in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for payload, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for k, i in enumerate(ids):
            revisit = k > 0 and len(payload) >= at_least
            out.append((i, len(payload), digest, "revisit" if revisit else "response", ids[0] if revisit else None))
    return sorted(out, key=str)


def packed(spark, rows, at_least=0, parts=5, **kw):
    stage = Stage(spark, "warc-test")
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return warczip.write_packages(warczip.page_records(df, stage, at_least), stage, **kw)


def report(packages, **kw):
    return sorted((tuple(r) for r in warczip.page_report(warczip.read_packages(packages, **kw)).collect()), key=str)


@pytest.mark.parametrize("at_least,kw", [(0, {}), (5, {"package_bytes": 4000, "member_bytes": 900}), (10**9, {"zip64": True})])
def test_pages_come_back(spark, at_least, kw):
    packages = packed(spark, pages(), at_least, **kw)
    assert report(packages, payloads=False) == brute(pages(), at_least)
    assert packages.agg(F.sum("records")).first()[0] == len(pages())


def test_empty_table(spark):
    packages = packed(spark, [])
    assert packages.count() == 0 and report(packages) == []


def test_payloads_and_targets(spark):
    got = warczip.read_packages(packed(spark, pages())).where("type = 'response'").select("payload", "size").collect()
    assert sorted(bytes(r[0]) for r in got) == sorted({(p[2] or "").encode() for p in pages()})
    assert all(len(r[0]) == r[1] for r in got)


def test_another_reader_agrees(spark):
    """The packages are ZIP files and gzipped WARC to other programs too."""
    for kw in ({}, {"zip64": True, "member_bytes": 500}):
        n = 0
        for row in packed(spark, pages(), **kw).collect():
            with zipfile.ZipFile(row["path"].removeprefix("file:")) as z:
                assert z.testzip() is None
                for info in z.infolist():
                    assert info.compress_type == zipfile.ZIP_STORED
                    if info.filename.startswith("archive/"):
                        data = z.read(info)
                        while data:
                            un = zlib.decompressobj(31)
                            headers, _ = warczip.parse_record(un.decompress(data))
                            assert headers["warc-type"] in ("response", "revisit")
                            data, n = un.unused_data, n + 1
        assert n == len(pages())


def foreign(path, compress=False, index=False, gz=False, damage=False, force64=False):
    """A package by the standard library: names of other lengths, extra fields, a comment, no index."""
    records, lines, at = [], [], 0
    for i in range(40):
        payload = f"text {i} ".encode() * (i * 50)
        raw = warczip.record_bytes("response", f"urn:page:{i}:x:0", f"http://a/{i}", None, warczip.base32_sha1(payload), len(payload), payload)
        raw = raw.replace(b"text 39", b"text 93", 1) if damage else raw
        raw = zlib.compress(raw, 6, 31) if gz else raw
        lines.append(f'a 2000 {{"filename": "archive/some.warc", "offset": {at}, "length": "{len(raw)}"}}\n')
        records.append(raw)
        at += len(raw)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED if compress else zipfile.ZIP_STORED) as z:
        z.comment = b"PK\x05\x06 a comment that looks like an end"
        z.writestr(zipfile.ZipInfo("datapackage.json"), b"{}")
        with z.open("archive/some.warc", "w", force_zip64=force64) as f:
            f.write(b"".join(records))
        if index:
            z.writestr("indexes/i.cdxj", "".join(lines))


@pytest.mark.parametrize("kw", [{}, {"gz": True}, {"index": True}, {"gz": True, "index": True, "force64": True}])
def test_foreign_packages_with_and_without_index(spark, kw):
    path = tempfile.mkdtemp(prefix="warczip-") + "/p.zip"
    foreign(path, **kw)
    got = warczip.read_packages(spark.createDataFrame([(path,)], "path string"))
    assert sorted(int(r["record_id"].split(":")[2]) for r in got.collect()) == list(range(40))


@pytest.mark.parametrize("kw,why", [({"compress": True}, "compressed within"), ({"damage": True}, "does not have its digest")])
def test_unreadable_packages_fail(spark, kw, why):
    path = tempfile.mkdtemp(prefix="warczip-") + "/p.zip"
    foreign(path, **kw)
    with pytest.raises(Exception, match=why):
        warczip.read_packages(spark.createDataFrame([(path,)], "path string")).collect()


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        assert n >= 0 and at >= 0
        return self.data[at : at + n]


def test_every_index_line_belongs_to_one_range():
    rng = random.Random(3)
    lines = [b"x" * rng.randrange(1, 9) for _ in range(60)]
    for data in (b"\n".join(lines), b"\n".join(lines) + b"\n", b""):
        for step in (1, 2, 5, 17, 10_000):
            got = [
                line
                for begin in range(0, max(len(data), 1), step)
                for line in warczip.index_lines(Bytes(b"?" * 9 + data), 9, len(data), begin, begin + step)
            ]
            assert got == (lines if data else [])


def test_zip64_directory_of_large_offsets():
    """Sizes and offsets beyond 32 bits, as far as a directory without the data goes."""
    writer = warczip.PackageWriter(io.BytesIO())
    writer.at = 0
    writer.entries = [(b"archive/a", 1, 5 << 32, 7), (b"archive/b", 2, 3, 6 << 32), (b"c", 3, 4, 9)]
    writer.close()
    data = writer.out.getvalue()
    assert list(warczip.directory(Bytes(data), len(data))) == [
        ("archive/a", 0, 5 << 32, 5 << 32, 7), ("archive/b", 0, 3, 3, 6 << 32), ("c", 0, 4, 4, 9),
    ]
    many = warczip.PackageWriter(io.BytesIO())
    many.entries = [(b"m%d" % i, 0, 1, i) for i in range(70_000)]
    many.close()
    data = many.out.getvalue()
    assert struct.unpack("<H", data[-12:-10])[0] == 0xFFFF
    assert sum(1 for _ in warczip.directory(Bytes(data), len(data))) == 70_000
    with pytest.raises(ValueError, match="no end"):
        list(warczip.directory(Bytes(b"nothing"), 7))
