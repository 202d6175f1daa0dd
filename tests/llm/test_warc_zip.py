"""Round trips of packages, and ZIP files of the standard library."""
import hashlib
import io
import zipfile

import pytest

from quaybook.llm import warc_zip as W
from quaybook.llm.queries import op2_zip_archive
from quaybook.sources.tables import read_table

SF001 = "/root/testdata/sf0.001"


def expected(pages):
    first = {}
    for i, html in pages:
        data = (html or "").encode()
        if len(data) >= 100:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, html in pages:
        data = (html or "").encode()
        to = first.get(data)
        revisit = to is not None and to != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def test_whole_table(spark):
    pages = [(r.page_id, r.html) for r in read_table(spark, SF001, "pages").collect()]
    got = op2_zip_archive(spark, SF001).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(pages)


def test_copies_and_odd_payloads(spark):
    pages = [(5, "a" * 100), (3, "a" * 100), (9, "a" * 100), (4, "b" * 99), (6, "b" * 99), (1, None), (2, ""), (7, "é" * 60),
             (8, "é" * 60), (3, "a" * 100), (10, "x\r\n\r\nWARC/1.1\r\n" * 20000)]
    df = spark.createDataFrame([(i, "http://x/\r\nX-Page-Id: 7", h, 1) for i, h in pages], "page_id long, url string, html string, path int")
    read = W.read_packages(W.write_packages(df, package_bytes=150)).collect()
    got = sorted(((int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None)
                  for r in read), key=str)
    assert got == expected(pages)
    bodies = {i: (h or "").encode() for i, h in pages}
    assert all(bytes(r.payload) == bodies[int(r.page_id)] for r in read if r.record_type == "response")
    assert W.read_packages(W.write_packages(df.limit(0))).collect() == []


@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 and more" * 3])
def test_reads_standard_zip(comment):
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        z.writestr("a.txt", b"hello world")
        z.writestr("é.txt", b"x" * 1000)
        z.comment = comment
    r = W.ZipReader(f, len(f.getvalue()))
    assert r.read("a.txt") == b"hello world" and r.read("a.txt", 6, 5) == b"world" and len(r.read("é.txt")) == 1000
    with pytest.raises(ValueError):
        r.read("a.txt", 6, 6)


def test_own_zip_is_standard_and_zip64():
    f = io.BytesIO()
    w = W.ZipWriter(f)
    for name, data in (("one", b"1" * 10), ("two", b"")):
        w.begin(name)
        w.data(data)
        w.end()
    w.close()
    with zipfile.ZipFile(f) as z:
        assert z.testzip() is None and z.read("one") == b"1" * 10 and z.namelist() == ["one", "two"]
    assert W.ZipReader(f, len(f.getvalue())).read("one") == b"1" * 10


def test_compressed_members_are_refused():
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"a" * 100)
    with pytest.raises(ValueError):
        W.ZipReader(f, len(f.getvalue()))


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_one_record_by_its_id(spark, scratch, scheme):
    pages = [(i, f"http://a{i % 3}.example.org/p {i}", "same" * 40 if i % 5 == 0 else f"page {i}") for i in range(40)] + [(None, None, "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    packages = W.write_packages(df, folder=f"{scheme}{scratch}/packages", package_bytes=500)
    assert all(r.path.startswith(f"{scheme}{scratch}/packages/") for r in packages.collect())
    index = W.index_rows(packages)
    assert index.count() == 41 and index.select("record_id").distinct().count() == 41
    got = W.read_records(index.where("page_id IN ('7', '10')")).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to, r.payload) for r in got) == [
        ("10", "revisit", "0", None), ("7", "response", None, bytearray(b"page 7"))]
    assert [r.url_key for r in index.where("page_id = '7'").collect()] == ["org,example,a1)/p%207"]
    assert [r.url_key for r in index.where("page_id IS NULL").collect()] == ["-"]


def test_packages_keep_the_scheme_of_their_folder():
    assert W.package_uri("s3://bucket/x/").startswith("s3://bucket/x/")
    lines = [W.index_line(1, "http://b.org/\r\n1", "d", "response", 50, 5), W.index_line(2, "http://a.org", "e", "revisit", 0, 50)]
    assert [x["page"] for x in W.parse_index("\n".join(sorted(lines)))] == ["2", "1"]
