import io
import zipfile
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from paperfield.llm import warczip


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as payload", "'c' as digest", "'c' as first").repartition(3)


ROWS = [(i, f"http://a.example/{i}", t) for i, t in enumerate(["x" * 100, "x" * 99, None, "", "é" * 50, "é" * 49, "line\r\n\r\nmore\r\n" * 20])]
ROWS += [(i + 10, None if i == 1 else "http://b\n", t) for i, (_, _, t) in enumerate(ROWS)] + [(50, "u", "y" * 2_000_000), (None, "u", "x" * 100)]


@pytest.mark.parametrize("given", [False, True])
def test_round_trip(spark, tmp_path, given):
    packages, folder = warczip.archive(pages(spark, ROWS), str(tmp_path / "p") if given else None)
    found = {r.page_id: r for r in warczip.read_archive(packages, folder).collect()}
    first = {}
    for i, _, t in sorted(ROWS, key=lambda r: (r[0] is None, r[0])):
        first.setdefault(t or "", i)
    for i, url, t in ROWS:
        data = (t or "").encode()
        kind = "response" if len(data) < 100 or first[t or ""] == i else "revisit"
        r = found[i]
        assert (r.record_type, r.payload_bytes, r.payload_digest) == (kind, len(data), sha256(data).hexdigest())
        assert r.refers_to == (None if kind == "response" else first[t or ""])
        assert (None if r.payload is None else bytes(r.payload)) == (data if kind == "response" else None)
        assert r.uri == (url or "").replace("\n", "")
    assert len(found) == len(ROWS)


def test_repeated_rows_and_empty_tables(spark):
    packages, folder = warczip.archive(pages(spark, [(1, "u", "x" * 100)] * 2 + [(2, "u", "x" * 100), (None, "v", "z" * 200), (None, "v", "z" * 200)]))
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warczip.read_archive(packages, folder).collect()), key=repr)
    assert got == sorted([(1, "response", None)] * 2 + [(2, "revisit", 1)] + [(None, "response", None)] * 2, key=repr)
    packages, folder = warczip.archive(pages(spark, []))
    assert warczip.read_archive(packages, folder).collect() == []


def test_directory_of_plain_and_zip64_packages(monkeypatch):
    for many in (False, True):
        if many:  # the library then writes ZIP64 records for small files too
            monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
            monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as package:
            package.comment = b"a comment" if not many else b""
            for name in ("a.txt", "ü/b.bin", "empty"):
                package.writestr(name, name.encode() * (name != "empty") * 7)
            package.writestr("packed", b"p" * 1000, zipfile.ZIP_DEFLATED)
        data = out.getvalue()
        members = warczip.directory(out, len(data))
        assert list(members) == ["a.txt", "ü/b.bin", "empty", "packed"]
        for name in ("a.txt", "ü/b.bin", "empty"):
            at = warczip.content_start(out, members[name])
            assert data[at : at + members[name].size] == name.encode() * (name != "empty") * 7
        with pytest.raises(ValueError, match="not stored"):
            warczip.content_start(out, members["packed"])
    with pytest.raises(ValueError, match="no end"):
        warczip.directory(io.BytesIO(b"nothing"), 7)


def test_packages_are_zip_files_with_an_index(spark):
    packages, folder = warczip.archive(pages(spark, ROWS))
    total = 0
    for r in packages.collect():
        with zipfile.ZipFile(r.path) as package:
            assert package.testzip() is None
            assert {i.compress_type for i in package.infolist()} == {zipfile.ZIP_STORED}
            assert len(package.read(warczip.INDEX).splitlines()) == r.records
        total += r.records
    assert total == len(ROWS)
    assert warczip.locate(packages, folder).filter(F.col("length") > 0).count() == total
