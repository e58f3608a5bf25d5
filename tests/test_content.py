import html as html_lib
from html.parser import HTMLParser

from pyspark.sql import functions as F

from paperfield.functions import content, retry


def one(spark, schema, values, *columns):
    frame = spark.createDataFrame(values, schema).repartition(1)
    return [tuple(r) for r in frame.select(*columns).collect()]


def test_pdf_detection(spark):
    cases = [
        ("https://x.gov/a/b.PDF", None, None),
        ("https://x.gov/a", None, bytearray(b" \n%PDF-1.7\n")),
        ("https://x.gov/getfile", "Application/PDF; x", None),
        ("https://x.gov/page?x=a.pdf", "text/html", bytearray(b"<!doctype")),
        ("https://x.gov/late", None, bytearray(b" " * 14 + b"%PDF-")),
    ]
    url, ct, body = F.col("u"), F.col("c"), F.col("b")
    got = one(spark, "u string, c string, b binary", cases, content.is_pdf(url, ct, body).alias("p"))
    assert [g[0] for g in got] == [True, True, True, False, False]


def test_content_class(spark):
    cases = [
        ("application/pdf", "pdf"), ("TEXT/HTML; charset=x", "html"), ("text/plain", "html"), ("image/png", "image"),
        ("application/msword", "document"), ("application/x-tar", "archive"), ("application/octet-stream", "binary"),
        (None, "unknown"), ("", "unknown"), ("video/mp4", "binary"),
    ]
    got = one(spark, "c string, e string", cases, content.content_class(F.col("c"), F.lit("http://a.gov/x")).alias("k"), "e")
    assert all(k == e for k, e in got)
    assert one(spark, "c string", [("image/png",)], content.content_class(F.col("c"), F.lit("http://a.gov/x.pdf")).alias("k")) == [("pdf",)]


def test_html_sniff(spark):
    cases = [(bytearray(b),) for b in (b"  <!DOCTYPE html>", b"<HTML>", b"%PDF", b" " * 4000 + b"<html", b"x<html")] + [(None,)]
    got = one(spark, "b binary", cases, content.starts_like_html(F.col("b")).alias("h"))
    assert [g[0] for g in got] == [True, True, False, True, False, False]


def test_decode_body(spark):
    cases = [
        (bytearray("é".encode()), "text/html; charset=UTF-8", "é"),
        (bytearray(b"\xe9"), "text/html", "é"),
        (bytearray(b"a\xffb"), "application/xhtml+xml", "a�b"),
        (bytearray(b"\xe9"), 'text/html; charset="ISO-8859-1"', "é"),
        (bytearray(b"a\xe9"), "text/html; charset=us-ascii", "a�"),
        (bytearray("é".encode()), None, "é"),
    ]
    got = one(spark, "b binary, c string, e string", cases, content.decode_body(F.col("b"), F.col("c")).alias("t"), "e")
    assert all(t == e for t, e in got)


class _Text(HTMLParser):
    def __init__(self, markup):
        super().__init__()
        self.pieces, self.skip = [], 0
        self.feed(markup)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.skip and data.strip():
            self.pieces.append(data.strip())


def test_visible_text_matches_html_parser_on_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = pages.select("html", content.visible_text(F.col("html")).alias("t")).collect()
    assert len(got) > 0
    assert all(r.t == " ".join(_Text(r.html).pieces) for r in got)


def test_entities(spark):
    cases = [("a&amp;b",), ("&lt;&#65;&#x42;&eacute;&hellip;",), ("&nosuch; & &amp",), ("&#128512;!",), ("&#66 x",)]
    got = one(spark, "t string", cases, content.unescape_entities(F.col("t")).alias("u"))
    assert [g[0] for g in got] == ["a&b", "<ABé…", "&nosuch; & &amp", html_lib.unescape("&#128512;!"), "B x"]


def test_block_outcomes(spark):
    cases = [
        (200, "fine", None, False, False, None),
        (429, "", "7.5", True, False, 7.5),
        (403, "", "soon", True, True, None),
        (200, "please solve this CAPTCHA", None, True, True, None),
        (200, "Unusual Traffic", "3", True, False, 3.0),
        (200, "x" * 4000 + "captcha", None, False, False, None),
    ]
    got = one(
        spark, "s int, b string, r string, e1 boolean, e2 boolean, e3 double", cases,
        content.block_outcome(F.col("s"), F.col("b"), F.col("r")).alias("o"), "e1", "e2", "e3",
    )
    assert all((o.blocked, o.fatal, o.retry_after) == (a, b, c) for o, a, b, c in got)


def test_retry_after_and_backoff(spark):
    cases = [("12",), ("1.5",), ("x",), (None,)]
    got = one(spark, "r string", cases, content.search_retry_after(F.col("r")).alias("s"), content.crawl_retry_after(F.col("r")).alias("c"))
    assert got == [(12.0, 12.0), (1.5, None), (None, None), (None, None)]
    frame = spark.range(200).select(retry.backoff_seconds(F.col("id"), (F.col("id") % 12).cast("int") - 1).alias("w"), "id")
    for w, i in frame.collect():
        full = min(120.0, 2.0 ** max(0, i % 12 - 1))
        assert 0.5 * full <= w < 1.5 * full
