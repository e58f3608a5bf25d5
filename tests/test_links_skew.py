from html.parser import HTMLParser

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paperfield.operators import links, skew


class _Refs(HTMLParser):
    def __init__(self, markup):
        super().__init__()
        self.anchors, self.frames = [], []
        self.feed(markup)
        self.close()

    def handle_starttag(self, tag, attrs):
        first = {}
        for name, value in attrs:
            first.setdefault(name, (value or "").strip())
        href = first.get("href", "")
        if tag == "a" and href and not href.startswith(("javascript:", "mailto:", "tel:", "#")):
            self.anchors.append(href)
        if tag in ("embed", "iframe", "object") and first.get("src"):
            self.frames.append(first["src"])


def test_links_match_html_parser_on_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = pages.select("html", links.link_refs(F.col("html")).alias("refs")).collect()
    for row in got:
        parsed = _Refs(row.html)
        assert row.refs == parsed.anchors + parsed.frames


FRAGMENTS = [
    "<a href=/x>1</a><A HREF='/y?a=1&amp;b=2'>2</A><a\n class=\"q > r\" href = \"/z\" >3</a>",
    "<!-- <a href='/no'> --><script>var s=\"<a href='/no2'>\";</script><a href='/yes'>",
    "<a>no</a><a href=''>e</a><a href='#t'>f</a><a href='mailto:x'>m</a><a href='MAILTO:x'>M</a><a href='tel:1'>t</a><a href='javascript:x'>j</a>",
    "<iframe src='/f'></iframe><a href='/a'><embed src=/e><object data='/no' src='/o'></object><embed src=''>",
    "<abbr href='/no'><a data-href='/no' href='/ok'><a data-x href=' /sp '><a title=\"href='/no'\" href=/real class=c>",
    "<a href='/one' href='/two'><a href=\"/q\"class=x><img href='/no'>",
]


@pytest.mark.parametrize("markup", FRAGMENTS)
def test_link_fragments_match_html_parser(spark, markup):
    parsed = _Refs(markup)
    got = spark.createDataFrame([(markup,)], "html string").select(links.link_refs(F.col("html")).alias("r")).first().r
    assert got == parsed.anchors + parsed.frames


def test_extract_links_resolves(spark, rows):
    page = spark.createDataFrame([(1, "https://h.gov/a/b", "<a href='c.pdf?utm_id=1'><a href='//k.gov'><a href='ftp://x'>")], "id int, url string, html string")
    assert rows(links.extract_links(page), "id", "pos", "link") == [(1, 1, "https://h.gov/a/c.pdf"), (1, 2, "https://k.gov/"), (1, 3, "")]


@pytest.fixture(scope="module")
def skewed(spark):
    ids = spark.range(20000)
    return ids.select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), (F.col("id") * 7919 % 1009).alias("v"))


def test_rank_within_hot_key(spark, skewed):
    order = [F.desc("v"), F.col("id")]
    plain = skewed.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("long"))
    spread = skew.rank_within(skewed, ["k"], order)
    assert spread.exceptAll(plain).count() == 0 and spread.count() == 20000


def test_rank_over_everything(spark, skewed):
    ranked = skew.rank_within(skewed, [], [F.col("id")])
    assert ranked.filter("rank = id + 1").count() == 20000


def test_rank_keeps_null_keys(spark):
    frame = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, v int")
    got = {(r.k, r.v): r.rank for r in skew.rank_within(frame, ["k"], [F.col("v")]).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 3): 1}


@pytest.mark.parametrize("cap", [3, 150])
def test_top_per_key(spark, skewed, cap):
    order = [F.col("v"), F.col("id")]
    plain = skewed.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(*order))).filter(F.col("rank") <= cap)
    tree = skew.top_per_key(skewed, ["k"], order, cap)
    assert tree.count() == plain.count() and tree.exceptAll(plain).count() == 0


def test_first_per_key_is_cut_before_the_shuffle(spark, skewed):
    first = skew.first_per_key(skewed, ["k"], [F.col("id")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert first.count() == skewed.select("k").distinct().count()


def test_lookup_keeps_all_rows(spark, skewed):
    table = skewed.select("k").distinct().filter("k <> 'k3'").withColumn("w", F.length("k"))
    joined = skew.lookup(skewed, table, "k")
    assert joined.count() == 20000 and joined.filter("w is null and k <> 'k3'").count() == 0
