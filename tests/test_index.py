"""The whole life of an index: seed, discover, crawl, download, verify, export, resume."""

import json

from pyspark.sql import functions as F

from paperfield import schemas
from paperfield.plans.index import DocumentIndex

HTML = {"Content-Type": "text/html; charset=utf-8"}


def at(text):
    return F.lit(text).cast("timestamp")


def responses(spark, data, when):
    frame = spark.createDataFrame([(u, u, s, h, bytearray(b)) for u, s, h, b in data], "request_url string, final_url string, status int, headers map<string,string>, body binary")
    return frame.withColumn("fetched_at", when)


def test_index_from_seed_to_export(spark, rows, tmp_path):
    (tmp_path / "seeds.json").write_text(json.dumps({"agencies": [
        {"state": "Texas", "agency_name": "TEA", "agency_type": "agency", "official_url": "https://tea.texas.gov"},
        {"state": "Florida", "agency_name": "DOE", "agency_type": "agency", "official_url": "https://www.fldoe.org"},
    ]}))
    index = DocumentIndex(spark, str(tmp_path / "index"))
    assert index.seed(str(tmp_path / "seeds.json"), at("2024-01-01")) == 2
    assert index.seed(str(tmp_path / "seeds.json"), at("2024-01-01")) == 2 and index.table("agencies").count() == 2

    page = "<h3><a href='https://tea.texas.gov/found.pdf'>x</a></h3><h3><a href='https://www.fldoe.org/list'>y</a><a href='https://no.com/z'>z</a></h3>"
    captured = spark.createDataFrame([("yahoo", "site:tea.texas.gov filetype:pdf", 1, 200, None, page)], "provider string, query string, page int, status int, retry_after string, html string").withColumn("fetched_at", at("2024-01-01"))
    assert index.discover(captured, at("2024-01-01"), pages_per_query=2) == {"planned": 24, "ingested": 2}
    assert index.pending_pages() == 23
    assert index.discover(captured, at("2024-01-01"), pages_per_query=2) == {"planned": 0, "ingested": 0}

    web = [
        ("https://tea.texas.gov/robots.txt", 200, {"Content-Type": "text/plain"}, b"User-agent: *\nDisallow: /private"),
        ("https://tea.texas.gov/", 200, HTML, b"<a href='/a.pdf'>a</a><a href='/private/x'>p</a><a href='/more'>m</a>"),
        ("https://www.fldoe.org/", 503, {"Retry-After": "60"}, b""),
        ("https://www.fldoe.org/list", 200, HTML, b"<a href='budget.pdf'>b</a>"),
    ]
    assert index.crawl(responses(spark, web, at("2024-01-02")), at("2024-01-02")) == {"met": 5, "completed": 2, "documents": 2}
    queue = {r.url: r for r in index.table("crawl_queue").collect()}
    assert {u: (q.status, q.depth, q.priority, q.attempts) for u, q in queue.items()} == {
        "https://tea.texas.gov/": ("completed", 0, 10, 1), "https://www.fldoe.org/": ("queued", 0, 10, 1),
        "https://www.fldoe.org/list": ("completed", 0, 5, 1), "https://tea.texas.gov/private/x": ("robots", 1, 0, 1),
        "https://tea.texas.gov/more": ("queued", 1, 0, 0),
    }
    # the next batch of responses goes on where this one stopped, at the depth reached
    later = responses(spark, [("https://tea.texas.gov/more", 200, HTML, b"<a href='/deep'>d</a><a href='/a.pdf?utm_id=1'>a</a>")], at("2024-01-03"))
    assert index.crawl(later, at("2024-01-03"))["completed"] == 1
    assert rows(index.table("crawl_queue").filter("url like '%deep'"), "depth", "status") == [(2, "queued")]
    assert rows(index.table("documents"), "canonical_url", "download_status") == [
        ("https://tea.texas.gov/a.pdf", "queued"), ("https://tea.texas.gov/found.pdf", "queued"), ("https://www.fldoe.org/budget.pdf", "queued"),
    ]

    got = [("a", 200, b"%PDF-1"), ("found", 200, b"%PDF-1"), ("gone", 404, b"")]
    fetched = spark.createDataFrame([(f"https://tea.texas.gov/{n}.pdf", s, {}, bytearray(b), False) for n, s, b in got], "canonical_url string, http_status int, headers map<string,string>, body binary, resumed boolean")
    index.download(fetched, at("2024-01-04"), "store")
    done = index.table("documents").filter("download_status = 'complete'")
    assert done.count() == 2 and done.select("download_path").distinct().count() == 1
    store = spark.read.parquet(f"{index.root}/bodies")
    assert store.count() == 1
    files = store.select(F.concat(F.lit("store/"), "p1", F.lit("/"), "p2", F.lit("/"), "sha256", F.lit(".pdf")).alias("path"), F.sha2("body", 256).alias("sha256"))
    assert rows(index.verify(files)) == [(2, 0, 0)]

    for kind in ("csv", "json", "jsonl"):
        assert index.export(kind, str(tmp_path / kind)) == 3
    report = {(r.section, r.metric): r.value for r in index.status(store.select(F.length("body").alias("length"))).collect()}
    assert report[("DOWNLOADS", "completed")] == 2 and report[("AGENCIES", "active")] == 2 and report[("STORAGE", "PDFs")] == 1
    assert report[("PDF INDEX", "unique")] == 2 and report[("PDF INDEX", "duplicates")] == 1

    before = {n: rows(index.table(n)) for n in ("searches", "crawl_queue", "download_queue", "documents")}
    index.resume(at("2024-01-05"))
    assert {n: rows(index.table(n)) for n in before} == before
    assert index.table("documents").schema == schemas.DOCUMENTS
