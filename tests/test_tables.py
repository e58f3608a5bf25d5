import json

import pytest
from pyspark.sql import functions as F

from paperfield import schemas
from paperfield.operators import agencies, status, tables
from paperfield.plans import discovery
from paperfield.sources import readers, writers

def now():
    return F.lit("2024-05-01 00:00:00").cast("timestamp")

def later():
    return F.lit("2024-05-02 00:00:00").cast("timestamp")



def empty(spark, schema):
    return spark.createDataFrame([], schema)


def sightings(spark, urls, at):
    frame = spark.createDataFrame([(u, s) for u, s in urls], "url string, source_url string")
    return frame.select("url", "source_url", *[F.lit(None).cast("string").alias(c) for c in ("state", "agency")], F.lit(1).alias("depth"), at.alias("seen_at"))


@pytest.fixture
def recorded(spark):
    merged = tables.sightings_by_document(sightings(spark, [("https://a.gov/a.pdf", "p1"), ("https://a.gov/a.pdf?utm_source=x", "p2"), ("mailto:x", "p3")], now()))
    docs = tables.merge_documents(empty(spark, schemas.DOCUMENTS), merged)
    queue = tables.enqueue_documents(empty(spark, schemas.DOWNLOAD_QUEUE), merged)
    urls = tables.merge_document_urls(empty(spark, schemas.URLS), merged)
    return docs, queue, urls


def test_record_merges_variants(recorded, rows):
    docs, queue, urls = recorded
    assert rows(docs, "canonical_url", "filename", "domain", "download_status") == [("https://a.gov/a.pdf", "a.pdf", "a.gov", "queued")]
    assert rows(queue, "canonical_url", "status", "attempts") == [("https://a.gov/a.pdf", "queued", 0)]
    assert rows(urls, "url_type", "status", "source_url", "depth") == [("pdf", "indexed", "p1", 1)]


def test_second_record_moves_last_seen_only(spark, recorded, rows):
    docs, queue, urls = recorded
    merged = tables.sightings_by_document(sightings(spark, [("https://a.gov/a.pdf#x", "z"), ("https://a.gov/b.pdf", "z")], later()))
    docs2 = tables.merge_documents(docs, merged)
    got = {r.canonical_url: (r.first_seen.day, r.last_seen.day, r.pdf_url) for r in docs2.collect()}
    assert got == {"https://a.gov/a.pdf": (1, 2, "https://a.gov/a.pdf"), "https://a.gov/b.pdf": (2, 2, "https://a.gov/b.pdf")}
    assert tables.enqueue_documents(queue, merged).count() == 2
    assert rows(tables.merge_document_urls(urls, merged), "source_url") == [("p1",), ("z",)]
    assert docs2.schema == docs.schema


def test_insert_upsert_replace(spark, rows):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 5), ("c", 4)], "k string, v int")
    assert rows(tables.insert_new(old, new, ["k"], [F.col("v")])) == [("a", 1), ("b", 2), ("c", 4)]
    assert rows(tables.upsert(old, new, ["k"], [F.desc("v")])) == [("a", 1), ("b", 9), ("c", 5)]
    assert rows(tables.replace_groups(old, new, ["k"])) == [("a", 1), ("b", 9), ("c", 4), ("c", 5)]
    assert rows(tables.add_columns(old, v=F.lit(0), w=F.lit("x")), "k", "w") == [("a", "x"), ("b", "x")]


def test_seed_files_and_agency_upsert(spark, rows, tmp_path):
    record = {"state": "Texas", "agency_name": "TEA", "official_url": "https://TEA.texas.gov:443/", "domain": "wrong"}
    (tmp_path / "a.json").write_text(json.dumps({"agencies": [record, {"state": "Ohio", "official_url": "nope"}]}))
    (tmp_path / "b.json").write_text(json.dumps([{**record, "agency_name": "TEA 2", "active": False, "last_verified": "2026-01-02"}]))
    (tmp_path / "c.json").write_text(json.dumps({"other": 1}))
    wrapped, bare = readers.read_seeds(spark, str(tmp_path / "a.json")), readers.read_seeds(spark, str(tmp_path / "b.json"))
    assert readers.read_seeds(spark, str(tmp_path / "c.json")).count() == 0
    table = agencies.upsert_agencies(empty(spark, schemas.AGENCIES), agencies.prepare_agencies(wrapped, now()))
    assert rows(table, "state", "official_url", "domain", "source", "active") == [("Texas", "https://tea.texas.gov/", "tea.texas.gov", "seed", True)]
    table = agencies.upsert_agencies(table, agencies.prepare_agencies(bare, now()))
    assert rows(table, "agency_name", "active", F.year("last_verified")) == [("TEA 2", False, 2026)]
    assert agencies.list_agencies(table).count() == 0


def test_agency_listing_and_queries(spark, rows):
    data = [("Texas", "Education Agency", "tea.gov", True), ("texas", None, "x.gov", True), ("Ohio", "Education", "o.gov", True), ("Texas", "Old Education", "y.gov", False)]
    table = spark.createDataFrame(data, "state string, agency_name string, domain string, active boolean")
    assert rows(agencies.list_agencies(table, "TEXAS", "educ%n"), "domain") == [("tea.gov",)]
    queries = rows(agencies.search_queries(table.filter("active")), "domain", "template_no", "query")
    assert len(queries) == 17
    assert ("tea.gov", 6, 'site:tea.gov filetype:pdf "Education Agency"') in queries
    plan = discovery.plan_searches(agencies.list_agencies(table), "yahoo", 2)
    searches = discovery.add_plan(empty(spark, schemas.SEARCHES), plan)
    assert searches.count() == 34
    assert discovery.add_plan(searches, plan).count() == 34


def test_exports(spark, recorded, tmp_path):
    docs = recorded[0]
    ag = spark.createDataFrame([("Texas", "TEA", "agency")], "state string, agency_name string, agency_type string")
    rows_ = writers.export_rows(docs, ag)
    assert writers.write_csv(rows_, str(tmp_path / "csv")) == 1
    assert writers.write_jsonl(rows_, str(tmp_path / "jsonl")) == 1
    header, line = "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*.csv")).splitlines()
    assert tuple(header.split(",")) == writers.EXPORT_COLUMNS
    assert line.startswith(",,,https://a.gov/a.pdf,https://a.gov/a.pdf,a.pdf,a.gov,,")
    record = json.loads("".join(p.read_text() for p in (tmp_path / "jsonl").glob("part-*.json")))
    assert tuple(record) == writers.EXPORT_COLUMNS and record["state"] is None


def test_export_fans_out_and_keeps_all(spark, recorded):
    docs = recorded[0].withColumns({"state": F.lit("Texas"), "agency": F.lit("TEA")})
    ag = spark.createDataFrame([("Texas", "TEA", "x"), ("Texas", "TEA", "y"), ("Ohio", "TEA", "z")], "state string, agency_name string, agency_type string")
    assert {r.agency_type for r in writers.export_rows(docs, ag).collect()} == {"x", "y"}


def test_status_report(spark, recorded, rows):
    docs, queue, urls = recorded
    counts = status.table_counts({"documents": docs, "urls": urls, "crawl_queue": empty(spark, schemas.CRAWL_QUEUE)})
    files = spark.createDataFrame([(3,), (4,)], "length long")
    report = {(r.section, r.metric): r.value for r in status.status_report(counts, status.storage_stats(files)).collect()}
    assert report[("PDF INDEX", "discovered")] == 1 and report[("PDF INDEX", "duplicates")] == 1
    assert report[("DOWNLOADS", "queued")] == 1 and report[("STORAGE", "bytes")] == 7 and report[("CRAWLER", "queued")] == 0
    assert rows(status.domain_counts(urls, docs)) == [("a.gov", 0, 1)]


def test_verify_and_storage(spark, rows, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "a.pdf").write_bytes(b"%PDF-a")
    (tmp_path / "x" / "y" / "b.pdf").write_bytes(b"%PDF-b")
    (tmp_path / "x" / "c.pdf.part").write_bytes(b"zz")
    assert rows(status.storage_stats(readers.scan_files(spark, str(tmp_path)))) == [(2, 12)]
    assert rows(status.storage_stats(readers.scan_files(spark, str(tmp_path / "none")))) == [(0, 0)]
    files = readers.hash_files(spark, str(tmp_path))
    digest = {r.path[-5]: r.sha256 for r in files.collect()}
    docs = spark.createDataFrame(
        [(str(tmp_path / "x" / "a.pdf"), digest["a"], "complete"), (str(tmp_path / "x" / "y" / "b.pdf"), "0" * 64, "complete"),
         (str(tmp_path / "x" / "y" / "b.pdf"), None, "complete"), ("/gone.pdf", "1", "complete"), (None, None, "complete"), ("/gone2.pdf", "1", "queued")],
        "download_path string, sha256 string, download_status string",
    )
    assert rows(status.verify_counts(status.verify_files(docs, files))) == [(2, 1, 2)]
