"""Discovery and crawl over captured tables; no network, no server."""

import pytest
from pyspark.sql import functions as F

from paperfield import schemas
from paperfield.operators import resultpages, robots
from paperfield.operators.policy import HostRules
from paperfield.operators.tables import align
from paperfield.plans import crawl, discovery
from paperfield.session import materialize


def now():
    return F.lit("2024-05-01 00:00:00").cast("timestamp")


def responses(spark, data):
    rows = [(u, f or u, s, h, bytearray(b)) for u, f, s, h, b in data]
    frame = spark.createDataFrame(rows, "request_url string, final_url string, status int, headers map<string,string>, body binary")
    return frame.withColumn("fetched_at", now())


HTML = {"Content-Type": "text/html; charset=utf-8"}


def page(*links):
    return "".join(f'<a href="{x}">x</a>' for x in links).encode()


def run(spark, data, options, seeds, robots_body="", **more):
    links = materialize(crawl.link_table(responses(spark, data)), "links")
    hosts = spark.createDataFrame([("h.gov", robots_body)], "domain string, body string")
    frontier = crawl.seed_frontier(spark.createDataFrame([(s, 10) for s in seeds], "url string, priority int"), options.rules)
    out = crawl.crawl(frontier, links, robots.host_rules(hosts), options, now(), **more)
    return {r.url: (r.status, r.depth) for r in out.queue.collect()}, out


SITE = [
    ("https://h.gov/", None, 200, HTML, page("/next", "/doc.pdf", "https://facebook.com/x", "/report")),
    ("https://h.gov/next", None, 200, HTML, page("/deep", "/", "/doc.pdf?utm_id=1", "/busy")),
    ("https://h.gov/report", "https://h.gov/real", 200, {"Content-Type": "application/pdf"}, b"%PDF-1.4"),
    ("https://h.gov/deep", None, 404, HTML, page("/deeper")),
    ("https://h.gov/busy", None, 429, {"Retry-After": "90"}, b""),
]


def test_depth_gate_and_documents(spark, rows):
    got, out = run(spark, SITE, crawl.CrawlOptions(max_depth=1), ["https://h.gov"])
    assert got == {"https://h.gov/": ("completed", 0), "https://h.gov/next": ("completed", 1), "https://h.gov/report": ("completed", 1)}
    assert rows(out.sightings, "url", "source_url", "depth") == [("https://h.gov/doc.pdf", "https://h.gov/", 1), ("https://h.gov/real", "https://h.gov/report", 1)]
    assert rows(out.urls, "canonical_url", "url_type", "source_url", "depth") == [
        ("https://h.gov/", "html", "https://h.gov/", 0), ("https://h.gov/next", "html", "https://h.gov/next", 1), ("https://h.gov/real", "pdf", "https://h.gov/report", 1),
    ]


def test_full_depth_follows_error_pages_and_requeues(spark):
    got, out = run(spark, SITE, crawl.CrawlOptions(), ["https://h.gov"])
    assert got["https://h.gov/deep"] == ("completed", 2) and got["https://h.gov/deeper"] == ("queued", 3)
    assert got["https://h.gov/busy"] == ("queued", 2)
    waits = {r.url: r.next_attempt for r in out.queue.collect()}
    assert waits["https://h.gov/busy"].minute == 1 and waits["https://h.gov/deeper"] is None


def test_robots_deny_all(spark):
    got, out = run(spark, SITE, crawl.CrawlOptions(), ["https://h.gov"], "User-agent: *\nDisallow: /")
    assert got == {"https://h.gov/": ("robots", 0)} and out.sightings.count() == 0


def test_newest_response_counts(spark):
    older = responses(spark, [("https://h.gov/", None, 200, HTML, page("/old"))]).withColumn("fetched_at", F.timestamp_seconds(F.lit(0)))
    links = crawl.link_table(older.unionByName(responses(spark, SITE[:1])))
    frontier = crawl.seed_frontier(spark.createDataFrame([("https://h.gov", 10)], "url string, priority int"), HostRules())
    out = crawl.crawl(frontier, links, robots.host_rules(spark.createDataFrame([], "domain string, body string")), crawl.CrawlOptions(max_depth=1), now())
    assert {r.url for r in out.queue.collect()} == {"https://h.gov/", "https://h.gov/next", "https://h.gov/report"}


@pytest.mark.parametrize("cap,known,completed", [(3, 0, 3), (3, 2, 1), (3, 5, 0), (100, 0, 8)])
def test_page_cap(spark, cap, known, completed):
    data = [(f"https://h.gov/p{i}", None, 200, HTML, page(f"/q{i}")) for i in range(8)] + [("https://h.gov/a.txt2", None, 200, {"Content-Type": "image/png"}, b"x")]
    urls = spark.createDataFrame([("h.gov", "html", f"https://h.gov/k{i}") for i in range(known)], "domain string, url_type string, canonical_url string")
    got, out = run(spark, data, crawl.CrawlOptions(max_depth=0, max_pages=cap), [d[0] for d in data], urls=urls)
    pages = sorted(u for u, (s, _) in got.items() if s == "completed" and "/p" in u)
    assert pages == [f"https://h.gov/p{i}" for i in range(completed)]
    # a job that yields no page is let through until the cap is reached; it sorts first here
    assert got["https://h.gov/a.txt2"][0] == ("completed" if known < cap else "domain_limit")
    assert sum(s == "domain_limit" for s, _ in got.values()) == 8 - completed + (known >= cap)


def test_document_cap(spark, rows):
    data = [("https://h.gov/", None, 200, HTML, page(*[f"/d{i}.pdf" for i in range(6)]))]
    docs = align(spark.createDataFrame([("https://h.gov/d5.pdf", "h.gov")], "canonical_url string, domain string"), schemas.DOCUMENTS)
    _, out = run(spark, data, crawl.CrawlOptions(max_documents=3), ["https://h.gov"], documents=docs)
    assert rows(out.sightings, "url") == [("https://h.gov/d0.pdf",), ("https://h.gov/d1.pdf",), ("https://h.gov/d5.pdf",)]


def queued(spark, rows):
    """A frontier of queue rows: (url, depth, attempts)."""
    return spark.createDataFrame([(u, 5, d, a) for u, d, a in rows], "url string, priority int, depth int, attempts int")


def test_policy_attempts_and_depth_of_queued_jobs(spark):
    busy = [("https://h.gov/busy", None, 429, {}, b""), ("https://h.gov/far", None, 200, HTML, page("/farther"))]
    links = crawl.link_table(responses(spark, busy))
    none = robots.host_rules(spark.createDataFrame([], "domain string, body string"))
    frontier = queued(spark, [("https://facebook.com/", 0, 0), ("https://h.gov/busy", 0, 6), ("https://h.gov/far", 4, 0), ("https://h.gov/none", 9, 0)])
    out = crawl.crawl(frontier, links, none, crawl.CrawlOptions(max_depth=2), now()).queue
    got = {r.url: (r.status, r.depth) for r in out.collect()}
    assert got == {"https://facebook.com/": ("skipped", 0), "https://h.gov/busy": ("queued", 0), "https://h.gov/far": ("completed", 4), "https://h.gov/none": ("queued", 9)}
    wait = out.filter("url = 'https://h.gov/busy'").select((F.unix_micros("next_attempt") - F.unix_micros(now())) / 1e6).first()[0]
    assert 32 <= wait < 96


def test_links_of_a_response_without_time(spark):
    links = crawl.link_table(responses(spark, SITE[:1]).withColumn("fetched_at", F.lit(None).cast("timestamp")))
    none = robots.host_rules(spark.createDataFrame([], "domain string, body string"))
    out = crawl.crawl(queued(spark, [("https://h.gov/", 0, 0)]), links, none, crawl.CrawlOptions(max_depth=1), now())
    assert "https://h.gov/next" in {r.url for r in out.queue.collect()}


def test_ties_of_time_keep_the_links_of_one_response(spark):
    links = crawl.link_table(responses(spark, [("https://h.gov/", None, 200, HTML, page("/a")), ("https://h.gov/", None, 200, HTML, page("/b"))]))
    none = robots.host_rules(spark.createDataFrame([], "domain string, body string"))
    out = crawl.crawl(queued(spark, [("https://h.gov/", 0, 0)]), links, none, crawl.CrawlOptions(max_depth=1), now())
    assert len({r.url for r in out.queue.collect()}) == 2


def test_crawl_does_not_depend_on_partitions(spark):
    first, _ = run(spark, SITE, crawl.CrawlOptions(), ["https://h.gov"])
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    second, _ = run(spark, list(reversed(SITE)), crawl.CrawlOptions(), ["https://h.gov"])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert first == second


def test_fetch_plan_spaces_a_domain(spark):
    jobs = spark.range(6).select((F.col("id") % 2).cast("string").alias("domain"), "id")
    planned = crawl.fetch_plan(jobs, now(), [F.col("id")])
    assert sorted((r.domain, r.earliest_start.second, r.earliest_start.microsecond) for r in planned.collect()) == [
        (d, *t) for d in "01" for t in [(0, 0), (0, 500000), (1, 0)]
    ]


def result_pages(spark, data):
    frame = spark.createDataFrame(data, "provider string, query string, page int, status int, retry_after string, html string")
    return frame.withColumn("fetched_at", now())


def test_result_page_parsing(spark, rows):
    long = "t" * 500
    markup = (
        "<div id=nav><a href='https://nav.gov'>n</a></div><div><h3><a href='https://r.search.yahoo.com/RU=https%3a%2f%2fa.gov%2fb.pdf/RK=2'>Bud <b>get</b></a></h3>"
        f"<p>Some text</p><script>no</script>{long}</div><ol class='x searchCenterMiddle'><li><a href='https://c.gov'>C</a> one<li><a href='https://d.gov'>D</a></ol>"
        "<h3><a href='https://search.yahoo.com/search?p=x'>own</a><a href='https://img.yimg.com/x'>i</a><a href='https://a.gov/b.pdf'>again</a><a>none</a></h3>"
    )
    plain = "<a href='https://e.gov/1'>E</a><a href='/rel'>r</a>"
    hits = resultpages.extract_hits(result_pages(spark, [("yahoo", "q", 1, 200, None, markup), ("yahoo", "q", 2, 200, None, plain), ("yahoo", "q", 3, 200, None, None)]))
    got = {(r.page, r.url): (r.title, r.snippet) for r in hits.collect()}
    assert set(got) == {(1, "https://a.gov/b.pdf"), (1, "https://c.gov"), (1, "https://d.gov"), (2, "https://e.gov/1")}
    assert got[(1, "https://a.gov/b.pdf")] == ("Bud get", f"Bud get Some text {long}"[:400])
    assert got[(1, "https://c.gov")] == ("C", "C one") and got[(2, "https://e.gov/1")] == ("E", "")


def test_unknown_provider():
    with pytest.raises(ValueError):
        resultpages.get_extractor("other")
    assert resultpages.get_extractor("Yahoo") is resultpages.extract_hits


def test_discovery_steps(spark, rows):
    agencies = spark.createDataFrame([("Texas", None, "tea.texas.gov", True)], "state string, agency_name string, domain string, active boolean")
    searches = materialize(discovery.add_plan(spark.createDataFrame([], schemas.SEARCHES), discovery.plan_searches(agencies, "yahoo", 2)), "searches")
    assert searches.count() == 10
    query = "site:tea.texas.gov filetype:pdf"
    pages = result_pages(spark, [
        ("yahoo", query, p, 200, None, f"<h3><a href='https://tea.texas.gov/{p}.pdf'>x</a></h3><h3><a href='https://tea.texas.gov/page{p}'>x</a><a href='https://evil.com'>x</a></h3>") for p in (1, 2)
    ] + [("yahoo", query + ' "audit"', 1, 429, "30", "")])
    empty = spark.createDataFrame([], schemas.SEARCH_RESULTS)
    after, stored, hits = discovery.fetch_step(searches, empty, pages, now())
    assert sorted(rows(after.filter("status <> 'pending'"), "query", "page", "status", "result_count"), key=str) == sorted([(query, 1, "completed", 3), (query, 2, "completed", 3), (query + ' "audit"', 1, "backoff", None)], key=str)
    routed = discovery.route_hits(hits, HostRules())
    assert rows(discovery.hit_sightings(routed, now()), "url", "source_url") == [(f"https://tea.texas.gov/{p}.pdf", "search:yahoo") for p in (1, 2)]
    queue = discovery.enqueue_hits(spark.createDataFrame([], schemas.CRAWL_QUEUE), routed, now())
    assert rows(queue, "url", "priority", "depth") == [(f"https://tea.texas.gov/page{p}", 5, 0) for p in (1, 2)]
    # stored pages answer without a capture
    again, _, cached = discovery.fetch_step(searches, stored, pages.limit(0), now())
    assert rows(again.filter("status = 'completed'"), "page", "result_count") == [(1, 3), (2, 3)] and cached.count() == 6
    one, _, _ = discovery.fetch_step(searches, empty, pages, now(), max_pages=1)
    assert rows(one.filter("status = 'completed'"), "page") == [(1,)]
