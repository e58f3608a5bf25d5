"""Streams cut into many batches give the rows of their batch forms; restarts change nothing."""

import random

import pytest
from pyspark.sql import functions as F

from paperfield.operators import robots
from paperfield.operators.policy import HostRules
from paperfield.plans import crawl as plans
from paperfield.session import new_location
from paperfield.streaming import counts, crawl, dedup, ingest, leases, retries
from paperfield.streaming.runner import file_stream
from paperfield.streaming.state import BucketedState


@pytest.fixture(scope="module")
def events(spark):
    """The events in five files, in time order."""
    path = new_location(spark, "event-files")
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    for number in range(5):
        rows.filter(F.floor(F.col("event_id") / 200) == number).coalesce(1).write.mode("append").parquet(path)
    assert rows.count() == 1000
    return path, spark.read.parquet(path)


def stream(spark, events):
    return file_stream(spark, events[0], events[1].schema, files_per_batch=1)


def lease_events(rows):
    kind = F.when(F.col("event_type") == "click", "claim").otherwise("done")
    return rows.select(F.col("user_id").cast("string").alias("job"), "ts", "event_id", kind.alias("kind"))


def outcomes(rows):
    picked = rows.filter(F.col("event_type").isin("error", "view", "purchase"))
    return picked.select((F.col("user_id") % 5).cast("string").alias("job"), "ts", "event_id", ((F.col("event_type") == "purchase") & (F.col("event_id") % 3 == 0)).alias("ok"))


def test_dedup_over_batches(spark, events, rows):
    key = F.concat("event_type", F.col("user_id").cast("string")).alias("key")
    found = dedup.first_seen_stream(stream(spark, events).select(key, "event_id"), "key", ["event_id"])
    assert rows(found) == rows(events[1].groupBy(key).agg(F.min("event_id")))


@pytest.mark.parametrize("buckets,deltas", [(1, 0), (3, 1), (16, 8)])
def test_dedup_over_small_buckets(spark, events, rows, buckets, deltas):
    key = F.concat("event_type", (F.col("user_id") % 40).cast("string")).alias("key")
    found = dedup.first_seen_stream(stream(spark, events).select(key, "event_id"), "key", ["event_id"], buckets=buckets, deltas=deltas)
    assert rows(found) == rows(events[1].groupBy(key).agg(F.min("event_id")))


def test_state_reads_and_rewrites_touched_buckets_only(spark, rows):
    state = BucketedState(spark, new_location(spark, "state"), spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("v")).schema, ["k"], buckets=8, deltas=1)
    batches = [[(i, 0) for i in range(64)], [(1, 1), (200, 1)], [], [(1, 3)], [(1, 4), (2, 4)]]
    want = {}
    for number, batch in enumerate(batches):
        want |= dict(batch)
        state.write(spark.createDataFrame(batch, "k long, v long"), number)
        assert rows(state.read(number)) == sorted(want.items(), key=repr)
        if batch and number:
            written = spark.read.parquet(f"{state.root}/rows/v{number}")
            assert written.count() == len(batch)
    assert rows(state.read(1)) == rows(spark.createDataFrame([(i, 0) for i in range(64) if i != 1] + [(1, 1), (200, 1)], "k long, v long"))
    key = spark.createDataFrame([(2, 9)], "k long, v long")
    files = state.lookup(key, 4).inputFiles()
    assert files and {f.split("bucket=")[1].split("/")[0] for f in files} == {str(b) for b in state.touched(key)}
    assert rows(state.unseen(spark.createDataFrame([(2, 0), (999, 0), (200, 0)], "k long, v long"), 4)) == [(999, 0)]
    state.write(spark.createDataFrame([(2, 7)], "k long, v long"), 4)  # the batch is replayed
    assert rows(state.lookup(key, 4)) == [(2, 7)] and rows(state.lookup(spark.createDataFrame([(1, 0)], "k long, v long"), 4)) == [(1, 3)]


def test_dedup_with_state_store_keeps_the_same_keys(spark, events, rows):
    key = F.concat("event_type", F.col("user_id").cast("string")).alias("key")
    found = dedup.first_seen_stream(stream(spark, events).select(key, "event_id", "ts"), "key", ["event_id"], event_time="ts")
    assert rows(found, "key") == rows(events[1].select(key).distinct())


@pytest.mark.parametrize("delay", [0, 86400])
def test_leases_over_batches(spark, events, rows, delay):
    batch = leases.expired_leases(lease_events(events[1]), delay, 7200)
    found = leases.expired_leases_stream(lease_events(stream(spark, events)), delay_seconds=delay, lease_seconds=7200)
    assert batch.count() > 0 and rows(found) == rows(batch)


def test_leases_run_out_without_their_job_and_finished_jobs_leave(spark, rows):
    path, root = new_location(spark, "lease-files"), new_location(spark, "leases")
    batches = [[("a", 0, 1, "claim"), ("b", 10, 2, "claim"), ("b", 20, 3, "done")], [("c", 90, 4, "done")], [("c", 150, 5, "claim")], [("d", 400, 6, "done")]]
    left = []
    for number, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, "job string, s long, event_id long, kind string").withColumn("ts", F.timestamp_seconds("s")).drop("s")
        frame.coalesce(1).write.mode("append").parquet(path)
        found = leases.expired_leases_stream(file_stream(spark, path, frame.schema), root, lease_seconds=100)
        left.append((rows(found, "job"), rows(spark.read.parquet(f"{root}/state/v{number}"), "job")))
    assert left == [([], [("a",), ("b",)]), ([], [("a",), ("c",)]), ([("a",)], [("c",)]), ([("a",), ("c",)], [("d",)])]


def test_retries_over_batches(spark, events, rows):
    batch = retries.retry_states(outcomes(events[1]))
    assert {r.status for r in batch.collect()} >= {"failed"}
    assert rows(retries.retry_states_stream(outcomes(stream(spark, events)))) == rows(batch)


def test_late_outcomes_give_the_batch_answer(spark, events, rows):
    picked = outcomes(events[1])
    want = rows(retries.retry_states(picked))
    path = new_location(spark, "late")
    for part in (3, 0, 4, 1, 2):  # files in an order that is not that of time, and one of them twice
        picked.filter(F.floor(F.col("event_id") / 200) == part).coalesce(1).write.mode("append").parquet(path)
    picked.filter(F.floor(F.col("event_id") / 200) == 0).coalesce(1).write.mode("append").parquet(path)
    late = file_stream(spark, path, picked.schema, files_per_batch=1)
    assert rows(retries.retry_states_stream(late, buckets=2)) == want


def test_retry_fold_statuses(spark):
    data = [("a", i, False) for i in range(9)] + [("b", 0, False), ("b", 1, True), ("b", 2, False)] + [("c", 0, False), ("c", 1, False)]
    frame = spark.createDataFrame(data, "job string, event_id long, ok boolean").withColumn("ts", F.timestamp_seconds("event_id"))
    got = {r.job: (r.status, r.failures, r.next_attempt is not None) for r in retries.retry_states(frame).collect()}
    assert got == {"a": ("failed", 6, False), "b": ("completed", 1, False), "c": ("queued", 2, True)}


def test_counts_over_batches(spark, events, rows):
    found = counts.windowed_counts_stream(stream(spark, events), delay="1 hour")
    closed = events[1].agg((F.max("ts") - F.expr("interval 1 hour")).alias("m")).first().m
    batch = counts.windowed_counts(events[1]).filter(F.col("start") + F.expr("interval 1 day") <= F.lit(closed))
    assert rows(found) == rows(batch)


def test_ingest_over_batches_and_restart(spark, rows):
    path, root = new_location(spark, "hit-files"), new_location(spark, "ingest")
    batches = [[], ["https://a.gov/1.pdf", "https://a.gov/p", "https://b.com/x"], ["https://a.gov/1.pdf?utm_id=3", "https://a.gov/p#z", "https://a.gov/2.pdf"], []]
    spark.createDataFrame([], "provider string, url string").write.parquet(path)
    for links in batches:
        frame = spark.createDataFrame([("yahoo", u) for u in links], "provider string, url string").coalesce(1)
        hits = frame.schema
        if links:
            frame.write.mode("append").parquet(path)
        out = ingest.ingest_stream(file_stream(spark, path, hits), HostRules(), lambda n: f"2024-05-0{n + 1} 00:00:00", root)
    assert rows(out.documents, "canonical_url", F.day("first_seen"), F.day("last_seen")) == [("https://a.gov/1.pdf", 2, 3), ("https://a.gov/2.pdf", 3, 3)]
    assert rows(out.crawl_queue, "url", F.day("added_at")) == [("https://a.gov/p", 2)]
    assert out.download_queue.count() == 2


def site(spark, seed=1, pages=60):
    """Answers of a small web: pages with links, documents, throttled and missing ones."""
    r = random.Random(seed)
    html, data = {"Content-Type": "text/html"}, []
    for i in range(pages):
        if i % 11 == 7:
            continue
        body = "".join(f"<a href='https://h{t % 3}.a.gov/{t}'>x</a>" for t in r.sample(range(pages), 3)) + (f"<a href='/f{i}.pdf'>f</a>" if i % 4 == 0 else "")
        kind = {"Content-Type": "application/pdf"} if i % 9 == 5 else html
        address = f"https://h{i % 3}.a.gov/{i}"
        data.append((address, address, 503 if i % 13 == 3 else 200, kind, bytearray(body.encode())))
    frame = spark.createDataFrame(data, "request_url string, final_url string, status int, headers map<string,string>, body binary")
    return frame.withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))


def crawled(out, rows):
    jobs = rows(out.queue, "url", "depth", "priority", "status", "http_status", "next_attempt")
    return jobs, rows(out.sightings), rows(out.urls)


def test_crawl_over_batches(spark, rows):
    answers = site(spark).cache()
    seeds = spark.createDataFrame([("https://h0.a.gov/0", 10), ("https://h2.a.gov/17", 10)], "url string, priority int")
    rules = robots.host_rules(spark.createDataFrame([("h1.a.gov", "User-agent: *\nDisallow: /1")], "domain string, body string"))
    options = plans.CrawlOptions(max_depth=3, max_documents=5)
    at = F.lit("2024-01-02").cast("timestamp")
    links = plans.link_table(answers).cache()
    want = crawled(plans.crawl(plans.seed_frontier(seeds, options.rules), links, rules, options, at), rows)
    assert len(want[0]) > 30 and len({j[1] for j in want[0]}) == 4
    path, root = new_location(spark, "answers"), new_location(spark, "crawl")
    part = F.regexp_extract("request_url", "([0-9]+)$", 1).cast("int") % 4
    answers.limit(0).write.parquet(path)
    for number in range(4):
        answers.filter(part == number).coalesce(1).write.mode("append").parquet(path)
        if number % 2:  # every second time the stream is started anew and finds two more files
            got = crawl.crawl_stream(file_stream(spark, path, answers.schema, files_per_batch=1), seeds_of(spark, seeds, options), rules, options, at, root, buckets=4)
    assert crawled(got, rows) == want


def seeds_of(spark, seeds, options):
    return plans.seed_frontier(seeds, options.rules)


def test_crawl_page_cap_over_batches(spark, rows):
    answers = site(spark)
    seeds = plans.seed_frontier(spark.createDataFrame([(f"https://h{i % 3}.a.gov/{i}", 10) for i in range(0, 60, 2)], "url string, priority int"), HostRules())
    rules = robots.host_rules(spark.createDataFrame([], "domain string, body string"))
    options = plans.CrawlOptions(max_depth=2, max_pages=4)
    path = new_location(spark, "answers")
    for number in range(3):
        answers.filter(F.regexp_extract("request_url", "([0-9]+)$", 1).cast("int") % 3 == number).coalesce(1).write.mode("append").parquet(path)
    out = crawl.crawl_stream(file_stream(spark, path, answers.schema, files_per_batch=1), seeds, rules, options, F.lit("2024-01-02").cast("timestamp"), buckets=2)
    pages = out.urls.filter("url_type = 'html'").groupBy("domain").count()
    assert rows(pages) == [("h0.a.gov", 4), ("h1.a.gov", 4), ("h2.a.gov", 4)]
    assert out.queue.filter("status = 'domain_limit'").count() > 0
