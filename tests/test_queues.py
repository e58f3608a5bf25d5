import hashlib
import random

import pytest
from pyspark.sql import functions as F

from paperfield import schemas
from paperfield.operators import bodies, queues
from paperfield.operators.tables import align
from paperfield.plans.download import download_step
from paperfield.plans.resume import resume
from paperfield.sources import writers

def now():
    return F.lit("2024-05-01 00:00:00").cast("timestamp")



def crawl_queue(spark, data):
    frame = spark.createDataFrame(data, "url string, status string, priority int, attempts int, na string, lu string")
    frame = frame.withColumns({"next_attempt": F.col("na").cast("timestamp"), "locked_until": F.col("lu").cast("timestamp"), "added_at": F.timestamp_seconds(F.lit(0))})
    return align(frame, schemas.CRAWL_QUEUE)


def test_claims_follow_priority(spark, rows):
    queue = crawl_queue(spark, [
        ("a", "queued", 0, 0, None, None), ("b", "queued", 10, 0, None, None), ("c", "queued", 5, 1, "2024-06-01", None),
        ("d", "queued", 5, 2, "2024-04-01", None), ("e", "failed", 10, 0, None, None),
    ])
    claimed = queues.claim(queue, now(), queues.crawl_order(), workers=2, per_worker=1)
    assert rows(claimed, "url", "worker_id", "attempts", "status") == [("b", "worker-1", 1, "processing"), ("d", "worker-2", 3, "processing")]
    assert claimed.select(F.unix_timestamp("locked_until") - F.unix_timestamp(now())).first()[0] == 300
    assert rows(queues.claim_all(queue, now(), queues.crawl_order(), 2), "url", "worker_id") == [("a", "worker-1"), ("b", "worker-1"), ("d", "worker-2")]
    after = queues.apply_changes(queue, claimed, ["url"])
    assert after.count() == 5 and rows(queues.next_jobs(after, now(), queues.crawl_order()), "url") == [("a",)]


def test_lease_sweep(spark, rows):
    queue = crawl_queue(spark, [("a", "processing", 0, 1, None, "2000-01-01"), ("b", "processing", 0, 1, None, "2030-01-01"), ("c", "processing", 0, 1, None, None)])
    assert rows(queues.release_expired(queue, now()), "url", "status") == [("a", "queued"), ("b", "processing"), ("c", "processing")]


def test_crawl_outcomes(spark, rows):
    queue = crawl_queue(spark, [(u, "processing", 0, 3, None, "2024-05-02") for u in "abcde"])
    outcomes = spark.createDataFrame(
        [("a", 429, 1.0, None), ("b", 200, None, "completed"), ("c", None, None, None), ("d", 503, None, "completed")],
        "url string, http_status int, retry_after double, result string",
    ).withColumn("at", now())
    done = {r.url: r for r in queues.finish_crawl(queue, outcomes).collect()}
    assert [done[u].status for u in "abcde"] == ["queued", "completed", "failed", "queued", "processing"]
    assert done["a"].next_attempt.second == 1 and done["d"].next_attempt is not None and done["b"].locked_until is None
    assert done["e"].locked_until is not None


def test_search_outcomes_and_provider_block(spark, rows):
    data = [("y", "q", p, s) for p, s in [(1, "running"), (2, "pending"), (3, "running"), (4, "completed"), (5, "running")]] + [("z", "q", 1, "pending")]
    searches = align(spark.createDataFrame(data, "provider string, query string, page int, status string"), schemas.SEARCHES)
    fine = spark.createDataFrame([("y", "q", 1, True, False, None, 7, None), ("y", "q", 3, False, False, 5.0, 0, "e" * 900)], "provider string, query string, page int, ok boolean, fatal boolean, retry_after double, hits int, error string").withColumn("at", now())
    tried = searches.withColumn("attempts", F.when(F.col("status") == "running", 1).otherwise(0))
    after = queues.finish_searches(tried, fine)
    got = {r.page: r for r in after.filter("provider = 'y'").collect()}
    assert (got[1].status, got[1].result_count, got[3].status, got[3].attempts, len(got[3].error), got[2].status) == ("completed", 7, "backoff", 1, 400, "pending")
    assert got[3].next_attempt.second == 5
    fatal = spark.createDataFrame([("y", "q", 5, False, True, 60.0, 0, "x")], fine.drop("at").schema).withColumn("at", now())
    blocked = queues.finish_searches(after, fatal)
    assert rows(blocked, "provider", "page", "status") == [
        ("y", 1, "completed"), ("y", 2, "blocked"), ("y", 3, "blocked"), ("y", 4, "completed"), ("y", 5, "blocked"), ("z", 1, "pending"),
    ]
    assert blocked.filter("provider = 'y' and page = 2").first().next_attempt.minute == 1


def test_part_assembly(spark):
    whole = b"%PDF-1.4 " + bytes(range(200))
    parts = [
        (1, 1, 200, 0, whole[:40]), (1, 2, 206, 40, whole[40:]),
        (2, 1, 200, 0, b"stale stale"), (2, 2, 206, 11, b"more"), (2, 3, 200, 0, whole),
        (3, 1, 429, 0, b"no"), (3, 2, 206, 0, whole[:3]), (3, 3, 206, 5, whole[5:]),
    ]
    frame = spark.createDataFrame([(*p[:4], bytearray(p[4])) for p in parts], schemas.PARTS)
    got = {r.doc_id: r for r in bodies.assemble_parts(frame).collect()}
    assert bytes(got[1].body) == whole and got[1].resumed and got[1].contiguous
    assert bytes(got[2].body) == whole and not got[2].resumed
    assert not got[3].contiguous


def download_tables(spark, attempts):
    urls = [(f"https://a.gov/{n}.pdf", a) for n, a in attempts.items()]
    queue = align(spark.createDataFrame(urls, "canonical_url string, attempts int"), schemas.DOWNLOAD_QUEUE, status=F.lit("processing"), locked_until=now())
    docs = align(spark.createDataFrame(urls, "canonical_url string, a int").drop("a"), schemas.DOCUMENTS, filename=F.lit("same.pdf"), download_status=F.lit("downloading"), state=F.lit("New York"))
    return queue, docs


def fetched(spark, data):
    frame = spark.createDataFrame([(f"https://a.gov/{n}.pdf", s, {"ETag": n}, bytearray(b) if b is not None else None, r) for n, s, b, r in data], "canonical_url string, http_status int, headers map<string,string>, body binary, resumed boolean")
    return frame.withColumn("at", now())


def test_download_step(spark):
    queue, docs = download_tables(spark, {"ok": 1, "copy": 1, "html": 1, "tired": 6, "fifth": 5, "htmlpart": 2, "idle": 1})
    batch = fetched(spark, [("ok", 200, b"%PDF-x", False), ("copy", 200, b"%PDF-x", False), ("html", 200, b" <!DOCTYPE html>", False), ("tired", 503, None, False), ("fifth", 404, b"x", False), ("htmlpart", 206, b"<html", True)])
    step = download_step(queue, docs, batch, "root")
    q = {r.canonical_url[14:-4]: r for r in step.queue.collect()}
    d = {r.canonical_url[14:-4]: r for r in step.documents.collect()}
    digest = hashlib.sha256(b"%PDF-x").hexdigest()
    assert {k: v.status for k, v in q.items()} == {"ok": "completed", "copy": "completed", "html": "queued", "tired": "failed", "fifth": "queued", "htmlpart": "completed", "idle": "processing"}
    assert (d["ok"].download_status, d["ok"].sha256, d["ok"].content_length, d["ok"].etag) == ("complete", digest, 6, "ok")
    assert d["ok"].download_path == d["copy"].download_path == f"root/{digest[:2]}/{digest[2:4]}/{digest}.pdf"
    assert (d["tired"].download_status, d["tired"].http_status, d["tired"].error) == ("failed", 503, "http 503")
    assert d["html"].error == "response is html, not pdf" and q["html"].next_attempt is not None and q["fifth"].next_attempt is not None
    assert d["idle"].download_status == "downloading"
    assert sorted((r.copies, bytes(r.body)) for r in step.bodies.collect()) == [(1, b"<html"), (2, b"%PDF-x")]


def test_by_state_layout_numbers_collisions(spark):
    queue, docs = download_tables(spark, {"a": 1, "b": 1, "c": 1})
    batch = fetched(spark, [("a", 200, b"%PDF-1", False), ("b", 200, b"%PDF-2", False), ("c", 200, b"%PDF-1", False)])
    step = download_step(queue, docs, batch, "root", layout="by_state")
    got = {r.canonical_url[14:-4]: r.download_path for r in step.documents.collect()}
    assert got == {"a": "root/New_York/same.pdf", "b": "root/New_York/same__2.pdf", "c": "root/New_York/same.pdf"}


def test_collision_numbers_do_not_depend_on_the_path_taken(spark, rows):
    files = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot.pdf").otherwise(F.concat(F.lit("f"), F.col("id") % 7)).alias("dest"), F.md5((F.col("id") % 900).cast("string")).alias("sha256"), F.col("id").alias("arrived"))
    assert len(rows(bodies.number_collisions(files))) == files.select("dest", "sha256").distinct().count()


def test_resume(spark, rows):
    queue, docs = download_tables(spark, {"a": 1})
    queue = queue.withColumn("locked_until", F.lit("2000-01-01").cast("timestamp"))
    searches = align(spark.createDataFrame([("y", "q", 1, "running")], "provider string, query string, page int, status string"), schemas.SEARCHES)
    out = resume(searches, crawl_queue(spark, [("u", "processing", 0, 1, None, "2000-01-01")]), queue, docs, now())
    assert rows(out["documents"], "download_status") == [("queued",)]
    assert {n: rows(out[n], "status") for n in ("searches", "crawl_queue", "download_queue")} == {"searches": [("pending",)], "crawl_queue": [("queued",)], "download_queue": [("queued",)]}
    again = resume(out["searches"], out["crawl_queue"], out["download_queue"], out["documents"], now())
    assert all(rows(again[n]) == rows(out[n]) for n in out)


def test_names_go_on_after_stored_ones(spark):
    stored = spark.createDataFrame([("s/r.pdf", "d1"), ("s/r__2.pdf", "d2"), ("s/q.pdf", "d9")], "path string, sha256 string")
    files = spark.createDataFrame([("s/r.pdf", "d2", 1), ("s/r.pdf", "d3", 2), ("s/r.pdf", "d4", 3), ("s/new.pdf", "d5", 4), ("s/q.pdf", "d9", 5)], "dest string, sha256 string, arrived int")
    got = {r.sha256: r.final_path for r in bodies.number_collisions(files, stored).collect()}
    assert got == {"d2": "s/r__2.pdf", "d3": "s/r__3.pdf", "d4": "s/r__4.pdf", "d5": "s/new.pdf", "d9": "s/q.pdf"}


def test_parts_overlaps_gaps_and_batches(spark):
    whole = bytes(range(60))
    one = [(1, 1, 206, 0, whole[:4]), (1, 2, 206, 2, whole[2:6]), (1, 3, 206, 8, whole[8:10]), (2, 1, 200, 0, whole[:30]), (3, 1, 206, 20, whole[20:60]), (4, 1, 429, 0, b"no"), (5, 1, 200, 0, b"")]
    two = [(1, 4, 206, 5, whole[5:9]), (2, 2, 206, 25, whole[25:]), (3, 2, 206, 0, whole[:20]), (3, 3, 206, 10, whole[10:30]), (2, 1, 200, 0, whole[:31])]
    totals = {1: 10, 2: 60, 3: 60, 4: None, 5: None}
    frames = [spark.createDataFrame([(*p[:4], bytearray(p[4]), totals[p[0]]) for p in batch], "doc_id long, part_no int, status int, offset long, bytes binary, total long") for batch in (one, two)]
    first = bodies.advance_parts(frames[0], frames[0].limit(0))
    got = {r.doc_id: r for r in first.bodies.collect()}
    assert {k: (bytes(r.body), r.contiguous, r.whole) for k, r in got.items()} == {1: (whole[:6], False, False), 2: (whole[:30], True, False), 3: (b"", False, False), 5: (b"", True, True)}
    second = bodies.advance_parts(frames[1], first.open)
    got = {r.doc_id: (bytes(r.body), r.whole) for r in second.bodies.collect()}
    assert got == {1: (whole[:10], True), 2: (whole, True), 3: (whole, True)}
    assert second.open.count() == 0
    with pytest.raises(Exception, match="part numbers repeat"):
        bodies.assemble_parts(frames[0].unionByName(frames[0])).collect()


def test_parts_of_unclaimed_jobs_do_not_count(spark):
    def parts(data):
        return spark.createDataFrame([(k, n, 206, at, bytearray(b), h) for k, n, at, b, h in data], "doc_id long, part_no int, status int, offset long, bytes binary, headers map<string,string>")

    batch = parts([(1, 2, 2, b"cd", {"ETag": "new"}), (2, 1, 0, b"ab", {}), (None, 1, 0, b"x", {}), (4, 1, 0, b"ab", {"ETag": "a"}), (4, 2, 2, b"c", {"ETag": "b"})])
    earlier = parts([(1, 1, 0, b"ab", {"ETag": "old"}), (2, 9, 5, b"q", {}), (3, 1, 3, b"z", {"ETag": "z"}), (None, 1, 7, b"n", {})])
    claimed = spark.createDataFrame([(1,), (1,), (3,), (4,), (None,)], "doc_id long")
    found = bodies.advance_parts(batch, earlier, claimed=claimed, carry=["headers"])
    got = {r.doc_id: (bytes(r.body), r.whole, r.newest and r.newest.headers["ETag"]) for r in found.bodies.collect()}
    assert got == {1: (b"abcd", True, "new"), 2: (b"", False, None), 3: (b"", False, None), 4: (b"abc", True, "b")}
    assert found.open.columns == batch.columns
    assert sorted((r.doc_id or 0, r.part_no, bytes(r.bytes)) for r in found.open.collect()) == [(0, 1, b"n"), (2, 9, b"q"), (3, 1, b"z")]


def test_answers_of_unclaimed_jobs_move_no_body(spark):
    queue, docs = download_tables(spark, {"a": 1, "b": 1})
    batch = fetched(spark, [("a", 200, b"%PDF-1", False), ("b", 200, b"%PDF-2", False)])
    claimed = queue.filter("canonical_url like '%/a.pdf'").select("canonical_url")
    step = download_step(queue, docs, batch, "root", claimed=claimed)
    assert sorted(r.status for r in step.queue.collect()) == ["completed", "processing"]
    assert [(r.copies, bytes(r.body)) for r in step.bodies.collect()] == [(1, b"%PDF-1")]
    assert "canonical_url" not in "".join(x for x in step.bodies._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x)


def test_a_batch_writes_one_file_a_bucket(spark, tmp_path):
    unique = spark.range(1500).repartition(4).select(F.sha2(F.col("id").cast("string"), 256).alias("sha256"), F.col("id").cast("string").cast("binary").alias("body"))
    writers.write_bodies(unique, str(tmp_path / "bodies"))
    folders = [list(d.glob("*.parquet")) for d in (tmp_path / "bodies").glob("bucket=*")]
    assert len(folders) > 200 and all(len(files) == 1 for files in folders)
    back = spark.read.parquet(str(tmp_path / "bodies"))
    assert back.filter(writers.body_bucket(F.col("sha256")) == F.col("bucket")).count() == 1500


def names_one_by_one(files, taken):
    """The rule for a batch, step by step: plain names first, then numbers in order of arrival."""
    taken, given = dict(taken), {}
    firsts = {}
    for dest, digest, arrived in sorted(files, key=lambda f: (f[2], f[1])):
        firsts.setdefault((dest, digest), arrived)
    order = sorted(firsts, key=lambda f: (firsts[f], f[1]))
    stored = set(taken)
    for dest, digest in order:
        if dest not in taken or dest in stored and taken[dest] == digest:
            given[dest, digest] = dest
            taken[dest] = digest
    for dest, digest in order:
        if (dest, digest) in given:
            continue
        stem, dot, ext = dest.rpartition(".") if "." in dest.rsplit("/", 1)[-1] else (dest, ".", "pdf")
        names = [f"{stem}__{n}{dot}{ext}" for n in range(2, 200)]
        same = [n for n in names if taken.get(n) == digest]
        name = (same or [n for n in names if n not in taken])[0]
        taken[name] = digest
        given[dest, digest] = name
    return given, taken


@pytest.mark.parametrize("seed", range(4))
def test_names_never_meet(spark, seed):
    r = random.Random(seed)
    dests = ["s/a.pdf", "s/a", "s/a__2.pdf", "s/a__3.pdf", "s/a__03.pdf", "s/a__2__2.pdf", "s/a__1.pdf", "t/a.pdf", "s/b.txt", "s/b__4.txt"]
    taken, stored = {}, spark.createDataFrame([], "path string, sha256 string")
    for batch in range(3):
        files = [(r.choice(dests), f"d{r.randrange(9)}", 100 * batch + i) for i in range(25)]
        want, taken = names_one_by_one(files, taken)
        found = bodies.number_collisions(spark.createDataFrame(files, "dest string, sha256 string, arrived long"), stored).collect()
        assert {(x.dest, x.sha256): x.final_path for x in found} == want and len(found) == len(want)
        stored = spark.createDataFrame(list(taken.items()), "path string, sha256 string")
        owners = {}
        for x in found:
            assert owners.setdefault(x.final_path, x.sha256) == x.sha256


def test_bodies_stay_out_of_the_joins_of_facts(spark):
    queue, docs = download_tables(spark, {"a": 1, "b": 1})
    step = download_step(queue, docs, fetched(spark, [("a", 200, b"%PDF-1", False), ("b", 200, b"%PDF-2", False)]), "root")
    for frame in (step.queue, step.documents):
        assert "body" not in frame._jdf.queryExecution().executedPlan().toString()
    plan = step.bodies._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len([x for x in exchanges if "sha256" in x]) <= 2 and "SortAggregate" not in plan
