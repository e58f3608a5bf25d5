"""Queue, lease and status queries over the event log."""

from pyspark.sql import functions as F

from paperfield import schemas
from paperfield.catalog.registry import (
    CRAWL_JOBS,
    NOW,
    PAGES,
    SEARCH_PAGES,
    crawl_jobs,
    now,
    plain,
    query,
    search_pages,
    table,
)
from paperfield.functions.retry import DOWNLOAD_LEASE_SECONDS
from paperfield.functions.urls import canonical_url, domain_of
from paperfield.operators import queues, status
from paperfield.operators.tables import align
from paperfield.plans.crawl import domain_cap, fetch_plan
from paperfield.plans.resume import resume

_T = f"timestamp '{NOW}'"
_DUE = f"status = 'queued' and (next_attempt is null or next_attempt <= {_T})"


@query(f"with {CRAWL_JOBS} select url, cast(priority as bigint) as priority, added_at from jobs where {_DUE} order by priority desc, added_at, url limit 100")
def due_jobs_topk(spark, folder):
    top = queues.next_jobs(crawl_jobs(spark, folder), now(), queues.crawl_order(), 100)
    return top.select("url", F.col("priority").cast("bigint").alias("priority"), plain("added_at"))


@query(
    f"""with {SEARCH_PAGES} select provider, query, min(page) as page from searches
    where status in ('pending','backoff') and (next_attempt is null or next_attempt <= {_T}) group by 1, 2"""
)
def per_query_next(spark, folder):
    """The next due result page of every query."""
    due = queues.next_page_per_query(search_pages(spark, folder), now())
    return due.select("provider", "query", F.col("page").cast("bigint").alias("page"))


@query(f"with {SEARCH_PAGES} select query, page from searches where status in ('pending','backoff') and (next_attempt is null or next_attempt <= {_T}) order by query, page limit 50")
def search_next_topk(spark, folder):
    top = queues.next_search_pages(search_pages(spark, folder), now(), 50)
    return top.select("query", F.col("page").cast("bigint").alias("page"))


_CLAIM = f"""with {CRAWL_JOBS}, due as (select *, row_number() over (order by priority desc, added_at, url) as rn from jobs where {_DUE})
    select url, 'worker-' || ((rn - 1) % 16 + 1) as worker_id, cast(attempts + 1 as bigint) as attempts, {_T} + interval 300 second as locked_until from due"""


def _claimed(rows):
    return rows.select("url", "worker_id", F.col("attempts").cast("bigint").alias("attempts"), plain("locked_until"))


@query(f"{_CLAIM} where rn <= 320")
def claim_batch(spark, folder):
    """Twenty jobs for each of sixteen workers."""
    jobs = crawl_jobs(spark, folder)
    return _claimed(queues.claim(jobs, now(), queues.crawl_order(), 16, 20))


@query(_CLAIM)
def claim_everything(spark, folder):
    """Every due job, dealt to sixteen workers in order."""
    return _claimed(queues.claim_all(crawl_jobs(spark, folder), now(), queues.crawl_order(), 16))


def _page_jobs(spark, folder):
    pages = table(spark, folder, "pages")
    jobs = pages.select("page_id", canonical_url(F.col("url")).alias("url"), (F.col("page_id") % 3).cast("int").alias("priority"))
    return jobs.withColumn("domain", domain_of(F.col("url")))


@query(
    f"""with {PAGES}, jobs as (select distinct page_id, canonical as url, host as domain, page_id % 3 as priority from canon),
    used as (select host as domain, count(*) as n from canon where page_id % 4 = 0 group by 1),
    ranked as (select *, row_number() over (partition by domain order by priority desc, url, page_id) as rn from jobs)
    select page_id, r.domain, rn as rank from ranked r left join used u on r.domain = u.domain where rn <= 8 - coalesce(n, 0)"""
)
def domain_cap_jobs(spark, folder):
    """At most eight jobs per domain, less what the domain used before."""
    jobs = _page_jobs(spark, folder)
    used = jobs.filter("page_id % 4 = 0").groupBy("domain").agg(F.count("*").alias("n"))
    order = [F.desc("priority"), F.col("url"), F.col("page_id")]
    return domain_cap(jobs, 8, used, order).select("page_id", "domain", F.col("rank").cast("bigint").alias("rank"))


@query(
    f"""with {PAGES}, jobs as (select page_id, canonical as url, host as domain, page_id % 3 as priority from canon)
    select page_id, domain, {_T} + to_milliseconds((row_number() over (partition by domain order by priority desc, url, page_id) - 1) * 500) as earliest_start from jobs"""
)
def fetch_schedule(spark, folder):
    """Start times that leave each domain two requests per second."""
    order = [F.desc("priority"), F.col("url"), F.col("page_id")]
    planned = fetch_plan(_page_jobs(spark, folder), now(), order)
    return planned.select("page_id", "domain", plain("earliest_start"))


@query(
    f"""with {CRAWL_JOBS} select url, case when status = 'processing' and locked_until < {_T} then 'queued' else status end as status,
    case when not (status = 'processing' and locked_until < {_T}) then locked_until end as locked_until from jobs"""
)
def lease_sweep(spark, folder):
    swept = queues.release_expired(crawl_jobs(spark, folder), now())
    return swept.select("url", "status", plain("locked_until"))


def _downloads(spark, folder):
    jobs = crawl_jobs(spark, folder).withColumnRenamed("url", "canonical_url")
    queue = align(jobs, schemas.DOWNLOAD_QUEUE)
    state = F.when(F.col("status") == "processing", "downloading").when(F.col("status") == "completed", "complete").otherwise(F.col("status"))
    docs = align(jobs.select("canonical_url", state.alias("download_status")), schemas.DOCUMENTS)
    return queue, docs


@query(
    f"""with {CRAWL_JOBS} select url as canonical_url, case status when 'processing' then case when locked_until < {_T} then 'queued' else 'downloading' end when 'completed' then 'complete' else status end as download_status from jobs"""
)
def document_lease_sweep(spark, folder):
    queue, docs = _downloads(spark, folder)
    return queues.release_documents(docs, queue, now()).select("canonical_url", "download_status")


@query(f"with {CRAWL_JOBS} select url as canonical_url, added_at, status as download_status from jobs where {_DUE}")
def due_downloads(spark, folder):
    """Due download jobs joined with their documents."""
    queue, docs = _downloads(spark, folder)
    due = queues.due_downloads(queue, docs, now())
    return due.select("canonical_url", plain("added_at"), "download_status")


@query(
    f"""with {CRAWL_JOBS}, {SEARCH_PAGES} select 'crawl_queue' as origin, case when status = 'processing' and locked_until < {_T} then 'queued' else status end as status, count(*) as n from jobs group by 2
    union all select 'searches', case when status = 'running' then 'pending' else status end, count(*) from searches group by 2"""
)
def resume_states(spark, folder):
    """Statuses after recovery from an interruption."""
    queue, docs = _downloads(spark, folder)
    out = resume(search_pages(spark, folder), crawl_jobs(spark, folder), queue, docs, now())
    parts = [out[t].groupBy("status").agg(F.count("*").alias("n")).select(F.lit(t).alias("origin"), "status", "n") for t in ("crawl_queue", "searches")]
    return parts[0].unionByName(parts[1])


_WAIT = "least(120.0, pow(2.0, attempts)) * (0.5 + cast(('0x' || substr(md5(url || '|' || attempts), 1, 8)) as bigint) / 4294967296.0)"


@query(
    f"""with {CRAWL_JOBS}, done as (select *, cast(regexp_extract(url, '[0-9]+$', 0) as bigint) % 5 as r from jobs)
    select url, case when status <> 'processing' then status when r in (0, 1) then 'queued' when r = 2 then 'failed' else 'completed' end as status,
      case when status = 'processing' and r = 0 then cast(30000000 as bigint) when status = 'processing' and r = 1 then cast(round({_WAIT} * 1000000) as bigint) end as wait_us from done"""
)
def crawl_outcomes(spark, folder):
    """Running crawl jobs finished: throttled with and without a header, broken, completed."""
    jobs = crawl_jobs(spark, folder)
    rest = F.regexp_extract("url", "[0-9]+$", 0).cast("bigint") % 5
    outcomes = jobs.filter("status = 'processing'").select(
        "url",
        F.when(rest == 0, 429).when(rest == 1, 503).when(rest == 2, F.lit(None)).otherwise(200).alias("http_status"),
        F.when(rest == 0, 30.0).alias("retry_after"),
        F.when(rest != 2, "completed").alias("result"),
        now().alias("at"),
    )
    after = queues.finish_crawl(jobs.withColumn("next_attempt", F.lit(None).cast("timestamp")), outcomes)
    wait = F.unix_micros("next_attempt") - F.unix_micros(now())
    return after.select("url", "status", wait.alias("wait_us"))


@query(
    f"""with {SEARCH_PAGES}, bad as (select provider, bool_or(page % 101 = 0 and provider <> 'p2') as fatal from searches where status = 'running' group by 1),
    applied as (select s.provider, query, page, case when status <> 'running' then status when page % 101 = 0 and s.provider <> 'p2' then 'blocked' when page % 3 = 0 then 'backoff' else 'completed' end as status,
      attempts, fatal from searches s left join bad b on b.provider = s.provider)
    select provider, query, page, case when fatal and status in ('pending','backoff') then 'blocked' else status end as status, cast(attempts as bigint) as attempts from applied"""
)
def provider_block(spark, folder):
    """Running result pages finished; a fatal answer blocks its whole provider."""
    searches = search_pages(spark, folder)
    fatal = (F.col("page") % 101 == 0) & (F.col("provider") != "p2")
    bad = fatal | (F.col("page") % 3 == 0)
    outcomes = searches.filter("status = 'running'").select(
        "provider", "query", "page", (~bad).alias("ok"), fatal.alias("fatal"), F.lit(None).cast("double").alias("retry_after"),
        F.lit(3).alias("hits"), F.lit("http 403").alias("error"), now().alias("at"),
    )
    after = queues.finish_searches(searches, outcomes)
    return after.select("provider", "query", F.col("page").cast("bigint").alias("page"), "status", F.col("attempts").cast("bigint").alias("attempts"))


@query(f"with {SEARCH_PAGES} select provider, query, count(*) as pages from searches where status in ('pending','backoff') group by 1, 2")
def pending_per_query(spark, folder):
    return status.pending_pages(search_pages(spark, folder))


@query(
    f"""with {CRAWL_JOBS}, {SEARCH_PAGES} select 'crawl_queued' as metric, count(*) filter (status = 'queued') as value from jobs union all
    select 'crawl_processing', count(*) filter (status = 'processing') from jobs union all select 'crawl_done', count(*) filter (status = 'completed') from jobs union all
    select 'crawl_failed', count(*) filter (status = 'failed') from jobs union all select 'searches', count(*) from searches union all
    select 'searches_done', count(*) filter (status = 'completed') from searches union all
    select 'searches_pending', count(*) filter (status in ('pending','running','backoff')) from searches union all
    select 'searches_blocked', count(*) filter (status = 'blocked') from searches"""
)
def status_counts(spark, folder):
    return status.table_counts({"crawl_queue": crawl_jobs(spark, folder), "searches": search_pages(spark, folder)})


@query(
    f"""with {CRAWL_JOBS} select 'CRAWLER' as section, case status when 'queued' then 'queued' when 'processing' then 'processing' when 'completed' then 'completed' else 'failed' end as metric, count(*) as value from jobs group by 2
    union all select 'STORAGE', 'PDFs', count(*) from documents union all select 'STORAGE', 'bytes', cast(sum(octet_length(encode(text))) as bigint) from documents"""
)
def status_report(spark, folder):
    """Crawler and storage sections of the status page."""
    counts = status.table_counts({"crawl_queue": crawl_jobs(spark, folder)})
    files = table(spark, folder, "documents").select(F.octet_length("text").alias("length"))
    return status.status_report(counts, status.storage_stats(files)).filter("section in ('CRAWLER', 'STORAGE')")


@query(
    f"""with {PAGES} select host as domain, count(*) filter (page_id % 5 <> 0) as html_pages, cast(0 as bigint) as documents from canon group by 1
    union all select source || '.example.gov', 0, count(*) from documents group by 1"""
)
def domain_counts(spark, folder):
    """HTML pages and documents per domain."""
    pages = _page_jobs(spark, folder).withColumn("url_type", F.when(F.col("page_id") % 5 != 0, "html").otherwise("pdf"))
    docs = table(spark, folder, "documents").select(F.concat("source", F.lit(".example.gov")).alias("domain"))
    return status.domain_counts(pages, docs)


@query(
    f"""with {CRAWL_JOBS} select url as canonical_url, case when {_DUE} then 'downloading' when status = 'processing' then 'downloading' when status = 'completed' then 'complete' else status end as download_status from jobs"""
)
def downloads_claimed(spark, folder):
    """Documents once every due download job was claimed."""
    queue, docs = _downloads(spark, folder)
    order = [F.col("added_at"), F.col("canonical_url")]
    claimed = queues.claim_all(queue, now(), order, 16, DOWNLOAD_LEASE_SECONDS)
    return queues.mark_downloading(docs, claimed).select("canonical_url", "download_status")


@query(
    f"""with {SEARCH_PAGES} select query, page, 'running' as status, cast(attempts + 1 as bigint) as attempts, {_T} as started_at from searches
    where status in ('pending','backoff') and (next_attempt is null or next_attempt <= {_T})"""
)
def searches_running(spark, folder):
    """Due result pages once they were taken up."""
    due = queues.due_jobs(search_pages(spark, folder), now(), queues.WAITING_SEARCHES)
    running = queues.mark_running(due, now())
    return running.select("query", F.col("page").cast("bigint").alias("page"), "status", F.col("attempts").cast("bigint").alias("attempts"), plain("started_at"))
