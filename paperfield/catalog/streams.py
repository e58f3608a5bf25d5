"""Streaming queries: the given tables, written in several files each, read as streams of several batches."""

from pyspark.sql import functions as F

from paperfield.catalog.crawl import PART_CRAWL, part_crawl, part_site
from paperfield.catalog.registry import NOW, RULES, plain, query, table
from paperfield.session import materialize, new_location
from paperfield.streaming import counts, crawl, dedup, ingest, leases, retries
from paperfield.streaming.runner import file_stream


BATCHES = 4


def pieces(spark, rows, piece, name, batches=BATCHES):
    """``rows`` as a stream of about ``batches`` batches; ``piece`` is the number of a row's batch."""
    path = new_location(spark, name)
    for number in range(batches):
        rows.filter(piece == number).write.mode("append").parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    return file_stream(spark, path, rows.schema, files_per_batch=-(-files // batches))


def _events(spark, folder, late=False):
    """The events in order of time; with ``late``, every batch has events of the whole time."""
    rows = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    if late:
        return pieces(spark, rows, F.col("event_id") % BATCHES, "events")
    count = rows.agg(F.max("event_id") + 1).first()[0] or 1
    return pieces(spark, rows, F.floor(F.col("event_id") * BATCHES / count), "events")


@query(
    """select date_trunc('day', ts) as start, event_type, count(*) as n from events
    where date_trunc('day', ts) + interval 1 day <= (select max(ts) from events) group by 1, 2"""
)
def stream_daily_counts(spark, folder):
    """Counts per day and type, closed days only.  The watermark is kept in milliseconds."""
    found = counts.windowed_counts_stream(_events(spark, folder))
    return found.select(plain("start"), "event_type", "n")


@query("select 'https://q' || user_id || '.example.gov/' || event_type as url, min((event_id % 4, event_id))[2] as event_id from events group by 1")
def stream_dedup(spark, folder):
    """An event of every address: the first of the earliest batch that has the address."""
    rows = _events(spark, folder, late=True).select(F.format_string("https://q%d.example.gov/%s", "user_id", "event_type").alias("url"), "event_id")
    return dedup.first_seen_stream(rows, "url", ["event_id"], buckets=8, deltas=1)


_LEASES = """with e as (select 'job ' || user_id as job, ts, event_id, event_type in ('view','click') as claim, lead(ts) over (partition by user_id order by ts, event_id) as next_ts from events)
    select job, ts as claimed_at, ts + interval 6 hour as locked_until from e where claim and ts + interval 6 hour < coalesce(next_ts, (select max(ts) from events))"""


def _lease_events(events):
    kind = F.when(F.col("event_type").isin("view", "click"), "claim").otherwise("done")
    return events.select(F.concat(F.lit("job "), F.col("user_id").cast("string")).alias("job"), "ts", "event_id", kind.alias("kind"))


@query(_LEASES)
def stream_lease(spark, folder):
    """Leases of six hours that ran out before the job's next event."""
    found = leases.expired_leases_stream(_lease_events(_events(spark, folder)), lease_seconds=21600)
    return found.select("job", plain("claimed_at"), plain("locked_until"))


@query(_LEASES)
def lease_history(spark, folder):
    """The batch form of the same."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    found = leases.expired_leases(_lease_events(events), lease_seconds=21600)
    return found.select("job", plain("claimed_at"), plain("locked_until"))


_RETRIES = """with e as (select 'job ' || user_id || '-' || (event_id % 4) as job, ts, event_id, event_type = 'purchase' as ok from events),
    wins as (select job, min((ts, event_id)) as win from e where ok group by 1),
    fails as (select job, ts, event_id, row_number() over (partition by job order by ts, event_id) as k from e where not ok),
    kept as (select f.* from fails f left join wins w on f.job = w.job where k <= 6 and (win is null or (ts, event_id) < win)),
    sums as (select j.job, count(k) as failures, max(k.ts) as last_fail from (select distinct job from e) j left join kept k on k.job = j.job group by 1),
    states as (select s.job, case when failures = 6 then 'failed' when win is not null then 'completed' else 'queued' end as status, failures,
      case when failures = 6 or win is null then last_fail else struct_extract(win, 1) end as changed_at from sums s left join wins w on w.job = s.job)
    select job, status, failures, changed_at, case when status = 'queued' and failures > 0 then
      cast(round(least(120.0, pow(2.0, greatest(failures - 1, 1))) * (0.5 + cast(('0x' || substr(md5(job || '|' || greatest(failures - 1, 1)), 1, 8)) as bigint) / 4294967296.0) * 1000000) as bigint) end as wait_us from states"""


def _outcomes(events):
    job = F.format_string("job %d-%d", "user_id", F.col("event_id") % 4)
    return events.select(job.alias("job"), "ts", "event_id", (F.col("event_type") == "purchase").alias("ok"))


def _shown(states):
    wait = F.unix_micros("next_attempt") - F.unix_micros("changed_at")
    return states.select("job", "status", F.col("failures").cast("bigint").alias("failures"), plain("changed_at"), wait.alias("wait_us"))


@query(_RETRIES)
def stream_retry(spark, folder):
    """State of every job after its outcome events, most of which come late."""
    return _shown(retries.retry_states_stream(_outcomes(_events(spark, folder, late=True)), buckets=8))


@query(_RETRIES)
def retry_history(spark, folder):
    """The batch form of the same."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return _shown(retries.retry_states(_outcomes(events)))


@query(
    f"""with hits as (select 'https://' || source || '.example.com/' || (doc_id % 200) || case when doc_id % 2 = 0 then '.pdf' else '' end as url, doc_id % 2 = 0 as pdf from documents)
    select url, case when pdf then 'document' else 'crawl' end as origin, timestamp '{NOW}' as added_at from hits group by 1, 2"""
)
def stream_ingest(spark, folder):
    """Hits streamed into the document index and the crawl queue."""
    number = (F.col("doc_id") % 200).cast("string")
    docs = pieces(spark, table(spark, folder, "documents").select("doc_id", "source"), F.col("doc_id") % BATCHES, "hits")
    hits = docs.select(
        F.lit("yahoo").alias("provider"),
        F.concat(F.lit("https://"), "source", F.lit(".example.com/"), number, F.when(F.col("doc_id") % 2 == 0, ".pdf?utm_id=1").otherwise("#x")).alias("url"),
    )
    out = ingest.ingest_stream(hits, RULES, lambda number: NOW)
    docs = out.documents.select(F.col("canonical_url").alias("url"), F.lit("document").alias("origin"), plain("first_seen"))
    queue = out.crawl_queue.select("url", F.lit("crawl").alias("origin"), plain("added_at"))
    return docs.withColumnRenamed("first_seen", "added_at").unionByName(queue)


@query(PART_CRAWL)
def stream_crawl(spark, folder):
    """The crawl of ``crawl_levels`` over a stream: the second answer of a part comes in the last batch."""
    site = part_site(spark, folder)
    piece = F.when(F.col("try") > 0, 2).otherwise(F.col("p_partkey") % 3)
    answers = pieces(spark, materialize(site, "site"), piece, "responses", 3).drop("p_partkey", "try")
    return part_crawl(spark, folder, lambda seeds, rules, options, at: crawl.crawl_stream(answers, seeds, rules, options, at, buckets=8))
