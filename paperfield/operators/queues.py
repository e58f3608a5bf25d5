"""Work queues: due rows, claims, leases, outcomes.

A queue is a table; each operator returns its next version.  ``now`` is always an argument, so a
rerun gives the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperfield.functions.content import DOWNLOAD_ERROR_LIMIT, SEARCH_ERROR_LIMIT, cut
from paperfield.functions.retry import (
    CRAWL_LEASE_SECONDS,
    DOWNLOAD_RETRIES,
    SEARCH_BACKOFF_BASE,
    SEARCH_BACKOFF_CAP,
    backoff_seconds,
    crawl_retry_at,
    is_due,
    is_throttled,
    lease_expired,
    plus_seconds,
)
from paperfield.operators.skew import first_per_key, lookup, rank_within

WAITING_SEARCHES = ("pending", "backoff")
CRAWL_ORDER = (F.desc, "priority"), (F.asc, "added_at"), (F.asc, "url")


def crawl_order() -> list[Column]:
    """Higher priority first, then first come, first served."""
    return [direction(name) for direction, name in CRAWL_ORDER]


def due_jobs(queue: DataFrame, now: Column, statuses: Sequence[str] = ("queued",)) -> DataFrame:
    return queue.filter(F.col("status").isin(*statuses) & is_due(F.col("next_attempt"), now))


def next_jobs(queue: DataFrame, now: Column, order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` due jobs."""
    return due_jobs(queue, now).orderBy(*order).limit(k)


def due_downloads(queue: DataFrame, documents: DataFrame, now: Column) -> DataFrame:
    """Due download jobs with their documents."""
    return due_jobs(queue, now).join(documents, "canonical_url", "inner")


def next_search_pages(searches: DataFrame, now: Column, k: int = 1) -> DataFrame:
    """The first due result pages of all queries, by query and page."""
    return due_jobs(searches, now, WAITING_SEARCHES).orderBy("query", "page").limit(k)


def next_page_per_query(searches: DataFrame, now: Column) -> DataFrame:
    """The lowest due page of every query."""
    return first_per_key(due_jobs(searches, now, WAITING_SEARCHES), ["provider", "query"], [F.col("page")])


def claim(
    queue: DataFrame, now: Column, order: Sequence[Column], workers: int, per_worker: int, lease_seconds: int = CRAWL_LEASE_SECONDS
) -> DataFrame:
    """Lease the first ``workers * per_worker`` due jobs, dealt to the workers in turn.

    Returns the claimed rows in their new state.
    """
    ranked = rank_within(due_jobs(queue, now), [], order, "_rank").filter(F.col("_rank") <= workers * per_worker)
    return _leased(ranked, now, workers, lease_seconds).drop("_rank")


def claim_all(
    queue: DataFrame, now: Column, order: Sequence[Column], workers: int, lease_seconds: int = CRAWL_LEASE_SECONDS
) -> DataFrame:
    """Lease every due job."""
    return _leased(rank_within(due_jobs(queue, now), [], order, "_rank"), now, workers, lease_seconds).drop("_rank")


def _leased(numbered: DataFrame, now: Column, workers: int, lease_seconds: int) -> DataFrame:
    return (
        numbered.withColumn("status", F.lit("processing"))
        .withColumn("worker_id", F.concat(F.lit("worker-"), F.pmod(F.col("_rank") - 1, F.lit(workers)) + 1))
        .withColumn("locked_until", plus_seconds(now, F.lit(lease_seconds)))
        .withColumn("attempts", F.coalesce("attempts", F.lit(0)) + 1)
    )


def apply_changes(table: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace the rows whose key is in ``changed`` (one row per key)."""
    return table.join(changed.select(*keys), list(keys), "left_anti").unionByName(changed.select(*table.columns))


def mark_downloading(documents: DataFrame, claimed: DataFrame) -> DataFrame:
    """Documents of claimed download jobs become ``downloading``."""
    flagged = documents.join(claimed.select("canonical_url", F.lit(True).alias("_claimed")), "canonical_url", "left")
    status = F.when(F.col("_claimed"), "downloading").otherwise(F.col("download_status"))
    return flagged.withColumn("download_status", status).select(*documents.columns)


def mark_running(searches: DataFrame, now: Column) -> DataFrame:
    """Claimed result pages are running; the first start time stays."""
    return (
        searches.withColumn("status", F.lit("running"))
        .withColumn("started_at", F.coalesce("started_at", now))
        .withColumn("attempts", F.coalesce("attempts", F.lit(0)) + 1)
    )


def release_expired(queue: DataFrame, now: Column) -> DataFrame:
    """Expired leases go back to the queue; attempts stay counted."""
    expired = lease_expired(F.col("status"), F.col("locked_until"), now)
    return queue.withColumns(
        {
            "status": F.when(expired, "queued").otherwise(F.col("status")),
            "worker_id": F.when(~expired, F.col("worker_id")),
            "locked_until": F.when(~expired, F.col("locked_until")),
        }
    )


def release_documents(documents: DataFrame, queue: DataFrame, now: Column) -> DataFrame:
    """Documents being downloaded under an expired lease are queued again."""
    expired = queue.filter(lease_expired(F.col("status"), F.col("locked_until"), now)).select("canonical_url")
    waiting = documents.filter(F.col("download_status") == "downloading").join(expired, "canonical_url", "left_semi")
    flags = waiting.select("canonical_url", F.lit(True).alias("_expired"))
    joined = documents.join(flags, "canonical_url", "left")
    status = F.when(F.col("_expired"), "queued").otherwise(F.col("download_status"))
    return joined.withColumn("download_status", status).select(*documents.columns)


def finish_crawl(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Apply crawl outcomes (url, http_status, retry_after, result, at), one per URL.

    ``result`` is the final status; a throttled answer requeues the job, without limit, after
    Retry-After or the back-off of its attempts; an error, ``result`` NULL, fails it.
    """
    joined = queue.join(outcomes.withColumn("_done", F.lit(True)), "url", "left")
    done = F.coalesce("_done", F.lit(False))
    throttled = done & is_throttled(F.col("http_status"))
    retry_at = crawl_retry_at(F.col("url"), F.col("attempts"), F.col("retry_after"), F.col("at"))
    status = F.when(throttled, "queued").when(done, F.coalesce("result", F.lit("failed"))).otherwise(F.col("status"))
    return joined.withColumns(
        {
            "status": status,
            "next_attempt": F.when(throttled, retry_at).otherwise(F.col("next_attempt")),
            "worker_id": F.when(~done, F.col("worker_id")),
            "locked_until": F.when(~done, F.col("locked_until")),
        }
    ).select(*queue.columns)


def finish_searches(searches: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Apply result-page outcomes (provider, query, page, ok, fatal, retry_after, hits, error, at).

    A success clears error and next_attempt.  A failure backs off, or blocks when fatal; a fatal
    outcome also blocks every waiting page of its provider.  :func:`mark_running` counted the try.
    """
    key = ["provider", "query", "page"]
    joined = searches.join(outcomes.withColumn("_done", F.lit(True)), key, "left")
    done = F.coalesce("_done", F.lit(False))
    good, bad = done & F.col("ok"), done & ~F.col("ok")
    attempts = F.coalesce("attempts", F.lit(0))
    job = F.concat_ws("|", "provider", "query", F.col("page").cast("string"))
    wait = F.coalesce(F.col("retry_after"), backoff_seconds(job, attempts, SEARCH_BACKOFF_BASE, SEARCH_BACKOFF_CAP))
    retry_at = plus_seconds(F.col("at"), wait)
    applied = joined.select(
        *key,
        F.when(good, "completed").when(bad & F.col("fatal"), "blocked").when(bad, "backoff").otherwise(F.col("status")).alias("status"),
        F.when(good, F.col("hits")).otherwise(F.col("result_count")).cast("int").alias("result_count"),
        F.when(bad, F.coalesce("started_at", "at")).otherwise(F.col("started_at")).alias("started_at"),
        F.when(good, F.col("at")).otherwise(F.col("completed_at")).alias("completed_at"),
        attempts.cast("int").alias("attempts"),
        F.when(good, F.lit(None)).when(bad, cut(outcomes["error"], SEARCH_ERROR_LIMIT)).otherwise(searches["error"]).alias("error"),
        F.when(good, F.lit(None)).when(bad, retry_at).otherwise(F.col("next_attempt")).alias("next_attempt"),
        (bad & F.col("fatal")).alias("_fatal"),
        F.when(bad & F.col("fatal"), F.struct("at", retry_at.alias("retry_at"))).alias("_block"),
    )
    blocks = applied.filter("_fatal").groupBy("provider").agg(F.min("_block").alias("_provider_block"))
    spread = lookup(applied, blocks, "provider")
    hit = F.col("_provider_block").isNotNull() & F.col("status").isin(*WAITING_SEARCHES)
    return spread.withColumns(
        {
            "next_attempt": F.when(hit, F.col("_provider_block.retry_at")).otherwise(F.col("next_attempt")),
            "status": F.when(hit, "blocked").otherwise(F.col("status")),
        }
    ).select(*searches.columns)


def finish_downloads(
    queue: DataFrame, documents: DataFrame, results: DataFrame, retries: int = DOWNLOAD_RETRIES
) -> tuple[DataFrame, DataFrame]:
    """Apply download results to queue and documents.

    ``results`` has one row per canonical URL: ok, sha256, content_length, etag, last_modified,
    http_status, download_path, error, at.  ``attempts`` of the claimed row counts the current try,
    and the limit is compared with the tries before it, so ``retries`` = 5 means six tries.
    """
    outcome = results.select(
        "canonical_url", F.struct(*[c for c in results.columns if c != "canonical_url"]).alias("_r")
    )
    jobs = queue.join(outcome, "canonical_url", "left")
    earlier = F.greatest(F.coalesce("attempts", F.lit(0)) - 1, F.lit(1))
    done = F.col("_r").isNotNull()
    good, given_up = done & F.col("_r.ok"), done & ~F.col("_r.ok") & (earlier >= retries)
    again = done & ~good & ~given_up
    judged = jobs.withColumns(
        {
            "_state": F.when(good, "completed").when(given_up, "failed").when(again, "queued"),
            "next_attempt": F.when(again, plus_seconds(F.col("_r.at"), backoff_seconds(F.col("canonical_url"), earlier))).otherwise(F.col("next_attempt")),
            "worker_id": F.when(~done, F.col("worker_id")),
            "locked_until": F.when(~done, F.col("locked_until")),
        }
    )
    new_queue = judged.withColumn("status", F.coalesce("_state", "status")).select(*queue.columns)
    docs = documents.join(judged.select("canonical_url", "_r", "_state"), "canonical_url", "left")
    state = {"completed": "complete", "failed": "failed", "queued": "queued"}
    value = {"download_status": F.col("download_status")}
    for job, doc in state.items():
        value["download_status"] = F.when(F.col("_state") == job, doc).otherwise(value["download_status"])
    won, lost = F.col("_state") == "completed", F.col("_state") == "failed"
    for name in ("download_path", "sha256", "content_length", "etag", "last_modified"):
        value[name] = F.when(won, F.col(f"_r.{name}")).otherwise(F.col(name))
    kept = F.when(won | is_throttled(F.col("_r.http_status")), F.col("_r.http_status"))  # a failure keeps throttling answers only
    value["http_status"] = F.when(won | lost, kept).otherwise(F.col("http_status"))
    value["error"] = (
        F.when(won, F.lit(None)).when(F.col("_state").isNotNull(), cut(F.col("_r.error"), DOWNLOAD_ERROR_LIMIT)).otherwise(F.col("error"))
    )
    return new_queue, docs.withColumns(value).select(*documents.columns)
