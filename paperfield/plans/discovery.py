"""Search plan, result pages and ingestion of hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperfield import schemas
from paperfield.functions.content import block_outcome, url_looks_like_pdf
from paperfield.functions.urls import canonical_url
from paperfield.operators.agencies import search_queries
from paperfield.operators.policy import HostRules, with_verdict
from paperfield.operators.queues import apply_changes, due_jobs, finish_searches, mark_running
from paperfield.operators.resultpages import get_extractor
from paperfield.operators.skew import first_per_key
from paperfield.operators.tables import align, insert_new, replace_groups
from paperfield.session import materialize

# --- fixed values -----------------------------------------------------------------------------
PAGES_PER_QUERY = 10
HIT_PRIORITY = 5
# ----------------------------------------------------------------------------------------------

PAGE_KEY = ["provider", "query", "page"]


def plan_searches(agencies: DataFrame, provider: str, pages_per_query: int = PAGES_PER_QUERY) -> DataFrame:
    """The wanted result pages of the agencies' queries, each once, as pending rows."""
    queries = search_queries(agencies).select("query").distinct()
    pages = queries.select("query", F.explode(F.sequence(F.lit(1), F.lit(pages_per_query))).alias("page"))
    return align(pages, schemas.SEARCHES, provider=F.lit(provider), status=F.lit("pending"), attempts=F.lit(0))


def add_plan(searches: DataFrame, plan: DataFrame) -> DataFrame:
    return insert_new(searches, plan, PAGE_KEY, [F.col("status")])


def split_by_cache(due: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Due pages answered by stored results, and those to fetch."""
    stored = results.select(*PAGE_KEY).distinct()
    return due.join(stored, PAGE_KEY, "left_semi"), due.join(stored, PAGE_KEY, "left_anti")


def fetch_step(
    searches: DataFrame, results: DataFrame, captured: DataFrame, now: Column, provider: str = "yahoo", max_pages: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Answer due pages from the cache or from captured pages.

    Returns the new searches, the new results and the hits of this step.  Pages that are neither
    cached nor captured stay as they are.  ``max_pages`` takes the first pages by query and page.
    """
    due = due_jobs(searches.filter(F.col("provider") == provider), now, ("pending", "backoff"))
    answerable = due.join(
        captured.select(*PAGE_KEY).unionByName(results.select(*PAGE_KEY)).distinct(), PAGE_KEY, "left_semi"
    )
    if max_pages is not None:
        answerable = answerable.orderBy("query", "page").limit(max_pages)
    cached, to_fetch = split_by_cache(answerable.select(*PAGE_KEY), results)
    newest = first_per_key(captured, PAGE_KEY, [F.desc("fetched_at"), F.desc("status"), F.col("html")])
    fetched = newest.join(to_fetch, PAGE_KEY, "left_semi")
    judged = fetched.withColumn("_o", block_outcome(F.col("status"), F.col("html"), F.col("retry_after")))
    good = ~F.col("_o.blocked") & (F.col("status") < 400)
    hits = get_extractor(provider)(judged.filter(good))
    new_hits = materialize(hits.withColumn("seen_at", now), "hits")  # feeds three outputs
    answered = results.join(cached, PAGE_KEY, "left_semi")
    counts = (
        answered.select(*PAGE_KEY).unionByName(new_hits.select(*PAGE_KEY)).groupBy(*PAGE_KEY).agg(F.count("*").alias("hits"))
    )
    outcomes = (
        judged.select(
            *PAGE_KEY,
            good.alias("ok"),
            F.col("_o.fatal").alias("fatal"),
            F.col("_o.retry_after").alias("retry_after"),
            F.concat(F.lit(f"{provider} http "), F.col("status").cast("string")).alias("error"),
        )
        .unionByName(
            cached.select(
                *PAGE_KEY, F.lit(True).alias("ok"), F.lit(False).alias("fatal"),
                F.lit(None).cast("double").alias("retry_after"), F.lit(None).cast("string").alias("error"),
            )
        )
        .join(counts, PAGE_KEY, "left")
        .withColumn("hits", F.coalesce("hits", F.lit(0)))
        .withColumn("at", now)
    )
    stored = replace_groups(results, new_hits, PAGE_KEY)
    running = apply_changes(searches, mark_running(answerable, now), PAGE_KEY)
    return finish_searches(running, outcomes), stored, answered.unionByName(new_hits.select(*answered.columns))


def route_hits(hits: DataFrame, rules: HostRules, extra_hosts: DataFrame | None = None) -> DataFrame:
    """Hits that pass the policy with ``canonical_url`` and ``kind`` (document or crawl)."""
    keyed = hits.withColumn("canonical_url", canonical_url(F.col("url"))).filter(F.col("canonical_url") != "")
    allowed = with_verdict(keyed, "canonical_url", rules, extra_hosts).filter("allowed").drop("allowed")
    return allowed.withColumn("kind", F.when(url_looks_like_pdf(F.col("canonical_url")), "document").otherwise("crawl"))


def hit_sightings(routed: DataFrame, now: Column) -> DataFrame:
    """Document sightings of routed hits."""
    return routed.filter("kind = 'document'").select(
        F.col("canonical_url").alias("url"),
        F.concat(F.lit("search:"), "provider").alias("source_url"),
        F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("string").alias("agency"),
        F.lit(0).alias("depth"),
        now.alias("seen_at"),
    )


def enqueue_hits(queue: DataFrame, routed: DataFrame, now: Column) -> DataFrame:
    """Crawl queue with the hits that are no documents."""
    batch = align(
        routed.filter("kind = 'crawl'").select(F.col("canonical_url").alias("url")), queue.schema,
        depth=F.lit(0), priority=F.lit(HIT_PRIORITY), status=F.lit("queued"), attempts=F.lit(0), added_at=now,
    )
    return insert_new(queue, batch, ["url"], [F.col("url")])
