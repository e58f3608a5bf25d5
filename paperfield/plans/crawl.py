"""Frontier expansion over captured responses, level by level.

Bodies are read once: :func:`link_table` turns responses into a compact table of facts and links,
and the levels work on that, bucketed by address, so that a level shuffles only its frontier.  The
levels and the frontier are written tables, so lineage does not grow with depth; only their
emptiness reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperfield.functions.content import content_class, crawl_retry_after, decode_body, is_pdf, url_looks_like_pdf
from paperfield.functions.retry import crawl_retry_at, is_throttled, plus_seconds
from paperfield.functions.urls import bind, canonical_links, canonical_url, domain_of
from paperfield.operators.links import extract_links, link_refs
from paperfield.operators.policy import HostRules, with_verdict
from paperfield.operators.robots import with_robots_verdict
from paperfield.operators.skew import first_per_key, lookup, rank_within, top_per_key
from paperfield.session import materialize, materialize_bucketed

# --- fixed values -----------------------------------------------------------------------------
MAX_DEPTH = 5
MAX_PAGES_PER_DOMAIN = 10_000
MAX_DOCUMENTS_PER_DOMAIN = 100_000
SEED_PRIORITY = 10
LINK_PRIORITY = 0
REQUESTS_PER_SECOND = 2.0
# ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class CrawlOptions:
    rules: HostRules = HostRules()
    max_depth: int = MAX_DEPTH
    max_pages: int = MAX_PAGES_PER_DOMAIN
    max_documents: int = MAX_DOCUMENTS_PER_DOMAIN


@dataclass(frozen=True)
class CrawlResult:
    """``queue``: every URL met, with depth, status and next_attempt.  ``urls``: what was fetched.

    ``sightings``: documents within the domain caps, ready for the document merge.
    """

    queue: DataFrame
    urls: DataFrame
    sightings: DataFrame


def _response_facts(responses: DataFrame) -> DataFrame:
    """Facts of each response, and its HTML where it is a page whose links count."""
    header = F.col("headers")
    ctype = header["Content-Type"]
    final = F.coalesce(F.nullif(canonical_url(F.col("final_url")), F.lit("")), F.col("request"))
    facts = (
        responses.withColumn("request", canonical_url(F.col("request_url")))
        .filter(F.col("request") != "")
        .withColumn("final", final)
        .withColumn("is_pdf", is_pdf(F.col("final"), ctype, F.col("body")))
        .withColumn("kind", content_class(ctype, F.col("final")))
        .withColumn("response", F.xxhash64("request_url", "final_url", "status", "fetched_at", "body", F.map_entries("headers")))
    )
    html = ~F.col("is_pdf") & (F.col("kind") == "html") & ~is_throttled(F.col("status"))
    return facts.select(
        "request",
        "final",
        F.col("status").alias("http_status"),
        crawl_retry_after(header["Retry-After"]).alias("retry_after"),
        "is_pdf",
        "kind",
        "fetched_at",
        "response",
        F.when(html, decode_body(F.col("body"), ctype)).alias("_html"),
    )


def link_table(responses: DataFrame) -> DataFrame:
    """One pass over the responses: facts of each, repeated for each of its links.

    A response without links has one row with ``pos`` NULL.  ``response`` tells responses apart.
    """
    return extract_links(_response_facts(responses), "_html", "final", keep_pages=True).drop("ref")


def page_table(responses: DataFrame) -> DataFrame:
    """One pass over the responses: facts of each, with the set of its ``links``."""
    found = bind(link_refs(F.col("_html")), lambda refs: canonical_links(refs, F.col("final")))
    links = F.array_distinct(F.filter(found, lambda link: link != ""))
    facts = _response_facts(responses)
    return facts.select(*[c for c in facts.columns if c != "_html"], F.coalesce(links, F.array().cast("array<string>")).alias("links"))


def newest_response() -> list[Column]:
    """Order of the responses of a request URL, the latest first."""
    return [F.desc("fetched_at"), F.col("final"), F.col("http_status"), F.col("response")]


def newest_facts(links: DataFrame) -> DataFrame:
    """The latest response of each request URL."""
    single = links.filter(F.col("pos").isNull() | (F.col("pos") == 1)).drop("pos", "link")
    return first_per_key(single, ["request"], newest_response())


def seed_frontier(seeds: DataFrame, rules: HostRules, extra_hosts: DataFrame | None = None) -> DataFrame:
    """Frontier of depth 0 from (url, priority): canonical, allowed, each URL once."""
    keyed = seeds.select(canonical_url(F.col("url")).alias("url"), "priority").filter(F.col("url") != "")
    allowed = with_verdict(keyed, "url", rules, extra_hosts).filter("allowed").drop("allowed")
    return allowed.groupBy("url").agg(F.max("priority").alias("priority"))


def agency_seeds(agencies: DataFrame) -> DataFrame:
    return agencies.select(F.col("official_url").alias("url"), F.lit(SEED_PRIORITY).alias("priority"))


def level_order() -> list[Column]:
    """The order in which the jobs of one level count against a domain's cap."""
    return [F.desc("priority"), F.col("url")]


def domain_cap(jobs: DataFrame, cap: int, used: DataFrame | None = None, order: Sequence[Column] | None = None) -> DataFrame:
    """Jobs (url, domain, ...) within ``cap`` per domain, less what ``used`` (domain, n) counts."""
    order = list(order or level_order())
    ranked = top_per_key(jobs, ["domain"], order, cap)
    if used is not None:
        spent = lookup(ranked, used.select("domain", F.col("n").alias("_n")), "domain")
        ranked = spent.filter(F.col("rank") <= cap - F.coalesce("_n", F.lit(0))).drop("_n")
    return ranked


def page_limits(yields: DataFrame, used: DataFrame, cap: int) -> DataFrame:
    """Per domain, the order key of the last job that still fits; NULL key: nothing fits.

    A job is let through while fewer than ``cap`` HTML pages of its domain come before it.
    """
    ranked = top_per_key(yields, ["domain"], level_order(), cap)
    spent = lookup(ranked, used, "domain").withColumn("_left", cap - F.coalesce("n", F.lit(0)))
    last = spent.filter(F.col("rank") == F.col("_left")).select(
        "domain", F.struct((-F.col("priority")).alias("p"), "url").alias("last_key")
    )
    full = used.filter(F.col("n") >= cap).select("domain")
    return last.unionByName(full.withColumn("last_key", F.lit(None).cast(last.schema["last_key"].dataType)))


def crawl(
    frontier: DataFrame,
    links: DataFrame,
    robots_rules: DataFrame,
    options: CrawlOptions,
    now: Column,
    urls: DataFrame | None = None,
    documents: DataFrame | None = None,
    extra_hosts: DataFrame | None = None,
    queue: DataFrame | None = None,
) -> CrawlResult:
    """Breadth-first expansion of ``frontier`` (url, priority, optional depth and attempts) over a written link table.

    ``urls`` and ``documents`` count against the caps; addresses in ``queue`` are not enqueued anew.
    Jobs that lie deeper than ``max_depth`` are judged like others, but their links are not followed.
    """
    facts = materialize_bucketed(newest_facts(links), "facts", "request")
    found = links.filter(F.col("link") != "").join(facts.select("request", "response"), ["request", "response"], "left_semi")
    edges = materialize_bucketed(found.select("request", "link"), "edges", "request")
    known_pages = (
        urls.filter(F.col("url_type") == "html").select("domain", F.col("canonical_url").alias("final"))
        if urls is not None
        else frontier.sparkSession.createDataFrame([], "domain string, final string")
    )
    start = frontier if "depth" in frontier.columns else frontier.withColumn("depth", F.lit(0))
    start = start if "attempts" in start.columns else start.withColumn("attempts", F.lit(0))
    start = materialize(start.select("url", "priority", "depth", F.coalesce("attempts", F.lit(0)).alias("attempts")), "frontier")
    done: list[DataFrame] = []
    seen = [start.select("url")] + ([queue.select("url")] if queue is not None else [])
    links_of: list[DataFrame] = []

    def limits_of(candidates: DataFrame) -> DataFrame:
        return _level_limits(candidates, known_pages, done, options.max_pages)

    level = start.filter(F.col("depth") == 0)
    depth = 0
    while True:
        judged = materialize(judge(level, facts, robots_rules, options, limits_of, now, extra_hosts), f"level{depth}")
        done.append(judged)
        if depth >= options.max_depth:
            break
        followed = materialize(_follow(judged, edges, options, extra_hosts), "followed")
        links_of.append(followed)
        fresh = first_per_key(
            followed.filter(~url_looks_like_pdf(F.col("link"))).select(F.col("link").alias("url")), ["url"], [F.col("url")]
        ).join(reduce(DataFrame.unionByName, seen), "url", "left_anti")
        depth += 1
        found = materialize(fresh.withColumns({"priority": F.lit(LINK_PRIORITY), "depth": F.lit(depth), "attempts": F.lit(0)}), "frontier")
        seen.append(found.select("url"))
        level = found.unionByName(start.filter(F.col("depth") == depth))
        if not found.head(1) and not start.filter(F.col("depth") >= depth).head(1):
            break
    deeper = start.filter(F.col("depth") > options.max_depth)
    if deeper.head(1):
        done.append(materialize(judge(deeper, facts, robots_rules, options, limits_of, now, extra_hosts), "deeper"))
    everything = reduce(DataFrame.unionByName, done)
    linked = [followed.filter(url_looks_like_pdf(F.col("link"))) for followed in links_of]
    found = found_documents(everything, reduce(DataFrame.unionByName, linked) if linked else None)
    return crawl_result(everything, found, options, documents, now)


def crawl_result(everything: DataFrame, found: DataFrame, options: CrawlOptions, documents: DataFrame | None, now: Column) -> CrawlResult:
    """The outcome of a crawl from its judged jobs and the documents it found."""
    return CrawlResult(
        queue=everything.select("url", "depth", "priority", "status", "http_status", "next_attempt"),
        urls=_remembered(everything, now),
        sightings=_document_sightings(found, options, documents, now),
    )


def judge(
    level: DataFrame, facts: DataFrame, robots_rules: DataFrame, options: CrawlOptions,
    limits_of: Callable[[DataFrame], DataFrame], now: Column, extra_hosts: DataFrame | None,
) -> DataFrame:
    """Statuses of one level: the host policy decides first, then robots rules, caps and the response.

    A job whose response was not captured stays queued.  ``limits_of`` gives the page limits (:func:`page_limits`) for
    the jobs that would be pages.
    """
    joined = level.join(facts.withColumnRenamed("request", "url"), "url", "left")
    ruled = with_verdict(joined, "url", options.rules, extra_hosts)
    checked = with_robots_verdict(ruled, "url", robots_rules).withColumn("domain", domain_of(F.col("url")))
    captured, throttled = F.col("http_status").isNotNull(), is_throttled(F.col("http_status"))
    open_ = F.col("allowed") & F.col("robots_allowed")
    is_page = open_ & captured & ~throttled & ~F.col("is_pdf") & (F.col("kind") == "html")
    limits = limits_of(checked.filter(is_page))
    marked = lookup(checked, limits.withColumn("_limited", F.lit(True)), "domain")
    key = F.struct((-F.col("priority")).alias("p"), F.col("url"))
    over = F.coalesce("_limited", F.lit(False)) & (F.col("last_key").isNull() | (key > F.col("last_key")))
    limited = marked.withColumn("_over", over)
    status = (
        F.when(~F.col("allowed"), "skipped")
        .when(~F.col("robots_allowed"), "robots")
        .when(F.col("_over"), "domain_limit")
        .when(~captured | throttled, "queued")
        .otherwise("completed")
    )
    waiting = open_ & ~F.col("_over") & throttled
    return limited.select(
        "url", "depth", "priority", status.alias("status"), "http_status", "final", "kind", "is_pdf", "fetched_at",
        F.coalesce(is_page, F.lit(False)).alias("is_page"),
        F.when(waiting, crawl_retry_at(F.col("url"), F.col("attempts"), F.col("retry_after"), now)).alias("next_attempt"),
    )


def _level_limits(candidates: DataFrame, known_pages: DataFrame, done: Sequence[DataFrame], cap: int) -> DataFrame:
    """Page limits of a level, given the pages of the index and of the levels before."""
    earlier = [
        d.filter((F.col("status") == "completed") & F.col("is_page")).select(domain_of(F.col("final")).alias("domain"), "final")
        for d in done
    ]
    pages = reduce(DataFrame.unionByName, earlier, known_pages).distinct()
    used = pages.groupBy("domain").agg(F.count("*").alias("n"))
    keyed = candidates.select(domain_of(F.col("final")).alias("domain"), "final", "priority", "url")
    yields = first_per_key(keyed, ["final"], level_order()).join(pages.select("final"), "final", "left_anti")
    return page_limits(yields, used, cap)


def _follow(judged: DataFrame, edges: DataFrame, options: CrawlOptions, extra_hosts: DataFrame | None) -> DataFrame:
    """Allowed links of the completed pages: (final, depth, link)."""
    pages = judged.filter((F.col("status") == "completed") & F.col("is_page")).select(
        F.col("url").alias("request"), "final", "depth"
    )
    linked = pages.join(edges, "request").select("final", "depth", "link")
    return with_verdict(linked, "link", options.rules, extra_hosts).filter("allowed").drop("allowed")


def _remembered(everything: DataFrame, now: Column) -> DataFrame:
    fetched = everything.filter(F.col("status") == "completed")
    first = first_per_key(fetched, ["final"], [F.col("depth"), *level_order()])
    return first.select(
        F.col("final").alias("canonical_url"),
        F.col("final").alias("url"),
        domain_of(F.col("final")).alias("domain"),
        F.when(F.col("is_pdf"), "pdf").otherwise(F.col("kind")).alias("url_type"),
        F.col("url").alias("source_url"),
        "depth",
        now.alias("discovered_at"),
        F.lit("seen").alias("status"),
        now.alias("last_checked"),
    )


def found_documents(judged: DataFrame, linked: DataFrame | None) -> DataFrame:
    """(url, source_url, depth, domain): answered documents and links (final, depth, link) to documents, each once."""
    found = judged.filter((F.col("status") == "completed") & F.col("is_pdf")).select(
        F.col("final").alias("url"), F.col("url").alias("source_url"), "depth", domain_of(F.col("url")).alias("domain")
    )
    if linked is not None:
        found = found.unionByName(linked.select(
            F.col("link").alias("url"), F.col("final").alias("source_url"), (F.col("depth") + 1).alias("depth"),
            domain_of(F.col("link")).alias("domain"),
        ))
    return first_per_key(found, ["url"], [F.col("depth"), F.col("source_url")])


def _document_sightings(found: DataFrame, options: CrawlOptions, documents: DataFrame | None, now: Column) -> DataFrame:
    order = [F.col("depth"), F.col("url")]
    if documents is None:
        used = None
        known = None
    else:
        used = documents.groupBy("domain").agg(F.count("*").alias("n"))
        known = found.join(documents.select(F.col("canonical_url").alias("url")), "url", "left_semi")
        found = found.join(known.select("url"), "url", "left_anti")
    found = domain_cap(found, options.max_documents, used, order).drop("rank")
    if known is not None:
        found = found.unionByName(known)
    nothing = F.lit(None).cast("string")
    return found.select("url", "source_url", nothing.alias("state"), nothing.alias("agency"), "depth", now.alias("seen_at"))


def fetch_plan(jobs: DataFrame, start: Column, order: Sequence[Column], rps: float = REQUESTS_PER_SECOND) -> DataFrame:
    """Earliest start of every job such that a domain gets at most ``rps`` requests per second."""
    ranked = rank_within(jobs, ["domain"], order, "turn")
    return ranked.withColumn("earliest_start", plus_seconds(start, (F.col("turn") - 1) / F.lit(max(rps, 0.01))))


def reachable(edges: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """(node, depth): the nodes within ``max_depth`` steps of the seeds with their least depth."""
    compact = materialize_bucketed(edges.select("src", "dst").distinct(), "edges", "src")
    level = materialize(seeds.select("node").distinct().withColumn("depth", F.lit(0)), "reached")
    levels = [level]
    for depth in range(1, max_depth + 1):
        targets = compact.join(level.select(F.col("node").alias("src")), "src", "left_semi")
        fresh = targets.select(F.col("dst").alias("node")).distinct()
        seen = reduce(DataFrame.unionByName, levels).select("node")
        level = materialize(fresh.join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)), "reached")
        if not level.head(1):
            break
        levels.append(level)
    return reduce(DataFrame.unionByName, levels)
