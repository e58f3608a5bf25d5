"""The document index as a set of versioned tables, and the jobs that move it on."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperfield import schemas
from paperfield.functions.retry import DOWNLOAD_LEASE_SECONDS
from paperfield.operators import agencies as agency_ops
from paperfield.operators import bodies, queues, robots, status, tables
from paperfield.operators.policy import HostRules, agency_hosts
from paperfield.operators.queues import WAITING_SEARCHES
from paperfield.operators.skew import first_per_key
from paperfield.plans import crawl as crawl_plan
from paperfield.plans import discovery
from paperfield.plans.download import download_step
from paperfield.plans.resume import resume
from paperfield.session import materialize
from paperfield.sources import readers, writers

TABLES = {
    "agencies": schemas.AGENCIES,
    "urls": schemas.URLS,
    "documents": schemas.DOCUMENTS,
    "searches": schemas.SEARCHES,
    "search_results": schemas.SEARCH_RESULTS,
    "crawl_queue": schemas.CRAWL_QUEUE,
    "download_queue": schemas.DOWNLOAD_QUEUE,
    "robots": schemas.ROBOTS,
    "parts": schemas.DOWNLOAD_PARTS,
}
# tables the status report does not count
UNCOUNTED = ("robots", "parts")


_LOG = StructType().add("name", "string").add("version", "integer").add("folder", "string")


def job(method: Callable) -> Callable:
    """A method that reads the versions there are when it starts."""

    @wraps(method)
    def run(self: DocumentIndex, *args, **kwargs):
        self._seen = self._versions()
        try:
            return method(self, *args, **kwargs)
        finally:
            self._seen = None

    return run


class DocumentIndex:
    """Tables below ``root``; every job reads the newest versions and writes new ones.

    New versions count once the job has logged them, all together, so a job that died half-way
    leaves the old ones in force and can simply be run again.  Jobs are meant to run one at a time: each writes to
    folders of its own, and one that finds newer versions than it read when it is about to log stops with an error.
    """

    def __init__(self, spark: SparkSession, root: str, rules: HostRules = HostRules()):
        self.spark, self.root, self.rules = spark, root.rstrip("/"), rules
        self._seen: dict[str, tuple[int, str]] | None = None  # versions that the job under way reads

    def _read(self, path: str, schema: StructType) -> DataFrame:
        """A table, empty where nothing has been written yet."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{path}")
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return self.spark.createDataFrame([], schema)

    def _versions(self) -> dict[str, tuple[int, str]]:
        """Newest version and folder of each table."""
        newest = self._read("versions", _LOG).groupBy("name").agg(F.max(F.struct("version", "folder")).alias("v"))
        return {r["name"]: (r["v"]["version"], r["v"]["folder"]) for r in newest.collect()}  # one row per table

    def table(self, name: str) -> DataFrame:
        versions = self._versions() if self._seen is None else self._seen
        if name not in versions:
            return self.spark.createDataFrame([], TABLES[name])
        return readers.read_table(self.spark, f"{self.root}/{name}/{versions[name][1]}", TABLES[name])

    def bodies(self) -> DataFrame:
        """The body table: (sha256, body, p1, p2)."""
        return self._read("bodies", schemas.BODIES)

    def _update(self, **changes: DataFrame) -> None:
        """Write new versions of some tables, then switch to all of them at once."""
        read = self._seen or {}
        entries = {name: (read.get(name, (0, ""))[0] + 1, f"v{read.get(name, (0, ''))[0] + 1}-{uuid.uuid4().hex}") for name in changes}
        for name, df in changes.items():
            tables.align(df, TABLES[name]).write.parquet(f"{self.root}/{name}/{entries[name][1]}")
        if self._versions() != read:
            raise RuntimeError("another job has changed the index")
        log = self.spark.createDataFrame([(n, *e) for n, e in entries.items()], _LOG)
        log.coalesce(1).write.mode("append").parquet(f"{self.root}/versions")

    @job
    def replace(self, **changes: DataFrame) -> None:
        """Put tables in the place of others, such as those of another index."""
        self._update(**changes)

    @job
    def seed(self, path: str, now: Column) -> int:
        """Upsert the agencies of seed files; returns the accepted records."""
        records = materialize(agency_ops.prepare_agencies(readers.read_seeds(self.spark, path), now), "seeds")
        self._update(agencies=agency_ops.upsert_agencies(self.table("agencies"), records))
        return records.count()

    @job
    def discover(
        self, captured: DataFrame, now: Column, state: str | None = None, agency: str | None = None,
        provider: str = "yahoo", pages_per_query: int = discovery.PAGES_PER_QUERY, max_pages: int | None = None,
    ) -> dict[str, int]:
        """Plan searches, answer due pages from captured ones and ingest the hits."""
        listed = agency_ops.list_agencies(self.table("agencies"), state, agency)
        searches = self.table("searches")
        plan = discovery.plan_searches(listed, provider, pages_per_query)
        planned = materialize(discovery.add_plan(searches, plan), "searches")
        created = planned.count() - searches.count()
        after, results, hits = discovery.fetch_step(planned, self.table("search_results"), captured, now, provider, max_pages)
        routed = materialize(discovery.route_hits(hits, self.rules, agency_hosts(self.table("agencies"))), "routed")
        self._update(
            **self._recorded(discovery.hit_sightings(routed, now), self.table("urls")),
            crawl_queue=discovery.enqueue_hits(self.table("crawl_queue"), routed, now),
            search_results=results,
            searches=after,
        )
        return {"planned": created, "ingested": routed.count()}

    def _recorded(self, sightings: DataFrame, urls: DataFrame) -> dict[str, DataFrame]:
        """Tables after document sightings were recorded."""
        merged = materialize(tables.sightings_by_document(sightings), "merged")
        return {
            "urls": tables.merge_document_urls(urls, merged),
            "download_queue": tables.enqueue_documents(self.table("download_queue"), merged),
            "documents": tables.merge_documents(self.table("documents"), merged),
        }

    @job
    def crawl(
        self, responses: DataFrame, now: Column, state: str | None = None, agency: str | None = None,
        options: crawl_plan.CrawlOptions | None = None, agent: str = robots.DEFAULT_AGENT,
    ) -> dict[str, int]:
        """Expand the frontier, agencies and due queue rows, over captured responses."""
        options = options or crawl_plan.CrawlOptions(rules=self.rules)
        every = self.table("agencies")
        extra = agency_hosts(every)
        seeds = crawl_plan.seed_frontier(crawl_plan.agency_seeds(agency_ops.list_agencies(every, state, agency)), options.rules, extra)
        queue = tables.insert_new(
            queues.release_expired(self.table("crawl_queue"), now),
            tables.align(seeds, schemas.CRAWL_QUEUE, depth=F.lit(0), status=F.lit("queued"), attempts=F.lit(0), added_at=now),
            ["url"], [F.desc("priority")],
        )
        queue = materialize(queue, "queue")
        answered = responses.filter(F.lower("request_url").endswith("/robots.txt"))
        hosts = answered.select(crawl_plan.domain_of(F.col("request_url")).alias("host"))
        cache = materialize(robots.fill_cache(hosts, answered, self.table("robots")), "robots")
        links = materialize(crawl_plan.link_table(responses), "links")
        result = crawl_plan.crawl(
            queues.due_jobs(queue, now), links, robots.host_rules(cache, agent), options, now,
            self.table("urls"), self.table("documents"), extra, queue,
        )
        met = materialize(result.queue, "met")
        sightings = materialize(result.sightings, "sightings")
        known = tables.insert_new(self.table("urls"), tables.align(result.urls, schemas.URLS), ["canonical_url"], [F.col("depth")])
        self._update(**self._recorded(sightings, known), crawl_queue=_applied(queue, met, now), robots=cache)
        counts = met.agg(F.count("*").alias("met"), F.count_if(F.col("status") == "completed").alias("completed")).first()
        return {"met": counts["met"], "completed": counts["completed"], "documents": sightings.count()}

    @job
    def claim_downloads(self, now: Column, workers: int, per_worker: int, lease_seconds: int = DOWNLOAD_LEASE_SECONDS) -> DataFrame:
        """Lease the first due jobs that have a document, first come, first served; their documents are ``downloading``.

        Returns the leased jobs with their documents.  Expired leases are given back first.
        """
        queue, documents = self.table("download_queue"), self.table("documents")
        waiting = materialize(queues.release_documents(documents, queue, now), "documents")
        released = materialize(queues.release_expired(queue, now), "queue")
        ready = released.join(waiting.select("canonical_url"), "canonical_url", "left_semi")
        order = [F.col("added_at").asc_nulls_first(), F.col("canonical_url")]
        claimed = materialize(queues.claim(ready, now, order, workers, per_worker, lease_seconds), "claimed")
        marked = materialize(queues.mark_downloading(waiting, claimed), "marked")
        self._update(download_queue=queues.apply_changes(released, claimed, ["canonical_url"]), documents=marked)
        return claimed.join(marked, "canonical_url")

    @job
    def download(
        self, fetched: DataFrame, now: Column, body_root: str, layout: str = "content_addressed", parts: DataFrame | None = None
    ) -> None:
        """Apply fetched bodies (canonical_url, http_status, headers, body, resumed) of due and of leased jobs.

        ``parts`` (canonical_url, part_no, status, offset, total, headers, bytes) are ranges of bodies: with those of
        earlier batches they make up whole bodies, or stay for later batches, and their job fails this time.
        """
        queue = self.table("download_queue")
        documents = materialize(queues.release_documents(self.table("documents"), queue, now), "documents")
        released = queues.release_expired(queue, now)
        answered = fetched.select("canonical_url")
        if parts is not None:
            answered = answered.unionByName(parts.select("canonical_url"))
        answered = answered.distinct()
        due = queues.due_jobs(released, now).withColumn("attempts", F.coalesce("attempts", F.lit(0)) + 1).withColumn("status", F.lit("processing"))
        leased = released.filter("status = 'processing'")
        claimed = materialize(due.unionByName(leased).join(answered, "canonical_url", "left_semi"), "claimed")
        running = queues.apply_changes(released, claimed, ["canonical_url"])
        keys = claimed.select("canonical_url")
        batch, changes = fetched, {}
        if parts is not None:
            pieces = tables.align(parts, schemas.DOWNLOAD_PARTS)
            assembled = bodies.advance_parts(pieces, self.table("parts"), "canonical_url", keys, ["headers"])
            made = assembled.bodies.filter("newest is not null").select(
                "canonical_url", F.when(F.col("resumed"), 206).otherwise(200).alias("http_status"), "newest.headers",
                F.when(F.col("whole"), F.col("body")).alias("body"), "resumed",
            )
            batch = batch.select(made.columns).unionByName(made)
            changes["parts"] = assembled.open
        step = download_step(running, documents, batch.withColumn("at", now), body_root, layout, stored=self.bodies(), claimed=keys)
        writers.write_bodies(step.bodies.drop("copies"), f"{self.root}/bodies")
        self._update(documents=step.documents, download_queue=step.queue, **changes)

    @job
    def resume(self, now: Column) -> None:
        """Give back what an interruption left behind; then run the other jobs again."""
        names = ("searches", "crawl_queue", "download_queue", "documents")
        self._update(**resume(*[self.table(n) for n in names], now))

    def status(self, files: DataFrame) -> DataFrame:
        """The status report; ``files`` is a scan with a ``length`` column."""
        counts = status.table_counts({name: self.table(name) for name in TABLES if name not in UNCOUNTED})
        return status.status_report(counts, status.storage_stats(files))

    def verify(self, files: DataFrame | None = None) -> DataFrame:
        """ok, mismatch and missing of the body table, or of ``files`` (path, sha256)."""
        documents = self.table("documents")
        verdicts = status.verify_bodies(documents, self.bodies()) if files is None else status.verify_files(documents, files)
        return status.verify_counts(verdicts)

    def export(self, kind: str, path: str) -> int:
        """Write the index as ``csv``, ``json`` (ASCII lines) or ``jsonl``; returns the rows."""
        rows = writers.export_rows(self.table("documents"), self.table("agencies"))
        write: dict[str, Callable[[], int]] = {
            "csv": lambda: writers.write_csv(rows, path),
            "json": lambda: writers.write_jsonl(rows, path, ascii_only=True),
            "jsonl": lambda: writers.write_jsonl(rows, path),
        }
        return write[kind]()

    def pending_pages(self) -> int:
        return self.table("searches").filter(F.col("status").isin(*WAITING_SEARCHES)).count()


def _applied(queue: DataFrame, met: DataFrame, now: Column) -> DataFrame:
    """Queue after a crawl: judged jobs take their outcome, new addresses are added."""
    seen = met.select(
        "url", F.struct("status", "next_attempt", "depth", "priority", F.col("http_status").isNotNull().alias("fetched")).alias("_m")
    )
    joined = queue.join(seen, "url", "full_outer")
    hit, new = F.col("_m").isNotNull(), F.col("status").isNull()
    tried = F.when(hit & (F.col("_m.fetched") | (F.col("_m.status") != "queued")), 1).otherwise(0)
    return joined.select(
        "url",
        F.coalesce("depth", "_m.depth").alias("depth"),
        F.coalesce("priority", "_m.priority").alias("priority"),
        F.coalesce("_m.status", "status").alias("status"),
        (F.coalesce("attempts", F.lit(0)) + tried).alias("attempts"),
        F.when(hit, F.col("_m.next_attempt")).otherwise(F.col("next_attempt")).alias("next_attempt"),
        F.when(~hit, F.col("worker_id")).alias("worker_id"),
        F.when(~hit, F.col("locked_until")).alias("locked_until"),
        F.when(new, now).otherwise(F.col("added_at")).alias("added_at"),
    )
