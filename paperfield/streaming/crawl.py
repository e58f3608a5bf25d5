"""A crawl over a stream of captured responses: a micro-batch answers one level of the frontier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperfield.functions.content import url_looks_like_pdf
from paperfield.operators.policy import with_verdict
from paperfield.operators.skew import first_per_key
from paperfield.plans.crawl import (
    LINK_PRIORITY,
    CrawlOptions,
    CrawlResult,
    crawl_result,
    domain_of,
    found_documents,
    judge,
    level_order,
    newest_response,
    page_limits,
    page_table,
)
from paperfield.session import materialize, new_location
from paperfield.streaming.runner import file_stream, last_committed, run_available
from paperfield.streaming.state import BUCKETS, BucketedState

# an answer is taken note of in these; denied jobs stay denied
UNANSWERED = ("queued", "robots", "skipped")
_FRONTIER = StructType().add("url", "string").add("depth", "integer").add("priority", "integer").add("attempts", "integer")
_VISITED = (
    StructType([*_FRONTIER.fields]).add("status", "string").add("http_status", "integer").add("final", "string").add("kind", "string")
    .add("is_pdf", "boolean").add("fetched_at", "timestamp").add("is_page", "boolean").add("next_attempt", "timestamp")
)
_FOUND = StructType().add("url", "string").add("source_url", "string").add("depth", "integer").add("domain", "string")


class CrawlStream:
    """Frontier, visited addresses, facts of responses, pages per domain and found documents of a crawl, as states.

    New addresses are written to a folder that the query itself reads as a second source, so the next micro-batch takes
    them up; a replayed batch may write some twice, which changes nothing.  A response may come before or after its
    address is met: facts wait in a state, and a waiting job is judged again when an answer comes.  Where an
    address turns out to be nearer than thought, its depth is lowered and its links are followed anew, so depths end as
    in a crawl that has all responses from the start.  Page caps count in the order of the batches.
    """

    def __init__(
        self, responses: DataFrame, seeds: DataFrame, robots_rules: DataFrame, options: CrawlOptions, now: Column,
        root: str | None = None, extra_hosts: DataFrame | None = None, buckets: int = BUCKETS,
    ):
        """``seeds``: a frontier (url, priority, optional depth and attempts), read at the first start only."""
        spark = responses.sparkSession
        self.root = root or new_location(spark, "crawl")
        self.robots_rules, self.options, self.now, self.extra_hosts = robots_rules, options, now, extra_hosts
        self.spark, self.responses = spark, responses

        def state(name: str, schema: StructType, key: str, order: list[Column] | None = None) -> BucketedState:
            return BucketedState(spark, f"{self.root}/{name}", schema, [key], order, buckets)

        self.pages = state("pages", page_table(responses).schema, "request", newest_response())
        self.visited = state("visited", _VISITED, "url")
        self.finals = state("finals", StructType().add("final", "string").add("domain", "string"), "final")
        self.counts = state("counts", StructType().add("domain", "string").add("n", "long"), "domain")
        self.found = state("found", _FOUND, "url", [F.col("depth"), F.col("source_url")])
        if last_committed(spark, f"{self.root}/checkpoint") < 0:
            given = {"depth": F.lit(0), "attempts": F.lit(0)}
            whole = seeds.withColumns({c: v for c, v in given.items() if c not in seeds.columns})
            self._frontier(whole, "overwrite")

    def _frontier(self, rows: DataFrame, mode: str) -> None:
        rows.select([F.col(f.name).cast(f.dataType) for f in _FRONTIER.fields]).write.mode(mode).parquet(f"{self.root}/frontier")

    def run(self) -> CrawlResult:
        """Take up what there is of both sources until no address is left to follow."""
        answers = self.responses.select(F.struct(*self.responses.columns).alias("response"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in _FRONTIER.fields])
        frontier = file_stream(self.spark, f"{self.root}/frontier", _FRONTIER)
        both = answers.unionByName(frontier.withColumn("response", F.lit(None).cast(answers.schema["response"].dataType)))
        last, number = -1, run_available(both, self._step, f"{self.root}/checkpoint")
        while number > last:
            last, number = number, run_available(both, self._step, f"{self.root}/checkpoint")
        everything = self.visited.read(last)
        return crawl_result(everything, self.found.read(last), self.options, None, self.now)

    def _step(self, batch: DataFrame, number: int) -> None:
        answers = page_table(batch.filter("response is not null").select("response.*"))
        answers = materialize(first_per_key(answers, ["request"], newest_response()), "answers")
        self.pages.write(answers, number)
        jobs = materialize(self._jobs(batch.filter("url is not null"), answers, number), "jobs")

        waiting = F.col("status").isNull() | F.col("status").isin(*UNANSWERED)
        open_jobs = jobs.filter(waiting)
        facts = self.pages.lookup(materialize(open_jobs.select(F.col("url").alias("request")), "open"), number).drop("links")
        judged = judge(
            open_jobs.select("url", "depth", "priority", "attempts"), facts, self.robots_rules, self.options,
            lambda candidates: self._limits(candidates, number - 1), self.now, self.extra_hosts,
        )
        outcome = judged.join(open_jobs.select("url", "attempts"), "url").select(_VISITED.names)
        moved = materialize(outcome.unionByName(jobs.filter(~waiting).select(_VISITED.names)), "judged")
        self.visited.write(moved, number)
        self._count_pages(moved, number)

        pages = moved.filter((F.col("status") == "completed") & F.col("is_page") & (F.col("depth") < self.options.max_depth))
        known = self.pages.lookup(materialize(pages.select(F.col("url").alias("request"), "final", "depth"), "followed"), number)
        linked = pages.select(F.col("url").alias("request"), "final", "depth").join(known.select("request", "links"), "request")
        links = linked.select("final", "depth", F.explode("links").alias("link"))
        links = materialize(with_verdict(links, "link", self.options.rules, self.extra_hosts).filter("allowed").drop("allowed"), "links")
        is_document = url_looks_like_pdf(F.col("link"))
        self.found.write(found_documents(moved, links.filter(is_document)), number)
        met = links.filter(~is_document).groupBy(F.col("link").alias("url")).agg((F.min("depth") + 1).alias("depth"))
        met = materialize(met.withColumns({"priority": F.lit(LINK_PRIORITY), "attempts": F.lit(0)}), "met")
        if not met.isEmpty():
            self._frontier(met, "append")

    def _jobs(self, arrived: DataFrame, answers: DataFrame, number: int) -> DataFrame:
        """Rows of the visited state to judge or move: new addresses, waiting ones with an answer, ones that came nearer."""
        fields = [F.min("depth").alias("_depth"), F.max("priority").alias("_priority"), F.max("attempts").alias("_attempts"), F.bool_or("_answered").alias("_answered")]
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in _FRONTIER.fields[1:]]
        met = arrived.select(*_FRONTIER.names, F.lit(False).alias("_answered"))
        answered = answers.select(F.col("request").alias("url"), *none, F.lit(True).alias("_answered"))
        named = materialize(met.unionByName(answered).groupBy("url").agg(*fields), "named")
        joined = named.join(self.visited.lookup(named, number - 1), "url", "left")
        new = F.col("status").isNull() & F.col("_depth").isNotNull()
        retried = F.col("status").isin(*UNANSWERED) & F.col("_answered")
        nearer = F.col("_depth") < F.col("depth")
        chosen = joined.filter(new | F.coalesce(retried, F.lit(False)) | F.coalesce(nearer, F.lit(False)))
        return chosen.withColumns(
            {"depth": F.least("depth", "_depth"), "priority": F.greatest("priority", "_priority"), "attempts": F.coalesce("attempts", "_attempts")}
        ).select(_VISITED.names)

    def _limits(self, candidates: DataFrame, number: int) -> DataFrame:
        keyed = candidates.select(domain_of(F.col("final")).alias("domain"), "final", "priority", "url")
        firsts = materialize(first_per_key(keyed, ["final"], level_order()), "yields")
        used = self.counts.lookup(firsts, number)
        return page_limits(self.finals.unseen(firsts, number), used, self.options.max_pages)

    def _count_pages(self, judged: DataFrame, number: int) -> None:
        pages = judged.filter((F.col("status") == "completed") & F.col("is_page")).select("final", domain_of(F.col("final")).alias("domain")).distinct()
        new = materialize(self.finals.unseen(materialize(pages, "finals"), number - 1), "new-finals")
        self.finals.write(new, number)
        added = materialize(new.groupBy("domain").agg(F.count("*").alias("_added")), "added")
        before = self.counts.lookup(added, number - 1)
        self.counts.write(added.join(before, "domain", "left").select("domain", (F.coalesce("n", F.lit(0)) + F.col("_added")).alias("n")), number)


def crawl_stream(
    responses: DataFrame, seeds: DataFrame, robots_rules: DataFrame, options: CrawlOptions, now: Column,
    root: str | None = None, extra_hosts: DataFrame | None = None, buckets: int = BUCKETS,
) -> CrawlResult:
    """The crawl of ``seeds`` over a stream of responses; run again with the same ``root`` it goes on with new files."""
    return CrawlStream(responses, seeds, robots_rules, options, now, root, extra_hosts, buckets).run()
