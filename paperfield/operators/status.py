"""Counts, verification and the status report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperfield.functions.content import sha256_hex

# metric -> (table, condition or None); the report sections of each metric follow.
_COUNTS = {
    "agencies": ("agencies", None),
    "agencies_active": ("agencies", "active"),
    "urls": ("urls", None),
    "searches": ("searches", None),
    "searches_done": ("searches", "status = 'completed'"),
    "searches_pending": ("searches", "status in ('pending', 'running', 'backoff')"),
    "searches_blocked": ("searches", "status = 'blocked'"),
    "search_results": ("search_results", None),
    "crawl_queued": ("crawl_queue", "status = 'queued'"),
    "crawl_processing": ("crawl_queue", "status = 'processing'"),
    "crawl_done": ("crawl_queue", "status = 'completed'"),
    "crawl_failed": ("crawl_queue", "status = 'failed'"),
    "docs": ("documents", None),
    "docs_hashed": ("documents", "sha256 is not null"),
    "dl_queued": ("documents", "download_status = 'queued'"),
    "dl_active": ("documents", "download_status = 'downloading'"),
    "dl_done": ("documents", "download_status = 'complete'"),
    "dl_failed": ("documents", "download_status = 'failed'"),
}


def unpivot_counts(wide: DataFrame) -> DataFrame:
    """One row of counts as (metric, value) rows."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in wide.columns]
    return wide.select(F.inline(F.array(*pairs)))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(metric, value) of all counters; every table is read once, and only its tested columns."""
    out = None
    for table in dict.fromkeys(t for t, _ in _COUNTS.values()):
        if table not in tables:
            continue
        counters = [
            (F.count("*") if test is None else F.count_if(F.expr(test))).alias(name)
            for name, (owner, test) in _COUNTS.items()
            if owner == table
        ]
        part = unpivot_counts(tables[table].agg(*counters))
        out = part if out is None else out.unionByName(part)
    return out


def pending_pages(searches: DataFrame) -> DataFrame:
    """Waiting pages per provider and query."""
    waiting = searches.filter(F.col("status").isin("pending", "backoff"))
    return waiting.groupBy("provider", "query").agg(F.count("*").alias("pages"))


def pending_queries(searches: DataFrame) -> DataFrame:
    """Distinct queries with waiting pages, sorted."""
    return pending_pages(searches).select("provider", "query").orderBy("provider", "query")


def domain_counts(urls: DataFrame, documents: DataFrame) -> DataFrame:
    """HTML pages and documents per domain."""
    pages = urls.groupBy("domain").agg(F.count_if(F.col("url_type") == "html").alias("html_pages"))
    docs = documents.groupBy("domain").agg(F.count("*").alias("documents"))
    joined = pages.join(docs, "domain", "full_outer")
    return joined.select("domain", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("html_pages", "documents")])


def duplicate_counts(documents: DataFrame) -> DataFrame:
    """Documents, hashed ones, distinct digests and the two notions of duplicates."""
    counts = documents.agg(
        F.count("*").alias("docs"), F.count("sha256").alias("docs_hashed"), F.countDistinct("sha256").alias("digests")
    )
    return counts.select(
        "docs",
        "docs_hashed",
        "digests",
        F.greatest(F.lit(0), F.col("docs") - F.col("docs_hashed")).alias("unhashed"),
        (F.col("docs_hashed") - F.col("digests")).alias("duplicate_bodies"),
    )


def storage_stats(files: DataFrame) -> DataFrame:
    """Number and total size of the files of a scan with a ``length`` column."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"))


def file_verdict(stored: Column, found: Column, present: Column) -> Column:
    """missing, mismatch or ok; a document without a stored digest is ok when its file exists."""
    return F.when(~present, "missing").when((F.coalesce(stored, F.lit("")) != "") & (found != stored), "mismatch").otherwise("ok")


def verify_files(documents: DataFrame, files: DataFrame) -> DataFrame:
    """Completed documents with their verdict; ``files`` has (path, sha256), one row per path."""
    done = documents.filter(F.col("download_status") == "complete")
    found = files.select(F.col("path").alias("download_path"), F.col("sha256").alias("_found"), F.lit(True).alias("_present"))
    joined = done.join(found, "download_path", "left")
    return joined.withColumn(
        "verdict", file_verdict(F.col("sha256"), F.col("_found"), F.coalesce("_present", F.lit(False)))
    ).drop("_found", "_present")


def verify_bodies(documents: DataFrame, bodies: DataFrame) -> DataFrame:
    """Completed documents with their verdict against the body table (sha256, body, ...).

    Digests are recomputed where the bodies lie; only the stored and the found digest meet the documents.  A body
    under the digest of a document whose bytes have another one is a mismatch; a document without a digest is
    missing, as nothing can be found for it.
    """
    found = bodies.select(F.col("sha256").alias("_key"), sha256_hex(F.col("body")).alias("_found"))
    whole = found.groupBy(F.col("_key").alias("sha256")).agg(F.bool_and(F.coalesce(F.col("_found") == F.col("_key"), F.lit(False))).alias("_whole"))
    joined = documents.filter(F.col("download_status") == "complete").join(whole, "sha256", "left")
    verdict = F.when(F.col("_whole").isNull(), "missing").when(F.col("_whole"), "ok").otherwise("mismatch")
    return joined.withColumn("verdict", verdict).select(*documents.columns, "verdict")


def verify_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in ("ok", "mismatch", "missing")])


_SECTIONS = {
    "AGENCIES": {"discovered": "agencies", "active": "agencies_active"},
    "SEARCH": {"queries": "searches", "pages processed": "searches_done", "pages remaining": "searches_pending"},
    "CRAWLER": {"queued": "crawl_queued", "processing": "crawl_processing", "completed": "crawl_done", "failed": "crawl_failed"},
    "PDF INDEX": {"discovered": "docs", "unique": "docs_hashed", "duplicates": "docs_unhashed"},
    "DOWNLOADS": {"queued": "dl_queued", "active": "dl_active", "completed": "dl_done", "failed": "dl_failed"},
    "STORAGE": {"PDFs": "files", "bytes": "bytes"},
}


def status_report(counts: DataFrame, storage: DataFrame) -> DataFrame:
    """(section, metric, value) of the status page."""
    unhashed = counts.agg(
        F.greatest(
            F.lit(0),
            F.sum(F.when(F.col("metric") == "docs", F.col("value")).when(F.col("metric") == "docs_hashed", -F.col("value"))),
        ).alias("docs_unhashed")
    )
    values = counts.unionByName(unpivot_counts(unhashed)).unionByName(unpivot_counts(storage))
    layout = F.array(
        *[
            F.struct(F.lit(s).alias("section"), F.lit(label).alias("label"), F.lit(m).alias("_metric"))
            for s, lines in _SECTIONS.items()
            for label, m in lines.items()
        ]
    )
    lines = F.filter(layout, lambda x: x["_metric"] == F.col("metric"))
    return values.select(F.inline(F.transform(lines, lambda x: F.struct(x["section"].alias("section"), x["label"].alias("metric"), F.col("value").alias("value")))))
