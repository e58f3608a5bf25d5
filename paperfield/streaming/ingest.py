"""Incremental ingestion of search hits into the document index and the crawl queue."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperfield import schemas
from paperfield.operators.policy import HostRules
from paperfield.operators.tables import enqueue_documents, merge_documents, sightings_by_document
from paperfield.plans.discovery import enqueue_hits, hit_sightings, route_hits
from paperfield.session import materialize, new_location
from paperfield.streaming.runner import VersionedTable, run_available


@dataclass(frozen=True)
class Ingested:
    documents: DataFrame
    crawl_queue: DataFrame
    download_queue: DataFrame


def ingest_stream(
    stream: DataFrame, rules: HostRules, seen_at: Callable[[int], str], root: str | None = None
) -> Ingested:
    """Ingest a stream of hits (provider, url); ``seen_at`` gives the time of a batch by its number."""
    spark = stream.sparkSession
    root = root or new_location(spark, "ingest")
    documents = VersionedTable(spark, f"{root}/documents", schemas.DOCUMENTS)
    crawl_queue = VersionedTable(spark, f"{root}/crawl_queue", schemas.CRAWL_QUEUE)
    downloads = VersionedTable(spark, f"{root}/download_queue", schemas.DOWNLOAD_QUEUE)

    def handle(batch: DataFrame, number: int) -> None:
        at = F.lit(seen_at(number)).cast("timestamp")
        routed = materialize(route_hits(batch, rules), "routed")
        merged = materialize(sightings_by_document(hit_sightings(routed, at)), "merged")
        documents.write(merge_documents(documents.version(number - 1), merged), number)
        downloads.write(enqueue_documents(downloads.version(number - 1), merged), number)
        crawl_queue.write(enqueue_hits(crawl_queue.version(number - 1), routed, at), number)

    last = run_available(stream, handle, f"{root}/checkpoint")
    return Ingested(documents.version(last), crawl_queue.version(last), downloads.version(last))
