"""Recovery after an interruption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperfield.operators.queues import release_documents, release_expired


def resume(
    searches: DataFrame, crawl_queue: DataFrame, download_queue: DataFrame, documents: DataFrame, now: Column
) -> dict[str, DataFrame]:
    """Give expired leases back and make interrupted result pages pending again."""
    running = F.when(F.col("status") == "running", "pending").otherwise(F.col("status"))
    return {
        "searches": searches.withColumn("status", running),
        "documents": release_documents(documents, download_queue, now),
        "crawl_queue": release_expired(crawl_queue, now),
        "download_queue": release_expired(download_queue, now),
    }
