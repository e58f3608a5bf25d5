"""From fetched bodies to the stored, deduplicated document index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperfield.functions.retry import DOWNLOAD_RETRIES
from paperfield.operators.bodies import body_facts, number_collisions, unique_bodies, with_paths
from paperfield.operators.queues import finish_downloads
from paperfield.operators.skew import lookup
from paperfield.session import materialize


@dataclass(frozen=True)
class DownloadStep:
    queue: DataFrame
    documents: DataFrame
    bodies: DataFrame


def download_step(
    queue: DataFrame,
    documents: DataFrame,
    fetched: DataFrame,
    root: str,
    layout: str = "content_addressed",
    retries: int = DOWNLOAD_RETRIES,
    stored: DataFrame | None = None,
    claimed: DataFrame | None = None,
) -> DownloadStep:
    """Apply one batch of fetched bodies (canonical_url, http_status, headers, body, resumed, at).

    One scan writes the facts of the answers, and everything is decided on those.  ``bodies`` then takes, in a second
    scan, one body of each digest that is not in ``stored`` (sha256).  Answers whose address is not in ``claimed``
    (canonical_url) are left out by their facts, so no body moves for that.
    """
    facts = materialize(body_facts(fetched), "facts")
    if claimed is not None:
        facts = facts.join(claimed.select("canonical_url"), "canonical_url", "left_semi")
    results = with_paths(facts.join(documents.select("canonical_url", "state", "filename"), "canonical_url"), root, layout)
    if layout != "content_addressed":
        good = results.filter("ok").select(
            F.col("download_path").alias("dest"), "sha256", F.struct("at", "canonical_url").alias("arrived")
        )
        taken = documents.filter(F.col("download_path").isNotNull() & F.col("sha256").isNotNull())
        names = number_collisions(good, taken.select(F.col("download_path").alias("path"), "sha256")).select(F.col("dest").alias("download_path"), "sha256", "final_path")
        results = (
            lookup(results, names, ["download_path", "sha256"])
            .withColumn("download_path", F.coalesce("final_path", "download_path"))
            .drop("final_path")
        )
    results = materialize(results, "results")
    new_queue, new_documents = finish_downloads(queue, documents, results, retries)
    wanted = results.filter("ok").groupBy("sha256").agg(F.count("*").alias("copies"))
    if stored is not None:
        wanted = wanted.join(stored.select("sha256"), "sha256", "left_anti")
    return DownloadStep(new_queue, new_documents, unique_bodies(fetched, wanted=wanted))
