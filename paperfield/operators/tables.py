"""Keyed tables: first-wins inserts, last-wins upserts, group replacement, document merge.

Plain Parquet has no MERGE, so each operator returns the new version of a table from the old one
and a batch.  Batches are reduced to one row per key before they are joined, so a hot key in a
batch never meets the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperfield.functions.urls import canonical_url, domain_of, filename_from_url
from paperfield.operators.skew import first_per_key


def align(df: DataFrame, schema, **defaults: Column) -> DataFrame:
    """Give ``df`` the columns of ``schema``: absent ones come from ``defaults`` or are NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def new_rows(existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of the batch whose key is not in ``existing`` yet, the first of each key."""
    return first_per_key(batch, keys, order).join(existing.select(*keys), list(keys), "left_anti")


def batch_counts(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(accepted, created): rows of the batch, and keys that ``existing`` did not hold."""
    created = batch.select(*keys).distinct().join(existing.select(*keys), list(keys), "left_anti")
    counts = batch.agg(F.count("*").alias("accepted"), F.lit(0).cast("long").alias("created"))
    both = counts.unionByName(created.agg(F.lit(0).cast("long").alias("accepted"), F.count("*").alias("created")))
    return both.agg(F.sum("accepted").alias("accepted"), F.sum("created").alias("created"))


def insert_new(existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First write wins."""
    fresh = new_rows(existing, batch, keys, order)
    return existing.unionByName(fresh.select(*existing.columns))


def upsert(existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Last write wins: the batch beats the table, and within the batch the first by ``order``."""
    winners = first_per_key(batch, keys, order)
    return existing.join(winners.select(*keys), list(keys), "left_anti").unionByName(winners.select(*existing.columns))


def replace_groups(existing: DataFrame, batch: DataFrame, group: Sequence[str]) -> DataFrame:
    """Drop every old row of a group that the batch mentions, then add the batch."""
    touched = batch.select(*group).distinct()
    return existing.join(touched, list(group), "left_anti").unionByName(batch.select(*existing.columns))


def add_columns(df: DataFrame, **defaults: Column) -> DataFrame:
    """Additive schema evolution: absent columns are added, NULLs take the default."""
    for name, value in defaults.items():
        current = F.coalesce(F.col(name), value) if name in df.columns else value
        df = df.withColumn(name, current)
    return df


def sightings_by_document(sightings: DataFrame) -> DataFrame:
    """One row per canonical URL of a batch of (url, source_url, state, agency, depth, seen_at)."""
    keyed = sightings.withColumn("canonical_url", canonical_url(F.col("url"))).filter(F.col("canonical_url") != "")
    first = F.struct("depth", "seen_at", "url", "source_url", "state", "agency")
    order = F.struct("seen_at", "depth", "url", F.coalesce("source_url", F.lit("")))
    return keyed.groupBy("canonical_url").agg(
        F.min_by(first, order).alias("_first"), F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen")
    )


def merge_documents(documents: DataFrame, merged: DataFrame) -> DataFrame:
    """New version of the document table: known documents move ``last_seen``, others are queued."""
    old = documents.alias("old")
    new = merged.select("canonical_url", F.col("_first").alias("_f"), F.col("first_seen").alias("_fs"), F.col("last_seen").alias("_ls"))
    joined = old.join(new, "canonical_url", "full_outer")
    known = F.col("old.download_status").isNotNull()
    fresh = {
        "pdf_url": F.col("_f.url"),
        "filename": filename_from_url(F.col("canonical_url")),
        "domain": domain_of(F.col("canonical_url")),
        "state": F.col("_f.state"),
        "agency": F.col("_f.agency"),
        "first_seen": F.col("_fs"),
        "last_seen": F.col("_ls"),
        "download_status": F.lit("queued"),
    }

    def column(field) -> Column:
        name = field.name
        if name == "canonical_url":
            return F.col(name)
        if name == "last_seen":
            return F.greatest(F.col("old.last_seen"), F.col("_ls")).alias(name)
        return F.when(known, F.col(f"old.{name}")).otherwise(fresh.get(name, F.lit(None))).cast(field.dataType).alias(name)

    return joined.select(*[column(f) for f in documents.schema.fields])


def merge_document_urls(urls: DataFrame, merged: DataFrame) -> DataFrame:
    """New version of the URL table after documents were recorded."""
    new = merged.select("canonical_url", F.col("_first").alias("_f"), F.col("first_seen").alias("_fs"), F.col("last_seen").alias("_ls"))
    joined = urls.alias("old").join(new, "canonical_url", "full_outer")
    known, touched = F.col("old.status").isNotNull(), F.col("_f").isNotNull()
    fresh = {
        "url": F.col("_f.url"),
        "domain": domain_of(F.col("canonical_url")),
        "url_type": F.lit("pdf"),
        "source_url": F.col("_f.source_url"),
        "depth": F.col("_f.depth"),
        "discovered_at": F.col("_fs"),
    }

    def column(field) -> Column:
        name = field.name
        if name == "canonical_url":
            return F.col(name)
        if name == "status":
            value = F.when(touched, "indexed").otherwise(F.col("old.status"))
        elif name == "last_checked":
            value = F.greatest(F.col("old.last_checked"), F.col("_ls"))
        else:
            value = F.when(known, F.col(f"old.{name}")).otherwise(fresh.get(name, F.lit(None)))
        return value.cast(field.dataType).alias(name)

    return joined.select(*[column(f) for f in urls.schema.fields])


def enqueue_documents(queue: DataFrame, merged: DataFrame) -> DataFrame:
    """Download queue with a row for every document that has none."""
    batch = align(
        merged.select("canonical_url", F.col("first_seen").alias("added_at")), queue.schema,
        status=F.lit("queued"), attempts=F.lit(0),
    )
    return insert_new(queue, batch, ["canonical_url"], [F.col("added_at")])
