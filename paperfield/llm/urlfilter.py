"""URL lists over time: dated entries become validity intervals, and captures meet those valid when they were fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def validity(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) of ``entries`` (list, pattern, action, day): [valid_from, valid_to) in days.

    An ``add`` begins an interval, unless one is open, and the next ``remove`` ends it; an open end is null. On one day
    a removal wins over an addition. Patterns are a host, which holds for its subdomains too, or a host and a path,
    which holds for the paths below it; they count in lower case, without scheme and closing slashes. Entries with a
    null or empty field or another action are ignored, repeated ones count once.
    """
    pattern = F.regexp_replace(F.regexp_replace(F.lower(F.trim("pattern")), "^[a-z]+://", ""), "/+$", "")
    clean = entries.select("list", pattern.alias("pattern"), F.lower("action").alias("action"), F.col("day").cast("date").alias("day"))
    clean = clean.filter(F.col("list").isNotNull() & (F.col("pattern") != "") & F.col("action").isin("add", "remove") & F.col("day").isNotNull())
    days = clean.groupBy("list", "pattern", "day").agg(F.min(F.col("action") == "add").alias("on"))  # a removal wins
    order = Window.partitionBy("list", "pattern").orderBy("day")
    turns = days.withColumn("was", F.lag("on", 1, False).over(order)).filter(F.col("on") != F.col("was"))
    return turns.withColumn("valid_to", F.lead("day").over(order)).filter("on").select("list", "pattern", F.col("day").alias("valid_from"), "valid_to")


def _keys(url: Column) -> Column:
    """Host, its parent domains, and the host with each leading part of the path."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    host = F.regexp_replace(F.lower(rest), r"\.+$", "")
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/*([^?#]*)", 1))
    labels, parts = F.split(host, r"\."), F.array_remove(F.split(path, "/+"), "")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    below = F.transform(parts, lambda p, i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i + 1), "/")))
    return F.when(host != "", F.array_distinct(F.concat(domains, below))).otherwise(F.array().cast("array<string>"))


def listed(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(capture_id, n_lists, lists, patterns, since): what was valid for each of ``captures`` (capture_id, url, day).

    Lists and patterns are sorted and distinct; ``since`` is the earliest start of the intervals that hold. Captures
    without a match, with a null url or day or without a host have none. Every capture keeps its row; rows that share a
    capture_id, or have none, share one result row of all that holds for them. Other columns are ignored.

    Captures meet intervals by equality of a key and then by time; a host or domain with many captures is split by
    Spark's skewed joins, as a pattern has few intervals. Captures of one key and day are looked up once.
    """
    rows = captures.select("capture_id", F.col("day").cast("date").alias("day"), F.explode_outer(_keys(F.col("url"))).alias("key"))
    intervals = validity(entries)
    wanted = rows.select("key", "day").filter(F.col("key").isNotNull() & F.col("day").isNotNull()).distinct()
    holds = (F.col("day") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))
    valid = wanted.join(intervals, (wanted["key"] == intervals["pattern"]) & holds).select("key", "day", "list", "pattern", "valid_from")
    valid = valid.groupBy("key", "day").agg(F.collect_set("list").alias("lists"), F.min("valid_from").alias("since"))
    found = rows.join(valid, ["key", "day"]).groupBy("capture_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("lists")))).alias("lists"),
        F.array_sort(F.collect_set("key")).alias("patterns"),
        F.min("since").alias("since"),
    )
    none = F.array().cast("array<string>")
    joined = captures.select("capture_id").distinct().alias("c").join(found.alias("f"), F.expr("c.capture_id <=> f.capture_id"), "left")
    return joined.select(
        "c.capture_id",
        F.when(F.col("lists").isNull(), 0).otherwise(F.size("lists")).cast("long").alias("n_lists"),
        F.coalesce("lists", none).alias("lists"),
        F.coalesce("patterns", none).alias("patterns"),
        "since",
    )
