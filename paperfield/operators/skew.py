"""Grouped operators that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperfield.session import materialize

def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key.

    ``row_number() = 1`` is cut down before the shuffle (WindowGroupLimit), so a hot key sends one
    row per map task.
    """
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col("_rn") == 1).drop("_rn")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], cap: int, out: str = "rank") -> DataFrame:
    """Rows ranked 1..cap within their key, exact for any cap and any size of a key."""
    return rank_within(df, keys, order, out).filter(F.col(out) <= cap)


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rank") -> DataFrame:
    """``row_number()`` of every row within its key, for groups of any size.

    The rows are range partitioned by (key, order), so that a hot key spans several tasks, and
    written once to fix their places; a key's rank is then the place inside its partition plus the
    rows of the same key in earlier partitions.  ``order`` must be total within a key.
    """
    sort = [*[F.col(k) for k in keys], *order]
    placed = materialize(
        df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_place", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("_part", F.shiftright("_place", 33))
    runs = placed.groupBy(*keys, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    renamed = runs.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), "_first", "_before")
    same = F.col("_part") == F.col("_p")
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_k{i}"))
    ranked = placed.join(renamed, same).withColumn(out, F.col("_before") + F.col("_place") - F.col("_first") + 1)
    return ranked.select(*df.columns, out)


def lookup(rows: DataFrame, table: DataFrame, key: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join rows, many to a key, to a table that has few rows per key.

    Spark broadcasts the table when its measured size allows.  Otherwise adaptive execution splits
    the partitions of hot keys into as many tasks as their bytes need; the table is repeated for
    those partitions only.
    """
    return rows.join(table, [key] if isinstance(key, str) else list(key), how)


def with_next(df: DataFrame, key: str, ts: str, tie: str, out: str = "next_ts", width_seconds: int = 3600) -> DataFrame:
    """Time of the next row of the same key, by (ts, tie); NULL for the last one.

    A key is cut into time buckets, so that no task sorts its whole history: rows look ahead within
    their bucket, and the last row of a bucket takes the first time of the key's next bucket.
    """
    cut = df.withColumn("_bucket", F.floor(F.unix_micros(ts) / F.lit(width_seconds * 1_000_000)))
    firsts = cut.groupBy(key, "_bucket").agg(F.min(ts).alias("_start"))
    later = firsts.withColumn("_later", F.lead("_start").over(Window.partitionBy(key).orderBy("_bucket"))).drop("_start")
    inside = cut.withColumn("_near", F.lead(ts).over(Window.partitionBy(key, "_bucket").orderBy(ts, tie)))
    joined = inside.join(later, [key, "_bucket"], "left")
    return joined.withColumn(out, F.coalesce("_near", "_later")).select(*df.columns, out)
