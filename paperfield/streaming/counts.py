"""Status counts over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperfield.session import new_location


def windowed_counts(events: DataFrame, ts: str = "ts", kind: str = "event_type", width: str = "1 day") -> DataFrame:
    """(start, kind, n) per tumbling window; works on tables and on streams."""
    counted = events.groupBy(F.window(ts, width).alias("_w"), kind).agg(F.count("*").alias("n"))
    return counted.select(F.col("_w.start").alias("start"), kind, "n")


def windowed_counts_stream(
    stream: DataFrame, ts: str = "ts", kind: str = "event_type", width: str = "1 day", delay: str = "0 seconds", root: str | None = None
) -> DataFrame:
    """Closed windows only: a window comes out once the watermark has passed its end."""
    spark = stream.sparkSession
    root = root or new_location(spark, "counts")
    counts = windowed_counts(stream.withWatermark(ts, delay), ts, kind, width)
    writer = counts.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
    started = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    started.awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{root}/out")
