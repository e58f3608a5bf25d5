"""Micro-batches over versioned tables.

Batch n writes version n of a table from version n - 1 and overwrites it when it is replayed, so a
lost executor or a restarted query never applies a batch twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Handler = Callable[[DataFrame, int], None]


class VersionedTable:
    """A table with one Parquet folder per micro-batch."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def version(self, number: int) -> DataFrame:
        if number < 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/v{number}")

    def write(self, df: DataFrame, number: int) -> None:
        df.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.root}/v{number}")

    def up_to(self, number: int) -> DataFrame:
        """All rows of the versions 0..number, for tables that only grow."""
        if number < 0:
            return self.version(-1)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/v{n}" for n in range(number + 1)])


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """Number of the newest committed batch of a query, -1 if there is none."""
    try:
        commits = spark.read.format("binaryFile").load(f"{checkpoint}/commits")
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return -1
    number = F.regexp_extract("path", r"/([0-9]+)$", 1).try_cast("int")
    newest = commits.agg(F.max(number)).first()[0]
    return -1 if newest is None else newest


def run_available(stream: DataFrame, handle: Handler, checkpoint: str) -> int:
    """Process what is there, batch by batch; returns the number of the newest batch, -1 for none."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return last_committed(stream.sparkSession, checkpoint)


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A stream over the Parquet files of a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)
