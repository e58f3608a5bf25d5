"""Seed files, file trees and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperfield import schemas
from paperfield.functions.content import sha256_hex

_FILE_SCAN = "path string, modificationTime timestamp, length long, content binary"


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Agency records of JSON files holding ``{"agencies": [...]}`` or a bare list.

    ``pos`` orders the records by file name and by their place in the file.
    """
    names = schemas.SEED_RECORD.names
    files = spark.read.schema(schemas.SEED_FILE).json(path, multiLine=True)
    flat = F.when(F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull(), F.array(F.struct(*names)))
    # A bare list gives one row per record, in the order of the file.
    located = files.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row"))
    listed = located.select("_file", "_row", F.posexplode(F.coalesce(F.col("agencies"), flat)).alias("_no", "_r"))
    pos = F.struct(F.col("_file").alias("file"), F.col("_row").alias("row"), F.col("_no").cast("long").alias("no"))
    return listed.filter(F.col("_r").isNotNull()).select("_r.*", pos.alias("pos"))


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table with a declared schema; columns that older files lack come back as NULL."""
    return spark.read.schema(schema).parquet(path)


def scan_files(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, length) of the files below ``root``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    try:
        files = reader.load(root)
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        files = spark.createDataFrame([], _FILE_SCAN)
    return files.filter(~F.col("path").endswith(".part")).select("path", "length")


def hash_files(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, sha256) of the files below ``root``; ``path`` is plain, without a scheme."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), sha256_hex(F.col("content")).alias("sha256"))
