"""CSV and JSON-lines exports and the content-addressed body table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from paperfield.operators.skew import lookup

# --- fixed values -----------------------------------------------------------------------------
EXPORT_COLUMNS = (
    "state",
    "agency",
    "agency_type",
    "pdf_url",
    "canonical_url",
    "filename",
    "domain",
    "content_length",
    "sha256",
    "etag",
    "last_modified",
    "first_seen",
    "last_seen",
    "download_status",
    "download_path",
    "http_status",
)
# ----------------------------------------------------------------------------------------------

_TIMESTAMPS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def export_rows(documents: DataFrame, agencies: DataFrame) -> DataFrame:
    """Documents with the type of their agency, in export columns.

    (state, agency_name) is no key of the agencies, so a document may come out more than once.
    Documents without an agency skip the join.
    """
    types = agencies.select("state", F.col("agency_name").alias("agency"), "agency_type")
    named = F.col("state").isNotNull() & F.col("agency").isNotNull()
    joined = lookup(documents.filter(named), types, ["state", "agency"])
    rest = documents.filter(~named).withColumn("agency_type", F.lit(None).cast("string"))
    return joined.select(*EXPORT_COLUMNS).unionByName(rest.select(*EXPORT_COLUMNS))


def _ordered(rows: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return rows.orderBy("first_seen", "canonical_url", "agency_type").observe(seen, F.count("*").alias("n")), seen


def write_csv(rows: DataFrame, path: str) -> int:
    """Header, fixed columns, NULL as an empty field; returns the number of rows."""
    ordered, seen = _ordered(rows)
    ordered.write.csv(path, header=True, nullValue="", emptyValue="", escape='"', timestampFormat=_TIMESTAMPS)
    return seen.get["n"]


def write_jsonl(rows: DataFrame, path: str, ascii_only: bool = False) -> int:
    """One object per line with NULLs kept; returns the number of rows."""
    ordered, seen = _ordered(rows)
    options = {"ignoreNullFields": "false", "timestampFormat": _TIMESTAMPS, "writeNonAsciiCharacterAsCodePoint": str(ascii_only).lower()}
    ordered.write.options(**options).json(path)
    return seen.get["n"]


BODY_BUCKETS = 256


def body_bucket(digest: Column) -> Column:
    """Bucket of a digest in the body table; the hash by which Spark exchanges rows."""
    return F.pmod(F.hash(digest), F.lit(BODY_BUCKETS))


def write_bodies(unique: DataFrame, path: str) -> None:
    """Append (sha256, body) to the body table, one folder per bucket of digests, with p1 and p2 of their paths.

    An exchange by digest into a multiple of the number of buckets, at least the number of shuffle partitions, leaves each
    task one folder, so the number of files does not grow as tasks times buckets.  Files are sorted by digest, so a
    lookup reads one folder and skips all but one row group of a file.
    """
    tasks = BODY_BUCKETS * -(-int(unique.sparkSession.conf.get("spark.sql.shuffle.partitions")) // BODY_BUCKETS)
    p1, p2 = F.substring("sha256", 1, 2), F.substring("sha256", 3, 2)
    placed = unique.withColumns({"p1": p1, "p2": p2, "bucket": body_bucket(F.col("sha256"))})
    placed.repartition(tasks, "sha256").sortWithinPartitions("bucket", "sha256").write.mode("append").partitionBy("bucket").parquet(path)
