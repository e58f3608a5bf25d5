"""Schemas of the tables.  Keys are natural: canonical URLs instead of surrogate numbers."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
    "binary": BinaryType(),
    "headers": MapType(StringType(), StringType()),
}


def _schema(**fields: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields.items()])


AGENCIES = _schema(
    state="string", agency_name="string", agency_type="string", official_url="string", domain="string",
    source="string", active="boolean", last_verified="timestamp",
)
URLS = _schema(
    canonical_url="string", url="string", domain="string", url_type="string", source_url="string", depth="int",
    discovered_at="timestamp", status="string", last_checked="timestamp",
)
DOCUMENTS = _schema(
    canonical_url="string", pdf_url="string", filename="string", domain="string", state="string", agency="string",
    content_length="long", sha256="string", etag="string", last_modified="string", first_seen="timestamp",
    last_seen="timestamp", download_status="string", download_path="string", http_status="int", error="string",
)
SEARCHES = _schema(
    provider="string", query="string", page="int", status="string", result_count="int", started_at="timestamp",
    completed_at="timestamp", attempts="int", error="string", next_attempt="timestamp",
)
SEARCH_RESULTS = _schema(
    provider="string", query="string", page="int", pos="int", url="string", title="string", snippet="string",
    seen_at="timestamp",
)
CRAWL_QUEUE = _schema(
    url="string", depth="int", priority="int", status="string", attempts="int", next_attempt="timestamp",
    worker_id="string", locked_until="timestamp", added_at="timestamp",
)
DOWNLOAD_QUEUE = _schema(
    canonical_url="string", status="string", attempts="int", next_attempt="timestamp", worker_id="string",
    locked_until="timestamp", added_at="timestamp",
)
ROBOTS = _schema(domain="string", body="string", status="int", fetched_at="timestamp")
RESPONSES = _schema(
    request_url="string", final_url="string", status="int", headers="headers", body="binary", fetched_at="timestamp"
)
RESULT_PAGES = _schema(
    provider="string", query="string", page="int", status="int", retry_after="string", html="string",
    fetched_at="timestamp",
)
BODIES = _schema(sha256="string", body="binary", p1="string", p2="string")
DOWNLOAD_PARTS = _schema(
    canonical_url="string", part_no="int", status="int", offset="long", total="long", headers="headers", bytes="binary",
)
PARTS = _schema(doc_id="long", part_no="int", status="int", offset="long", bytes="binary")

SEED_RECORD = StructType(
    [
        *[StructField(n, StringType()) for n in ("state", "agency_name", "agency_type", "official_url", "domain", "source")],
        StructField("active", BooleanType()),
        StructField("last_verified", StringType()),
    ]
)
SEED_FILE = StructType([StructField("agencies", ArrayType(SEED_RECORD)), *SEED_RECORD.fields])
