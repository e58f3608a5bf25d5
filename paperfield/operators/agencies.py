"""Agencies: preparation, upsert, listing and search queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperfield import schemas
from paperfield.functions.urls import canonical_url, domain_of
from paperfield.operators.tables import align, upsert

# --- fixed values -----------------------------------------------------------------------------
QUERY_TEMPLATES = (
    "site:{domain} filetype:pdf",
    'site:{domain} filetype:pdf "annual report"',
    'site:{domain} filetype:pdf "budget"',
    'site:{domain} filetype:pdf "meeting minutes"',
    'site:{domain} filetype:pdf "audit"',
)
NAME_TEMPLATE = 'site:{domain} filetype:pdf "{name}"'
DEFAULT_SOURCE = "seed"
# ----------------------------------------------------------------------------------------------


def prepare_agencies(records: DataFrame, now: Column) -> DataFrame:
    """Seed records in table form; records without a usable URL are dropped.

    The host comes from the canonical URL, not from the record.
    """
    url = canonical_url(F.col("official_url"))
    cleaned = records.withColumn("official_url", url).filter(F.col("official_url") != "")
    order = [records.schema["pos"]] if "pos" in records.columns else []
    return align(
        cleaned.withColumn("domain", domain_of(F.col("official_url")))
        .withColumn("source", F.coalesce("source", F.lit(DEFAULT_SOURCE)))
        .withColumn("active", F.coalesce("active", F.lit(True)))
        .withColumn("last_verified", F.coalesce(F.nullif(F.col("last_verified"), F.lit("")).try_cast("timestamp"), now)),
        StructType([*schemas.AGENCIES.fields, *order]),
    )


def upsert_agencies(agencies: DataFrame, prepared: DataFrame) -> DataFrame:
    """One row per (state, official_url), the record with the highest ``pos`` winning.

    Records without a state never conflict.
    """
    stateless = prepared.filter(F.col("state").isNull()).select(*agencies.columns)
    return upsert(
        agencies, prepared.filter(F.col("state").isNotNull()), ["state", "official_url"], [F.desc("pos")]
    ).unionByName(stateless)


def list_agencies(agencies: DataFrame, state: str | None = None, agency: str | None = None) -> DataFrame:
    """Active agencies by case-insensitive state and name pattern, in order of state and name."""
    out = agencies.filter(F.col("active"))
    if state:
        out = out.filter(F.lower("state") == state.lower())
    if agency:
        pattern = agency.lower().replace("\\", "\\\\")
        out = out.filter(F.lower("agency_name").like(f"%{pattern}%"))
    return out.orderBy("state", "agency_name")


def search_queries(agencies: DataFrame) -> DataFrame:
    """One row per agency and query: the agency's columns, ``template_no`` (from 1) and ``query``."""

    def fill(template: str) -> Column:
        text = F.replace(F.lit(template), F.lit("{domain}"), F.col("domain"))
        return F.replace(text, F.lit("{name}"), F.coalesce("agency_name", F.lit("")))

    fixed = F.array(*[fill(t) for t in QUERY_TEMPLATES])
    named = F.coalesce(F.col("agency_name"), F.lit("")) != ""
    queries = F.when(named, F.concat(fixed, F.array(fill(NAME_TEMPLATE)))).otherwise(fixed)
    listed = agencies.select("*", F.posexplode(queries).alias("_no", "query"))
    return listed.withColumn("template_no", F.col("_no") + 1).drop("_no")
