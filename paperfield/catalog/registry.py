"""Registry of queries and shared views of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperfield import schemas
from paperfield.operators.policy import HostRules
from paperfield.operators.tables import align

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NOW = "2024-01-15 00:00:00"
RULES = HostRules(
    allowed=("*.example.com", "*.example.o?g"),
    denied=("*.cheap-pills.example.com", "spam-*.example.org"),
    extra=("blog.tionsh.example.net",),
)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def plain(column: str) -> Column:
    """A timestamp column without zone, as the given tables have it."""
    return F.col(column).cast("timestamp_ntz").alias(column)


def crawl_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """The event log read as a crawl queue: one job per event."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    kind = F.col("event_type")
    wait = F.make_dt_interval(mins=F.floor("value").cast("int"))
    return align(
        events.select(
            F.format_string("https://q%d.example.gov/job/%d", "user_id", "event_id").alias("url"),
            F.when(kind.isin("view", "signup"), "queued").when(kind == "click", "processing").when(kind == "purchase", "completed").otherwise("failed").alias("status"),
            F.when(F.col("user_id") % 3 == 0, 10).when(F.col("user_id") % 3 == 1, 5).otherwise(0).alias("priority"),
            (F.col("event_id") % 7).alias("attempts"),
            F.when(kind == "signup", F.col("ts") + wait).alias("next_attempt"),
            F.when(kind == "click", F.lit("w")).alias("worker_id"),
            F.when(kind == "click", F.col("ts") + wait).alias("locked_until"),
            F.col("ts").alias("added_at"),
        ),
        schemas.CRAWL_QUEUE,
        depth=F.lit(0),
    )


CRAWL_JOBS = """jobs as (select 'https://q' || user_id || '.example.gov/job/' || event_id as url,
  case when event_type in ('view','signup') then 'queued' when event_type = 'click' then 'processing'
       when event_type = 'purchase' then 'completed' else 'failed' end as status,
  case user_id % 3 when 0 then 10 when 1 then 5 else 0 end as priority, event_id % 7 as attempts,
  case when event_type = 'signup' then ts + to_minutes(cast(floor(value) as integer)) end as next_attempt,
  case when event_type = 'click' then ts + to_minutes(cast(floor(value) as integer)) end as locked_until,
  ts as added_at, 'q' || user_id || '.example.gov' as domain from events)"""


def search_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The event log read as a search plan: one result page per event."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    kind = F.col("event_type")
    return align(
        events.select(
            F.concat(F.lit("p"), F.col("user_id") % 3).alias("provider"),
            F.concat(F.lit("query "), F.col("user_id")).alias("query"),
            F.col("event_id").cast("int").alias("page"),
            F.when(kind.isin("view", "error"), "pending").when(kind == "click", "backoff").when(kind == "purchase", "completed").otherwise("running").alias("status"),
            (F.col("event_id") % 5).alias("attempts"),
            F.when(kind == "click", F.col("ts") + F.make_dt_interval(mins=F.floor("value").cast("int"))).alias("next_attempt"),
        ),
        schemas.SEARCHES,
    )


SEARCH_PAGES = """searches as (select 'p' || (user_id % 3) as provider, 'query ' || user_id as query, event_id as page,
  case when event_type in ('view','error') then 'pending' when event_type = 'click' then 'backoff'
       when event_type = 'purchase' then 'completed' else 'running' end as status, event_id % 5 as attempts,
  case when event_type = 'click' then ts + to_minutes(cast(floor(value) as integer)) end as next_attempt from events)"""


def document_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The documents with an address each and their text as body."""
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id",
        F.format_string("https://%s.example.gov/%s/report %d.pdf", "source", "lang", "doc_id").alias("pdf_url"),
        F.concat("source", F.lit(".example.gov")).alias("domain"),
        F.col("lang").alias("state"),
        F.col("source").alias("agency"),
        F.col("text").cast("binary").alias("body"),
    )


DOCUMENT_ROWS = """docs as (select doc_id, 'https://' || source || '.example.gov/' || lang || '/report ' || doc_id || '.pdf' as pdf_url,
  source || '.example.gov' as domain, lang as state, source as agency, text, sha256(text) as sha256 from documents)"""


def agency_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as agencies, their nations as states."""
    supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("state"),
        F.when(F.col("s_suppkey") % 10 == 0, F.lit(None)).otherwise(F.col("s_name")).alias("agency_name"),
        F.when(F.col("s_acctbal") > 5000, "portal").otherwise("board").alias("agency_type"),
        F.format_string("https://WWW.s%d.gov:443/home/?utm_source=x", F.col("s_suppkey") % 60).alias("official_url"),
        F.format_string("www.s%d.gov", F.col("s_suppkey") % 60).alias("domain"),
        F.lit(None).cast("string").alias("source"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit(None)).otherwise(F.col("s_acctbal") > 0).alias("active"),
        F.lit(None).cast("string").alias("last_verified"),
        F.col("s_suppkey").alias("pos"),
    )


AGENCY_ROWS = """agencies as (select n_name as state, case when s_suppkey % 10 <> 0 then s_name end as agency_name,
  case when s_acctbal > 5000 then 'portal' else 'board' end as agency_type,
  'https://www.s' || (s_suppkey % 60) || '.gov/home' as official_url, 'www.s' || (s_suppkey % 60) || '.gov' as domain,
  case when s_suppkey % 4 = 0 then true else s_acctbal > 0 end as active, s_suppkey as pos
  from supplier join nation on s_nationkey = n_nationkey)"""

# --- SQL fragments over the URLs of the pages ---------------------------------------------------
HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"
PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
RAW_QUERY = "regexp_extract(url, '[?]([^#]*)', 1)"
TRACKING = "('utm_source','utm_medium','utm_campaign','utm_term','utm_content','utm_id','gclid','fbclid','mc_cid','mc_eid','msclkid','_ga')"


def encoded(text: str) -> str:
    return f"replace(url_encode(url_decode(replace({text}, '+', '%20'))), '%20', '+')"


QUERY = (
    f"array_to_string(list_transform(list_filter(string_split({RAW_QUERY}, '&'), lambda p: p <> '' and lower(split_part(p, '=', 1)) not in {TRACKING}), "
    f"lambda p: {encoded('split_part(p, $$=$$, 1)')} || '=' || {encoded('substr(p, length(split_part(p, $$=$$, 1)) + 2)')}), '&')"
)
CANONICAL = (
    f"lower(regexp_extract(url, '^([A-Za-z]+):', 1)) || '://' || {HOST} || case when {PATH} in ('', '/') then '/' else rtrim({PATH}, '/') end"
    f" || case when {QUERY} = '' then '' else '?' || {QUERY} end"
)
PAGES = f"canon as (select page_id, url, html, {CANONICAL} as canonical, {HOST} as host from pages)"
LINKS = (
    PAGES
    + """, refs as (select page_id, url, canonical, host, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as ref,
  generate_subscripts(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1), 1) as pos from canon),
  links as (select page_id, pos, url, canonical, host, ref, regexp_extract(url, '^([a-z]+://)', 1) || host || ref as link from refs)"""
)


def allowed_sql(host: str) -> str:
    return (
        f"(not regexp_matches({host}, '^(.*[.]cheap-pills[.]example[.]com|spam-.*[.]example[.]org)$') and "
        f"({host} = 'blog.tionsh.example.net' or {host} like '%.blog.tionsh.example.net' or regexp_matches({host}, '^.*[.]example[.](com|o.g)$')))"
    )
