"""Search plan, result page and agency queries."""

from pyspark.sql import functions as F

from paperfield import schemas
from paperfield.catalog.registry import (
    AGENCY_ROWS,
    RULES,
    agency_rows,
    now,
    query,
    table,
)
from paperfield.functions import urls
from paperfield.operators import agencies, policy, resultpages, tables
from paperfield.operators.policy import HostRules
from paperfield.plans import discovery
from paperfield.plans.crawl import agency_seeds, seed_frontier
from paperfield.session import materialize

_TEMPLATES = """queries as (select *, unnest(list_concat(list_value('site:' || domain || ' filetype:pdf', 'site:' || domain || ' filetype:pdf "annual report"',
  'site:' || domain || ' filetype:pdf "budget"', 'site:' || domain || ' filetype:pdf "meeting minutes"', 'site:' || domain || ' filetype:pdf "audit"'),
  case when agency_name is null then [] else list_value('site:' || domain || ' filetype:pdf "' || agency_name || '"') end)) as query from agencies where active)"""


def _agencies(spark, folder):
    return agencies.prepare_agencies(agency_rows(spark, folder), now())


@query(
    f"""with {AGENCY_ROWS} select state, agency_name, agency_type, official_url, domain, active from agencies
    where active and lower(state) in ('nation_1') and lower(agency_name) like '%supp%er#%'
    union all select state, agency_name, agency_type, official_url, domain, active from agencies where active and lower(agency_name) like '%#0000_0%1%'"""
)
def agency_filter(spark, folder):
    table_ = _agencies(spark, folder)
    picked = agencies.list_agencies(table_, "Nation_1", "SUPP%er#").unionByName(agencies.list_agencies(table_, agency="#0000_0%1"))
    return picked.select("state", "agency_name", "agency_type", "official_url", "domain", "active")


@query(
    f"""with {AGENCY_ROWS}, ranked as (select *, row_number() over (partition by state, official_url order by pos desc) as rn from agencies)
    select state, official_url, agency_name, agency_type, domain, 'seed' as source, active from ranked where rn = 1"""
)
def agency_upsert(spark, folder):
    """Two batches of records; the last one wins per (state, official_url)."""
    records = agencies.prepare_agencies(agency_rows(spark, folder), now())
    empty = spark.createDataFrame([], schemas.AGENCIES)
    first = agencies.upsert_agencies(empty, records.filter("pos % 2 = 0"))
    merged = agencies.upsert_agencies(first, records)
    return merged.select("state", "official_url", "agency_name", "agency_type", "domain", "source", "active")


@query(f"with {AGENCY_ROWS} select distinct domain as host from agencies")
def agency_domains(spark, folder):
    return policy.agency_hosts(_agencies(spark, folder))


@query(f"with {AGENCY_ROWS}, {_TEMPLATES} select distinct 'yahoo' as provider, query, page from queries, (select unnest(range(1, 11)) as page)")
def query_plan(spark, folder):
    plan = discovery.plan_searches(_agencies(spark, folder).filter("active"), "yahoo")
    return plan.select("provider", "query", F.col("page").cast("bigint").alias("page"))


@query(
    f"""with {AGENCY_ROWS}, {_TEMPLATES}, plan as (select distinct query, page from queries, (select unnest(range(1, 11)) as page)),
    known as (select distinct query, page from queries, (select unnest(range(1, 4)) as page) where state <> 'NATION_3')
    select (select count(*) from plan) as planned, (select count(*) from plan anti join known using (query, page)) as created"""
)
def plan_new_rows(spark, folder):
    """Wanted pages and those that an earlier, shorter plan did not hold yet."""
    active = _agencies(spark, folder).filter("active")
    earlier = discovery.plan_searches(active.filter("state <> 'NATION_3'"), "yahoo", 3)
    plan = discovery.plan_searches(active, "yahoo")
    counts = tables.batch_counts(earlier, plan, discovery.PAGE_KEY)
    return counts.select(F.col("accepted").alias("planned"), "created")


@query(
    f"""with {AGENCY_ROWS}, {_TEMPLATES} select distinct query, page, 'https://search.yahoo.com/search?p=' || replace(url_encode(query), '%20', '+') || '&b=' || (1 + (page - 1) * 10) || '&pz=10' as request
    from queries, (select unnest(range(1, 11)) as page)"""
)
def result_page_url(spark, folder):
    plan = discovery.plan_searches(_agencies(spark, folder).filter("active"), "yahoo")
    request = urls.result_page_url(F.col("query"), F.col("page"))
    return plan.select("query", F.col("page").cast("bigint").alias("page"), request.alias("request"))


@query("""select page_id, url as target from pages union all select -1 - page_id, url from pages union all select 1000000000 + page_id, 'https://plain.gov/' || page_id from pages""")
def result_unwrap(spark, folder):
    """Redirect links in their query and path forms, and plain links."""
    pages, url = table(spark, folder, "pages"), urls.form_encode(F.col("url"))
    hrefs = F.array(
        F.struct(F.col("page_id").alias("page_id"), F.concat(F.lit("https://r.search.yahoo.com/x?a=1&RU="), urls.form_encode(url)).alias("href")),
        F.struct((-1 - F.col("page_id")).alias("page_id"), F.concat(F.lit("https://r.search.yahoo.com/_ylt=z/RU="), url, F.lit("/RK=2/RS=abc")).alias("href")),
        F.struct((F.lit(1000000000) + F.col("page_id")).alias("page_id"), F.concat(F.lit("https://plain.gov/"), F.col("page_id").cast("string")).alias("href")),
    )
    return pages.select(F.inline(hrefs)).select("page_id", urls.unwrap_result_url(F.col("href")).alias("target"))


def _result_pages(spark, folder):
    """Captured result pages: per document one page with a wrapped, a plain, a repeated and an own link."""
    docs = table(spark, folder, "documents")
    target = F.concat(F.lit("https://"), "source", F.lit(".example.com/"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, ".pdf").otherwise(".html"))
    wrapped = F.concat(F.lit("https://r.search.yahoo.com/RU="), urls.form_encode(target), F.lit("/RK=2"))
    word = F.regexp_extract("text", r"^[\p{L}\p{N}_]+", 0)
    html = F.concat(
        F.lit("<html><div id='nav'><a href='https://nav.example.com/'>nav</a></div><div class='r'><h3><a href='"), wrapped, F.lit("'>Doc <b>"), word,
        F.lit("</b></a></h3><p> found "), F.col("lang"), F.lit(" </p></div><ol class='searchCenterMiddle'><li><a href='https://spam-farm.example.org/"),
        F.col("source"), F.lit("'>spam</a></li></ol><h3><a href='"), target, F.lit("'>again</a><a href='https://search.yahoo.com/search?p=1'>own</a></h3></html>"),
    )
    return docs.select(
        F.lit("yahoo").alias("provider"), F.concat(F.lit("q "), "source").alias("query"), F.col("doc_id").cast("int").alias("page"),
        F.when(F.col("doc_id") % 10 == 9, 429).when(F.col("doc_id") % 10 == 8, 500).otherwise(200).alias("status"),
        F.when(F.col("doc_id") % 20 == 9, "60").alias("retry_after"), html.alias("html"), now().alias("fetched_at"),
    )


_HITS = """found as (select source, doc_id, 'https://' || source || '.example.com/' || doc_id || case when doc_id % 2 = 0 then '.pdf' else '.html' end as url,
  'Doc ' || regexp_extract(text, '^[\\pL\\pN_]+', 0) as title, 'Doc ' || regexp_extract(text, '^[\\pL\\pN_]+', 0) || ' found ' || lang as snippet from documents),
  hits as (select 'q ' || source as query, doc_id, 1 as pos, url, trim(title) as title, case when trim(title) = 'Doc' then replace(snippet, 'Doc  ', 'Doc ') else snippet end as snippet from found
    union all select 'q ' || source, doc_id, 2, 'https://spam-farm.example.org/' || source, 'spam', 'spam' from found)"""


@query(f"with {_HITS} select query, doc_id as page, pos, url, title, snippet from hits")
def result_page_hits(spark, folder):
    hits = resultpages.extract_hits(_result_pages(spark, folder))
    return hits.select("query", F.col("page").cast("bigint").alias("page"), F.col("pos").cast("bigint").alias("pos"), "url", "title", "snippet")


@query(
    f"""with {_HITS} select url as canonical_url, case when url like '%.pdf' then 'document' else 'crawl' end as kind, count(*) as hits
    from hits where regexp_matches(url, '^https://[^/]*[.]example[.]com/') group by 1, 2"""
)
def ingest_routing(spark, folder):
    """Hits that pass the policy, sorted into documents and pages to crawl."""
    routed = discovery.route_hits(resultpages.extract_hits(_result_pages(spark, folder)), RULES)
    return routed.groupBy("canonical_url", "kind").agg(F.count("*").alias("hits"))


@query(
    f"""with {_HITS}, targets as (select distinct url from hits where regexp_matches(url, '^https://[^/]*[.]example[.]com/'))
    select url, 'search:yahoo' as origin, cast(null as bigint) as priority from targets where url like '%.pdf'
    union all select url, 'queue', cast(5 as bigint) from targets where url not like '%.pdf'"""
)
def ingest_tables(spark, folder):
    """Document index and crawl queue after ingestion."""
    routed = materialize(discovery.route_hits(resultpages.extract_hits(_result_pages(spark, folder)), RULES), "routed")
    merged = tables.sightings_by_document(discovery.hit_sightings(routed, now()))
    found = tables.merge_document_urls(spark.createDataFrame([], schemas.URLS), merged)
    queue = discovery.enqueue_hits(spark.createDataFrame([], schemas.CRAWL_QUEUE), routed, now())
    return found.select(F.col("canonical_url").alias("url"), F.col("source_url").alias("origin"), F.lit(None).cast("bigint").alias("priority")).unionByName(
        queue.select("url", F.lit("queue").alias("origin"), F.col("priority").cast("bigint").alias("priority"))
    )


@query(
    """select 'q ' || source as query, doc_id as page, case when doc_id % 10 = 7 then 'completed' when doc_id % 10 >= 8 then 'backoff' else 'completed' end as status,
      case when doc_id % 10 = 7 then cast(1 as bigint) when doc_id % 10 < 8 then cast(2 as bigint) end as result_count,
      case when doc_id % 10 = 9 then 'yahoo http 429' when doc_id % 10 = 8 then 'yahoo http 500' end as error, cast(1 as bigint) as attempts, true as started from documents"""
)
def search_step(spark, folder):
    """One step of the search plan: cached, answered, throttled and failed pages."""
    pages = materialize(_result_pages(spark, folder), "captured")
    searches = tables.align(pages.select("provider", "query", "page"), schemas.SEARCHES, status=F.lit("pending"), attempts=F.lit(0))
    stored = tables.align(pages.filter("page % 10 = 7").select("provider", "query", "page"), schemas.SEARCH_RESULTS, url=F.lit("https://a.gov"), pos=F.lit(1))
    after, _, _ = discovery.fetch_step(searches, stored, pages, now())
    counts = [F.col(c).cast("bigint").alias(c) for c in ("page", "result_count", "attempts")]
    return after.select("query", *counts, "status", "error", F.col("started_at").isNotNull().alias("started"))


@query(
    """with old as (select user_id, event_type, event_id, 'old' as origin from events where event_id % 2 = 0 or user_id % 3 <> 0), new as (select user_id, event_type, event_id, 'new' as origin from events where event_id % 2 = 1 and user_id % 3 = 0)
    select * from old anti join new using (user_id, event_type) union all select user_id, event_type, event_id, origin from new"""
)
def group_replace(spark, folder):
    """Rows of every (user, type) group that the new batch mentions are replaced."""
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id")
    old = events.filter("event_id % 2 = 0 or user_id % 3 <> 0").withColumn("origin", F.lit("old"))
    new = events.filter("event_id % 2 = 1 and user_id % 3 = 0").withColumn("origin", F.lit("new"))
    return tables.replace_groups(old, new, ["user_id", "event_type"])


@query(
    """with old as (select user_id, event_type, min(event_id) as event_id from events where event_id % 4 = 0 group by 1, 2), new as (select user_id, event_type, min(event_id) as event_id from events group by 1, 2)
    select * from old union all select * from new anti join old using (user_id, event_type)"""
)
def insert_or_ignore(spark, folder):
    """First write wins per (user, type)."""
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id")
    key, order = ["user_id", "event_type"], [F.col("event_id")]
    old = tables.insert_new(events.limit(0), events.filter("event_id % 4 = 0"), key, order)
    return tables.insert_new(old, events, key, order)


@query("""select event_id, event_type, case when event_id % 2 = 0 then cast(0 as bigint) else event_id % 9 end as attempts, case when event_id % 2 = 1 then 'late' else 'none' end as error from events""")
def schema_evolution(spark, folder):
    """Older rows lack two columns; both get their defaults."""
    events = table(spark, folder, "events").select("event_id", "event_type")
    old = events.filter("event_id % 2 = 0")
    new = events.filter("event_id % 2 = 1").withColumns({"attempts": F.col("event_id") % 9, "error": F.lit("late")})
    merged = old.unionByName(new, allowMissingColumns=True)
    return tables.add_columns(merged, attempts=F.lit(0).cast("bigint"), error=F.lit("none"))


@query(f"with {AGENCY_ROWS} select distinct official_url as url, cast(10 as bigint) as priority from agencies where active")
def crawl_seeds(spark, folder):
    """Frontier of depth 0 from the active agencies, with their own hosts as extra hosts."""
    active = _agencies(spark, folder).filter("active")
    frontier = seed_frontier(agency_seeds(active), HostRules(allowed=("none.invalid",)), policy.agency_hosts(_agencies(spark, folder)))
    return frontier.select("url", F.col("priority").cast("bigint").alias("priority"))


@query(
    """with old as (select distinct user_id, event_type from events where event_id % 4 = 0)
    select (select count(*) from events) as accepted, (select count(*) from (select distinct user_id, event_type from events) anti join old using (user_id, event_type)) as created"""
)
def accepted_created(spark, folder):
    """Rows a batch was accepted with, and keys it created."""
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id")
    key = ["user_id", "event_type"]
    old = tables.insert_new(events.limit(0), events.filter("event_id % 4 = 0"), key, [F.col("event_id")])
    return tables.batch_counts(old, events, key)


@query("select 'q ' || source as query, doc_id as page, case when doc_id % 10 in (3, 7) then 'cached' else 'fetch' end as source from documents")
def cache_split(spark, folder):
    """Due pages answered by stored results, and those to fetch."""
    pages = table(spark, folder, "documents").select(F.lit("yahoo").alias("provider"), F.concat(F.lit("q "), "source").alias("query"), F.col("doc_id").alias("page"))
    hits = pages.filter("page % 10 in (3, 7)").withColumn("pos", F.explode(F.sequence(F.lit(1), F.lit(4))))
    cached, to_fetch = discovery.split_by_cache(pages, hits)
    return cached.select("query", "page", F.lit("cached").alias("source")).unionByName(to_fetch.select("query", "page", F.lit("fetch").alias("source")))
