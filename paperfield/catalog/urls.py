"""URL, link, policy and robots queries."""

from pyspark.sql import functions as F

from paperfield.catalog.registry import (
    LINKS,
    PAGES,
    RULES,
    allowed_sql,
    query,
    table,
)
from paperfield.functions import urls
from paperfield.operators import policy, robots
from paperfield.operators.links import extract_links


@query(f"with {PAGES} select page_id, canonical from canon")
def canonical_url(spark, folder):
    return table(spark, folder, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


@query(f"with {PAGES} select host, count(*) as pages from canon group by host")
def url_domain(spark, folder):
    pages = table(spark, folder, "pages").select(urls.domain_of(F.col("url")).alias("host"))
    return pages.groupBy("host").agg(F.count("*").alias("pages"))


@query(
    r"select page_id, cast(len(regexp_extract_all(url, '[?&](utm_[a-z]+|gclid|fbclid|mc_cid|mc_eid|msclkid|_ga)=')) as bigint) as tracking_pairs from pages"
)
def tracking_params(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", urls.tracking_pair_count(F.col("url")).cast("bigint").alias("tracking_pairs")
    )


@query(f"with {LINKS} select page_id, cast(pos as bigint) as pos, link from links")
def page_links(spark, folder):
    found = extract_links(table(spark, folder, "pages"))
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), "link")


@query(
    f"""with {LINKS} select host as domain, count(*) as links, count(distinct link) as distinct_links
    from links where {allowed_sql('host')} group by host"""
)
def link_domain_counts(spark, folder):
    found = policy.with_verdict(extract_links(table(spark, folder, "pages")), "link", RULES).filter("allowed")
    return (
        found.groupBy(urls.domain_of(F.col("link")).alias("domain"), "link")
        .agg(F.count("*").alias("n"))
        .groupBy("domain")
        .agg(F.sum("n").alias("links"), F.count("*").alias("distinct_links"))
    )


@query(
    f"""with {PAGES} select page_id, regexp_extract(url, '^([a-z]+://)', 1) || host || regexp_extract(url, '^[a-z]+://[^/]*([^?#]*/)', 1) || 'x;p/' || page_id || '.pdf' as resolved from canon"""
)
def relative_resolution(spark, folder):
    """A relative reference with dot segments, resolved against every page address."""
    ref = F.concat(F.lit("./y/.././x;p/z/../"), F.col("page_id").cast("string"), F.lit(".pdf;q#top"))
    return table(spark, folder, "pages").select("page_id", urls.canonical_link(ref, F.col("url")).alias("resolved"))


@query(
    f"""with {LINKS}, ranked as (select link, page_id, pos, count(*) over (partition by link) as seen,
      row_number() over (partition by link order by page_id, pos) as rn from links)
    select link, page_id as first_page, cast(pos as bigint) as first_pos, seen from ranked where rn = 1"""
)
def url_dedup_first_seen(spark, folder):
    """First sighting of every link, with the number of sightings."""
    order = F.struct("page_id", F.col("pos").cast("bigint").alias("pos"))
    firsts = extract_links(table(spark, folder, "pages")).groupBy("link").agg(F.min(order).alias("first"), F.count("*").alias("seen"))
    return firsts.select("link", F.col("first.page_id").alias("first_page"), F.col("first.pos").alias("first_pos"), "seen")


@query(f"with {PAGES} select page_id, host, {allowed_sql('host')} as allowed from canon")
def policy_allowed(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", urls.domain_of(F.col("url")).alias("host"))
    return policy.with_verdict(pages, "url", RULES).drop("url")


@query(
    f"""with {PAGES}, parents as (select distinct regexp_extract(host, '[^.]+[.][^.]+[.][^.]+$', 0) as parent from canon where page_id % 3 = 0)
    select page_id, host, exists (select 1 from parents where host = parent or host like '%.' || parent) as below from canon"""
)
def subdomain_allowed(spark, folder):
    """Hosts at or below the registered parents, by an equi join on label suffixes."""
    pages = table(spark, folder, "pages").select("page_id", "url", urls.domain_of(F.col("url")).alias("host"))
    parents = pages.filter(F.col("page_id") % 3 == 0).select(F.regexp_extract("host", r"[^.]+\.[^.]+\.[^.]+$", 0).alias("host"))
    nothing_else = policy.HostRules(allowed=("none.invalid",), denied=())
    return policy.with_verdict(pages, "url", nothing_else, parents.distinct(), "below").drop("url")


PATTERN_SQL = """patterns as (select 'deny' as kind, 'www.' || regexp_extract(host, '^www[.](.*)$', 1) as pattern from canon where host like 'www.%'
   union select 'allow', '*.' || regexp_extract(host, '[^.]+[.][^.]+$', 0) from canon where host like '%.com' or host like '%.org'
   union select 'extra', host from canon where host like 'm.%')"""


@query(
    f"""with {PAGES}, {PATTERN_SQL}, flags as (select host,
      bool_or(kind = 'deny' and (host = pattern or ends_with(host, '.' || pattern))) as denied,
      bool_or(kind = 'extra' and (host = pattern or ends_with(host, '.' || pattern))) as extra,
      bool_or(kind = 'allow' and ends_with(host, substr(pattern, 2))) as allowed
      from (select distinct host from canon) cross join patterns group by host)
    select host, not denied and (extra or allowed) as allowed from flags"""
)
def pattern_table(spark, folder):
    """Policy from a table of patterns of any size."""
    hosts = table(spark, folder, "pages").select(urls.domain_of(F.col("url")).alias("host")).distinct()
    two = F.regexp_extract("host", r"[^.]+\.[^.]+$", 0)
    patterns = (
        hosts.filter("host like 'www.%'").select(F.lit("deny").alias("kind"), F.col("host").alias("pattern"))
        .unionByName(hosts.filter("host like '%.com' or host like '%.org'").select(F.lit("allow").alias("kind"), F.concat(F.lit("*."), two).alias("pattern")))
        .unionByName(hosts.filter("host like 'm.%'").select(F.lit("extra").alias("kind"), F.col("host").alias("pattern")))
    )
    return policy.classify_hosts(hosts, patterns)


def robots_bodies(pages):
    """A robots body per host, made of the addresses of its own pages."""
    hosted = pages.select(urls.domain_of(F.col("url")).alias("domain"), urls.url_path(F.col("url")).alias("path"), "page_id")
    facts = hosted.groupBy("domain").agg(F.min("page_id").alias("low"), F.max_by("path", "page_id").alias("last"))
    shut = F.substring("last", 1, 4)
    body = F.concat(
        F.lit("# rules\nUser-agent: other\nDisallow: /\n\nUser-Agent: *\nAllow: "), F.col("last"),
        F.lit("\nDisallow: "), shut, F.lit(" # part\nDisallow:"), F.when(F.col("low") % 2 == 0, " /fr/").otherwise(""),
        F.lit("\nDisallow: /es\n"),
    )
    return facts.select("domain", body.alias("body"), "low", "last", shut.alias("shut"))


ROBOTS_SQL = f"""{PAGES}, facts as (select host, min(page_id) as low, arg_max(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), page_id) as last from canon group by host),
  rules as (select host, 1 as no, true as allow, last as prefix from facts union all
    select host, 2, false, substr(last, 1, 4) from facts union all
    select host, 3, low % 2 <> 0, case when low % 2 = 0 then '/fr/' else '' end from facts union all
    select host, 4, false, '/es' from facts)"""


@query(
    f"""with {ROBOTS_SQL}, paths as (select page_id, url, host, regexp_extract(url, '^[a-z]+://[^/?#]*(.*)$', 1) as target from canon)
    select p.page_id, coalesce(arg_min(r.allow, r.no), true) as robots_allowed
    from paths p left join rules r on p.host = r.host and starts_with(p.target, r.prefix) group by p.page_id"""
)
def robots_verdict(spark, folder):
    """First matching rule of the host's robots body, for every page."""
    pages = table(spark, folder, "pages")
    rules = robots.host_rules(robots_bodies(pages))
    return robots.with_robots_verdict(pages.select("page_id", "url"), "url", rules).select("page_id", "robots_allowed")


@query(
    f"""with {ROBOTS_SQL} select host as domain, cast(2 as bigint) as group_no, cast(no as bigint) as rule_no, allow, prefix as path from rules
    union all select host, 1, 1, false, '/' from facts"""
)
def robots_rules(spark, folder):
    found = robots.rule_table(robots_bodies(table(spark, folder, "pages")))
    return found.select("domain", F.col("group_no").cast("bigint").alias("group_no"), F.col("rule_no").cast("bigint").alias("rule_no"), "allow", "path")


@query(
    f"""with {PAGES}, answers as (select host, case when page_id % 3 = 0 then 404 else 200 end as status, 'Disallow: /' || page_id as body, page_id,
      row_number() over (partition by host order by page_id desc) as rn from canon where page_id % 4 <> 0)
    select h.host as domain, cast(coalesce(status, 0) as bigint) as status, case when status = 200 then body else '' end as body
    from (select distinct host from canon) h left join answers a on a.host = h.host and rn = 1"""
)
def robots_cache_fill(spark, folder):
    """One robots row per host from captured answers, the newest first."""
    pages = table(spark, folder, "pages").withColumn("host", urls.domain_of(F.col("url")))
    answers = pages.filter(F.col("page_id") % 4 != 0).select(
        F.concat(F.lit("https://"), "host", F.lit("/robots.txt")).alias("request_url"),
        F.when(F.col("page_id") % 3 == 0, 404).otherwise(200).alias("status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/plain")).alias("headers"),
        F.concat(F.lit("Disallow: /"), F.col("page_id").cast("string")).cast("binary").alias("body"),
        F.timestamp_seconds("page_id").alias("fetched_at"),
    )
    filled = robots.fill_cache(pages.select("host"), answers)
    return filled.select("domain", F.col("status").cast("bigint").alias("status"), "body")
