"""Content detection, text and naming queries."""

from pyspark.sql import functions as F

from paperfield.catalog.registry import DOCUMENT_ROWS, document_rows, query, table
from paperfield.functions import content, retry, urls

_TYPES = "list_value('application/pdf','text/html; charset=utf-8','image/png','application/msword','application/zip','application/octet-stream',null,'video/mp4','text/plain')[cast(doc_id % 9 as integer) + 1]"


def _typed(spark, folder):
    types = F.array(*[F.lit(t) for t in ("application/pdf", "text/html; charset=utf-8", "image/png", "application/msword", "application/zip", "application/octet-stream", None, "video/mp4", "text/plain")])
    docs = table(spark, folder, "documents")
    tail = F.when(F.col("doc_id") % 5 == 0, ".PDF?v=1").otherwise(".htm?x=.pdf")
    return docs.select(
        "doc_id",
        F.concat(F.lit("https://a.gov/"), F.col("doc_id").cast("string"), tail).alias("url"),
        F.get(types, (F.col("doc_id") % 9).cast("int")).alias("ctype"),
        F.concat(F.when(F.col("doc_id") % 2 == 0, F.lit(" \n%PDF-1.4 ")).when(F.col("doc_id") % 7 == 1, F.lit("\n<!DocType ")).otherwise(F.lit("")), F.col("text")).cast("binary").alias("body"),
    )


_TYPED = f"""typed as (select doc_id, doc_id % 5 = 0 as pdf_url, {_TYPES} as ctype,
  case when doc_id % 2 = 0 then 'pdf' when doc_id % 7 = 1 then 'html' else '' end as opening from documents)"""


@query(
    f"""with {_TYPED} select doc_id, case when pdf_url or ctype like '%application/pdf%' then 'pdf' when ctype like 'text/%' then 'html'
      when ctype like 'image/%' then 'image' when ctype like '%msword%' then 'document' when ctype like '%zip%' then 'archive'
      when ctype is null then 'unknown' else 'binary' end as kind from typed"""
)
def content_class(spark, folder):
    return _typed(spark, folder).select("doc_id", content.content_class(F.col("ctype"), F.col("url")).alias("kind"))


@query(
    f"""with {_TYPED} select doc_id, pdf_url as by_url, coalesce(ctype like '%application/pdf%', false) as by_type, opening = 'pdf' as by_magic,
      pdf_url or coalesce(ctype like '%application/pdf%', false) or opening = 'pdf' as is_pdf from typed"""
)
def pdf_flags(spark, folder):
    url, ctype, body = F.col("url"), F.col("ctype"), F.col("body")
    return _typed(spark, folder).select(
        "doc_id",
        content.url_looks_like_pdf(url).alias("by_url"),
        content.content_type_is_pdf(ctype).alias("by_type"),
        content.magic_is_pdf(body).alias("by_magic"),
        content.is_pdf(url, ctype, body).alias("is_pdf"),
    )


@query(
    f"""with {_TYPED} select doc_id, opening = 'html' as html from typed
    union all select -1 - page_id, regexp_matches(html, '^\\s*<(!doctype|html)', 'i') from pages"""
)
def html_sniff(spark, folder):
    typed = _typed(spark, folder).select("doc_id", content.starts_like_html(F.col("body")).alias("html"))
    pages = table(spark, folder, "pages").select((-1 - F.col("page_id")).alias("doc_id"), content.starts_like_html(F.col("html").cast("binary")).alias("html"))
    return typed.unionByName(pages)


@query(
    """select page_id, array_to_string(list_filter(list_transform(
      regexp_split_to_array(regexp_replace(html, '<!--.*?-->|<style[^>]*>.*?</style>|<script[^>]*>.*?</script>', '<!>', 'gs'), '<[A-Za-z/!?][^>]*>'),
      lambda p: trim(replace(replace(replace(replace(p, '&quot;', '"'), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&'), ' ' || chr(9) || chr(10) || chr(13) || chr(160))), lambda p: p <> ''), ' ') as visible
    from pages"""
)
def visible_text(spark, folder):
    return table(spark, folder, "pages").select("page_id", content.visible_text(F.col("html")).alias("visible"))


@query(
    """select doc_id, 'https://' || source || '.gov/a b/' || lang || '%20' || doc_id || case when doc_id % 3 = 0 then '' when doc_id % 3 = 1 then '.pdf' else '.x*y' end as url,
      lang || ' ' || doc_id || case when doc_id % 3 = 0 then '.pdf' when doc_id % 3 = 1 then '.pdf' else '.x_y' end as filename from documents"""
)
def file_names(spark, folder):
    tail = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, ".pdf").otherwise(".x*y")
    docs = table(spark, folder, "documents").select(
        "doc_id",
        F.concat(F.lit("https://"), "source", F.lit(".gov/a b/"), "lang", F.lit("%20"), F.col("doc_id").cast("string"), tail).alias("url"),
    )
    return docs.withColumn("filename", urls.filename_from_url(F.col("url")))


@query(
    f"""with {DOCUMENT_ROWS} select doc_id, 'data/' || substr(sha256, 1, 2) || '/' || substr(sha256, 3, 2) || '/' || sha256 || '.pdf' as by_content,
      'data/' || state || '/report ' || doc_id || '.pdf' as by_state from docs"""
)
def content_paths(spark, folder):
    docs = document_rows(spark, folder).withColumn("canonical", urls.canonical_url(F.col("pdf_url")))
    return docs.select(
        "doc_id",
        urls.content_path("data", content.sha256_hex(F.col("body"))).alias("by_content"),
        urls.named_path("data", F.col("state"), F.lit(None).cast("string"), F.col("canonical")).alias("by_state"),
    )


_STATUS = "case doc_id % 6 when 0 then 429 when 1 then 503 when 2 then 403 else 200 end"


@query(
    f"""with heads as (select doc_id, {_STATUS} as status, lower(substr(case when doc_id % 4 = 3 then 'Please solve the CAPTCHA. ' || text when doc_id % 10 = 5 then 'Access Denied ' || text else text end, 1, 4000)) as head,
      case when doc_id % 3 = 0 then cast(doc_id % 90 as varchar) when doc_id % 3 = 1 then '2.5' else 'later' end as retry from documents),
    judged as (select doc_id, status in (403, 429, 503) or regexp_matches(head, 'not a robot|unusual traffic|captcha|access denied|temporarily blocked') as blocked,
      status = 403 or regexp_matches(head, 'captcha|not a robot') as fatal, try_cast(retry as double) as wait from heads)
    select doc_id, blocked, blocked and fatal as fatal, case when blocked then wait end as retry_after from judged"""
)
def block_outcomes(spark, folder):
    doc = F.col("doc_id")
    docs = table(spark, folder, "documents").select(
        "doc_id",
        F.when(doc % 6 == 0, 429).when(doc % 6 == 1, 503).when(doc % 6 == 2, 403).otherwise(200).alias("status"),
        F.concat(F.when(doc % 4 == 3, "Please solve the CAPTCHA. ").when(doc % 10 == 5, "Access Denied ").otherwise(""), "text").alias("text"),
        F.when(doc % 3 == 0, (doc % 90).cast("string")).when(doc % 3 == 1, "2.5").otherwise("later").alias("retry"),
    )
    return docs.select("doc_id", content.block_outcome(F.col("status"), F.col("text"), F.col("retry")).alias("o")).select("doc_id", "o.*")


@query(
    """select event_id, round(least(120.0, pow(2.0, greatest(event_id % 10 - 1, 0))) * (0.5 + cast(('0x' || substr(md5(user_id || '|' || (event_id % 10 - 1)), 1, 8)) as bigint) / 4294967296.0), 6) as crawl_wait,
      round(least(1800.0, 8.0 * pow(2.0, event_id % 10)) * (0.5 + cast(('0x' || substr(md5(user_id || '|' || (event_id % 10)), 1, 8)) as bigint) / 4294967296.0), 6) as search_wait from events"""
)
def backoff_schedule(spark, folder):
    n = (F.col("event_id") % 10).cast("int")
    key = F.col("user_id")
    return table(spark, folder, "events").select(
        "event_id",
        F.round(retry.backoff_seconds(key, n - 1), 6).alias("crawl_wait"),
        F.round(retry.backoff_seconds(key, n, retry.SEARCH_BACKOFF_BASE, retry.SEARCH_BACKOFF_CAP), 6).alias("search_wait"),
    )


@query(
    """with raw as (select event_id, case event_id % 4 when 0 then cast(event_id % 100 as varchar) when 1 then cast(value as varchar) when 2 then 'Mon' end as header from events)
    select event_id, try_cast(header as double) as search_seconds, case when regexp_matches(header, '^[0-9]+$') then cast(header as double) end as crawl_seconds from raw"""
)
def retry_after(spark, folder):
    event = F.col("event_id")
    header = F.when(event % 4 == 0, (event % 100).cast("string")).when(event % 4 == 1, F.col("value").cast("string")).when(event % 4 == 2, "Mon")
    return table(spark, folder, "events").select("event_id", content.search_retry_after(header).alias("search_seconds"), content.crawl_retry_after(header).alias("crawl_seconds"))


@query("""select doc_id, text as decoded, sha256(text) as digest from documents""")
def body_decode(spark, folder):
    docs = document_rows(spark, folder)
    return docs.select("doc_id", content.decode_body(F.col("body"), F.lit("text/html; charset=UTF-8")).alias("decoded"), content.sha256_hex(F.col("body")).alias("digest"))
