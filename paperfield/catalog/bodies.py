"""Body, document and export queries."""

from pyspark.sql import functions as F

from paperfield import schemas
from paperfield.catalog.registry import (
    AGENCY_ROWS,
    DOCUMENT_ROWS,
    NOW,
    agency_rows,
    document_rows,
    now,
    plain,
    query,
    table,
)
from paperfield.functions.content import sha256_hex
from paperfield.functions.urls import canonical_url
from paperfield.operators import bodies, status, tables
from paperfield.operators.agencies import prepare_agencies
from paperfield.plans.download import download_step
from paperfield.plans.index import DocumentIndex
from paperfield.session import materialize, new_location
from paperfield.sources import readers, writers


@query("select doc_id, sha256(text) as sha256, cast(octet_length(encode(text)) as bigint) as content_length from documents")
def body_sha256(spark, folder):
    docs = document_rows(spark, folder)
    return docs.select("doc_id", sha256_hex(F.col("body")).alias("sha256"), F.length("body").cast("bigint").alias("content_length"))


@query("select sha256(text) as sha256, count(*) as copies, min(doc_id) as first_doc from documents group by 1 having count(*) > 1")
def duplicate_bodies(spark, folder):
    hashed = document_rows(spark, folder).select("doc_id", sha256_hex(F.col("body")).alias("sha256"))
    groups = hashed.groupBy("sha256").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"))
    return groups.filter("copies > 1")


@query("""select sha256(text) as sha256, any_value(text) as body, count(*) as copies from documents group by 1""")
def unique_bodies(spark, folder):
    """Content of every digest once."""
    return bodies.unique_bodies(document_rows(spark, folder), key="doc_id").withColumn("body", F.col("body").cast("string"))


@query(
    """with d as (select case when doc_id % 3 = 0 then null else sha256(text) end as h from documents)
    select count(*) as docs, count(h) as docs_hashed, count(distinct h) as digests, greatest(0, count(*) - count(h)) as unhashed, count(h) - count(distinct h) as duplicate_bodies from d"""
)
def unique_docs(spark, folder):
    digest = F.when(F.col("doc_id") % 3 != 0, sha256_hex(F.col("body")))
    return status.duplicate_counts(document_rows(spark, folder).select(digest.alias("sha256")))


def _parts(spark, folder):
    """Every body cut in three ranged parts; every fourth document restarts after a stale part."""
    docs = document_rows(spark, folder)
    third = (F.floor(F.length("body") / 3)).cast("long")
    cut = docs.withColumn("third", third).withColumn("restart", F.col("doc_id") % 4 == 0)

    def piece(number, status_, offset, start, length):
        return F.struct(
            F.lit(number).alias("part_no"), F.lit(status_).alias("status"), offset.cast("long").alias("offset"),
            F.substring("body", start.cast("int"), length.cast("int")).alias("bytes"),
        )

    one, third_ = F.lit(1), F.col("third")
    stale = F.array(piece(0, 200, F.lit(0), one, third_ + 5), piece(1, 206, third_ + 5, one, one * 7), piece(2, 429, F.lit(0), one, one))
    whole = F.array(
        piece(3, 200, F.lit(0), one, third_),
        piece(4, 206, third_, third_ + 1, third_),
        piece(5, 206, third_ * 2, third_ * 2 + 1, F.length("body")),
    )
    chosen = F.when(F.col("restart"), F.concat(stale, whole)).otherwise(whole)
    return cut.select("doc_id", F.inline(chosen))


@query(
    """select doc_id, sha256(text) as sha256, cast(octet_length(encode(text)) as bigint) as content_length, cast(3 as bigint) as n_parts, true as contiguous from documents"""
)
def part_assembly(spark, folder):
    whole = bodies.assemble_parts(_parts(spark, folder))
    return whole.select("doc_id", sha256_hex(F.col("body")).alias("sha256"), F.length("body").cast("bigint").alias("content_length"), "n_parts", "contiguous")


@query(
    """with files as (select 'root/' || lang || '/' || (doc_id % 5) || case when doc_id % 2 = 0 then '.pdf' else '' end as dest, sha256(text) as sha256, min(doc_id) as arrived from documents group by 1, 2),
    ranked as (select *, replace(dest, '.pdf', '') as stem, row_number() over (partition by dest order by arrived, sha256) as nth from files),
    rest as (select stem, sha256, 1 + row_number() over (partition by stem order by min(arrived), sha256) as copy_no from ranked where nth > 1 group by stem, sha256)
    select dest, r.sha256, case when nth = 1 then 1 else copy_no end as copy_no, case when nth = 1 then dest else r.stem || '__' || copy_no || '.pdf' end as final_path
    from ranked r left join rest on nth > 1 and rest.stem = r.stem and rest.sha256 = r.sha256"""
)
def name_collisions(spark, folder):
    """Names ``n`` and ``n.pdf`` number alike, so they share one series of numbers."""
    tail = F.when(F.col("doc_id") % 2 == 0, ".pdf").otherwise("")
    files = document_rows(spark, folder).select(
        F.concat(F.lit("root/"), "state", F.lit("/"), (F.col("doc_id") % 5).cast("string"), tail).alias("dest"),
        sha256_hex(F.col("body")).alias("sha256"),
        F.col("doc_id").alias("arrived"),
    )
    return bodies.number_collisions(files).select("dest", "sha256", "copy_no", "final_path")


_NAMED = """files as (select doc_id, 'd/' || lang || case when doc_id % 4 = 3 then '__' || (2 + doc_id % 9) else '' end || '.pdf' as dest, sha256(text) as sha256, doc_id % 2 as batch from documents)"""


@query(
    f"""with {_NAMED}, one as (select dest, sha256, min(doc_id) as arrived from files where batch = 0 group by 1, 2),
    one_n as (select *, row_number() over (partition by dest order by arrived) as n from one),
    one_p as (select dest, sha256, case when n = 1 then dest else replace(dest, '.pdf', '__' || n || '.pdf') end as final_path from one_n),
    two as (select dest, sha256, min(doc_id) as arrived from files where batch = 1 group by 1, 2),
    stored as (select final_path as path, sha256 from one_p),
    plain as (select t.*, row_number() over (partition by dest order by arrived) = 1 and dest not in (select path from stored) or exists (select 1 from stored s where s.path = t.dest and s.sha256 = t.sha256) as own from two t),
    names as (select path, sha256 from stored union select dest, sha256 from plain where own),
    numbers as (select regexp_replace(path, '__[0-9]+[.]pdf$', '.pdf') as family, cast(regexp_extract(path, '__([0-9]+)[.]pdf$', 1) as bigint) as number, sha256 from names where regexp_matches(path, '__[0-9]+[.]pdf$')),
    known as (select family, sha256, min(number) as number from numbers group by 1, 2),
    asked as (select p.dest, p.sha256, k.number from plain p left join known k on k.family = p.dest and k.sha256 = p.sha256 where not own),
    new as (select dest, sha256, row_number() over (partition by dest order by arrived) as k from plain p where not own and not exists (select 1 from known k where k.family = p.dest and k.sha256 = p.sha256)),
    free as (select dest, n, row_number() over (partition by dest order by n) as k from (select distinct dest from new), range(2, 100000) r(n) where not exists (select 1 from numbers x where x.family = dest and x.number = n)),
    given as (select new.dest, new.sha256, free.n from new join free on free.dest = new.dest and free.k = new.k)
    select 0 as batch, dest, sha256, final_path from one_p
    union all select 1, dest, sha256, dest from plain where own
    union all select 1, a.dest, a.sha256, replace(a.dest, '.pdf', '__' || coalesce(a.number, g.n) || '.pdf') from asked a left join given g on g.dest = a.dest and g.sha256 = a.sha256"""
)
def free_names(spark, folder):
    """Names of two batches: plain ones that look numbered, and numbers that go into the gaps of what is taken."""
    docs = document_rows(spark, folder)
    looks = F.when(F.col("doc_id") % 4 == 3, F.concat(F.lit("__"), (2 + F.col("doc_id") % 9).cast("string"))).otherwise("")
    files = docs.select(F.concat(F.lit("d/"), "state", looks, F.lit(".pdf")).alias("dest"), sha256_hex(F.col("body")).alias("sha256"), F.col("doc_id").alias("arrived"))
    first = materialize(bodies.number_collisions(files.filter("arrived % 2 = 0")), "first")
    second = bodies.number_collisions(files.filter("arrived % 2 = 1"), first.select(F.col("final_path").alias("path"), "sha256"))
    both = first.withColumn("batch", F.lit(0)).unionByName(second.withColumn("batch", F.lit(1)))
    return both.select("batch", "dest", "sha256", "final_path")


_RANGES = """select doc_id, case when doc_id % 4 = 3 then sha256('') else sha256(text) end as sha256, case when doc_id % 4 = 3 then cast(0 as bigint) else cast(octet_length(encode(text)) as bigint) end as content_length,
      doc_id % 4 <> 3 as whole, case doc_id % 4 when 3 then cast(0 as bigint) when 2 then cast(2 as bigint) else cast(3 as bigint) end as n_parts from documents where octet_length(encode(text)) >= 30"""


@query(_RANGES)
def part_ranges(spark, folder):
    """Bodies from byte ranges that overlap or leave gaps, in two batches; the parts of a body with a gap stay open.

    By remainder of the id: 0 three overlapping ranges in one batch; 1 the same over two batches, the middle last; 2 a
    stale part before an answer that starts anew; 3 a body whose beginning never comes.
    """
    docs = document_rows(spark, folder).filter(F.length("body") >= 30).withColumn("n", F.length("body").cast("long"))
    a, b = F.floor(F.col("n") / 3), F.floor(F.col("n") / 2)

    def piece(number, batch, status_, offset, end):
        return F.struct(
            F.lit(number).alias("part_no"), F.lit(batch).alias("batch"), F.lit(status_).alias("status"), offset.cast("long").alias("offset"),
            F.substring("body", (offset + 1).cast("int"), (end - offset).cast("int")).alias("bytes"),
        )

    zero, n, kind = F.lit(0), F.col("n"), F.col("doc_id") % 4
    ranges = (
        F.when(kind == 0, F.array(piece(1, 0, 206, a - 5, b), piece(2, 0, 200, zero, a), piece(3, 0, 206, b - 9, n), piece(4, 0, 206, a, b)))
        .when(kind == 1, F.array(piece(1, 0, 200, zero, a), piece(2, 0, 206, b - 1, n), piece(3, 1, 206, a - 3, b)))
        .when(kind == 2, F.array(piece(1, 0, 206, zero, n - 1), piece(2, 1, 200, zero, b), piece(3, 1, 206, b, n)))
        .otherwise(F.array(piece(1, 0, 206, a, b), piece(2, 1, 206, b, n)))
    )
    parts = docs.select("doc_id", F.col("n").alias("total"), F.inline(ranges))
    batches = [parts.filter(F.col("batch") == i).drop("batch") for i in (0, 1)]
    first = bodies.advance_parts(batches[0], batches[0].limit(0))
    second = bodies.advance_parts(batches[1], materialize(first.open, "open"))
    done = first.bodies.filter("whole").unionByName(second.bodies)
    return done.select("doc_id", sha256_hex(F.col("body")).alias("sha256"), F.length("body").cast("bigint").alias("content_length"), "whole", "n_parts")


def _sightings(spark, folder):
    """Each document seen three times under two spellings."""
    docs = table(spark, folder, "documents")
    url = F.concat(F.lit("https://"), "source", F.lit(".example.gov/"), F.substring(F.sha2("text", 256), 1, 12), F.lit(".pdf"))
    seen = F.array(
        F.struct(url.alias("url"), F.lit(2).alias("depth"), F.lit(0).alias("day")),
        F.struct(F.concat(url, F.lit("?utm_source=feed#p")).alias("url"), F.lit(1).alias("depth"), F.lit(1).alias("day")),
        F.struct(F.concat(F.lit("mailto:"), url).alias("url"), F.lit(0).alias("depth"), F.lit(2).alias("day")),
    )
    start = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)
    return docs.select("doc_id", "source", "lang", F.inline(seen), start.alias("start")).select(
        "url", F.concat(F.lit("page/"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("source_url"), F.col("lang").alias("state"),
        F.col("source").alias("agency"), "depth", (F.col("start") + F.make_dt_interval(days=F.col("day"))).alias("seen_at"),
    )


@query(
    """with seen as (select 'https://' || source || '.example.gov/' || substr(sha256(text), 1, 12) || '.pdf' as canonical_url, source, doc_id,
        epoch_ms((1704067200 + doc_id * 60) * 1000) as t from documents)
    select canonical_url, regexp_extract(canonical_url, '[^/]*$', 0) as filename, source || '.example.gov' as domain, 'queued' as download_status,
      min(t) as first_seen, max(t) + interval 1 day as last_seen, 'page/' || lpad(cast(min(doc_id) as varchar), 9, '0') as source_url
    from seen group by canonical_url, source"""
)
def document_merge(spark, folder):
    """Sightings of one day merged into an empty index, then those of the next day."""
    seen = _sightings(spark, folder)
    first = materialize(tables.sightings_by_document(seen.filter("depth = 2")), "first")
    later = materialize(tables.sightings_by_document(seen.filter("depth < 2")), "later")
    empty = spark.createDataFrame([], schemas.DOCUMENTS)
    docs = tables.merge_documents(tables.merge_documents(empty, first), later)
    urls = tables.merge_document_urls(tables.merge_document_urls(spark.createDataFrame([], schemas.URLS), first), later)
    joined = docs.join(urls.select("canonical_url", "source_url"), "canonical_url")
    return joined.select("canonical_url", "filename", "domain", "download_status", plain("first_seen"), plain("last_seen"), "source_url")


@query(
    """with keyed as (select 'https://' || source || '.example.gov/' || substr(sha256(text), 1, 12) || '.pdf' as canonical_url, doc_id from documents)
    select canonical_url, 'queued' as status, cast(0 as bigint) as attempts, epoch_ms((1704067200 + min(doc_id) * 60) * 1000) as added_at from keyed group by 1"""
)
def download_enqueue(spark, folder):
    merged = tables.sightings_by_document(_sightings(spark, folder))
    queue = tables.enqueue_documents(spark.createDataFrame([], schemas.DOWNLOAD_QUEUE), merged)
    again = tables.enqueue_documents(queue, merged)
    return again.select("canonical_url", "status", F.col("attempts").cast("bigint").alias("attempts"), plain("added_at"))


def _documents(spark, folder):
    docs = document_rows(spark, folder)
    return tables.align(
        docs.select(
            "doc_id", canonical_url(F.col("pdf_url")).alias("canonical_url"), "pdf_url", "domain",
            F.concat(F.lit("NATION_"), F.col("doc_id") % 25).alias("state"),
            F.when(F.col("doc_id") % 7 != 0, F.format_string("Supplier#%09d", F.col("doc_id") % 40)).alias("agency"),
            F.when(F.col("doc_id") % 3 != 0, sha256_hex(F.col("body"))).alias("sha256"),
            F.length("body").alias("content_length"),
            F.when(F.col("doc_id") % 3 == 0, "queued").when(F.col("doc_id") % 3 == 1, "complete").otherwise("failed").alias("download_status"),
            F.timestamp_seconds(F.col("doc_id")).alias("first_seen"),
        ),
        schemas.DOCUMENTS,
    )


_DOCUMENTS = f"""{DOCUMENT_ROWS}, index_rows as (select doc_id, pdf_url as canonical_url, pdf_url, domain, 'NATION_' || (doc_id % 25) as state,
  case when doc_id % 7 <> 0 then 'Supplier#' || lpad(cast(doc_id % 40 as varchar), 9, '0') end as agency,
  case when doc_id % 3 <> 0 then sha256 end as sha256, cast(octet_length(encode(text)) as bigint) as content_length,
  case doc_id % 3 when 0 then 'queued' when 1 then 'complete' else 'failed' end as download_status, text from docs)"""

_EXPORT = f"""with {_DOCUMENTS}, {AGENCY_ROWS} select d.state, d.agency, a.agency_type, d.pdf_url, d.canonical_url, d.domain, d.content_length, d.sha256, d.download_status
  from index_rows d left join agencies a on a.agency_name = d.agency and a.state = d.state"""
_SHOWN = ("state", "agency", "agency_type", "pdf_url", "canonical_url", "domain", "content_length", "sha256", "download_status")


def _export(spark, folder):
    agencies = prepare_agencies(agency_rows(spark, folder), now())
    return writers.export_rows(_documents(spark, folder), agencies)


@query(_EXPORT)
def export_rows(spark, folder):
    return _export(spark, folder).select(*_SHOWN)


@query(_EXPORT)
def export_csv_round_trip(spark, folder):
    """The CSV export, read back."""
    path = new_location(spark, "export-csv")
    writers.write_csv(_export(spark, folder), path)
    back = spark.read.csv(path, header=True, escape='"', schema=", ".join(f"{c} string" for c in writers.EXPORT_COLUMNS))
    return back.withColumn("content_length", F.col("content_length").cast("bigint")).select(*_SHOWN)


@query(_EXPORT)
def export_jsonl_round_trip(spark, folder):
    """The JSON-lines export, read back."""
    path = new_location(spark, "export-jsonl")
    writers.write_jsonl(_export(spark, folder), path)
    back = spark.read.schema(", ".join(f"{c} string" for c in writers.EXPORT_COLUMNS)).json(path)
    return back.withColumn("content_length", F.col("content_length").cast("bigint")).select(*_SHOWN)


@query(
    f"""with {_DOCUMENTS}, judged as (select case when doc_id % 5 = 0 then 'missing' when doc_id % 11 = 0 then 'mismatch' else 'ok' end as v from index_rows where download_status = 'complete')
    select count(*) filter (v = 'ok') as ok, count(*) filter (v = 'mismatch') as mismatch, count(*) filter (v = 'missing') as missing from judged"""
)
def verify_counts(spark, folder):
    """Completed documents against a damaged copy of their files."""
    docs = _documents(spark, folder).withColumn("download_path", F.col("canonical_url"))
    stored = document_rows(spark, folder).filter(F.col("doc_id") % 5 != 0)
    body = F.when(F.col("doc_id") % 11 == 0, F.concat("body", F.lit("!").cast("binary"))).otherwise(F.col("body"))
    files = stored.select(canonical_url(F.col("pdf_url")).alias("path"), sha256_hex(body).alias("sha256"))
    return status.verify_counts(status.verify_files(docs, files))


@query(
    f"""with {_DOCUMENTS} select 'docs' as metric, count(*) as value from index_rows union all select 'docs_hashed', count(sha256) from index_rows
    union all select 'dl_queued', count(*) filter (download_status = 'queued') from index_rows
    union all select 'dl_active', count(*) filter (download_status = 'downloading') from index_rows
    union all select 'dl_done', count(*) filter (download_status = 'complete') from index_rows
    union all select 'dl_failed', count(*) filter (download_status = 'failed') from index_rows"""
)
def document_counts(spark, folder):
    return status.table_counts({"documents": _documents(spark, folder)})


@query("select count(*) as files, cast(sum(octet_length(encode(text))) as bigint) as bytes from documents")
def storage_stats(spark, folder):
    return status.storage_stats(document_rows(spark, folder).select(F.length("body").alias("length")))


@query("select count(distinct source) as files, cast(sum(octet_length(encode(text)) + 1) as bigint) as bytes from documents")
def file_tree_scan(spark, folder):
    """Number and bytes of a tree of text files, one for each source, from a scan that does not open them."""
    path = new_location(spark, "tree")
    table(spark, folder, "documents").select("source", "text").repartition("source").write.partitionBy("source").text(path)
    return status.storage_stats(readers.scan_files(spark, path, "*.txt"))


_STEP = f"""with {DOCUMENT_ROWS}, tried as (select doc_id, pdf_url as canonical_url, sha256, cast(octet_length(encode(text)) as bigint) as n, doc_id % 8 as attempts,
  case when doc_id % 5 = 0 then 'http 503' when doc_id % 5 = 1 then 'http 404' when doc_id % 5 = 2 then 'response is html, not pdf' end as error,
  case doc_id % 5 when 0 then 503 when 1 then 404 else 200 end as http_status from docs),
  judged as (select *, case when error is null then 'complete' when greatest(attempts - 1, 1) >= 5 then 'failed' else 'queued' end as state from tried)"""


def _step(spark, folder):
    docs = document_rows(spark, folder).withColumn("canonical_url", canonical_url(F.col("pdf_url")))
    table_ = tables.align(docs.select("canonical_url", "pdf_url", "domain"), schemas.DOCUMENTS, download_status=F.lit("downloading"))
    queue = tables.align(docs.select("canonical_url", (F.col("doc_id") % 8).alias("attempts")), schemas.DOWNLOAD_QUEUE, status=F.lit("processing"), locked_until=now())
    bucket = F.col("doc_id") % 5
    fetched = docs.select(
        "canonical_url",
        F.when(bucket == 0, 503).when(bucket == 1, 404).otherwise(200).alias("http_status"),
        F.create_map(F.lit("ETag"), F.col("doc_id").cast("string")).alias("headers"),
        F.when(bucket == 2, F.concat(F.lit(" <html>").cast("binary"), "body")).otherwise(F.col("body")).alias("body"),
        F.lit(False).alias("resumed"),
        now().alias("at"),
    )
    return download_step(queue, table_, fetched, "data")


@query(
    f"""{_STEP} select canonical_url, state as download_status, case when state = 'complete' then sha256 end as sha256, case when state = 'complete' then n end as content_length,
      case when state = 'complete' then 'data/' || substr(sha256, 1, 2) || '/' || substr(sha256, 3, 2) || '/' || sha256 || '.pdf' end as download_path,
      case when state = 'complete' or state = 'failed' and http_status = 503 then cast(http_status as bigint) end as http_status, error, case when state = 'complete' then cast(doc_id as varchar) end as etag from judged"""
)
def download_finalise(spark, folder):
    """Documents after one batch of fetched bodies."""
    docs = _step(spark, folder).documents
    return docs.select("canonical_url", "download_status", "sha256", "content_length", "download_path", F.col("http_status").cast("bigint").alias("http_status"), "error", "etag")


@query(
    f"""{_STEP} select canonical_url, case state when 'complete' then 'completed' else state end as status, case when state = 'queued' then
      cast(round(least(120.0, pow(2.0, greatest(attempts - 1, 1))) * (0.5 + cast(('0x' || substr(md5(canonical_url || '|' || greatest(attempts - 1, 1)), 1, 8)) as bigint) / 4294967296.0) * 1000000) as bigint) end as wait_us from judged"""
)
def failure_fold(spark, folder):
    """Download queue after the same batch, with the wait before the next try."""
    queue = _step(spark, folder).queue
    wait = F.unix_micros("next_attempt") - F.unix_micros(now())
    return queue.select("canonical_url", "status", wait.alias("wait_us"))


@query("select sha256(text) as sha256, substr(sha256(text), 1, 2) as p1, substr(sha256(text), 3, 2) as p2, max(text) as body from documents group by 1")
def body_store(spark, folder):
    """The content-addressed body table, written and read back."""
    path = new_location(spark, "bodies")
    writers.write_bodies(bodies.unique_bodies(document_rows(spark, folder), key="doc_id").drop("copies"), path)
    back = spark.read.schema("sha256 string, body binary, p1 string, p2 string").parquet(path)
    return back.select("sha256", "p1", "p2", F.col("body").cast("string").alias("body"))


def _stored(spark, folder):
    """An index whose documents came in two batches of bodies: even ones whole, odd ones as ranges, a part of them late."""
    docs = materialize(document_rows(spark, folder).withColumn("canonical_url", canonical_url(F.col("pdf_url"))), "docs")
    index = DocumentIndex(spark, new_location(spark, "index"))
    known = tables.align(docs.select("canonical_url", "pdf_url", "domain"), schemas.DOCUMENTS, download_status=F.lit("queued"))
    queue = tables.align(docs.select("canonical_url"), schemas.DOWNLOAD_QUEUE, status=F.lit("queued"), attempts=F.lit(0), added_at=now())
    index.replace(documents=known, download_queue=queue)
    kind, half = F.col("doc_id") % 4, F.floor(F.length("body") / 2).cast("long")
    whole = docs.select("canonical_url", "doc_id", F.lit(200).alias("http_status"), F.create_map(F.lit("ETag"), F.col("doc_id").cast("string")).alias("headers"), "body", F.lit(False).alias("resumed"))

    def ranged(number, status_, offset, length):
        return docs.select(
            "canonical_url", "doc_id", F.lit(number).alias("part_no"), F.lit(status_).alias("status"), offset.alias("offset"), F.length("body").cast("long").alias("total"),
            F.create_map(F.lit("ETag"), F.col("doc_id").cast("string")).alias("headers"), F.substring("body", (offset + 1).cast("int"), length.cast("int")).alias("bytes"),
        )

    start, rest = ranged(1, 200, F.lit(0).cast("long"), half), ranged(2, 206, half, F.length("body"))
    later = F.lit(NOW).cast("timestamp") + F.expr("interval 1 hour")
    index.download(whole.filter(kind == 0).drop("doc_id"), now(), "data", parts=start.filter(kind % 2 == 1).unionByName(rest.filter(kind == 1)).drop("doc_id"))
    index.download(whole.filter(kind == 2).drop("doc_id"), later, "data", parts=rest.filter(kind == 3).drop("doc_id"))
    return index


@query(
    f"""with {DOCUMENT_ROWS} select pdf_url as canonical_url, 'complete' as download_status, sha256, cast(octet_length(encode(text)) as bigint) as content_length,
      'data/' || substr(sha256, 1, 2) || '/' || substr(sha256, 3, 2) || '/' || sha256 || '.pdf' as download_path, cast(doc_id as varchar) as etag, 'completed' as job, cast(1 as bigint) as bodies from docs"""
)
def download_two_batches(spark, folder):
    """Documents, jobs and body table after two batches; no digest is stored twice."""
    index = _stored(spark, folder)
    stored = index.bodies().groupBy("sha256").agg(F.count("*").alias("bodies"))
    jobs = index.table("download_queue").select("canonical_url", F.col("status").alias("job"))
    docs = index.table("documents").join(jobs, "canonical_url").join(stored, "sha256", "left")
    return docs.select("canonical_url", "download_status", "sha256", "content_length", "download_path", "etag", "job", "bodies")


@query(
    f"""with {DOCUMENT_ROWS}, judged as (select case when substr(sha256, 1, 1) in ('0', '1') then 'missing' when substr(sha256, 1, 1) in ('2', '3', '4') then 'mismatch' else 'ok' end as v from docs)
    select count(*) filter (v = 'ok') as ok, count(*) filter (v = 'mismatch') as mismatch, count(*) filter (v = 'missing') as missing from judged"""
)
def verify_store(spark, folder):
    """The body table, damaged, against the documents of the index."""
    index = _stored(spark, folder)
    kept = index.bodies().filter(~F.col("sha256").rlike("^[01]"))
    damaged = kept.withColumn("body", F.when(F.col("sha256").rlike("^[234]"), F.concat("body", F.lit(b"!"))).otherwise(F.col("body")))
    writers.write_bodies(damaged.select("sha256", "body"), f"{index.root}/damaged")
    table_ = spark.read.schema(schemas.BODIES).parquet(f"{index.root}/damaged")
    return status.verify_counts(status.verify_bodies(index.table("documents"), table_))
