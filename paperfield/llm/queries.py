"""Queries of the text operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperfield.llm import bpe, langid, merkle, packing, quality, warczip
from paperfield.llm.decontam import contamination, is_contaminated
from paperfield.llm.divergence import source_divergence
from paperfield.llm.kdshard import shard_documents
from paperfield.llm.minhash import NearDuplicates, near_duplicates
from paperfield.llm.simhash import fingerprint_documents
from paperfield.llm.suffixdedup import remove_repeats
from paperfield.llm.urlfilter import listed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_min_bin_slack_packing(spark: SparkSession, folder: str) -> DataFrame:
    found = packing.pieces(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return found.drop("ids")


def _fold(folds: int) -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


@query
def op2_language_filters(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    trained = langid.train(docs, _fold(4) != 2)
    found = langid.identify(docs.select("doc_id", "text"), trained)
    return found.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprint_documents(table(spark, folder, "documents"))
    return found.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256)).drop("edited")


@query
def op4_quality_network(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    found = quality.score(docs, model)
    return found.select("doc_id", (_fold(5) == 0).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))


@query
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), NearDuplicates(shingle=3, percent=85))


def _draw(column: str, salt: str, parts: int) -> F.Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col(column))), 1, 6), 16, 10).cast("int") % parts


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries of five lists over what the pages have: hosts, their parent domains, and first folders of paths.

    Each is added, removed and added again on days drawn from its name.
    """
    host = F.lower(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1))
    folder = F.regexp_extract("url", "^[a-z]+://[^/?#]*/([^/?#]+)", 1)
    named = pages.select(host.alias("host"), F.when(folder != "", F.concat(host, F.lit("/"), F.lower(folder))).alias("folder"), F.regexp_replace(host, "^[^.]*[.]", "").alias("domain"))
    patterns = named.select(F.explode(F.array("host", "folder", "domain")).alias("pattern")).filter("pattern <> ''").distinct()
    first = F.date_add(F.lit("2024-01-01").cast("date"), _draw("pattern", "a", 300))
    after = F.date_add(first, 1 + _draw("pattern", "b", 60))
    again = F.date_add(after, _draw("pattern", "c", 40))
    events = [F.struct(F.lit(action).alias("action"), day.alias("day")) for action, day in (("add", first), ("remove", after), ("add", again))]
    kept = patterns.filter(_draw("pattern", "d", 3) > 0).withColumn("list", F.concat(F.lit("list"), _draw("pattern", "e", 5)))
    return kept.select("list", "pattern", F.explode(F.array(*events)).alias("e")).select("list", "pattern", "e.*")


@query
def op6_temporal_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int"))
    found = listed(pages.select(F.col("page_id").alias("capture_id"), "url", day.alias("day")), list_entries(pages))
    joined = [F.array_join(c, ",").alias(c) for c in ("lists", "patterns")]
    return found.select(F.col("capture_id").alias("page_id"), "n_lists", *joined, F.col("since").cast("string").alias("since"))


_HEX = "cast('0x' || substr(md5('{}' || pattern), 1, 6) as integer) % {}"
ORACLES["op6_temporal_url_lists"] = f"""with p as (select page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) as host,
    lower(regexp_extract(url, '^[a-z]+://[^/?#]*/([^/?#]+)', 1)) as folder, lower(regexp_extract(url, '^[a-z]+://[^/?#]*/*([^?#]*)', 1)) as path,
    date '2024-01-01' + cast(page_id % 366 as integer) as day from pages),
  pat as (select distinct pattern from (select host as pattern from p union all select case when folder <> '' then host || '/' || folder end from p
    union all select regexp_replace(host, '^[^.]*[.]', '') from p) where pattern <> ''),
  lst as (select pattern, 'list' || {_HEX.format("e", 5)} as list, date '2024-01-01' + {_HEX.format("a", 300)} as d1, 1 + {_HEX.format("b", 60)} as n2, {_HEX.format("c", 40)} as n3
    from pat where {_HEX.format("d", 3)} > 0),
  val as (select pattern, list, d1 as f, d1 + n2 as t from lst
    union all select pattern, list, d1 + n2 + n3, null from lst where n3 > 0),
  keys as (select page_id, day, unnest(list_distinct(list_concat(
      list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
      list_transform(range(1, len(list_filter(string_split(path, '/'), lambda x: x <> '')) + 1),
        lambda i: host || '/' || array_to_string(list_filter(string_split(path, '/'), lambda x: x <> '')[1:i], '/'))))) as key from p),
  hit as (select page_id, list, key, f from keys join val on key = pattern and day >= f and (t is null or day < t))
  select page_id, count(distinct list) as n_lists, coalesce(array_to_string(list_sort(list(distinct list) filter (list is not null)), ','), '') as lists,
    coalesce(array_to_string(list_sort(list(distinct key) filter (key is not null)), ','), '') as patterns, cast(min(f) as varchar) as since
  from p left join hit using (page_id) group by page_id"""


@query
def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    removed = (F.col("n_bytes") - F.length("kept")).alias("n_removed")
    return found.select("doc_id", "n_bytes", removed, F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_zip_packaged_warc(spark: SparkSession, folder: str) -> DataFrame:
    packages, place = warczip.archive(table(spark, folder, "pages"))
    found = warczip.read_archive(packages, place, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op8_zip_packaged_warc"] = """with p as (select page_id, encode(coalesce(html, '')) as b from pages),
  q as (select page_id, octet_length(b) as n, sha256(b) as d from p),
  f as (select d, min(page_id) as least from q where n >= 100 group by d)
  select page_id, n as payload_bytes, d as payload_digest, case when n >= 100 and page_id <> least then 'revisit' else 'response' end as record_type,
    case when n >= 100 and page_id <> least then least end as refers_to from q left join f using (d)"""


@query
def op9_benchmark_contamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    ids = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), ids, is_contaminated().alias("contaminated"))


_GAP = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op9_benchmark_contamination"] = f"""with d as (select doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_GAP}') as w from documents),
  i as (select item_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_GAP}') as w from benchmark),
  iw as (select item_id, unnest(range(1, greatest(len(w) - 11, 2))) as pos, least(len(w), 13) as n, w from i where len(w) > 0),
  win as (select distinct item_id, n, array_to_string(w[pos:pos + n - 1], ' ') as s from iw),
  dn as (select doc_id, n, w from d, (select distinct n from win) where len(w) >= n),
  dw as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as pos, w from dn),
  ds as (select doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') as s from dw),
  hit as (select doc_id, item_id, n, pos from ds join win using (n, s)),
  cover as (select doc_id, count(distinct pos + k) as n_hit from (select doc_id, pos, unnest(range(0, n)) as k from hit) group by doc_id),
  items as (select doc_id, count(distinct item_id) as n_items, array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as ids from hit group by doc_id)
  select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
  from d left join cover using (doc_id) left join items using (doc_id)"""


@query
def op10_kd_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"), shards=40)


@query
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(table(spark, folder, "documents"))


ORACLES["op11_source_divergence"] = r"""with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
  t as (select r, lang, source, unnest(w) as term from d),
  k as (select lang, term from t group by all having count(distinct r) >= 3),
  v as (select lang, count(*) as v from k group by all),
  c as (select lang, source, term, count(*) as c from t join k using (lang, term) group by all),
  n as (select lang, source, sum(c) as n from c group by all),
  g as (select distinct lang, source from d),
  p as (select g.lang, g.source, k.term, coalesce(c, 0) as c, 1 + (1000000000::hugeint * (coalesce(c, 0) + 1)) // (coalesce(n, 0) + v)::hugeint as p
    from g join k using (lang) join v using (lang) left join n using (lang, source) left join c using (lang, source, term)),
  q as (select lang, term, 1 + (1000000000::hugeint * (ct + 1)) // (nt + v)::hugeint as q from (select lang, term, sum(c) as ct from c group by all)
    join (select lang, sum(c) as nt from c group by all) using (lang) join v using (lang)),
  s as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
  rows as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
      from g a join g b on a.lang = b.lang and a.source <> b.source left join s on s.lang = a.lang and s.source = a.source and s.item = b.source
    union all select p.lang, p.source, 'term', term, ((p.p - q.q) * (p.p - q.q)) // q.q from p join q using (lang, term) where c > 0 and p.p > q.q)
  select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
  from (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from rows) where part = 'pair' or rank <= 200"""


@query
def op12_two_tier_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = bpe.decode_documents(bpe.encode_documents(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    ids = F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    found = merkle.manifest(table(spark, folder, "documents"), received=merkle.leaf_digest(text=text))
    again = merkle.folded(F.col("received"), F.col("path"))
    found = found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), again.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field(value: str, text: str | None = None) -> str:
    text = text or f"cast({value} as varchar)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _merkle_sql(depth: int = 8, above: int = 3) -> str:
    """The tree of at most 8^depth documents a language and 8^above languages, level by level."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # CRC-32 bit by bit: the reflected polynomial, over the digits of the id
    bits = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda d, i: xor(d >> 1, 3988292384 * (d & 1)))"
    digits = "list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: ascii(x)::bigint))"
    tampered = f"case when xor(list_reduce({digits}, lambda c, b: {bits}), 4294967295) % 3 = 0 then {lowered} else text end"
    fields = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    steps = [f"""d as (select doc_id, lang, {_field('lang')} as g, sha256({fields} || {_field('text', 'text')}) as leaf, sha256({fields} || {_field('text', f'({tampered})')}) as received from documents),
  n0 as (select g, leaf as digest, lang, doc_id, received, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by g) as n from d)"""]

    def level(nodes: str, slots: str, over: str) -> None:
        steps.append(f"{slots} as (select g, pos // 8 as parent, any_value(n) as n, list(digest order by pos) as a from {nodes} group by g, pos // 8)")
        steps.append(f"{over} as (select g, parent as pos, (n + 7) // 8 as n, case when n > 1 then sha256(array_to_string(a, '')) else a[1] end as digest from {slots})")

    def climb(path: str, slots: str, over: str) -> None:
        left, right = "array_to_string(a[1:pos % 8], '')", "array_to_string(a[pos % 8 + 2:], '')"
        steps.append(f"""{over} as (select p.* replace (pos // 8 as pos, case when s.n > 1 then sha256({left} || cur || {right}) else cur end as cur,
    case when s.n > 1 then proof || {left} || {right} else proof end as proof) from {path} p join {slots} s on s.g = p.g and s.parent = p.pos // 8)""")

    for i in range(depth):
        level(f"n{i}", f"s{i}", f"n{i + 1}")
    steps.append(f"t0 as (select '' as g, n{depth}.g as own, digest, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from n{depth} join (select distinct g, lang from d) l using (g))")
    for i in range(above):
        level(f"t{i}", f"u{i}", f"t{i + 1}")
    steps.append("p0 as (select doc_id, digest as leaf, received as cur, '' as proof, g, pos from n0)")
    for i in range(depth):
        climb(f"p{i}", f"s{i}", f"p{i + 1}")
    steps.append(f"q0 as (select doc_id, leaf, cur, proof, '' as g, t0.pos, t0.digest as subroot from p{depth} p join t0 on t0.own = p.g)")
    for i in range(above):
        climb(f"q{i}", f"u{i}", f"q{i + 1}")
    return "with " + ",\n  ".join(steps) + f"""
  select doc_id, leaf, subroot, digest as root, sha256(proof) as proof_sha256, cur as folded_root, cur = digest as verified from q{above}, t{above}"""


ORACLES["op13_merkle_manifest"] = _merkle_sql()
