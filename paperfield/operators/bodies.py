"""Document bodies: part assembly, finalisation, deduplication, names."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperfield.functions.content import sha256_hex, starts_like_html
from paperfield.functions.retry import is_throttled
from paperfield.functions.urls import collision_name, content_path, named_path
from paperfield.operators.skew import first_per_key, rank_within
from paperfield.session import materialize


@dataclass(frozen=True)
class Assembled:
    """``bodies``: what the parts of each key give; ``open``: live parts of keys whose body is not whole yet."""

    bodies: DataFrame
    open: DataFrame


def part_ranges(parts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sweep over the byte ranges of each key's parts; their bytes are not touched but for their length.

    (key, part_no, status, offset, cut, used, reached, gap): an answer with status 200 starts anew at byte 0 and discards
    the parts before it, 206 continues.  In order of offset, then part, a part gives what lies beyond the
    bytes ``reached`` so far, ``cut`` bytes less; behind a gap no part is used.
    """
    total = F.col("total") if "total" in parts.columns else F.lit(None).cast("long")
    facts = parts.filter(F.col("status").isin(200, 206)).select(
        F.col(key), "part_no", "status", F.when(F.col("status") == 200, 0).otherwise(F.col("offset")).alias("offset"),
        F.length("bytes").cast("long").alias("length"), total.alias("total"),
    )
    facts = facts.withColumn("_start", F.max(F.when(F.col("status") == 200, F.col("part_no"))).over(Window.partitionBy(key)))
    live = facts.filter(F.col("_start").isNull() | (F.col("part_no") >= F.col("_start"))).drop("_start")
    before = Window.partitionBy(key).orderBy("offset", "part_no").rowsBetween(Window.unboundedPreceding, -1)
    swept = live.withColumn("reached", F.coalesce(F.max(F.col("offset") + F.col("length")).over(before), F.lit(0)))
    so_far = Window.partitionBy(key).orderBy("offset", "part_no").rowsBetween(Window.unboundedPreceding, 0)
    swept = swept.withColumn("gap", F.max(F.col("offset") > F.col("reached")).over(so_far))
    cut = F.greatest(F.col("reached") - F.col("offset"), F.lit(0))
    return swept.withColumn("cut", cut).withColumn("used", ~F.col("gap") & (cut < F.col("length")))


def assemble_parts(parts: DataFrame, key: str = "doc_id", newest: DataFrame | None = None) -> DataFrame:
    """Bodies from ranged parts: (key, body, n_parts, resumed, contiguous, whole).

    Overlaps are cut, and a body ends before the first gap; ``contiguous`` says that there is none, ``whole`` that the
    ``total`` length is reached too, where a part names one.  ``n_parts`` counts the live parts before a gap.  Part numbers
    must be unique within a key (:func:`advance_parts` sees to that).  The sweep works on offsets and lengths; the bytes
    move once, to where their key is put together, together with what ``newest`` (key, newest) says of the key.
    """
    swept = part_ranges(parts, key)
    repeated = F.raise_error(F.lit("part numbers repeat within a key"))
    end = F.max(F.when(~F.col("gap"), F.col("offset") + F.col("length")))
    plan = swept.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("used"), F.struct("part_no", "cut")))).alias("_used"),
        F.when(F.count("*") == F.size(F.collect_set("part_no")), F.count_if(~F.col("gap"))).otherwise(repeated.cast("long")).alias("n_parts"),
        F.bool_or((F.col("status") == 206) & ~F.col("gap")).alias("resumed"),
        (~F.bool_or("gap")).alias("contiguous"),
        (end >= F.coalesce(F.max("total"), F.lit(0))).alias("_ended"),
    )
    if newest is not None:
        plan = plan.join(newest, key, "left")
    joined = plan.join(parts.filter(F.col("status").isin(200, 206)).select(key, "part_no", "status", "offset", "bytes"), key)
    cut = F.col("_used")[F.col("part_no")]
    pieces = joined.withColumn("_piece", F.when(cut.isNotNull(), F.substring("bytes", (cut + 1).cast("int"), F.length("bytes"))))
    pieces = pieces.withColumn("_at", F.when(F.col("status") == 200, 0).otherwise(F.col("offset")) + F.coalesce(cut, F.lit(0)))
    facts = ["n_parts", "resumed", "contiguous", "_ended"]
    carried = [F.first("newest").alias("newest")] if newest is not None else []
    whole = pieces.groupBy(key, *facts).agg(F.coalesce(F.expr("listagg(_piece) within group (order by _at)"), F.lit(b"")).alias("body"), *carried)
    shown = ["newest"] if newest is not None else []
    return whole.select(key, "body", "n_parts", "resumed", "contiguous", (F.col("contiguous") & F.col("_ended")).alias("whole"), *shown)


def advance_parts(
    parts: DataFrame, earlier: DataFrame, key: str = "doc_id", claimed: DataFrame | None = None, carry: Sequence[str] = ()
) -> Assembled:
    """Whole bodies of the parts of a batch and the open parts of earlier ones, and the parts that stay open.

    A repeated part, of the same number, counts once; the one of the batch counts.  Parts of the batch whose key is not in
    ``claimed`` do not count; they are left out in the exchange by key that also tells repeated parts.  With ``carry``,
    bodies have these columns of the batch's last part of their key as a struct ``newest``, NULL without such a part.
    """
    columns = parts.columns
    every = parts.withColumn("_age", F.lit(0)).unionByName(earlier.select(columns).withColumn("_age", F.lit(1)))
    if claimed is not None:
        every = every.join(claimed.select(key, F.lit(True).alias("_claimed")), key, "left").filter("_age = 1 or _claimed").drop("_claimed")
    both = materialize(first_per_key(every, [key, "part_no"], [F.col("_age"), F.col("offset"), F.length("bytes").desc()]), "parts")
    last = F.max_by(F.struct(*carry), F.when(F.col("_age") == 0, F.struct("part_no"))).alias("newest") if carry else None
    bodies = materialize(assemble_parts(both.drop("_age"), key, both.groupBy(key).agg(last) if carry else None), "assembled")
    open_ = both.select(columns).filter(F.col("status").isin(200, 206)).join(bodies.filter("whole").select(key), key, "left_anti")
    return Assembled(bodies, open_)


def body_facts(fetched: DataFrame) -> DataFrame:
    """What the index needs to know of fetched answers, without their bodies: one scan judges, measures and hashes them.

    Input: canonical_url, http_status, headers, body, resumed, at.  Throttled and failed answers and, unless
    resumed, HTML in place of a document are errors.
    """
    status = F.col("http_status")
    error = (
        F.when(is_throttled(status) | (status >= 400), F.concat(F.lit("http "), status.cast("string")))
        .when(F.col("body").isNull(), "no body")
        .when(~F.coalesce("resumed", F.lit(False)) & starts_like_html(F.col("body")), "response is html, not pdf")
    )
    good = error.isNull()
    return fetched.select(
        "canonical_url",
        good.alias("ok"),
        F.when(good, sha256_hex(F.col("body"))).alias("sha256"),
        F.when(good, F.length("body").cast("long")).alias("content_length"),
        F.col("headers")["ETag"].alias("etag"),
        F.col("headers")["Last-Modified"].alias("last_modified"),
        "http_status",
        error.alias("error"),
        "at",
    )


def with_paths(facts: DataFrame, root: str, layout: str = "content_addressed") -> DataFrame:
    """Facts, with state and filename of the document, and ``download_path`` instead of those."""
    path = content_path(root, F.col("sha256")) if layout == "content_addressed" else named_path(root, F.col("state"), F.col("filename"), F.col("canonical_url"))
    return facts.withColumn("download_path", F.when(F.col("ok"), path)).drop("state", "filename")


def unique_bodies(bodies: DataFrame, body: str = "body", key: str = "canonical_url", wanted: DataFrame | None = None) -> DataFrame:
    """One row per digest: (sha256, body, copies), or those of the digests in ``wanted`` (sha256, copies).

    Copies are cut to one a task before the exchange by digest, so a body moves at most once and a frequent one does not
    fill a task.  Without ``wanted``, digests are counted in a scan of their own.
    """
    hashed = bodies.select(F.col(key).alias("_key"), sha256_hex(F.col(body)).alias("sha256"), F.col(body).alias("body")).filter(F.col("body").isNotNull())
    if wanted is None:
        wanted = hashed.groupBy("sha256").agg(F.count("*").alias("copies"))
    return first_per_key(hashed, ["sha256"], [F.col("_key")]).join(wanted, "sha256").select("sha256", "body", "copies")


_NUMBERED = r"(?s)^(.*[^/])__([0-9]{1,18})(\.[^./]+)$"


def _family(path: Column) -> Column:
    """What the numbered names of a path have in common: the name numbered 0."""
    return collision_name(path, F.lit(0))


def number_collisions(files: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Final name of every (dest, sha256): equal digests share one, others get the smallest free numbers from 2.

    Input: dest, sha256, arrived (a total order).  ``stored`` (path, sha256) are the taken names, plain and numbered; a
    digest stored under its plain name or a number of it keeps that.  In a batch plain names are given first, each to
    the digest that arrived first; the others take numbers in order of arrival.  No two digests get one name,
    also where a plain name looks like a numbered one or two names number alike (``a`` and ``a.pdf``).

    Free numbers come from one ranking of requests and taken numbers per family of names: the taken number t has t - i - 1
    free ones below it if it is the i-th, request k stands behind those with fewer than k, and its rank in
    that order plus one is the k-th free number.
    """
    firsts = materialize(files.groupBy("dest", "sha256").agg(F.min("arrived").alias("arrived")), "names")
    taken = (stored if stored is not None else files.limit(0).select(F.col("dest").alias("path"), "sha256")).groupBy("path").agg(F.min("sha256").alias("sha256"))
    first = first_per_key(firsts, ["dest"], [F.col("arrived"), F.col("sha256")])
    plain = first.join(taken.select(F.col("path").alias("dest")), "dest", "left_anti")
    own = firsts.join(taken.select(F.col("path").alias("dest"), "sha256"), ["dest", "sha256"], "left_semi")
    settled = materialize(own.select("dest", "sha256", "arrived").unionByName(plain.select("dest", "sha256", "arrived")), "plain")
    asked = firsts.join(settled.select("dest", "sha256"), ["dest", "sha256"], "left_anti").withColumn("family", _family(F.col("dest")))

    names = taken.select("path", "sha256").unionByName(plain.select(F.col("dest").alias("path"), "sha256"))
    number = F.regexp_extract("path", _NUMBERED, 2)
    stem = F.concat(F.regexp_extract("path", _NUMBERED, 1), F.regexp_extract("path", _NUMBERED, 3))
    # "a__02.pdf" is no name that numbering gives
    used = names.filter(number.rlike("^([2-9]|[1-9][0-9]+)$")).select(_family(stem).alias("family"), number.cast("long").alias("number"), "sha256")
    used = materialize(used.distinct(), "numbers")
    known = used.groupBy("family", "sha256").agg(F.min("number").alias("_known"))
    asked = materialize(asked.join(known, ["family", "sha256"], "left"), "asked")

    new = asked.filter(F.col("_known").isNull()).groupBy("family", "sha256").agg(F.min("arrived").alias("arrived"))
    requests = rank_within(new, ["family"], [F.col("arrived"), F.col("sha256")], "key").select("family", "key", F.lit(1).alias("kind"), "sha256")
    gone = rank_within(used.select("family", "number").distinct(), ["family"], [F.col("number")], "_i")
    gone = gone.select("family", (F.col("number") - F.col("_i")).alias("key"), F.lit(0).alias("kind"), F.col("number").cast("string").alias("sha256"), "number")
    # among taken numbers with as many free ones below, any order will do
    order = rank_within(requests.unionByName(gone.drop("number")), ["family"], [F.col("key"), F.col("kind"), F.length("sha256"), F.col("sha256")], "_rank")
    given = order.filter("kind = 1").select("family", "sha256", (F.col("_rank") + 1).alias("_new"))

    numbered = asked.join(given, ["family", "sha256"], "left").withColumn("copy_no", F.coalesce("_known", "_new"))
    numbered = numbered.select("dest", "sha256", "arrived", "copy_no", collision_name(F.col("dest"), F.col("copy_no")).alias("final_path"))
    return settled.select("dest", "sha256", "arrived", F.lit(1).cast("long").alias("copy_no"), F.col("dest").alias("final_path")).unionByName(numbered)
