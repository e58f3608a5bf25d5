"""Benchmark contamination: a prefix-filtered join of rare word shingles, confirmed over item-sized windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperfield.llm.common import named, numbered
from paperfield.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _split(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def words(column: str) -> Column:
    """Runs of digits, ASCII letters (A-Z in lower case) and all other code points above 127."""
    return _split(F.translate(column, UPPER, LOWER))


def coarse_words(column: str) -> Column:
    """As many words, all letters in lower case: faster, and equal wherever :func:`words` are. Only finds candidates."""
    return _split(F.lower(F.replace(F.col(column), F.lit("Σ"), F.lit("σ"))))


def _shingle(array: str, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.col(array)[at + i] for i in range(size)])


def _shingles(array: str, size: int) -> Column:
    last = F.size(array) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: _shingle(array, i, size))).otherwise(F.array().cast("array<long>"))


def windows(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, words, coarse) of the items, and which item has which (window_id, item_id).

    A window is ``window`` consecutive words; an item of fewer words, but not none, is one window.
    """
    parts = items.select("item_id", words("text").alias("w"), coarse_words("text").alias("c")).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)).alias("at")
    cut = parts.select("item_id", "w", "c", length.alias("n"), at)
    cut = cut.select("item_id", F.slice("w", F.col("at"), F.col("n")).alias("words"), F.slice("c", F.col("at"), F.col("n")).alias("coarse"))
    kinds = cut.select("words", "coarse").dropDuplicates(["words"]).withColumn("window_id", F.monotonically_increasing_id())
    kinds = materialize(kinds, "windows")
    return kinds, cut.join(kinds.select("words", "window_id"), "words").select("window_id", "item_id").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, shingle: int = 5) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids): words of each document inside an occurrence of a window of an item.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. Null and empty texts have no
    words. ``item_ids`` are the ids of the items with an occurring window as strings, sorted; a null item_id is left
    out of them, but its windows hit. Equal rows of documents have equal results; so have rows of a null doc_id and
    equal text. Items that share an id count as one item.

    All shingles of the windows meet those of the documents once, which gives their exact corpus counts. Each window's
    rarest shingle is its prefix: an occurrence must hold it. Hits of prefixes, at places where the window fits, are
    then compared word by word with the text. Texts are shuffled once, and only to meet candidates.
    """
    docs, names = numbered(docs, "text")
    kinds, owners = windows(items, window)
    sizes = [r.s for r in kinds.select(F.least(F.size("words"), F.lit(shingle)).alias("s")).distinct().collect()]
    tokens = None
    for size in sizes:
        fits = kinds.filter(F.least(F.size("words"), F.lit(shingle)) == size)
        found = fits.select("window_id", F.posexplode(_shingles("coarse", size)).alias("at", "token"))
        tokens = found if tokens is None else tokens.union(found)
    rows = docs.select("_id", coarse_words("text").alias("w"))
    own = F.xxhash64(F.lit("document"))  # one row of each document stays, with its number of words
    arrays = [F.transform(_shingles("w", s), lambda h, i: F.struct(i.alias("at"), h.alias("token"))) for s in sizes]
    one = F.array(F.struct(F.lit(-1).alias("at"), own.alias("token")))
    each = rows.select("_id", F.size("w").cast("long").alias("n_words"), F.explode(F.concat(one, *arrays)).alias("s"))
    wanted = rows.sparkSession.range(1).select(own.alias("token"))
    if tokens is not None:
        tokens = materialize(tokens, "tokens")
        wanted = wanted.union(tokens.select("token"))
    wanted = materialize(wanted.distinct(), "wanted")
    hits = materialize(each.select("_id", "n_words", "s.at", "s.token").join(wanted, "token"), "hits")
    every = hits.filter("at < 0").select("_id", "n_words")
    if tokens is None:
        empty = every.select("_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("item_ids"))
        return named(empty, names)

    counts = hits.filter("at >= 0").groupBy("token").agg(F.count("*").alias("c"))
    rarest = tokens.join(counts, "token", "left").groupBy("window_id").agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "token", F.col("at").alias("inner"))).alias("r"))
    prefixes = rarest.filter("r.c > 0").select("window_id", "r.token", "r.inner").join(kinds.select("window_id", "words"), "window_id")
    start = F.col("at") - F.col("inner")
    cuts = hits.filter("at >= 0").join(prefixes, "token").filter((start >= 0) & (start + F.size("words") <= F.col("n_words")))
    cuts = cuts.select("_id", start.alias("start"), "window_id", F.col("words").alias("want")).groupBy("_id").agg(F.collect_list(F.struct("start", "window_id", "want")).alias("cuts"))
    texts = docs.join(cuts, "_id").select("_id", F.array(words("text")).alias("once"), "cuts")
    fits = lambda w: lambda c: F.slice(w, c["start"] + 1, F.size(c["want"])) == c["want"]
    place = lambda c: F.sequence(c["start"], c["start"] + F.size(c["want"]) - 1)
    covered = lambda x: F.size(F.array_distinct(F.flatten(F.transform(x, place)))).cast("long")
    kept = lambda x: F.struct(covered(x).alias("n_hit"), F.array_distinct(F.transform(x, lambda c: c["window_id"])).alias("windows"))
    # Arguments of lambdas are made once; a column that only a lambda reads would be split anew for each cut.
    found = F.transform(F.transform("once", lambda w: F.filter("cuts", fits(w))), kept)
    found = texts.select("_id", F.inline(found)).select("_id", "n_hit", F.explode("windows").alias("window_id")).join(owners, "window_id")
    having = found.groupBy("_id").agg(F.max("n_hit").alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    joined = every.join(having, "_id", "left")
    none = F.array().cast("array<string>")
    result = joined.select("_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids"))
    return named(result, names)


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
