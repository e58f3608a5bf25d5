"""SimHash fingerprints of 128 bits, their likeness, and a search within a Hamming radius by permuted block tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperfield.llm.common import named, numbered
from paperfield.session import materialize

BITS = 128
LANES = 0x0000000100000001  # two counters of 32 bits in a long
SPACE = r"[\x20\x09-\x0D]+"


def _terms(column: str) -> Column:
    """Each word with the next one; the last with an empty one."""
    words = F.array_remove(F.split(F.lower(column), SPACE), "")
    after = F.concat(F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(0))), F.array(F.lit("")))
    return F.arrays_zip(words.alias("a"), after.alias("b"))


def _votes(texts: DataFrame) -> DataFrame:
    """(_id, total, v0 ... v63): the weight of all terms and, two bits a column, of those whose hash has the bit.

    Terms weigh 1 to 7, longer ones more, as rare ones do. The votes are sums in generated code; a lane holds the votes
    of 300 million terms.
    """
    each = texts.select("_id", F.explode(_terms("text")).alias("t")).select("_id", "t.a", "t.b")
    weight = 1 + F.least((F.length("a") + F.length("b")) / 4, F.lit(6)).cast("int")
    hashed = each.select("_id", weight.cast("long").alias("w"), F.xxhash64("a", "b").alias("h0"), F.xxhash64(F.lit(1), "a", "b").alias("h1"))
    lanes = [F.sum(F.shiftrightunsigned(f"h{k}", i).bitwiseAND(F.lit(LANES)) * F.col("w")).alias(f"v{32 * k + i}") for k in (0, 1) for i in range(32)]
    return hashed.groupBy("_id").agg(F.sum("w").alias("total"), *lanes)


def _word(k: int) -> Column:
    """64 bits of the fingerprint: those for which more than half of the weight votes."""
    bits = []
    for i in range(32):
        for lane in (0, 1):
            count = F.shiftrightunsigned(f"v{32 * k + i}", 32 * lane).bitwiseAND(F.lit(0xFFFFFFFF))
            bits.append(F.shiftleft((2 * count > F.col("total")).cast("long"), 32 * lane + i))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fingerprints(texts: DataFrame) -> DataFrame:
    """(_id, f0, f1): the fingerprint of each text (_id, text) that has a word, as two longs."""
    return _votes(texts).select("_id", _word(0).alias("f0"), _word(1).alias("f1"))


def hexadecimal(f0: str, f1: str) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(F.coalesce(f, F.lit(0)))), 16, "0") for f in (f0, f1)])


def distance(a: tuple[str, str], b: tuple[str, str]) -> Column:
    return sum((F.bit_count(F.coalesce(x, F.lit(0)).bitwiseXOR(F.coalesce(y, F.lit(0)))) for x, y in zip(a, b)), F.lit(0))


def _block(f0: str, f1: str, low: int, high: int) -> Column:
    """Bits [low, high) of the fingerprint as a key."""
    parts = []
    for word, base in ((f0, 0), (f1, 64)):
        start, end = max(low - base, 0), min(high - base, 64)
        if start < end:
            mask = (1 << (end - start)) - 1
            part = F.shiftrightunsigned(word, start)
            parts.append(part if end - start == 64 else part.bitwiseAND(F.lit(mask)))
    return F.xxhash64(*parts) if len(parts) > 1 else parts[0]


def within_radius(queries: DataFrame, table: DataFrame, radius: int = 3, extra: int = 3) -> DataFrame:
    """(query, id, distance): for each of ``queries`` (id, f0, f1) the rows of ``table`` (id, f0, f1) at most ``radius`` bits away.

    The bits form ``radius + extra`` blocks; every choice of ``extra`` blocks has a table that brings them to the front.
    A pair within the radius agrees in some choice, so the equi-joins find every pair; it is returned for the first
    choice in which it agrees. Both sides should hold distinct fingerprints: their rows then differ, and copies are a
    join away.
    """
    from itertools import combinations

    blocks = radius + extra
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    keys = [F.xxhash64(F.lit(n), *[_block("f0", "f1", edges[i], edges[i + 1]) for i in chosen]) for n, chosen in enumerate(combinations(range(blocks), extra))]
    rows = lambda df, name: df.select(F.col("id").alias(name), F.col("f0").alias(f"{name}0"), F.col("f1").alias(f"{name}1"), F.posexplode(F.array(*keys)).alias("no" + name, "key"))
    q, t = rows(queries, "q"), rows(table, "t")
    apart = distance(("q0", "q1"), ("t0", "t1"))
    close = q.join(t, (q["key"] == t["key"]) & (F.col("noq") == F.col("not")) & (apart <= radius))
    return close.groupBy(F.col("q").alias("query"), F.col("t").alias("id")).agg(F.min(apart).cast("int").alias("distance"))


def _successors(ids: DataFrame) -> DataFrame:
    """(_id, next, before, n_before): each id's next and previous one, in a circle, and the previous one's ``n``.

    Ids are dealt by range; the ends of the ranges, one row each, are put together by themselves.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(ids.repartitionByRange(parts, "_id").withColumn("p", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("p").orderBy("_id")
    ends = dealt.groupBy("p").agg(F.min("_id").alias("low"), F.max(F.struct("_id", "n")).alias("high"))
    around = Window.orderBy("p")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "p",
        F.coalesce(F.lead("low").over(around), F.first("low").over(whole)).alias("after"),
        F.coalesce(F.lag("high").over(around), F.last("high").over(whole)).alias("ahead"),
    )
    near = dealt.select("*", F.lead("_id").over(inside).alias("x"), F.lag("_id").over(inside).alias("y"), F.lag("n").over(inside).alias("z"))
    joined = near.join(F.broadcast(ends), "p")  # at most one row per partition
    return joined.select("_id", F.coalesce("x", "after").alias("next"), F.coalesce("y", "ahead._id").alias("before"), F.coalesce("z", "ahead.n").alias("n_before"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts and of their edited forms: (doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last floor(n / 2) code points replaced by the first as many, or all, of the next document by
    doc_id; after the last comes the first, and a single document is its own next one. Likeness is the share of equal
    bits. Null texts are empty; texts without words have fingerprint 0. Rows of a null doc_id come first, rows of one
    doc_id in the order of their texts, equal rows count as one. Other columns are ignored.
    """
    docs, names = numbered(docs, "text")
    texts = docs.select("_id", F.coalesce("text", F.lit("")).alias("text"))
    order = _successors(texts.select("_id", F.length("text").alias("n")))
    base = texts.join(order, "_id")
    half = F.floor(F.length("text") / 2).cast("int")
    heads = base.select("_id", F.length("text").cast("long").alias("n_chars"), F.col("text").substr(F.lit(1), F.length("text") - half).alias("head"))
    tails = base.select(F.col("before").alias("_id"), F.col("text").substr(F.lit(1), F.floor(F.col("n_before") / 2).cast("int")).alias("tail"))
    edited = heads.join(tails, "_id").select("_id", "n_chars", F.concat("head", "tail").alias("text"))
    own = fingerprints(base.select("_id", "text"))
    changed = fingerprints(edited.select("_id", "text")).select("_id", F.col("f0").alias("e0"), F.col("f1").alias("e1"))
    rows = edited.withColumnRenamed("text", "edited").join(own, "_id", "left").join(changed, "_id", "left")
    following = own.select(F.col("_id").alias("next"), F.col("f0").alias("n0"), F.col("f1").alias("n1"))
    rows = rows.join(order.select("_id", "next").join(following, "next").drop("next"), "_id", "left")
    like = lambda a, b: (1 - distance(a, b) / BITS).cast("double")
    result = rows.select(
        "_id", "n_chars", "edited",
        hexadecimal("f0", "f1").alias("fingerprint"),
        hexadecimal("e0", "e1").alias("edited_fingerprint"),
        like(("f0", "f1"), ("e0", "e1")).alias("near_edited"),
        like(("f0", "f1"), ("n0", "n1")).alias("near_next"),
    )
    return named(result, names)
