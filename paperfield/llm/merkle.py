"""Merkle trees over documents, a tree a group and one over the groups; leaf places are ranks in merged bitmaps of ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperfield.operators.skew import rank_within
from paperfield.session import materialize

FANOUT = 8
WORD = 6  # log2 of the ids of a bitmap word, and of the words of a container
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def field(column: Column) -> Column:
    """A value as its length in bytes, a colon and itself; ``-`` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[str] = COLUMNS, **instead: Column) -> Column:
    """Digest of a row's columns, some of which may be given otherwise."""
    return digest(F.concat(*[field(instead.get(c, F.col(c))) for c in columns]))


def _below(bit: Column) -> Column:
    """A word with the bits under ``bit`` set."""
    return F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit.cast("int")))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def _placed_ids(rows: DataFrame) -> DataFrame:
    """``rows`` with the bitmap word of their id (null: one before all others), its container, and the bit in the word."""
    word = F.coalesce(F.shiftright("doc_id", WORD), F.lit(-(1 << 63 - WORD) - 1))
    bit = F.coalesce(F.col("doc_id").bitwiseAND(63), F.lit(0))
    return rows.withColumn("_word", word).withColumn("_bit", bit).withColumn("_key", F.shiftright("_word", WORD))


def containers(rows: DataFrame) -> DataFrame:
    """Merged, compressed bitmaps of the ids of each group, with their popcount directories.

    A container covers 64 words of 64 ids and has only words that are not zero: which ones (``present``), their bits,
    and the rows before each (``directory``; rows, as an id may repeat). ``base`` has the rows of the group in earlier
    containers, ``members`` all rows of the group. Ids are merged word by word before the shuffle.
    """
    words = _placed_ids(rows).groupBy("group", "_key", "_word").agg(F.bit_or(_bit(F.col("_bit"))).alias("bits"), F.count("*").alias("n"))
    slot = F.col("_word").bitwiseAND(63)
    merged = words.groupBy("group", "_key").agg(
        F.bit_or(_bit(slot)).alias("present"), F.array_sort(F.collect_list(F.struct(slot.alias("slot"), "bits", "n"))).alias("w"), F.sum("n").alias("rows")
    )
    before = F.aggregate("w", F.array(F.lit(0).cast("long")), lambda sums, w: F.array_append(sums, F.element_at(sums, -1) + w["n"]))
    packed = merged.select("group", "_key", "present", F.transform("w", lambda w: w["bits"]).alias("words"), before.alias("directory"), "rows")
    ranged = packed.repartitionByRange("group", "_key").sortWithinPartitions("group", "_key")
    placed = materialize(ranged.withColumn("_part", F.shiftright(F.monotonically_increasing_id(), 33)), "containers")
    parts = placed.groupBy("group", "_part").agg(F.sum("rows").alias("_rows"))
    whole = Window.partitionBy("group").orderBy("_part")
    parts = parts.select(
        "group", "_part", (F.sum("_rows").over(whole) - F.col("_rows")).alias("_earlier"), F.sum("_rows").over(Window.partitionBy("group")).alias("members")
    )
    inside = F.sum("rows").over(Window.partitionBy("group", "_part").orderBy("_key")) - F.col("rows")
    found = placed.withColumn("_inside", inside).join(parts, ["group", "_part"])
    return found.withColumn("base", F.col("_earlier") + F.col("_inside")).drop("_part", "_earlier", "_inside")


def coordinates(rows: DataFrame) -> DataFrame:
    """``rows`` (group, doc_id, leaf, others) with ``members``, the size of the group, and ``pos``, the place in it from 0.

    A place is a rank query: the rows before the container, the word and the bit. Nothing is sorted but rows whose word
    has a repeated id: those take their places by (doc_id, leaf), null first, in ranges that part a frequent id.
    """
    index = materialize(containers(rows), "bitmaps")
    own = F.bit_count(F.col("present").bitwiseAND(_below(F.col("_word").bitwiseAND(63))))
    found = _placed_ids(rows).join(index, ["group", "_key"]).withColumn("_i", own)
    bits, start = F.col("words")[F.col("_i")], F.col("directory")[F.col("_i")]
    inside = F.bit_count(bits.bitwiseAND(_below(F.col("_bit"))))
    repeats = F.col("directory")[F.col("_i") + 1] - start > F.bit_count(bits)
    placed = found.select(*rows.columns, "members", "_word", (F.col("base") + start).alias("_start"), inside.cast("long").alias("_inside"), repeats.alias("_repeats"))
    placed = materialize(placed, "coordinates")
    single = placed.filter(~F.col("_repeats")).withColumn("pos", F.col("_start") + F.col("_inside"))
    tied = rank_within(placed.filter("_repeats"), ["group", "_word"], [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "_rank")
    tied = tied.withColumn("pos", F.col("_start") + F.col("_rank") - 1)
    return single.select(*rows.columns, "members", "pos").unionByName(tied.select(*rows.columns, "members", "pos"))


def _up(nodes: DataFrame, members: int, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Levels of slot arrays, written one by one, over nodes (group, members, pos, digest, payload), and each group's root.

    A level has a row a parent: its place, the nodes of its level in the group, and its up to ``fanout`` children in
    order. A group that has come down to one node is carried on as it is.
    """
    levels = []
    while True:
        slots = F.array_sort(F.collect_list(F.struct("pos", "digest", *(["payload"] if not levels else []))))
        level = nodes.groupBy("group", "members", F.expr(f"pos div {fanout}").alias("parent")).agg(slots.alias("slots"))
        levels.append(materialize(level, "slots"))
        joined = F.array_join(F.transform("slots", lambda s: s["digest"]), "")
        over = F.when(F.col("members") > 1, digest(joined)).otherwise(F.col("slots")[0]["digest"])
        nodes = levels[-1].select("group", F.expr(f"(members + {fanout - 1}) div {fanout}").alias("members"), F.col("parent").alias("pos"), over.alias("digest"))
        members = -(-members // fanout)
        if members <= 1:
            return levels, nodes.select("group", "digest")


def _down(levels: list[DataFrame], top: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Payloads of the first level with their ``path``: what stands left and right of each digest on the way to the top.

    ``top`` has (group, path, carried) for the last node of each group. A node's path is its own siblings before its
    parent's path, so a level needs one join of its parents.
    """
    known = top.withColumn("pos", F.lit(0).cast("long"))
    for i, level in reversed(list(enumerate(levels))):
        joined = level.join(known.withColumnRenamed("pos", "parent"), ["group", "parent"])
        slots = joined.select("*", F.posexplode("slots").alias("_at", "_slot"))
        digests = F.transform("slots", lambda s: s["digest"])
        left = F.array_join(F.slice(digests, F.lit(1), F.col("_at")), "")
        right = F.array_join(F.slice(digests, F.col("_at") + 2, F.size("slots")), "")
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        path = F.when(F.col("members") > 1, F.concat(step, "path")).otherwise(F.col("path"))
        rest = ["_slot.payload"] if i == 0 else [F.col("_slot.pos").alias("pos")]
        known = slots.select("group", *rest, path.alias("path"), *carried)
    return known


PATH = "array<struct<left:string,right:string>>"


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, fanout: int = FANOUT, **carried: Column) -> DataFrame:
    """A row a document: doc_id, lang, leaf, subroot, root, path, and ``carried`` expressions of its row.

    ``columns`` are digested into the leaf. Per lang, leaves ascend by doc_id; runs of ``fanout`` nodes become one
    until one is left, the subroot; subroots by lang, null first, likewise become the root. ``path`` has the digests left
    and right of each node from the leaf to the root (:func:`folded`, :func:`proof`).

    Null doc_ids come first; rows of one doc_id are ordered by their leaves, and equal rows stand side by side. Null and
    empty texts have different leaves. A very long text is hashed in one task and goes no further. Other columns are not
    read. An empty table has no rows.
    """
    lang = field(F.col("lang"))
    own = [F.col("doc_id").cast("long").alias("doc_id"), "lang", lang.alias("group"), leaf_digest(columns).alias("leaf")]
    rows = materialize(docs.select(*own, F.struct(F.lit(0).alias("_"), *[e.alias(n) for n, e in carried.items()]).alias("carried")), "leaves")
    found = coordinates(rows)
    nodes = materialize(found.select("group", "members", "pos", F.col("leaf").alias("digest"), F.struct("doc_id", "lang", "leaf", "carried").alias("payload")), "nodes")
    largest = nodes.agg(F.max("members")).first()[0] or 0
    levels, subroots = _up(nodes, largest, fanout)

    langs = nodes.groupBy("group").agg(F.min("payload.lang").alias("lang"))
    named = subroots.join(langs, "group").withColumn("all", F.lit(""))
    ranked = rank_within(named, ["all"], [F.col("lang").asc_nulls_first()], "place")
    count = ranked.count()
    above = ranked.select(
        F.col("all").alias("group"), F.lit(count).cast("long").alias("members"), (F.col("place") - 1).alias("pos"), "digest",
        F.struct("group", F.col("digest").alias("subroot")).alias("payload"),
    )
    upper, root = _up(above, count, fanout)
    top = root.select("group", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    tops = _down(upper, top, ["root"]).select("payload.group", "path", "payload.subroot", "root")
    whole = _down(levels, tops, ["subroot", "root"])
    return whole.select("payload.doc_id", "payload.lang", "payload.leaf", "subroot", "root", "path", *[F.col(f"payload.carried.{n}").alias(n) for n in carried])


def proof(path: Column) -> Column:
    """Digest of all siblings from a leaf to the root."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"])))
