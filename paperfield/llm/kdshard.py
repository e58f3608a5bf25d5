"""Shards of near-equal bytes: a k-d tree over metadata, split at distributed weighted medians."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperfield.session import materialize

BINS = 4096


def _cuts(rows: DataFrame, place: F.Column, shares: DataFrame) -> DataFrame:
    """(node, bin, left): the bin of ``place`` in which a node's share of weight is reached, and what it still takes of it.

    A histogram of at most ``BINS`` bins a node, made by partial sums, is all that is brought together.
    """
    bins = rows.groupBy("node", place.alias("bin")).agg(F.sum("size").alias("w"))
    so_far = F.sum("w").over(Window.partitionBy("node").orderBy("bin"))
    found = bins.join(shares, "node").withColumn("upto", so_far).withColumn("before", F.col("upto") - F.col("w"))
    here = found.filter((F.col("before") <= F.col("want")) & (F.col("want") < F.col("upto")))
    return here.groupBy("node").agg(F.min_by("bin", "before").alias("bin"), (F.min("want") - F.min("before")).alias("left"))


def kd_shards(rows: DataFrame, dimensions: list[str], shards: int) -> DataFrame:
    """``rows`` (size, tie, the dimensions) with ``shard`` from 0: leaves of a k-d tree of near-equal total size.

    Each node with k > 1 leaves to come is cut along its widest dimension, whose range in the node is the largest part
    of its range in the table, at the weight share of floor(k / 2) leaves. Values of dimensions are numbers; null is the
    smallest. A cut through equal values goes on by ``tie``, a long that is spread evenly, in two further histograms, so
    the sides miss their share by a row or by a 2**-24th of the equal ones. Each level reads the rows four times and
    writes them once; nothing but histograms is shuffled.
    """
    low = [F.min(d).alias(f"low_{d}") for d in dimensions]
    high = [F.max(d).alias(f"high_{d}") for d in dimensions]
    spread = rows.agg(*low, *high).first()
    unit = {d: (spread[f"high_{d}"] - spread[f"low_{d}"]) or 1.0 if spread[f"low_{d}"] is not None else 1.0 for d in dimensions}
    rows = rows.withColumns({"node": F.lit(0), "leaves": F.lit(shards)})
    level = shards
    while level > 1:
        level = -(-level // 2)
        rows = materialize(rows, "level")
        open_ = rows.filter("leaves > 1")
        ranges = open_.groupBy("node").agg(F.max("leaves").alias("leaves"), F.sum("size").alias("total"), *low, *high)
        widths = [F.struct(F.coalesce((F.col(f"high_{d}") - F.col(f"low_{d}")) / unit[d], F.lit(0.0)).alias("width"), F.lit(-i).alias("no")) for i, d in enumerate(dimensions)]
        ranges = ranges.withColumn("dim", -F.greatest(*widths)["no"]).withColumn("want", F.floor(F.col("total") * F.floor(F.col("leaves") / 2) / F.col("leaves")))
        value = F.element_at(F.array(*[F.col(d).cast("double") for d in dimensions]), F.col("dim") + 1)
        least = F.element_at(F.array(*[F.col(f"low_{d}").cast("double") for d in dimensions]), F.col("dim") + 1)
        most = F.element_at(F.array(*[F.col(f"high_{d}").cast("double") for d in dimensions]), F.col("dim") + 1)
        ranges = materialize(ranges.select("node", "dim", "want", least.alias("least"), most.alias("most")), "ranges")
        bounds = F.broadcast(ranges)  # a row for each inner node, fewer than there are shards
        first = F.coalesce(F.least(F.floor((value - F.col("least")) / (F.col("most") - F.col("least")) * BINS), F.lit(BINS - 1)), F.lit(-1)).cast("int")
        first = F.when(F.col("most") > F.col("least"), first).otherwise(F.when(value.isNull(), -1).otherwise(0))
        binned = open_.join(bounds, "node").withColumn("b1", first)
        high_tie = F.shiftrightunsigned("tie", 52).cast("int")
        low_tie = F.shiftrightunsigned("tie", 40).bitwiseAND(BINS - 1).cast("int")
        one = _cuts(binned, F.col("b1"), ranges.select("node", "want"))
        inside = binned.drop("want").join(F.broadcast(one.withColumnRenamed("left", "want")), "node").filter("b1 = bin").drop("bin")
        two = _cuts(inside, high_tie, one.select("node", F.col("left").alias("want")))
        within = inside.drop("want").join(F.broadcast(two.withColumnRenamed("left", "want")), "node").filter(high_tie == F.col("bin")).drop("bin")
        three = _cuts(within, low_tie, two.select("node", F.col("left").alias("want")))
        cuts = one.select("node", F.col("bin").alias("c1")).join(two.select("node", F.col("bin").alias("c2")), "node", "left").join(three.select("node", F.col("bin").alias("c3")), "node", "left")
        cuts = ranges.join(cuts, "node", "left")
        at = F.struct(first, high_tie, low_tie)
        cut = F.struct(F.coalesce("c1", F.lit(BINS)), F.coalesce("c2", F.lit(BINS)), F.coalesce("c3", F.lit(BINS)))
        moved = rows.join(F.broadcast(cuts), "node", "left").withColumn("right", (F.col("leaves") > 1) & (at >= cut))
        half = F.floor(F.col("leaves") / 2).cast("int")
        leaves = F.when(F.col("leaves") <= 1, F.col("leaves")).when(F.col("right"), F.col("leaves") - half).otherwise(half)
        node = F.when(F.col("right"), F.col("node") + half).otherwise(F.col("node"))  # a node is named by its first shard
        rows = moved.select(*[c for c in rows.columns if c not in ("node", "leaves")], node.alias("node"), leaves.alias("leaves"))
    return rows.withColumnRenamed("node", "shard").drop("leaves")


def shard_documents(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of ``docs`` (doc_id, text, lang, source).

    ``shards`` leaves, or as many as leaves of ``target_bytes`` need. A document's size is that of its text in UTF-8
    (null: none) and 16. The law is ``bytes``: sizes are near-equal, whatever texts, sources or ids repeat; equal texts
    may part. ``slot`` numbers a shard's rows by doc_id from 0; a leaf holds what it should by its bytes, so the
    numbering of one leaf is one task's work. ``grown_shard`` is null, as more shards mean another tree. Null ids and
    metadata come first; repeated rows are rows of their own. Other columns are ignored.
    """
    number = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 20)).cast("double")
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.length(data) + 16).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.when(F.col("lang").isNotNull(), number("lang")).alias("d_lang"),
        F.when(F.col("source").isNotNull(), number("source")).alias("d_source"),
        F.log2(F.length(data) + 16.0).alias("d_size"),
        F.col("doc_id").cast("double").alias("d_id"),
        F.xxhash64("doc_id", "text").alias("tie"),
    )
    rows = materialize(rows, "metadata")
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    placed = kd_shards(rows, ["d_source", "d_lang", "d_size", "d_id"], shards)
    slot = (F.row_number().over(Window.partitionBy("shard").orderBy("doc_id", "tie")) - 1).cast("long")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
