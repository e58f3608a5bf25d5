"""Repeated byte strings: content-chosen anchors bring equal strings together, a hash-compared suffix sort decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperfield.llm.common import BLOCK_BYTES, mix, named, numbered, prefix_hashes, substring_hashes, text_blocks, utf8

GRAM = 32  # bytes that choose an anchor
HOT_IN_BLOCK = 64  # surroundings of one anchor in a block from which its group is spread over tasks
HOT_GROUP = 2048  # the same for a whole group; smaller groups are sorted in one task
STRINGS = 10  # strings of a part of a spread region
HOT_CORE = 8192  # parts with one core that are sorted in one task; more are dealt string by string
FIRST, DONE, SPREAD, MARK = 0, 1, 2, 3


def anchor_regions(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of all strings of ``length`` bytes: gram hash, region hash, first and last start of its strings, anchor.

    A string's anchor is its gram of least hash, the leftmost of equals, so equal strings have equal anchors at equal
    places. A region is what the strings of one anchor cover.
    """
    n = len(data)
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    sums = prefix_hashes(data)
    place = np.arange(n - GRAM + 1)
    grams = mix(substring_hashes(sums, place, place + GRAM))
    low = np.uint64((1 << 24) - 1)
    least = (grams & ~low) | place.astype(np.uint64)
    window, step = length - GRAM + 1, 1
    while 2 * step <= window:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < window:
        least = np.minimum(least[: step - window], least[window - step :])
    inside = np.zeros(n + 1, np.int32)
    whole = sizes >= length
    np.add.at(inside, starts[whole], 1)
    np.add.at(inside, starts[whole] + sizes[whole] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
    if not len(start):
        return anchor_regions(data[:0], starts, sizes, length)
    anchor = (least[start] & low).astype(np.int64)
    change = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(start) != 1))
    first, last = start[np.append(0, change + 1)], start[np.append(change, len(start) - 1)]
    anchor = anchor[np.append(0, change + 1)]
    shape = ((last - first) * 256 + (anchor - first)).astype(np.uint64)
    region = mix(mix(substring_hashes(sums, first, last + length)) + mix(shape))
    return grams[anchor], region, first, last, anchor


def spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of a document merged; rows sorted by document and start, ends ascending too."""
    new = np.append(True, (doc[1:] != doc[:-1]) | (start[1:] > end[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], end[last]


def _block_rows(ids: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, offset: int, most: int) -> list[np.ndarray]:
    """Rows (route, gram, region, doc, place) of a block; strings that it repeats are settled at once."""
    gram, region, first, last, anchor = anchor_regions(data, starts, sizes, length)
    if not len(gram):
        return []
    of = np.searchsorted(starts, first, "right") - 1
    doc, low, width, left = ids[of], first - starts[of] + offset, last - first, anchor - first
    order = np.lexsort((low, doc))
    gram, region, doc, low, width, left = (x[order] for x in (gram, region, doc, low, width, left))
    _, once = np.unique(mix(gram) + region, return_index=True)
    fresh = np.zeros(len(gram), bool)
    fresh[once] = True
    rows = []
    if not fresh.all():
        d, s, e = spans(doc[~fresh], low[~fresh], (low + width)[~fresh] + length)
        rows.append((mix(d.view(np.uint64) + mix(s.view(np.uint64))), np.zeros(len(d), np.uint64), e.view(np.uint64), d, s << 16 | DONE))
    gram, region, doc, low, width, left = (x[fresh] for x in (gram, region, doc, low, width, left))
    _, which, count = np.unique(gram, return_inverse=True, return_counts=True)
    hot = count[which] > most
    route = np.where(hot, mix(gram + region), gram)
    rows.append((route, np.where(hot, gram, np.uint64(0)), region, doc, low << 16 | width << 9 | left << 2 | np.where(hot, SPREAD, FIRST)))
    if hot.any():
        marks = np.unique(gram[hot])
        none = np.zeros(len(marks), np.int64)
        rows.append((marks, none.view(np.uint64), none.view(np.uint64), none, none + MARK))
    return [np.concatenate(x) for x in zip(*rows)]


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """(route, gram, region, doc, place) of every text (_id, text); place packs start, widths and kind."""

    most = HOT_IN_BLOCK

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, starts, sizes in text_blocks(batch.column(1)):
                for offset in range(0, max(1, len(data)), 2 * BLOCK_BYTES):
                    if last - first == 1:  # a long text goes in pieces that overlap by all but one byte of a string
                        part = data[offset : offset + 2 * BLOCK_BYTES + length - 1]
                        rows = _block_rows(ids[first:last], part, starts, np.array([len(part)]), length, offset, most)
                    else:
                        rows = [] if offset else _block_rows(ids[first:last], data, starts, sizes, length, 0, most)
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in rows], ["route", "gram", "region", "doc", "place"])

    return texts.mapInArrow(scan, "route long, gram long, region long, doc long, place long")


def settle(rows: DataFrame, length: int) -> DataFrame:
    """(doc, start, end, code, gram): spans found repeated (gram null), and regions whose strings must be compared.

    Rows of one gram and equal regions repeat the first of them. Where all regions of a gram are equal, nothing is left
    to do. Regions of frequent grams are dealt by themselves, so they need no common task.
    """
    kind = F.col("place").bitwiseAND(3)
    same = Window.partitionBy("route", "region").orderBy("doc", "place")
    every = Window.partitionBy("route")
    judged = (
        rows.withColumn("nth", F.row_number().over(same))
        .withColumn("count", F.count("*").over(every))
        .withColumn("marked", F.max(kind == MARK).over(every))
        .withColumn("differ", F.col("marked") | (F.min("region").over(every) != F.max("region").over(every)))
    )
    start = F.shiftright("place", 16)
    width = F.shiftright("place", 9).bitwiseAND(127)
    end = F.when(kind == DONE, F.col("region")).otherwise(start + width + length)
    repeat = (kind == DONE) | (F.col("nth") > 1)
    spread = (kind == SPREAD) | (F.col("count") > HOT_GROUP) | F.col("marked")
    code = F.shiftright("place", 2).bitwiseAND(127) * 2 + spread.cast("long")
    gram = F.when(~repeat, F.when(kind == SPREAD, F.col("gram")).otherwise(F.col("route")))
    wanted = (kind != MARK) & (repeat | F.col("differ") | (kind == SPREAD))
    return judged.filter(wanted).select("doc", start.alias("start"), end.alias("end"), code.cast("int").alias("code"), gram.alias("gram"))


class Suffixes:
    """Strings of ``length`` bytes of a text, compared by the hashes of their prefixes."""

    def __init__(self, data: np.ndarray, place: np.ndarray, length: int):
        self.data, self.place, self.length = data, place, length
        self.sums = prefix_hashes(data)
        self.whole = substring_hashes(self.sums, place, place + length)

    def above(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether string x is above string y, and whether they are equal; their common prefix by binary search."""
        equal = self.whole[x] == self.whole[y]
        i, j = self.place[x], self.place[y]
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length)
        for _ in range(int(self.length).bit_length()):
            mid = (low + high) >> 1
            common = substring_hashes(self.sums, i, i + mid) == substring_hashes(self.sums, j, j + mid)
            low = np.where(common, mid, low)
            high = np.where(common, high, mid)
        return ~equal & (self.data[i + low] > self.data[j + low]), equal

    def sort(self, bounds: np.ndarray) -> np.ndarray:
        """Stable order of the strings inside each segment, by a mergesort whose merges all run at once."""
        n = int(bounds[-1])
        order = np.arange(n)
        sizes = np.diff(bounds)
        begin, end = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
        width = 1
        longest = int(sizes.max(initial=0))
        while width < longest:
            k = np.flatnonzero(end - begin > width)
            run = begin[k] + (k - begin[k]) // (2 * width) * (2 * width)
            left = k < run + width
            low = np.where(left, np.minimum(run + width, end[k]), run)
            high = np.minimum(np.where(left, run + 2 * width, run + width), end[k])
            first = low.copy()
            for _ in range(int(width).bit_length() + 1):
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                above, equal = self.above(order[k[open_]], order[mid])
                right = above | (equal & ~left[open_])
                low[open_] = np.where(right, mid + 1, low[open_])
                high[open_] = np.where(right, high[open_], mid)
            moved = order.copy()
            moved[np.where(left, k, k - width) + (low - first)] = order[k]
            order = moved
            width *= 2
        return order

    def repeats(self, bounds: np.ndarray) -> np.ndarray:
        """Whether each string equals an earlier one of its segment; equal hashes are confirmed byte by byte."""
        order = self.sort(bounds)
        segment = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        alike = np.append(False, (self.whole[order[1:]] == self.whole[order[:-1]]) & (segment[1:] == segment[:-1]))
        view = np.lib.stride_tricks.sliding_window_view(self.data, self.length)
        later = np.flatnonzero(alike)
        for low in range(0, len(later), 1 << 14):
            at = later[low : low + (1 << 14)]
            alike[at] = (view[self.place[order[at]]] == view[self.place[order[at - 1]]]).all(axis=1)
        found = np.zeros(len(order), bool)
        found[order] = alike
        for at in later[~alike[later]]:  # two strings share a hash: compare this one with all that do
            same = np.flatnonzero((self.whole == self.whole[order[at]]) & (segment == segment[at]) & (np.arange(len(order)) < order[at]))
            found[order[at]] = (view[self.place[same]] == view[self.place[order[at]]]).all(axis=1).any()
        return found


def repeated_strings(data: np.ndarray, sizes: np.ndarray, gram: np.ndarray, left: np.ndarray, doc: np.ndarray, low: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Spans (doc, start, end) of the strings of regions that repeat one of an earlier region of the same gram."""
    count = sizes - length + 1
    owner = np.repeat(np.arange(len(sizes)), count)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    place = (np.cumsum(sizes) - sizes)[owner] + inner
    start = low[owner] + inner
    ahead = left[owner] - inner
    order = np.lexsort((start, doc[owner], ahead, gram[owner]))
    change = (np.diff(gram[owner[order]]) != 0) | (np.diff(ahead[order]) != 0)
    bounds = np.concatenate([[0], np.flatnonzero(change) + 1, [len(order)]])
    found = np.zeros(len(order), bool)
    found[order] = Suffixes(data, place[order], length).repeats(bounds)
    hit = np.flatnonzero(found)
    if not len(hit):
        return doc[:0], low[:0], low[:0]
    new = np.append(True, (owner[hit[1:]] != owner[hit[:-1]]) | (hit[1:] - hit[:-1] != 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hit)) - 1
    return doc[owner[hit[first]]], start[hit[first]], start[hit[last]] + length


def sorted_spans(regions: DataFrame, length: int) -> DataFrame:
    """(doc, start, end) from regions (gram, left, doc, low, bytes) of grams with few regions."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle_rows(rows: pa.Table) -> pa.RecordBatch:
            data = rows["bytes"].combine_chunks()
            parts = list(text_blocks(data, 1 << 40))
            gram, left, doc, low = (rows[c].to_numpy() for c in ("gram", "left", "doc", "low"))
            found = repeated_strings(parts[0][2], parts[0][4], gram, left, doc, low, length)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["doc", "start", "end"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            gram = held["gram"].to_numpy()
            cut = np.flatnonzero(np.diff(gram)) + 1  # complete groups
            while len(cut):
                take = int(cut[np.searchsorted(cut, 1024, "left").clip(0, len(cut) - 1)])
                yield settle_rows(held.slice(0, take))
                held = held.slice(take)
                cut = cut[cut > take] - take
        if held is not None and len(held):
            yield settle_rows(held)

    return regions.repartition("gram").sortWithinPartitions("gram").mapInArrow(sort, "doc long, start long, end long")


def cored(regions: DataFrame, length: int) -> DataFrame:
    """Regions of frequent grams in parts of few strings, named anew by what all strings of a part have in common.

    Strings that are equal have equal cores, so a frequent gram falls apart into as many groups as it has cores. Parts
    whose core occurs once are left out; ``count`` tells how often the others' does.
    """
    i = lambda c: F.col("left") - c * STRINGS  # noqa: E731  the last string of part c
    first = lambda c: F.greatest(F.lit(0).cast("long"), i(c) - (STRINGS - 1))
    last = lambda c: F.least(F.length("bytes") - length, i(c))
    cut = lambda start, size: F.col("bytes").substr((start + 1).cast("int"), size.cast("int"))
    part = lambda c: F.struct(
        F.xxhash64("gram", c, cut(i(c), F.lit(length - STRINGS + 1))).alias("gram"),
        (F.col("left") - first(c)).alias("left"),
        "doc",
        (F.col("low") + first(c)).alias("low"),
        cut(first(c), last(c) - first(c) + length).alias("bytes"),
    )
    parts = F.sequence(F.floor((F.col("left") - (F.length("bytes") - length)) / STRINGS), F.floor(F.col("left") / STRINGS))
    dealt = regions.select(F.explode(F.transform(parts, part)).alias("p")).select("p.*")
    counts = dealt.groupBy("gram").agg(F.count("*").alias("count")).filter("count > 1")
    return dealt.join(counts, "gram")


def spread_spans(regions: DataFrame, length: int) -> DataFrame:
    """(doc, start, end) for cores that are frequent too: the first of equal strings is found with a partial minimum."""
    inner = F.sequence(F.lit(0), F.length("bytes") - length)
    key = lambda i: F.unhex(F.md5(F.col("bytes").substr(i + F.lit(1), F.lit(length))))
    each = regions.select("doc", F.explode(F.transform(inner, lambda i: F.struct((F.col("low") + i).alias("start"), key(i).alias("key")))).alias("s"))
    strings = each.select("s.key", F.struct("doc", "s.start").alias("at"))
    firsts = strings.groupBy("key").agg(F.min("at").alias("first"), F.count("*").alias("c")).filter("c > 1").select("key", "first")
    later = strings.join(firsts, "key").filter("at > first")
    return later.select("at.doc", "at.start", (F.col("at.start") + length).alias("end"))


def _cut(batches: Iterator[pa.RecordBatch], whole_characters: bool) -> Iterator[pa.RecordBatch]:
    """(_id, data, spans) to (_id, n_bytes, spans, kept): spans merged and cut out of the bytes."""
    for batch in batches:
        for first, last, data, starts, sizes in text_blocks(batch.column(1)):
            spans_ = batch.column(2).slice(first, last - first)
            flat, counts = spans_.flatten(), np.asarray(spans_.value_lengths().fill_null(0))
            doc = np.repeat(np.arange(last - first), counts)
            low, high = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            order = np.lexsort((low, doc))
            doc, low, high = doc[order], low[order], high[order]
            if len(doc):
                reach = doc * (1 << 40) + high  # the running maximum starts anew with each document
                high = np.maximum.accumulate(reach) - doc * (1 << 40)
                doc, low, high = spans(doc, low, high)
            gone = np.zeros(len(data) + 1, np.int32)
            np.add.at(gone, starts[doc] + low, 1)
            np.add.at(gone, starts[doc] + high, -1)
            stay = np.cumsum(gone)[:-1] == 0
            if whole_characters and not stay.all():
                lead = np.flatnonzero((data & 0xC0) != 0x80)
                stay = np.repeat(np.logical_and.reduceat(stay, lead), np.diff(lead, append=len(data)))
            left = np.concatenate([[0], np.cumsum(stay)])
            kept = left[starts + sizes] - left[starts]
            bounds = np.append(0, np.cumsum(kept))
            content = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(kept), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[stay].tobytes())])
            per = np.append(0, np.cumsum(np.bincount(doc, minlength=len(kept)))).astype(np.int32)
            runs = pa.ListArray.from_arrays(pa.array(per), pa.StructArray.from_arrays([pa.array(low), pa.array(high)], ["start", "end"]))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(sizes), runs, content.cast(pa.binary())], ["_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = 100, whole_characters: bool = False) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): each text's UTF-8 bytes without those in a string that occurs earlier.

    A string of ``length`` bytes occurs earlier if an equal one starts in a document of smaller doc_id, or in the same
    document before it. ``spans`` are the maximal removed runs as [start, end), ``kept`` the other bytes in order. Null
    texts are empty. With ``whole_characters``, ``kept`` also lacks the rest of a character that a span cuts, and is
    valid UTF-8. Texts shorter than ``length`` stay whole. Rows with a null doc_id come first, rows of one doc_id
    in the order of their texts; equal rows count as one and have the same result. Other columns are ignored.

    Every string has an anchor chosen by its content, so equal strings meet by their anchors' hashes. What is equal
    around an anchor is settled by one window over compact rows; only regions that differ are fetched, and their
    strings go through a mergesort that compares by prefix hashes and binary search. Texts are shuffled once, by id.
    """
    if not GRAM < length <= GRAM + 68:
        raise ValueError(f"length must lie between {GRAM + 1} and {GRAM + 68}")
    docs, names = numbered(docs, "text")
    # The filter, always true, makes both joins below read one exchange: an inner join would add it on its own.
    texts = docs.select(F.col("_id").alias("doc"), utf8("text").alias("data")).filter(F.col("doc").isNotNull())
    found = settle(anchors(docs.select("_id", "text"), length), length)
    items = found.groupBy("doc").agg(F.collect_list(F.struct("start", "end", "code", "gram")).alias("items"))
    open_ = F.filter("items", lambda x: x["gram"].isNotNull())
    piece = lambda x: F.col("data").substr((x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))
    region = lambda x: F.struct(x["gram"].alias("gram"), x["code"].alias("code"), x["start"].alias("low"), piece(x).alias("bytes"))
    regions = texts.join(items, "doc").select("doc", F.explode(F.transform(open_, region)).alias("r"))
    regions = regions.select("r.gram", F.shiftright("r.code", 1).cast("long").alias("left"), "doc", "r.low", "r.bytes", (F.col("r.code") % 2 == 1).alias("spread"))
    parts = cored(regions.filter("spread"), length)
    few = regions.filter("not spread").drop("spread").union(parts.filter(F.col("count") <= HOT_CORE).drop("count"))
    more = sorted_spans(few, length).union(spread_spans(parts.filter(F.col("count") > HOT_CORE), length))
    more = more.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("more"))
    settled = F.transform(F.filter("items", lambda x: x["gram"].isNull()), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    none = F.array().cast("array<struct<start:long,end:long>>")
    every = F.concat(F.coalesce(settled, none), F.coalesce("more", none)).alias("spans")
    whole = texts.join(items, "doc", "left").join(more, "doc", "left").select(F.col("doc").alias("_id"), "data", every)
    cut = whole.mapInArrow(lambda batches: _cut(batches, whole_characters), "_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return named(cut, names)
