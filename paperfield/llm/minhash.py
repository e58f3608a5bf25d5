"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperfield.llm.common import mix, prefix_hashes, substring_hashes, text_blocks
from paperfield.llm.components import components
from paperfield.session import materialize

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
PROBES = 2048


@dataclass(frozen=True)
class NearDuplicates:
    """Settings. Documents are linked if ``percent`` % of their joint shingles of ``shingle`` words are common.

    ``bands`` x ``rows`` minima are compared; with 24 x 5 a pair of similarity 0.85 shares no band once in a million
    times, one of 0.8 once in 15,000. Documents of a candidate group are confirmed in tiles of at most
    ``tile_documents`` documents and about ``tile_shingles`` shingles, which bound the memory of a task.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 24
    rows: int = 5
    tile_documents: int = 1024
    tile_shingles: int = 1 << 20


def shingle_sets(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text; shorter texts are one shingle, without words none."""
    if not len(data):
        return [np.zeros(0, np.uint64)] * len(starts)
    data = LOWER[data]
    gap = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    edge[-1] = True
    begin = np.flatnonzero(~gap & (np.concatenate([[True], gap[:-1]]) | edge[:-1]))
    end = np.flatnonzero(~gap & (np.concatenate([gap[1:], [True]]) | edge[1:])) + 1
    words = mix(substring_hashes(prefix_hashes(data), begin, end) + (end - begin).astype(np.uint64))
    bounds = np.searchsorted(begin, np.append(starts, len(data)))
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    count = len(words) - width + 1
    runs = np.zeros(0, np.uint64)
    if count > 0:
        runs = words[:count] * factors[0]
        for i in range(1, width):
            runs = runs + words[i : i + count] * factors[i]
        runs = mix(runs)
    found = []
    for first, last in zip(bounds[:-1], bounds[1:]):
        n = last - first
        if n >= width:
            found.append(np.unique(runs[first : last - width + 1]))
        elif n:
            found.append(mix((words[first:last] * factors[:n]).sum(keepdims=True) + np.uint64(n)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def probe_table(bins: int) -> np.ndarray:
    """For each bin the bins that it asks, one after the other, to lend their minimum."""
    cells = np.arange(bins * PROBES, dtype=np.uint64).reshape(bins, PROBES)
    return (mix(cells + np.uint64(77)) % np.uint64(bins)).astype(np.int32)


def signature(shingles: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """Minimum of each bin of one permutation; empty bins borrow by optimal densification. ``shingles`` is sorted."""
    bins = len(probes)
    of = ((shingles >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(of, prepend=-1))
    source = np.full(bins, -1, np.int64)
    source[of[first]] = first
    empty = np.flatnonzero(source < 0)
    if len(empty):
        full = source >= 0
        lender = source.copy()
        step = 64
        for at in range(0, PROBES, step):
            asked = probes[empty, at : at + step]
            hit = full[asked]
            some = hit.any(axis=1)
            lender[empty[some]] = source[asked[some, hit[some].argmax(axis=1)]]
            empty = empty[~some]
            if not len(empty):
                break
        if len(empty):
            filled = np.flatnonzero(full)
            lender[empty] = source[filled[probes[empty, 0] % len(filled)]]
        source = lender
    return shingles[source]


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    factors = mix(np.arange(11, 11 + rows, dtype=np.uint64)) | np.uint64(1)
    return mix((minima.reshape(bands, rows) * factors).sum(axis=1) + mix(np.arange(bands, dtype=np.uint64)))


def sketches(docs: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(doc_id, n_shingles, set_id, bands): the size and digest of each document's set and its bucket keys."""
    width, bands, rows = settings.shingle, settings.bands, settings.rows

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = probe_table(bands * rows)
        none = np.zeros(bands, np.uint64)
        for batch in batches:
            counts, names, keys = [], [], []
            for _, _, data, starts, sizes in text_blocks(batch.column(1)):
                for found in shingle_sets(data, starts, sizes, width):
                    counts.append(len(found))
                    names.append(md5(found.tobytes()).digest())
                    keys.append(band_keys(signature(found, probes), bands, rows) if len(found) else none)
            values = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            places = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.binary()), pa.ListArray.from_arrays(places, pa.array(values))],
                ["doc_id", "n_shingles", "set_id", "bands"],
            )

    return docs.mapInArrow(sketch, "doc_id long, n_shingles long, set_id binary, bands array<long>")


def _candidates(reps: DataFrame) -> DataFrame:
    """(hub, doc_id): each document with the smallest one of every bucket that it shares."""
    rows = reps.select("doc_id", F.explode("bands").alias("key"))
    hubs = rows.groupBy("key").agg(F.min("doc_id").alias("hub"), F.count("*").alias("c")).filter("c > 1").select("key", "hub")
    return rows.join(hubs, "key").filter("doc_id <> hub").select("hub", "doc_id").distinct()


def _tiles(stars: DataFrame, sizes: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(doc_id, hub, a, b): the pairs of tiles of each hub's group in which the document takes part.

    Every two documents of a group meet in one pair of tiles. Groups that fit into one tile are one task's.
    """
    hubs = stars.select("hub").distinct()
    members = stars.union(hubs.select("hub", F.col("hub").alias("doc_id")))
    weighed = members.join(sizes, "doc_id").groupBy("hub").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("s"))
    tiles = F.ceil(F.greatest(F.col("c") / settings.tile_documents, F.col("s") / settings.tile_shingles)).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    dealt = members.join(weighed.select("hub", tiles.alias("tiles")), "hub").select("doc_id", "hub", own.alias("own"), other)
    return dealt.select("doc_id", "hub", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))


def linked_groups(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the first one that it reaches over links, from the exact size of every intersection."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    common = np.zeros((n, n), np.float32)
    if n == 2:
        common[0, 1] = common[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
    else:
        values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        column = np.cumsum(count > 1) - 1
        owner = np.repeat(np.arange(n), sizes)
        shared = count[place] > 1
        owner, place = owner[shared], column[place[shared]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        step = max(1, (1 << 21) // n)
        for low in range(0, int(place[-1]) + 1 if len(place) else 0, step):
            i, j = np.searchsorted(place, [low, low + step])
            part = np.zeros((n, step), np.float32)
            part[owner[i:j], place[i:j] - low] = 1
            common += part @ part.T
    common = common.astype(np.int64)
    link = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    label = np.full(n, -1)
    for i in range(n):
        if label[i] < 0:
            reached = link[i].copy()
            reached[i] = True
            front = reached
            while front.any():
                front = link[front].any(axis=0) & ~reached
                reached |= front
            label[reached] = i
    return label


def links(docs: DataFrame, reps: DataFrame, settings: NearDuplicates) -> DataFrame:
    """(a, b): links that connect what the confirmed pairs of candidates connect, at most one per document and task."""
    width, percent = settings.shingle, settings.percent
    stars = materialize(_candidates(reps.select("doc_id", "bands")), "stars")
    tiles = _tiles(stars, reps.select("doc_id", "n_shingles"), settings)
    wanted = tiles.groupBy("doc_id").agg(F.collect_list(F.struct("hub", "a", "b")).alias("groups"))

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts, sizes in text_blocks(batch.column(1)):
                found = [s.tobytes() for s in shingle_sets(data, starts, sizes, width)]
                rest = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([rest.column(0), rest.column(2), pa.array(found, pa.binary())], ["doc_id", "groups", "shingles"])

    def confirm(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["doc_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        label = linked_groups([np.frombuffer(group["shingles"].iloc[i], np.uint64) for i in order], percent)
        moved = label != np.arange(len(ids))
        return pd.DataFrame({"a": ids[moved], "b": ids[label[moved]]})

    texts = docs.join(wanted, "doc_id").select("doc_id", "text", "groups")
    sets = texts.mapInArrow(shingles, "doc_id long, groups array<struct<hub:long,a:int,b:int>>, shingles binary")
    dealt = sets.select("doc_id", "shingles", F.explode("groups").alias("g")).select("doc_id", "shingles", "g.*")
    return dealt.groupBy("hub", "a", "b").applyInPandas(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, settings: NearDuplicates = NearDuplicates()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of ``docs`` (doc_id, text).

    Words are runs of other bytes than ASCII white space, A-Z in lower case; a text of fewer words than a shingle has
    one shingle of them all. Null, empty and blank texts have none and are linked with nothing. Documents with equal
    sets are linked as one; the smallest stands for them in the search. Buckets only join a document to their smallest
    one (a star), so candidate rows grow with documents times bands; within a star's group every pair is compared
    exactly inside a task, and only the links that connect groups leave it. Rows that share a doc_id are one node of
    the graph. A null doc_id is smaller than none: such a row takes its equals' component, or null, and is kept if that
    is null. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = materialize(sketches(docs, settings), "sketches")
    full = found.filter("n_shingles > 0")
    classes = full.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    chosen = classes.select(F.col("rep").alias("doc_id"), F.col("set_id").alias("own"))
    reps = full.join(chosen, "doc_id").filter("set_id = own").dropDuplicates(["doc_id", "set_id"])  # by id, as a set may be that of many
    labels = components(links(docs, reps, settings))
    named = found.select("doc_id", "n_shingles", "set_id").join(classes, "set_id", "left").join(labels, F.col("rep") == F.col("node"), "left")
    smallest = F.coalesce("component", "rep", "doc_id")
    return named.select("doc_id", "n_shingles", smallest.alias("component_id"), smallest.eqNullSafe(F.col("doc_id")).alias("kept"))
