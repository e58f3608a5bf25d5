"""Helpers of the text operators: byte blocks of Arrow batches, vectorised hashing, row numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperfield.session import materialize

BLOCK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BYTE_CODES = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n, kept per process."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, BLOCK_BYTES + 4096), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit words."""
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hash of every prefix; one longer than the data."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * powers(BASE, len(data) + 1)[: len(data)], out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] from the prefix hashes, independent of its place."""
    return (sums[end] - sums[start]) * powers(BASE_INVERSE, len(sums) + 1)[start]


def text_column(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a string or binary array without copies, and the start and length of each value (null: empty)."""
    array = array.cast(pa.large_binary())
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    lengths = np.diff(bounds)
    if array.null_count:
        lengths = np.where(np.asarray(array.is_null()), 0, lengths)
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return content, bounds[:-1], lengths


def text_blocks(array: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows [first, last) in blocks of about ``limit`` bytes: first, last, their bytes, and the starts and lengths in them.

    A value longer than the limit is a block of its own.
    """
    content, starts, lengths = text_column(array)
    total = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + limit, "right")))
        size = lengths[first:last]
        inner = np.cumsum(size) - size
        begin = starts[first]
        if (starts[first:last] - begin == inner).all():
            data = content[begin : begin + int(size.sum())]
        else:  # bytes of nulls lie between the values
            data = np.concatenate([content[s : s + n] for s, n in zip(starts[first:last], size)] or [content[:0]])
        yield first, last, data, inner, size
        first = last


def utf8(column: str) -> Column:
    return F.encode(F.coalesce(F.col(column), F.lit("")), "UTF-8")


DRAWS = 1 << 62


def draw(*columns: str) -> Column:
    """A number below ``DRAWS`` fixed by the columns: fine enough to take a given number of any number of rows."""
    hashed = F.xxhash64(F.lit("sample"), *columns)
    return F.pmod(hashed, F.lit(1 << 20)) * F.lit(1 << 42) + F.pmod(F.shiftright(hashed, 20), F.lit(1 << 42))


def drawn(sample: int, rows: int) -> int:
    """Below which draw about ``sample`` of ``rows`` rows lie."""
    return min(DRAWS, sample * DRAWS // rows)


def numbered(docs: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame | None]:
    """(_id, *columns) with a unique ``_id`` in the order of (doc_id, columns), null first, and the names of the ids.

    Where doc_id is unique and never null, ``_id`` is doc_id and there are no names. Else equal rows become one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)
    twice = docs.groupBy("doc_id").count().filter((F.col("count") > 1) | F.col("doc_id").isNull())
    if twice.isEmpty():
        return docs.withColumnRenamed("doc_id", "_id"), None
    one = docs.groupBy(*docs.columns).agg(F.count("*").cast("int").alias("_n"))
    rows = materialize(one.orderBy("doc_id", *columns).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    return rows.select("_id", *columns), rows.select("_id", "doc_id", "_n")


def named(result: DataFrame, names: DataFrame | None) -> DataFrame:
    """The result of :func:`numbered` rows with doc_id in place of ``_id``, as often as the row occurred."""
    if names is None:
        return result.withColumnRenamed("_id", "doc_id")
    again = result.join(names, "_id").withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return again.select("doc_id", *[c for c in result.columns if c != "_id"])
