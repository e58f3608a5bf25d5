"""How the word use of sources differs: terms kept by iceberg prefix refinement, exact divergences between sources."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperfield.llm.common import mix, text_column
from paperfield.session import materialize

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
GAP = re.compile(rb"[^A-Za-z\x80-\xff]")
END = b" "  # ends each term; no term has it
PIECE = 1 << 20
BLOCK = 1 << 22  # bytes of terms that a task groups at once
SCALE = 1_000_000_000


@dataclass(frozen=True)
class Audit:
    """``documents``: in how many documents of a language a kept term occurs; ``first``: bytes of the first prefixes,
    doubled at each level; ``filter_bits``: size of the bit filter of surviving prefixes that every task gets (false
    positives cost work, not results); ``top``: ranks of terms that are returned."""

    documents: int = 3
    first: int = 4
    filter_bits: int = 1 << 23
    top: int = 200


def _count(text: bytes) -> Counter:
    """Terms of a text, A-Z lowered; a long text is taken in pieces that end between terms."""
    found: Counter = Counter()
    start = 0
    while start < len(text):
        gap = GAP.search(text, start + PIECE) if len(text) > start + PIECE else None
        end = gap.end() if gap else len(text)
        found.update(TERM.findall(text[start:end].lower()))
        start = end
    return found


def document_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, terms, counts) a document: its distinct terms, a blank behind each, and how often each occurs. Null is ''."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, terms, counts, size = 0, [], [], 0

            def rows() -> pa.RecordBatch:
                kept = [c.slice(first, len(terms)) for c in batch.columns[:2]]
                ends = np.cumsum([0, *map(len, counts)])
                numbers = pa.array(np.fromiter(chain.from_iterable(counts), np.int32, ends[-1]))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), numbers)
                return pa.RecordBatch.from_arrays([*kept, pa.array(terms, pa.binary()), lists], ["lang", "source", "terms", "counts"])

            for text in batch.column(2).cast(pa.large_binary()):
                found = _count(text.as_py() or b"")
                terms.append(END.join(found) + END if found else b"")
                counts.append(list(found.values()))
                size += len(terms[-1])
                if size > PIECE:
                    yield rows()
                    first, terms, counts, size = first + len(terms), [], [], 0
            if terms:
                yield rows()

    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*texts).mapInArrow(split, "lang string, source string, terms binary, counts array<int>")


class _Spans:
    """Stretches of a block of bytes, compared and hashed eight bytes at a time."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.data, self.start, self.size = data, start, size
        self.words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))

    def take(self, chosen: np.ndarray) -> _Spans:
        return _Spans(self.data, self.start[chosen], self.size[chosen])

    def prefix(self, size: int) -> _Spans:
        return _Spans(self.data, self.start, np.minimum(self.size, size))

    def word(self, at: int, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Bytes ``at`` to ``at`` + 8 of the spans, zero behind their end."""
        left = np.clip(self.size[rows] - at, 0, 8)
        start = np.minimum(self.start[rows] + at, len(self.words) - 1)
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> np.where(left, 64 - 8 * left, 0).astype(np.uint64)
        return np.where(left > 0, self.words[start] & mask, np.uint64(0))

    def hashes(self) -> np.ndarray:
        """Equal for equal spans; no span has a zero byte, so up to eight bytes also differ for different ones."""
        found = self.word(0)
        rest = np.flatnonzero(self.size > 8)
        at = 8
        while len(rest):
            found[rest] = mix(found[rest] + np.uint64(at)) ^ self.word(at, rest)
            at += 8
            rest = rest[self.size[rest] > at]
        return found

    def differ(self, one: np.ndarray, other: np.ndarray) -> bool:
        """Whether any of the spans ``one`` differs from that of ``other`` in the same place."""
        if (self.size[one] != self.size[other]).any():
            return True
        at = 8
        while len(one):
            long = self.size[one] > at
            one, other = one[long], other[long]
            if (self.word(at, one) != self.word(at, other)).any():
                return True
            at += 8
        return False

    def values(self) -> pa.Array:
        ends = np.cumsum(self.size, dtype=np.int64)
        places = np.repeat(self.start - ends + self.size, self.size) + np.arange(ends[-1] if len(ends) else 0)
        offsets = np.append(0, ends).astype(np.int64)
        found = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[places])])
        return found.cast(pa.binary())


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, _Spans]]:
    """Rows [first, last) of a batch in blocks of about ``BLOCK`` bytes: the row of each term, and the terms with their ends."""
    content, starts, lengths = text_column(batch.column(column))
    total = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + BLOCK, "right")))
        begin, size = starts[first], lengths[first:last]
        data = np.concatenate([content[begin : begin + size.sum()], np.zeros(8, np.uint8)])
        ends = (np.flatnonzero(data[:-8] == END[0]) + 1).astype(np.int32)
        spans = _Spans(data, np.append(np.int32(0), ends)[: len(ends)], np.diff(ends, prepend=np.int32(0)))
        held = np.diff(np.searchsorted(ends, np.cumsum(size), "right"), prepend=0)  # terms of each row
        yield first, last, np.repeat(np.arange(first, last, dtype=np.int32), held), spans
        first = last


def _groups(code: np.ndarray, spans: _Spans) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal (code, span) together, and where in it each group begins. ``code`` is below 2^16."""
    hashes = spans.hashes()
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(code[order].astype(np.uint16), kind="stable")]
    new = np.append(True, (np.diff(hashes[order]) != 0) | (np.diff(code[order]) != 0))[: len(order)]
    first = np.flatnonzero(new)
    same = order[np.flatnonzero(~new)]
    if spans.differ(same, order[np.flatnonzero(~new) - 1]):  # two spans of one hash: sort the bytes themselves
        keys = list(zip(code.tolist(), spans.values().to_pylist()))
        order = np.array(sorted(range(len(keys)), key=lambda i: keys[i]), np.int64)
        first = np.array([n for n, i in enumerate(order) if n == 0 or keys[i] != keys[order[n - 1]]], np.int64)
    return order, first


def _language_hashes(lang: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code of each row's language, and a hash of each code's language."""
    coded = lang.dictionary_encode()
    values = pa.array([(v + "\1").encode() for v in coded.dictionary.to_pylist()], pa.binary())
    content, starts, sizes = text_column(values)
    return np.asarray(coded.indices), mix(_Spans(np.concatenate([content, np.zeros(8, np.uint8)]), starts, sizes).hashes())


def _in_filter(bits: np.ndarray, seeds: np.ndarray, spans: _Spans) -> np.ndarray:
    at = mix(spans.hashes() ^ seeds) % np.uint64(8 * len(bits))
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bit_filter(kept: DataFrame, bits: int) -> np.ndarray:
    """A bit for every row (lang, prefix); at most ``bits`` / 8 bytes of bits reach the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, starts, sizes = text_column(batch.column(1))
            spans = _Spans(np.concatenate([content, np.zeros(8, np.uint8)]), starts, sizes)
            code, seeds = _language_hashes(batch.column(0))
            at = (mix(spans.hashes() ^ seeds[code]) % np.uint64(bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], ["word", "bit"])

    words = kept.select("lang", "prefix").mapInArrow(places, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("set")).toArrow()
    found = np.zeros(bits // 32, np.uint32)
    found[words["word"].to_numpy()] = words["set"].to_numpy()
    return found.view(np.uint8)


def _level(terms: DataFrame, done: int, length: int, survivors: np.ndarray | None) -> DataFrame:
    """(lang, prefix, n): partial document counts of prefixes of ``length`` bytes of terms, their end being a byte too.

    Only terms not complete within ``done`` bytes, whose prefix of that length is in the filter, are extended.
    """

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, seeds = _language_hashes(batch.column(0))
            names = pa.array(batch.column(0).dictionary_encode().dictionary)
            for _, _, row, spans in _blocks(batch, 1):
                if survivors is not None:
                    open_ = np.flatnonzero(spans.size > done)
                    row, spans = row[open_], spans.take(open_)
                    passed = np.flatnonzero(_in_filter(survivors, seeds[code[row]], spans.prefix(done)))
                    row, spans = row[passed], spans.take(passed)
                if not len(row):
                    continue
                spans = spans.prefix(length)
                order, first = _groups(code[row], spans)
                documents = np.append(True, np.diff(row[order]) != 0)
                documents[first] = True
                counts = np.add.reduceat(documents.astype(np.int64), first)
                heads = order[first]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(code[row[heads]])), spans.take(heads).values(), pa.array(counts)], ["lang", "prefix", "n"])

    return terms.select("lang", "terms").mapInArrow(extend, "lang string, prefix binary, n long")


def kept_terms(terms: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """(lang, term, documents) of the terms in at least ``audit.documents`` documents of a language.

    Prefixes are counted level by level, each twice as long. A prefix in too few documents is dropped with all that
    begins with it; a term is complete once its end is within the prefix. Each document lies in one task, so its
    distinct prefixes add up without their documents being shuffled.
    """
    done, length, survivors, complete = 0, audit.first, None, []
    ended = F.substring("prefix", -1, 1) == F.lit(END)
    while True:
        counts = _level(terms, done, length, survivors).groupBy("lang", "prefix").agg(F.sum("n").alias("documents"))
        kept = materialize(counts.filter(F.col("documents") >= audit.documents).withColumn("ended", ended), "prefixes")
        complete.append(kept.filter("ended"))
        open_ones = kept.filter(~F.col("ended"))
        if open_ones.isEmpty():
            break
        survivors = bit_filter(open_ones, audit.filter_bits)
        done, length = length, 2 * length
    found = complete[0]
    for more in complete[1:]:
        found = found.unionByName(more)
    return found.select("lang", F.expr("substring(prefix, 1, length(prefix) - 1)").alias("term"), "documents")


def term_counts(terms: DataFrame, kept: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """(lang, source, term, count) of kept terms where they occur."""
    bits = bit_filter(kept.select("lang", F.concat("term", F.lit(END)).alias("prefix")), audit.filter_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, seeds = _language_hashes(batch.column(0))
            source = np.asarray(batch.column(1).dictionary_encode().indices)
            pairs, group = np.unique(code.astype(np.int64) << 32 | source, return_inverse=True)
            names = [batch.column(i).dictionary_encode().dictionary for i in (0, 1)]
            numbers = batch.column(3)
            sizes = np.asarray(numbers.value_lengths(), np.int64)
            flat, before = np.asarray(numbers.flatten(), np.int64), np.append(0, np.cumsum(sizes))
            for first_row, last_row, row, spans in _blocks(batch, 2):
                here = flat[before[first_row] : before[last_row]]
                passed = np.flatnonzero(_in_filter(bits, seeds[code[row]], spans))
                row, spans, here = row[passed], spans.take(passed), here[passed]
                if not len(row):
                    continue
                order, first = _groups(group[row], spans)
                sums = np.add.reduceat(here[order], first)
                heads = order[first]
                used = pairs[group[row[heads]]]
                terms_ = spans.take(heads)
                terms_.size = terms_.size - 1
                columns = [names[0].take(pa.array(used >> 32)), names[1].take(pa.array(used & (1 << 32) - 1)), terms_.values(), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n"])

    partial = terms.mapInArrow(count, "lang string, source string, term binary, n long")
    counts = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("count"))
    return counts.join(kept.select("lang", "term"), ["lang", "term"], "left_semi")


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kept)); null where no term is kept."""
    wide = [c.cast("decimal(19,0)") for c in (count, total, kept)]
    above = F.lit(SCALE).cast("decimal(10,0)") * (wide[0] + 1)
    return 1 + F.call_function("div", above, F.nullif(wide[1] + wide[2], F.lit(0)))


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def source_divergence(docs: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) of the documents.

    Shares are smoothed counts of the language's kept terms, in billionths. Part ``pair``: each other source of the
    language and the sum over all kept terms of the squared difference of shares over the other's share. Part ``term``:
    the ``audit.top`` terms that the source uses more than the language, by the same measure against the language.

    A row is a document, whatever its doc_id (not read); equal rows count again. Null text, lang and source are ''. Groups
    and languages without kept terms have value 0 for their pairs and no terms. Terms of any length are counted; a very
    long text is split in pieces and needs memory for its distinct terms. Ties are ranked by item. Other columns are
    not read; an empty table has no rows.
    """
    terms = materialize(document_terms(docs), "terms")
    kept = materialize(kept_terms(terms, audit), "kept")
    counts = materialize(term_counts(terms, kept, audit), "counts")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count("*").alias("used"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    groups = terms.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.select("lang", "source", zero("n"), zero("used"), zero("v"))
    groups = materialize(groups.withColumn("p0", _share(F.lit(0), F.col("n"), F.col("v"))), "groups")
    shares = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", "count", "p0", _share(F.col("count"), F.col("n"), F.col("v")).alias("p"))
    shares = materialize(shares, "shares")

    pairs = _pairs(groups, shares).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))

    overall = counts.groupBy("lang", "term").agg(F.sum("count").alias("count"))
    whole = materialize(counts.groupBy("lang").agg(F.sum("count").alias("n")).join(sizes, "lang"), "languages")
    expected = overall.join(whole, "lang").select("lang", "term", _share(F.col("count"), F.col("n"), F.col("v")).alias("q"))
    over = shares.join(expected, ["lang", "term"]).filter("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    over = over.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= audit.top)
    parts = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for rows, part in ((pairs, "pair"), (over, "term"))]
    return parts[0].unionByName(parts[1])


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, source, item, value) of each source against each other one of its language.

    Terms that neither source has add the same amount each, and those that one has depend on its count only, so they are
    taken from numbers of terms by count. Only terms that both have are joined; what the other parts said of them
    is taken back.
    """
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("used").alias("used_there"))
    both = groups.join(other, "lang").filter("source <> item")
    neither = (F.col("v") - F.col("used") - F.col("used_there")) * F.coalesce(_gap(F.col("p0"), F.col("q0")), F.lit(0))
    none = both.select("lang", "source", "item", neither.alias("value"))

    numbers = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("terms"))
    one = numbers.join(other, "lang").filter("source <> item")
    here = one.select("lang", "source", "item", (F.col("terms") * _gap(F.col("p"), F.col("q0"))).alias("value"))
    there = one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("terms") * _gap(F.col("q0"), F.col("p"))).alias("value"))

    met = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    common = shares.join(met, ["lang", "term"]).filter("source < item")
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    forth = (_gap(p, q) - _gap(p, q0) - _gap(p0, q) + _gap(p0, q0)).alias("forth")
    back = (_gap(q, p) - _gap(q, p0) - _gap(q0, p) + _gap(q0, p0)).alias("back")
    sums = common.select("lang", "source", "item", forth, back).groupBy("lang", "source", "item").agg(_total("forth").alias("forth"), _total("back").alias("back"))
    sums = materialize(sums, "common")

    parts = none.select("lang", "source", "item", F.col("value").cast("decimal(38,0)").alias("value"))
    for rows in (here, there):
        parts = parts.unionByName(rows.groupBy("lang", "source", "item").agg(_total("value").alias("value")))
    parts = parts.unionByName(sums.select("lang", "source", "item", F.col("forth").alias("value")))
    parts = parts.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def _total(column: str) -> Column:
    """Exact sum of 64-bit numbers from two sums of 32-bit halves, which cannot overflow."""
    high, low = F.sum(F.shiftright(column, 32)), F.sum(F.col(column).bitwiseAND(F.lit(0xFFFFFFFF)))
    return (high.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(20,0)")).cast("decimal(38,0)")
