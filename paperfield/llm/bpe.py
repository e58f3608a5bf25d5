"""Byte-level BPE in two tiers: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the others."""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from paperfield.llm.common import mix

BLOCK = 1 << 20  # characters encoded at once
MATCHES = 1 << 17  # pre-tokens taken at once from a longer text
KEPT = 1 << 18  # merged pre-tokens that a task remembers
LONGEST_KEPT = 64
ASCII_CLASSES = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}
PLACE = (1 << 40) - 1
AFTER, BEFORE = list(range(1, LONGEST_KEPT + 1)), list(range(-1, LONGEST_KEPT - 1))
SALT = 0x9E3779B97F4A7C15


class PerfectHash:
    """Numbers 0..n-1 for n distinct 64-bit keys; other keys get some number or -1, so callers compare.

    A level is a bit array with two bits a key: keys alone at their bit stay, the others go to the next level. A key's
    number is the rank of its bit, from a directory of popcounts before each word.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        rest, before = keys, 0
        while len(rest):
            if len(self.levels) == 64:
                raise ValueError("keys repeat")
            size = np.uint64(2 * len(rest) + 62)
            at = mix(rest + self._salt(len(self.levels))) % size
            alone = np.bincount(at.astype(np.int64), minlength=int(size))[at.astype(np.int64)] == 1
            words = np.zeros(int(size) // 64 + 1, np.uint64)
            np.bitwise_or.at(words, (at[alone] >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at[alone] & np.uint64(63)))
            counts = np.bitwise_count(words).astype(np.int64)
            self.levels.append((size, words, before + np.cumsum(counts) - counts))
            before += int(counts.sum())
            rest = rest[~alone]

    @staticmethod
    def _salt(level: int) -> np.uint64:
        return np.uint64(SALT * (level + 1) & (1 << 64) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, (size, words, before) in enumerate(self.levels):
            at = mix(keys[rest] + self._salt(level)) % size
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            there = words[word] & bit != 0
            found[rest[there]] = (before[word] + np.bitwise_count(words[word] & (bit - np.uint64(1))))[there]
            rest = rest[~there]
            if not len(rest):
                break
        return found


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one word; ``data`` ends in eight bytes that do not count."""
    return np.ndarray(len(data) - 7, "<u8", data, strides=(1,))


def _word(words: np.ndarray, start: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next eight bytes of spans of which ``left`` bytes are left, zero behind their end."""
    bits = 8 * np.minimum(left, 8)
    return words[start] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (64 - bits).astype(np.uint64))


def _hashes(words: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    found = length.astype(np.uint64)
    rest = np.flatnonzero(length > 0)
    for k in range(0, int(length.max(initial=0)), 8):
        rest = rest[length[rest] > k]
        found[rest] = mix(found[rest] ^ _word(words, start[rest] + k, length[rest] - k))
    return found


def _for_ascii(pattern: str) -> str:
    """The pattern with ASCII members for its classes of letters and numbers, with or without brackets around them."""
    inside, parts = False, []
    for part in re.findall(r"\\p\{\w+\}|\\.|[\[\]]|[^\\\[\]]+", pattern):
        inside = part == "[" or inside and part != "]"
        members = ASCII_CLASSES.get(part)
        parts.append(part if members is None else members if inside else f"[{members}]")
    return "".join(parts)


class Splitter:
    """Sizes, in characters, of the matches of a pattern, which must cover the text.

    ``unknown`` has, for classes of the pattern, the ranges of code points that are not to count for them. Plain ASCII
    is split by an equal pattern of the faster ``re``.
    """

    def __init__(self, pattern: str, unknown: dict[str, str]):
        self.plain = regex.compile(pattern, regex.V1)
        self.exact, self.doubtful = self.plain, None
        if unknown:
            narrow = pattern
            for kind, ranges in unknown.items():
                narrow = narrow.replace(kind, f"[{kind}--[{ranges}]]")
            self.exact = regex.compile(narrow, regex.V1)
            first = min(ranges.split("-")[0] for ranges in unknown.values())
            self.doubtful = re.compile(f"[{first}-\U0010ffff]")
        try:
            self.ascii = re.compile(_for_ascii(pattern), re.ASCII)
        except re.error:
            self.ascii = self.plain

    def __call__(self, text: str) -> Iterator[tuple[str, list[int]]]:
        """Stretches of a text and the characters of each of their matches."""
        if text.isascii():
            pattern = self.ascii
        else:
            pattern = self.exact if self.doubtful and self.doubtful.search(text) else self.plain
        if len(text) <= BLOCK:
            yield text, list(map(len, pattern.findall(text)))
            return
        found, start = pattern.finditer(text), 0
        while sizes := [m.end() - m.start() for m in islice(found, MATCHES)]:
            yield text[start : start + sum(sizes)], sizes
            start += sum(sizes)


class Bpe:
    """Ids of texts and bytes of ids, by the ranks of a file with one token (base64) and its rank a line."""

    def __init__(self, ranks: bytes):
        pairs = [line.split() for line in ranks.splitlines() if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        if not all(bytes([b]) in self.ranks for b in range(256)):
            raise ValueError("a vocabulary needs all single bytes")
        tokens = list(self.ranks)
        sizes = np.array([len(t) for t in tokens])
        self.longest = int(sizes.max())
        padded = np.frombuffer(b"".join(tokens) + bytes(8), np.uint8)
        starts = np.cumsum(sizes) - sizes
        hashes = _hashes(_words(padded), starts, sizes)
        self.table = PerfectHash(hashes)
        slot = self.table.find(hashes)
        self.data, self.words = padded, _words(padded)
        # by slot: place and length of the token, and its id
        self.start, self.size, self.id = (np.zeros(len(tokens), np.int64) for _ in range(3))
        self.start[slot], self.size[slot], self.id[slot] = starts, sizes, list(self.ranks.values())
        # by id, for decoding
        self.at, self.length = (np.full(max(self.ranks.values()) + 1, fill, np.int64) for fill in (0, -1))
        self.at[self.id], self.length[self.id] = self.start, self.size
        self.length_of = self.length.tolist()
        self.pairs = {tuple(token): rank for token, rank in self.ranks.items() if len(token) == 2}
        self.kept: dict[bytes, Sequence[int]] = {}

    def whole(self, words: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """First tier: the ids of spans that are tokens as a whole, else -1. The bytes are compared."""
        found = np.full(len(start), -1, np.int64)
        short = np.flatnonzero((length <= self.longest) & (length > 0))
        slot = self.table.find(_hashes(words, start[short], length[short]))
        short, slot = short[slot >= 0], slot[slot >= 0]
        same = self.size[slot] == length[short]
        short, slot = short[same], slot[same]
        found[short] = self.id[slot]
        for k in range(0, int(length[short].max(initial=0)), 8):
            more = length[short] > k
            short, slot = short[more], slot[more]
            left = length[short] - k
            differs = _word(words, start[short] + k, left) != _word(self.words, self.start[slot] + k, left)
            found[short[differs]] = -1
        return found

    def merged(self, piece: bytes) -> Sequence[int]:
        """Second tier: ids of a pre-token that is no token: the pair of lowest rank, the first of equals, is joined again and again.

        Parts are linked by their places; a heap holds the pairs, and entries of pairs that are gone are passed over.
        """
        n, rank, length = len(piece), self.ranks.get, self.length_of
        if n <= LONGEST_KEPT:
            after, before = AFTER[:n], BEFORE[:n]
        else:
            after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        heap = [r << 40 | i for i, r in enumerate(map(self.pairs.get, zip(piece, piece[1:]))) if r is not None]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i = entry & PLACE
            j = after[i]
            if j < 0 or j >= n:
                continue
            k = after[j]
            if k != i + length[entry >> 40]:
                continue
            after[i], after[j] = k, -1
            if k < n:
                before[k] = i
                r = rank(piece[i : after[k]])
                if r is not None:
                    heappush(heap, r << 40 | i)
            h = before[i]
            if h >= 0:
                r = rank(piece[h:k])
                if r is not None:
                    heappush(heap, r << 40 | h)
        ids, i = [], 0
        while i < n:
            k = after[i]
            ids.append(self.ranks[piece[i:k]])
            i = k
        if n <= LONGEST_KEPT:
            if len(self.kept) >= KEPT:
                self.kept.clear()
            self.kept[piece] = ids = tuple(ids)  # unlike lists, no work for the garbage collector
        return ids

    def block(self, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive pre-tokens of ``sizes`` characters, and the number of ids of each."""
        data = text.encode("utf-8")
        ends = np.cumsum(sizes)
        content = np.frombuffer(data + bytes(8), np.uint8)
        if len(data) > len(text):
            ends = np.append(np.flatnonzero(content[: len(data)] & 0xC0 != 0x80), len(data))[ends]
        starts = np.append(0, ends)[: len(ends)]
        ids = self.whole(_words(content), starts, ends - starts)
        missed = np.flatnonzero(ids < 0)
        if not len(missed):
            return ids, np.ones(len(ids), np.int64)
        known, merged = self.kept.get, self.merged
        pieces = [data[a:b] for a, b in zip(starts[missed].tolist(), ends[missed].tolist())]
        parts = [known(piece) or merged(piece) for piece in pieces]
        counts = np.ones(len(ids), np.int64)
        counts[missed] = list(map(len, parts))
        out = np.repeat(ids, counts)
        out[out < 0] = np.fromiter(chain.from_iterable(parts), np.int64)
        return out, counts

    def encode(self, texts: Iterable[str], split: Splitter) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        waiting: list[tuple[bool, str, list[int]]] = []  # whether a text ends here, a stretch, the sizes of its pre-tokens
        size, pending = 0, []

        def flush() -> Iterator[np.ndarray]:
            nonlocal size, pending
            tokens = [len(sizes) for _, _, sizes in waiting]
            sizes = np.fromiter(chain.from_iterable(sizes for _, _, sizes in waiting), np.int64, sum(tokens))
            ids, counts = self.block("".join(t for _, t, _ in waiting), sizes)
            bounds = np.append(0, np.cumsum(counts))[np.append(0, np.cumsum(tokens))]
            for (last, _, _), a, b in zip(waiting, bounds, bounds[1:]):
                pending.append(ids[a:b])
                if last:
                    yield np.concatenate(pending) if len(pending) > 1 else pending[0]
                    pending = []
            waiting.clear()
            size = 0

        for text in texts:
            for stretch, sizes in split(text):
                waiting.append((False, stretch, sizes))
                size += len(stretch)
                if size >= BLOCK:
                    yield from flush()
            waiting.append((True, "", []))
        yield from flush()

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, and where those of each id begin."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.length) or (self.length[ids] < 0).any()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.length[ids]
        ends = np.cumsum(sizes)
        places = np.repeat(self.at[ids] - ends + sizes, sizes) + np.arange(sizes.sum())
        return self.data[places], np.append(0, ends)


_made: dict[object, object] = {}


def _once(kind: type, *arguments):
    """One object of a kind and its arguments a process."""
    key = (kind, repr(arguments) if kind is Splitter else hash(arguments))
    if key not in _made:
        _made[key] = kind(*arguments)
    return _made[key]


def unknown_points(pattern: str) -> dict[str, str]:
    """For the classes of letters and numbers in a pattern: ranges of code points that tiktoken's own engine does not count.

    It and the ``regex`` module follow different versions of Unicode.
    """
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    found = {}
    for kind in ASCII_CLASSES:
        own = regex.findall(kind, "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))) if kind in pattern else []
        probe = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks=single, special_tokens={})
        points = np.array(sorted(set(map(ord, own)) - set(map(ord, bytes(probe.encode_ordinary("".join(own))).decode("utf-8")))), np.int64)
        if len(points):
            firsts = np.flatnonzero(np.diff(points, prepend=-2) != 1)
            lasts = np.append(firsts[1:], len(points)) - 1
            found[kind] = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(points[firsts].tolist(), points[lasts].tolist()))
    return found


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of whole texts: every match of ``pattern`` is encoded by itself, without special tokens.

    ``ranks_path`` is read by the driver; the vocabulary travels with the tasks. Rows are independent: repeated and null
    doc_ids stay as they are, null and empty texts have no ids, other columns are not read. A text is taken in stretches
    of about a million characters; what grows with it are the text and its ids. One pre-token that is no token costs
    about 60 bytes of memory a byte.
    """
    with open(ranks_path, "rb") as file:
        ranks = file.read()
    unknown = unknown_points(pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, split = _once(Bpe, ranks), _once(Splitter, pattern, unknown)
        for batch in batches:
            texts = (t.decode("utf-8", "replace") if t else "" for t in (v.as_py() for v in batch.column(1).cast(pa.large_binary())))
            first, parts, size = 0, [], 0

            def rows() -> pa.RecordBatch:
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum([len(p) for p in parts])), pa.int32()),
                    pa.array(np.concatenate(parts), pa.int32()),
                )
                return pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(parts)), lists], ["doc_id", "ids"])

            for ids in coder.encode(texts, split):
                parts.append(ids)
                size += len(ids)
                if size >= BLOCK:
                    yield rows()
                    first, parts, size = first + len(parts), [], 0
            if parts:
                yield rows()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def decode_documents(rows: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of each row's ids; null ids have none. An id outside the vocabulary is an error."""
    with open(ranks_path, "rb") as file:
        ranks = file.read()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _once(Bpe, ranks)
        for batch in batches:
            lists = batch.column(1)
            sizes = np.array(lists.value_lengths().fill_null(0), np.int64)
            ends = np.cumsum(sizes)
            flat = np.array(lists.flatten(), np.int64)
            first = 0
            while first < len(sizes):
                begin = ends[first] - sizes[first]
                last = max(first + 1, int(np.searchsorted(ends, begin + BLOCK, "right")))
                data, at = coder.decode(flat[begin : ends[last - 1]])
                bounds = at[np.append(0, ends[first:last] - begin)]
                texts = pa.Array.from_buffers(pa.large_binary(), last - first, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
                yield pa.RecordBatch.from_arrays([*(c.slice(first, last - first) for c in batch.columns), texts.cast(pa.binary())], ["doc_id", "ids", "decoded"])
                first = last

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, ids array<int>, decoded binary")
