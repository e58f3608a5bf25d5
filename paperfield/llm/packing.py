"""Packing of token sequences into fixed windows by minimum bin slack."""

from __future__ import annotations

import os
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperfield.llm.common import text_column

END = 1  # id after each document
BLOCK_TOKENS = 1 << 20


def fill(lengths: list[int], count: Callable[[int], int], window: int) -> list[int]:
    """Lengths, of a multiset, whose sum comes closest to ``window`` without exceeding it.

    ``lengths`` ascend and ``count`` says how often each is there. The largest is taken first. Then a bitset of the sums
    that can be reached grows by one length after the other, its count cut into powers of two; the bitset before each
    step is kept, and the best sum is traced back through them to the count of each length.
    """
    largest = lengths[-1]
    room = window - largest
    full = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for i in range(bisect_right(lengths, room) - 1, -1, -1):
        if reached >> room & 1:
            break
        length = lengths[i]
        left = min(count(length) - (length == largest), room // length)
        part = 1
        while left > 0:
            take = min(part, left)
            steps.append((length, take, reached))
            reached |= reached << (length * take) & full
            left -= take
            part *= 2
    best = reached.bit_length() - 1
    chosen = [largest]
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            chosen += [length] * take
            best -= length * take
    return chosen


def pack(sizes: np.ndarray, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) for documents of ``sizes`` tokens; no two overlap, none is left out.

    Whole windows of a document are cut off first. Of the remaining lengths each sequence takes the multiset of least
    slack. What slack is left is closed by a cut from a remaining piece, so only the last sequence has padding.
    """
    sequences = []
    waiting: dict[int, list[tuple[int, int]]] = {}
    for doc, size in enumerate(sizes.tolist()):
        whole = size // window * window
        sequences += [[(doc, at, window)] for at in range(0, whole, window)]
        if size > whole:
            waiting.setdefault(size - whole, []).append((doc, whole))
    lengths = sorted(waiting)

    def take(length: int) -> tuple[int, int]:
        piece = waiting[length].pop()
        if not waiting[length]:
            del waiting[length], lengths[bisect_left(lengths, length)]
        return piece

    while lengths:
        chosen = fill(lengths, lambda length: len(waiting[length]), window)
        slack = window - sum(chosen)
        times = 1 if slack else min(len(waiting[length]) // n for length, n in Counter(chosen).items())
        for _ in range(times):
            sequences.append([(*take(length), length) for length in chosen])
        if slack and lengths:
            longest = lengths[-1]  # longer than the slack, else it had been chosen
            doc, at = take(longest)
            sequences[-1].append((doc, at, slack))
            rest = longest - slack
            if rest not in waiting:
                insort(lengths, rest)
            waiting.setdefault(rest, []).append((doc, at + slack))
    return sequences


def stretches(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of ``flat`` in stretches of ``sizes`` from ``starts``, one stretch after the other."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Encoder:
    """Token ids of texts.

    With ``by_words``, for vocabularies that ignore ASCII case, drop white space and split at it and between letters or
    digits and punctuation: each run between ASCII white space is cut before its closing punctuation, and the parts are
    encoded once and kept, up to ``KEPT`` of them. Texts that may hold a special token are encoded whole.
    """

    KEPT = 1 << 20
    MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation without the apostrophe, which begins word endings

    def __init__(self, path: str, by_words: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = by_words
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False) if by_words and suffix else {}
        self.closing = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith(suffix or " ")]] = True
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {"": 0}
        self.ids = np.zeros(0, np.uint32)  # the ids of all places, one after the other; place 0 is empty
        self.bounds = np.zeros(2, np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, parts: list[str]) -> None:
        """Encode new parts; words of letters together, as each of them has one closing token."""
        words = [p for p in parts if p.isalpha()] if self.closing.any() else []
        found, sizes, first = [], [], len(self.places)
        for low in range(0, len(words), 500):
            some = words[low : low + 500]
            ids = self._whole([" ".join(some)])[0]
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) == len(some):
                found.append(ids)
                sizes.append(np.diff(ends, prepend=0))
                self.places.update(zip(some, range(len(self.places), len(self.places) + len(some))))
        rest = [p for p in parts if p not in self.places] if len(self.places) < first + len(parts) else []
        self.places.update(zip(rest, range(len(self.places), len(self.places) + len(rest))))
        found += self._whole(rest)
        sizes.append(np.array([len(f) for f in found[len(found) - len(rest) :]], np.int64))
        self.ids = np.concatenate([self.ids, *found])
        self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(np.concatenate(sizes)))

    def _cut(self, runs: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The two parts of each run; the second is empty where no letter or digit precedes the closing punctuation."""
        heads = pc.ascii_rtrim(runs, self.MARKS)
        last = pc.utf8_slice_codeunits(heads, -1).dictionary_encode()
        closed = [c != "" and c.lower()[-1].isalnum() for c in last.dictionary.to_pylist()]
        heads = pc.if_else(pa.array(closed, pa.bool_()).take(last.indices), heads, runs)
        content, starts, lengths = text_column(runs)
        begun = text_column(heads)[2]
        tails = stretches(content, starts + begun, lengths - begun)
        bounds = np.append(0, np.cumsum(lengths - begun)).astype(np.int32)
        return heads, pa.StringArray.from_buffers(len(runs), pa.py_buffer(bounds), pa.py_buffer(tails))

    def _runs(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct runs, one after the other, and their bounds."""
        parts = pa.concat_arrays(self._cut(runs)).dictionary_encode()
        texts = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.places) + len(texts) > self.KEPT:
            self._forget()
        self._words([t for t in texts if t not in self.places])
        places = np.fromiter(map(self.places.__getitem__, texts), np.int64, len(texts))
        of = places[parts.indices.to_numpy()].reshape(2, -1).T.ravel()
        sizes = np.diff(self.bounds)[of]
        return stretches(self.ids, self.bounds[of], sizes), np.append(0, np.cumsum(sizes)[1::2])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, with the end id after each text, and the number of ids of each text."""
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, "<|") if self.by_words else pa.array(np.ones(len(texts), bool))
        plain = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(special, "", texts)))
        coded = plain.flatten().dictionary_encode()
        per = np.asarray(plain.value_lengths()).astype(np.int64)
        of = coded.indices.to_numpy()
        flat, bounds = self._runs(coded.dictionary)
        whole = np.flatnonzero(np.asarray(special))
        found = self._whole(texts.take(pa.array(whole)).to_pylist())  # such a text is one run of its own
        of = np.insert(of, np.cumsum(per)[whole], np.arange(len(bounds) - 1, len(bounds) - 1 + len(whole)))
        per[whole] += 1
        found.append(np.array([END], np.uint32))  # the end id closes each text
        flat, bounds = np.concatenate([flat, *found]), np.append(bounds, bounds[-1] + np.cumsum([len(f) for f in found]))
        of = np.insert(of, np.cumsum(per), len(bounds) - 2)
        sizes = np.diff(bounds)[of]
        total = np.append(0, np.cumsum(sizes))
        closed = np.append(0, np.cumsum(per + 1))
        return stretches(flat, bounds[of], sizes), np.diff(total[closed])


def pieces(docs: DataFrame, path: str, window: int = 2048, by_words: bool = True, with_ids: bool = True) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of sequences of ``window`` tokens.

    Each document's ids, of the vocabulary at ``path`` and with an end id, lie in pieces without gap or overlap; a
    sequence's pieces lie from offset 0 without gap. Each task packs the rows of its own partition in blocks, and the
    incomplete sequence at the end of a block is packed again with the next one, so that at most one sequence of a
    partition has padding and no row is shuffled. A sequence id holds the partition and a number. Documents are packed
    as rows: null texts are empty and have the end id only; a null or repeated doc_id is kept as it is. Other columns
    are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, by_words)
        number = TaskContext.get().partitionId() << 40
        names: list = []
        tokens: list[np.ndarray] = []
        begun: list[int] = []
        totals: list[int] = []

        def emit(last: bool) -> pa.RecordBatch:
            nonlocal number, names, tokens, begun, totals
            sequences = pack(np.array([len(t) for t in tokens], np.int64), window)
            rest = []
            if not last and sequences and sum(n for *_, n in sequences[-1]) < window:
                rest = sequences.pop()
            doc, start, length, check, sequence, offset, ids = [], [], [], [], [], [], []
            for found in sequences:
                at = 0
                for d, s, n in found:
                    part = tokens[d][s : s + n]
                    doc.append(d)
                    start.append(begun[d] + s)
                    length.append(n)
                    check.append(crc32(part.tobytes()))
                    sequence.append(number)
                    offset.append(at)
                    at += n
                    if with_ids:
                        ids.append(part.astype("<u4").tobytes())
                number += 1
            whole = [names[d] for d in doc]
            arrays = [pa.array(x, pa.int64()) for x in (whole, start, length, check, [totals[d] for d in doc], sequence, offset)]
            arrays.append(pa.array(ids if with_ids else [None] * len(doc), pa.binary()))
            names, tokens, begun, totals = ([names[d] for d, *_ in rest], [tokens[d][s : s + n] for d, s, n in rest], [begun[d] + s for d, s, _ in rest], [totals[d] for d, *_ in rest])
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

        held = 0
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                ids, counts = encoder.encode(part.column(1))
                bounds = np.append(0, np.cumsum(counts))
                names += part.column(0).to_pylist()
                tokens += [ids[i:j] for i, j in zip(bounds[:-1], bounds[1:])]
                begun += [0] * len(counts)
                totals += counts.tolist()
                held += len(ids)
                if held >= BLOCK_TOKENS:
                    yield emit(False)
                    held = sum(len(t) for t in tokens)
        if tokens:
            yield emit(True)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, tokens): the ids of each sequence of :func:`pieces`, one after the other; at most a window long."""
    order = Window.partitionBy("sequence_id").orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = packed.select("sequence_id", "offset", F.collect_list(F.hex("ids")).over(order).alias("parts")).filter("offset = 0")
    bytes_ = F.concat_ws("", "parts")
    number = lambda i: F.conv(F.concat(*[F.substr(bytes_, 8 * i + 7 - 2 * k, F.lit(2)) for k in range(4)]), 16, 10).cast("long")
    return parts.select("sequence_id", F.transform(F.sequence(F.lit(0), (F.length(bytes_) / 8 - 1).cast("int")), number).alias("tokens"))
