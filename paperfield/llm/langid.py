"""Language of texts by a bit-sliced Bloom filter that answers, for an n-gram, with the set of languages that have it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperfield.llm.common import draw, drawn, text_blocks

GRAM = 4  # bytes
PLAIN = np.full(256, 32, np.uint8)  # letters and bytes of non-ASCII characters stay, the rest is a gap
PLAIN[97:123] = np.arange(97, 123)
PLAIN[128:] = np.arange(128, 256)
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Fit:
    """Bounds of the fit: at most about ``sample`` texts a language, drawn by a hash of doc_id, and the ``grams`` most
    frequent n-grams of each. An n-gram belongs to every language in which it is at least ``share`` as frequent as in
    the language that has it most."""

    sample: int = 2000
    grams: int = 100_000
    share: float = 0.2
    slot_bits: int = 20


def grams(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each text as numbers, and where they start."""
    data = PLAIN[data].astype(np.uint64)
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = data[:n].copy()
    for i in range(1, GRAM):
        value |= data[i : n + i] << np.uint64(8 * i)
    ends = np.zeros(len(data) + 1, bool)
    for i in range(GRAM - 1):  # those that reach over the end of a text
        at = starts + sizes - 1 - i
        ends[at[(at >= starts)]] = True
    place = np.flatnonzero(~ends[:n])
    return value[place], place


def prepared(texts: pa.Array) -> pa.Array:
    """Texts in lower case between gaps; null is empty."""
    gap = pa.scalar(" ", pa.large_string())
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    return pc.binary_join_element_wise(gap, lower, gap, pa.scalar("", pa.large_string()))


class LanguageFilter:
    """``slots`` holds, for each language, one bit in each slot of a Bloom filter: a slot is a set of languages."""

    def __init__(self, languages: list[str], slot_bits: int):
        self.languages, self.slot_bits = languages, slot_bits
        self.planes = [np.zeros(1 << slot_bits, np.uint8) for _ in range(max(1, -(-len(languages) // 8)))]

    def _places(self, values: np.ndarray) -> list[np.ndarray]:
        shift = np.uint64(64 - self.slot_bits)
        return [((values * np.uint64(f)) >> shift).astype(np.int64) for f in FACTORS]

    def add(self, language: int, values: np.ndarray) -> None:
        for place in self._places(values):
            self.planes[language // 8][place] |= np.uint8(1 << language % 8)

    def chances(self) -> np.ndarray:
        """For each language the probability that an n-gram which it lacks seems to be there."""
        full = [np.mean(self.planes[i // 8] >> np.uint8(i % 8) & 1) for i in range(len(self.languages))]
        return np.array(full) ** len(FACTORS)

    def counts(self, values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """(text, language): how many n-grams of each text are in each language's filter."""
        places = self._places(values)
        bits = np.arange(256)[:, None] >> np.arange(8) & 1
        found = []
        for plane in self.planes:
            sets = plane[places[0]]
            for place in places[1:]:
                sets = sets & plane[place]
            found.append(np.bincount(owner * 256 + sets, minlength=n * 256).reshape(n, 256) @ bits)
        return np.concatenate(found, axis=1)[:, : len(self.languages)]


def train(docs: DataFrame, usable: F.Column, fit: Fit = Fit()) -> LanguageFilter:
    """A filter of the languages of ``docs`` (doc_id, text, lang) in the rows where ``usable`` holds.

    Rows without text or lang are not used. Counts are made by partial sums on the executors; what the driver gets is
    bounded by languages times ``fit.grams``.
    """
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    trained = LanguageFilter(languages, fit.slot_bits)
    if not languages:
        return trained
    share = F.create_map(*[F.lit(x) for language, n in sizes.items() for x in (language, drawn(fit.sample, n))])
    sample = rows.filter(draw("doc_id") < share[F.col("lang")].cast("long"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist())
            for first, last, data, starts, sizes in text_blocks(prepared(batch.column(0))):
                values, place = grams(data, starts, sizes)
                of = langs[first:last][np.searchsorted(starts, place, "right") - 1] if len(place) else langs[:0]
                for language in np.unique(of):
                    value, times = np.unique(values[of == language], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([str(language)] * len(value)), pa.array(value.view(np.int64)), pa.array(times)], ["lang", "gram", "n"])

    counted = sample.select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rate = counted.withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy("lang")))
    kept = rate.withColumn("most", F.max("rate").over(Window.partitionBy("gram"))).filter((F.col("rate") >= fit.share * F.col("most")) & (F.col("n") > 1))
    best = kept.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("nth") <= fit.grams)
    found = best.select("lang", "gram").toPandas()
    for number, language in enumerate(languages):
        trained.add(number, found["gram"][found["lang"] == language].to_numpy(np.int64).view(np.uint64))
    return trained


def identify(docs: DataFrame, trained: LanguageFilter, label: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """``docs`` with the language of each whole text and a score from 0 to 1.

    All n-grams of a text are looked up; each language's number of hits is corrected for the filter's false positives,
    and the largest decides, the first language in alphabetical order among equals. The score is the corrected share
    of n-grams that the language has. Texts that are null or have no letter are ``und`` with score 0, as are all texts
    if no language is known. Texts count as surrounded by gaps. Other columns pass through;
    those of the names of the new ones are replaced.
    """
    docs = docs.drop(label, score)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not trained.languages:
        return docs.withColumns({label: F.lit("und"), score: F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(trained)
    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        chance = model.chances()
        names = np.array(model.languages, object)
        for batch in batches:
            labels, scores = [], []
            for first, last, data, starts, sizes in text_blocks(prepared(batch.column(place)), 1 << 18):
                values, at = grams(data, starts, sizes)
                owner = np.searchsorted(starts, at, "right") - 1
                total = np.bincount(owner, minlength=last - first)[:, None]
                hits = model.counts(values, owner, last - first)
                true = np.clip((hits - total * chance) / (1 - chance), 0, None)
                best = true.argmax(axis=1)
                labels.append(names[best])
                scores.append(true[np.arange(len(best)), best] / np.maximum(1, total[:, 0]))
            new = [pa.array(np.concatenate([np.zeros(0, object), *labels]).tolist(), pa.string()), pa.array(np.clip(np.concatenate([np.zeros(0), *scores]), 0, 1), pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, label, score])

    schema = docs.withColumns({label: F.lit(""), score: F.lit(0.0)}).schema
    found = docs.mapInArrow(work, schema)
    return found.withColumns({label: F.when(letters, F.col(label)).otherwise("und"), score: F.when(letters, F.col(score)).otherwise(0.0)})
