"""Quality of texts by a small byte-level convolutional network in numpy."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperfield.llm.common import draw, drawn, text_blocks

DEPTH = 8  # numbers for a byte
STRIDE = 4
WIDTH = 2 * STRIDE  # bytes under a filter
FILTERS = 24
CHUNK = 128  # filter positions of a chunk
STEP = 112  # from chunk to chunk, so chunks overlap by 16 positions


@dataclass(frozen=True)
class Training:
    """Bounds of the fit: at most about ``sample`` labelled rows, drawn evenly from both classes by a hash of doc_id."""

    sample: int = 3000
    steps: int = 560
    rate: float = 0.004
    batch: int = 64
    seed: int = 5


class Network:
    """Embedding, one layer of filters at every fourth byte, maxima of overlapping chunks, and one logistic unit.

    Every chunk of a document is used: the unit sees the mean and the maximum of the chunks' maxima.
    """

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.weights = {
            "embed": random.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
            "filters": random.normal(0, 0.2, (WIDTH * DEPTH, FILTERS)).astype(np.float32),
            "shift": np.zeros(FILTERS, np.float32),
            "unit": random.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            "base": np.zeros(1, np.float32),
        }

    def pooled(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Chunk maxima, their positions, the owner of each chunk, and the padded bytes."""
        w = self.weights
        places = np.maximum(1, -(-sizes // STRIDE))  # filter positions of each text
        room = places + 1  # one group of zero bytes after each text
        base = np.cumsum(room) - room
        padded = np.zeros((int(room.sum())) * STRIDE, np.uint8)
        target = np.repeat(base * STRIDE - starts, sizes) + np.arange(len(data))
        padded[target] = data
        groups = w["embed"][padded].reshape(-1, STRIDE * DEPTH)
        half = STRIDE * DEPTH
        both = groups @ np.concatenate([w["filters"][:half], w["filters"][half:]], axis=1)
        values = both[:-1, :FILTERS] + both[1:, FILTERS:] + w["shift"]
        chunks = np.maximum(1, -(-(places - (CHUNK - STEP)) // STEP))
        owner = np.repeat(np.arange(len(sizes)), chunks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        low = base[owner] + nth * STEP
        high = np.minimum(low + CHUNK, base[owner] + places[owner])
        cuts = np.empty(2 * len(low), np.int64)
        cuts[::2], cuts[1::2] = low, high
        if cuts[-1] == len(values):
            values = np.concatenate([values, values[-1:]])
        return np.maximum.reduceat(values, cuts, axis=0)[::2], values, low, high, owner, padded

    def features(self, maxima: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        first = np.searchsorted(owner, np.arange(n))
        high = np.maximum(maxima, 0)
        mean = np.add.reduceat(high, first, axis=0) / np.bincount(owner, minlength=n)[:, None]
        return np.concatenate([mean, np.maximum.reduceat(high, first, axis=0)], axis=1)

    def scores(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        maxima, *_, owner, _ = self.pooled(data, starts, sizes)
        return self.probability(self.features(maxima, owner, len(sizes)))

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights["unit"] + self.weights["base"][0], -30, 30)))

    def gradients(self, texts: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        maxima, values, low, high, owner, padded = self.pooled(np.concatenate(texts), starts, sizes)
        n = len(texts)
        x = self.features(maxima, owner, n)
        error = ((self.probability(x) - labels) / n).astype(np.float32)
        into = error[:, None] * self.weights["unit"]
        chunks = np.bincount(owner, minlength=n)
        to_max = into[owner, :FILTERS] / chunks[owner, None]
        top = np.maximum(maxima, 0) == x[owner, FILTERS:]  # ties share nothing: the first chunk of a text takes it
        order = np.lexsort((np.arange(len(owner)), owner))
        for f in range(FILTERS):
            hit = order[top[order, f]]
            first = hit[np.append(True, owner[hit[1:]] != owner[hit[:-1]])[: len(hit)]]
            to_max[first, f] += into[owner[first], FILTERS + f]
        to_max *= maxima > 0
        at = np.stack([low[c] + values[low[c] : high[c]].argmax(axis=0) for c in range(len(low))])
        bytes_ = padded[at[:, :, None] * STRIDE + np.arange(WIDTH)]
        seen = self.weights["embed"][bytes_].reshape(len(at), FILTERS, -1)
        back = (to_max[:, :, None] * self.weights["filters"].T[None]).reshape(-1, DEPTH)
        embed = np.stack([np.bincount(bytes_.ravel(), back[:, d], 256) for d in range(DEPTH)], axis=1)
        return {"embed": embed, "filters": np.einsum("cfw,cf->wf", seen, to_max), "shift": to_max.sum(axis=0), "unit": error @ x, "base": error.sum(keepdims=True)}


def fit(texts: list[np.ndarray], labels: np.ndarray, training: Training) -> Network:
    """A network fitted with Adam; both classes weigh as they occur in the sample."""
    network, random = Network(training.seed), np.random.default_rng(training.seed)
    moments = {k: [np.zeros_like(v, np.float64), np.zeros_like(v, np.float64)] for k, v in network.weights.items()}
    order = np.zeros(0, np.int64)
    for step in range(1, training.steps + 1):
        if len(order) < training.batch:
            order = np.append(order, random.permutation(len(texts)))
        rows, order = order[: training.batch], order[training.batch :]
        rate = training.rate * (1 - 0.9 * step / training.steps)
        for k, g in network.gradients([texts[i] for i in rows], labels[rows]).items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
            network.weights[k] -= change.astype(np.float32)
    return network


def held_out(column: str, folds: int) -> F.Column:
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds == 0


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, training: Training = Training()) -> Network | None:
    """A network for ``labels`` (doc_id, quality 0 or 1) of ``docs`` (doc_id, text), without the rows held out.

    The sample is bounded by ``training.sample``, so it is broadcast to find its texts and fitted in one task. With no
    labelled row there is no network. Null labels and labels of unknown documents are not used; of several labels of a
    document all are.
    """
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", folds))
    counts = {r.y: r.n for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = {y: min(1.0, training.sample / len(counts) / n) for y, n in counts.items()}
    limit = sum((F.when(F.col("y") == y, F.lit(drawn(training.sample, len(counts) * n))).otherwise(0).cast("long") for y, n in counts.items()), F.lit(0))
    sample = usable.filter(draw("doc_id") < limit)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most about training.sample short rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            ids, ys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for first, _, data, starts, sizes in text_blocks(batch.column(1)):
                found += [(ids[first + i], data[s : s + n].tobytes(), ys[first + i]) for i, (s, n) in enumerate(zip(starts, sizes))]
        found.sort()
        if found:
            model = fit([np.frombuffer(t, np.uint8) for _, t, _ in found], np.array([y for *_, y in found], np.float32), training)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model.weights)], pa.binary())], ["model"])

    fitted = rows.repartition(1).mapInArrow(work, "model binary").collect()
    if not fitted:
        return None
    model = Network(training.seed)
    model.weights = pickle.loads(bytes(fitted[0].model))
    if len(counts) == 2:  # from the sample's odds to those of all labelled rows
        model.weights["base"] += np.float32(np.log(share[0] / share[1]))
    return model


def score(docs: DataFrame, model: Network | None, column: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of good quality of each whole text; without a model 0.5.

    Every byte is under a filter. Null texts count as empty, which is scored like one filter position of zero bytes.
    All other columns pass through; one of the name of the new column is replaced.
    """
    docs = docs.drop(column)
    if model is None:
        return docs.withColumn(column, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(0)
        network.weights = shared.value
        for batch in batches:
            found = [np.zeros(0)]
            for _, _, data, starts, sizes in text_blocks(batch.column(place), 1 << 16):
                found.append(network.scores(data, starts, sizes))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found), pa.float64())], [*batch.schema.names, column])

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
