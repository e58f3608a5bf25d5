import random

import numpy as np
from pyspark.sql import functions as F

from paperfield.llm import quality

FAST = quality.Training(sample=200, steps=120, batch=16)


def table(spark, n=300):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(r.randint(20, 200))]
        good = i % 3 > 0
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(good)))
    rows += [(900, None), (901, ""), (902, "a"), (None, "WORDS!! WORDS!!"), (5, rows[5][1]), (903, "abc def " * 40_000)]
    labels += [(700, 0), (None, 1), (3, None), (4, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as score", "'c' as y", "'c' as quality").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "'c' as text")


def test_held_out_rows_and_edges(spark):
    docs, labels = table(spark)
    model = quality.train(docs, labels, training=FAST)
    found = quality.score(docs, model).withColumn("out", quality.held_out("doc_id", 5)).collect()
    assert len(found) == 306 and all(0 <= r.quality_score <= 1 for r in found)
    out = [r for r in found if r.out and r.doc_id is not None and r.doc_id < 300]
    assert np.mean([(r.quality_score >= 0.5) == (r.doc_id % 3 > 0) for r in out]) > 0.95
    again = {r.doc_id: r.quality_score for r in quality.score(docs.filter("doc_id < 40"), model).collect()}
    assert all(abs(again[r.doc_id] - r.quality_score) < 1e-5 for r in found if r.doc_id in again)  # whatever else is in the block
    assert found[0].score == "c"


def test_without_labels_or_documents(spark):
    docs, labels = table(spark)
    assert quality.train(docs, labels.limit(0)) is None
    assert {r.quality_score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.train(docs.limit(0), labels, training=FAST) is None
    assert quality.score(docs.limit(0), quality.Network(1)).collect() == []


def test_gradients_are_those_of_differences():
    network = quality.Network(3)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 110, n, dtype=np.uint8) for n in (3, 700, 2000)]
    labels = np.array([0, 1, 1], np.float32)

    def loss():
        p = np.concatenate([network.scores(t, np.array([0]), np.array([len(t)])) for t in texts])
        return -np.mean(np.log(np.where(labels > 0, p, 1 - p)))

    got = network.gradients(texts, labels)
    for name, index in (("embed", (100, 3)), ("filters", (5, 2)), ("shift", (4,)), ("unit", (1,)), ("unit", (quality.FILTERS + 1,)), ("base", (0,))):
        weight = network.weights[name]
        kept = weight[index]
        weight[index] = kept + 1e-4
        high = loss()
        weight[index] = kept - 1e-4
        low = loss()
        weight[index] = kept
        assert abs((high - low) / 2e-4 - got[name][index]) < 2e-3 * max(1, abs(got[name][index])), name


def test_every_byte_counts():
    network = quality.Network(7)
    rng = np.random.default_rng(2)
    data = rng.integers(97, 123, 5000, dtype=np.uint8)
    maxima, values, low, high, owner, padded = network.pooled(data, np.array([0]), np.array([5000]))
    assert low[0] == 0 and high[-1] == 1250 and (low[1:] < high[:-1]).all()  # chunks overlap and reach the end
    assert bytes(padded[:5000]) == bytes(data)
    assert np.allclose(maxima, [values[a:b].max(axis=0) for a, b in zip(low, high)])


def test_folds(spark):
    import zlib

    df = spark.range(50).select(F.col("id").alias("doc_id"), quality.held_out("doc_id", 5).alias("out"))
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in df.collect())
