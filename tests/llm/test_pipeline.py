import corpus_pipeline
import pytest
from corpus import contamination, near_components, repeats
from pyspark.sql import functions as F

from paperfield.llm import quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder():
    return "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_against_plain_python(spark, folder, monkeypatch):
    monkeypatch.setattr(quality.Training, "__init__", lambda self: self.__dict__.update(sample=3000, steps=60, batch=32, rate=0.004, seed=5))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    start = texts(docs)
    first = corpus_pipeline.quality_filter(spark, docs, folder).cache()
    assert first.columns == COLUMNS
    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {r.doc_id: r.quality_score for r in quality.score(docs, model).collect()}
    assert sorted(texts(first)) == sorted((i, t) for i, t in start if scores[i] >= 0.3)

    second = corpus_pipeline.near_dedup(spark, first, folder).cache()
    kept = {i for i, (_, _, k) in near_components(texts(first), 5, 80).items() if k}
    assert second.columns == COLUMNS and sorted(texts(second)) == sorted((i, t) for i, t in texts(first) if i in kept)

    third = corpus_pipeline.repeated_passages(spark, second, folder).cache()
    want = {i: k for i, (_, k) in repeats(texts(second)).items()}
    assert third.columns == COLUMNS and third.count() == second.count()
    for r in third.collect():
        assert r.n_chars == len(r.text)
        assert r.text.encode() == want[r.doc_id] or len(want[r.doc_id]) - len(r.text.encode()) < 8  # parts of characters go too

    fourth = corpus_pipeline.decontaminate(spark, third, folder).cache()
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    hits = contamination(texts(third), items)
    clean = {i for i, (n, h, _) in hits.items() if not (h > 0 and 20 * h >= n)}
    assert fourth.columns == COLUMNS and {i for i, _ in texts(fourth)} == clean

    pieces = corpus_pipeline.pack(spark, fourth, folder).cache()
    assert {r.doc_id for r in pieces.collect()} == clean
    full = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n < 2048").count()
    assert full <= fourth.rdd.getNumPartitions()


def test_odd_rows_pass_every_stage(spark, folder):
    rows = [(None, None, None, None, None), (None, "a b c d e f", "en", "s", 11), (1, "", "en", None, 0), (2, "same words here in a row", "en", "s", 24), (2, "same words here in a row", "en", "s", 24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (corpus_pipeline.near_dedup, corpus_pipeline.repeated_passages, corpus_pipeline.decontaminate):
        for table in (docs, docs.limit(0)):
            found = stage(spark, table, folder)
            assert found.columns == COLUMNS and found.count() == table.count()
