import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperfield.llm import langid
from paperfield.llm.common import DRAWS, draw, drawn

WORDS = {"xx": "the of and thing ation".split(), "yy": "der die und schaft ung".split(), "zz": "le la et tion eaux".split()}


def table(spark, n=240):
    r = random.Random(1)
    rows = []
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        rows.append((i, " ".join(r.choice(WORDS[lang]) for _ in range(40)), lang))
    rows += [(1000, None, "xx"), (1001, "", "xx"), (1002, "12 !?", "xx"), (1003, "the of thing", None), (None, "der die und ung", None), (1004, "le", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'c' as lang_pred", "'c' as hits").repartition(3)


def test_held_out_accuracy_and_edges(spark):
    docs = table(spark)
    usable = F.coalesce(F.col("doc_id") % 4 != 2, F.lit(False))
    trained = langid.train(docs, usable)
    assert trained.languages == ["xx", "yy", "zz"]
    found = {r.doc_id: r for r in langid.identify(docs, trained).collect()}
    assert all(r.lang_pred == r.lang for r in found.values() if r.doc_id is not None and r.doc_id < 1000)
    assert all(0 <= r.lang_score <= 1 for r in found.values())
    for i in (1000, 1001, 1002):
        assert (found[i].lang_pred, found[i].lang_score) == ("und", 0)
    assert (found[1003].lang_pred, found[None].lang_pred, found[1004].lang_pred) == ("xx", "yy", "zz")
    assert found[1003].hits == "c"


def test_no_rows_to_learn_from(spark):
    docs = table(spark)
    nothing = langid.train(docs, F.lit(False))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(docs.limit(0), langid.train(docs, F.lit(True))).collect() == []


def test_filter_has_what_was_added_for_more_languages_than_a_plane():
    rng = np.random.default_rng(1)
    filter_ = langid.LanguageFilter([f"l{i}" for i in range(19)], 14)
    values = [rng.integers(0, 2**40, 300, dtype=np.uint64) for _ in range(19)]
    for i, v in enumerate(values):
        filter_.add(i, v)
    chances = filter_.chances()
    for i, v in enumerate(values):
        hits = filter_.counts(v, np.zeros(300, np.int64), 1)[0]
        assert hits[i] == 300
        others = np.delete(hits / 300, i)
        assert abs(others.mean() - np.delete(chances, i).mean()) < 0.01


def test_grams_stay_inside_a_text():
    data = np.frombuffer(b"abcdefabcdeABC", np.uint8)
    values, place = langid.grams(data, np.array([0, 6, 11]), np.array([6, 5, 3]))
    assert place.tolist() == [0, 1, 2, 6, 7] and values[:2].tolist() == values[3:].tolist()


@pytest.mark.parametrize("rows", [10, 2_000, 10**7, 10**10, 10**13])
def test_samples_of_any_number_of_rows(spark, rows):
    """About ``sample`` rows lie below the limit, however many there are: draws are even down to their last bits."""
    limit = drawn(2000, rows)
    assert limit == DRAWS if rows <= 2000 else abs(limit * rows / DRAWS - 2000) < 1
    draws = spark.range(100_000).select(draw("id").alias("d"), (F.pmod(draw("id"), F.lit(1 << 42)) / F.lit(1 << 42)).alias("fine"))
    low, high, fine = draws.agg(F.min("d"), F.max("d"), F.avg("fine")).first()
    assert 0 <= low < DRAWS // 10_000 and DRAWS - DRAWS // 10_000 < high < DRAWS and abs(fine - 0.5) < 0.01
