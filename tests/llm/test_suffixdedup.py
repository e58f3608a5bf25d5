import numpy as np
import pytest
from corpus import LINE, corpus, frame, repeats

from paperfield.llm import suffixdedup
from paperfield.llm.suffixdedup import Suffixes, remove_repeats


@pytest.mark.parametrize("limits", [(64, 512, 8192), (2, 4, 8192), (2, 4, 3)])
def test_same_as_every_string(spark, monkeypatch, limits):
    """Small limits send groups over the ways that frequent ones take."""
    for name, value in zip(("HOT_IN_BLOCK", "HOT_GROUP", "HOT_CORE"), limits):
        monkeypatch.setattr(suffixdedup, name, value)
    rows = corpus(260, seed=4)
    found = remove_repeats(frame(spark, rows)).collect()
    want = repeats(rows)
    assert {r.doc_id: ([tuple(s) for s in r.spans], bytes(r.kept)) for r in found} == want
    assert {r.doc_id: r.n_bytes for r in found} == {i: len((t or "").encode()) for i, t in rows}


def test_long_text_in_pieces(spark):
    rng = np.random.default_rng(2)
    part = bytes(rng.integers(97, 123, 300, dtype=np.uint8)).decode()
    filler = bytes(rng.integers(97, 123, 2_300_000, dtype=np.uint8)).decode()
    rows = [(1, part + filler + part), (2, filler[2_097_000:2_097_400])]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in remove_repeats(frame(spark, rows)).collect()}
    assert got == {1: [(2_300_300, 2_300_600)], 2: [(0, 400)]}


def test_null_and_repeated_ids_and_empty_tables(spark):
    rows = [(None, LINE), (3, LINE), (3, LINE), (3, LINE + "!" * 120), (4, None)]
    got = sorted(((r.doc_id, bytes(r.kept)) for r in remove_repeats(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, LINE.encode()), (3, b""), (3, b""), (3, b"!"), (4, b"")], key=repr)
    assert len(got) == 5 and remove_repeats(frame(spark, [])).collect() == []


def test_whole_characters_are_valid(spark):
    text = "ä" * 3 + LINE + "é" * 60
    rows = [(1, text), (2, "ö" + text[2:] + "ü")]
    got = {r.doc_id: bytes(r.kept).decode() for r in remove_repeats(frame(spark, rows), whole_characters=True).collect()}
    assert got[1] and set(got[2]) <= set("öäéü")


def test_sort_with_colliding_hashes_is_confirmed():
    data = np.frombuffer(b"abcabdabcabc", np.uint8)
    places = np.array([0, 3, 6, 9])
    suffixes = Suffixes(data, places, 3)
    assert suffixes.repeats(np.array([0, 4])).tolist() == [False, False, True, True]
    suffixes.whole[:] = 7  # every hash collides
    assert suffixes.repeats(np.array([0, 4])).tolist() == [False, False, True, True]


def test_mergesort_is_stable_and_sorted():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 4000, dtype=np.uint8)
    places = rng.permutation(3900)
    bounds = np.array([0, 1, 5, 5, 1000, 3900])
    order = Suffixes(data, places, 100).sort(bounds)
    for low, high in zip(bounds[:-1], bounds[1:]):
        want = sorted(range(low, high), key=lambda i: (bytes(data[places[i] : places[i] + 100]), i))
        assert order[low:high].tolist() == want


def test_length_is_checked(spark):
    with pytest.raises(ValueError):
        remove_repeats(frame(spark, []), length=20)
