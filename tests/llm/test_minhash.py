import numpy as np
import pytest
from corpus import LINE, corpus, frame, near_components

from paperfield.llm.components import components
from paperfield.llm.minhash import NearDuplicates, linked_groups, near_duplicates, probe_table, shingle_sets, signature


@pytest.mark.parametrize(("width", "percent", "tile"), [(3, 85, 1024), (5, 80, 3)])
def test_same_as_all_pairs(spark, width, percent, tile):
    rows = corpus()
    found = near_duplicates(frame(spark, rows), NearDuplicates(shingle=width, percent=percent, tile_documents=tile))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()}
    assert got == near_components(rows, width, percent)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_chain_of_links_has_one_component(spark):
    words = [f"w{i}" for i in range(60)]
    chain = [(i, " ".join(words[i : i + 40])) for i in range(12)]  # neighbours are alike, the ends are not
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, chain), NearDuplicates(3, 85)).collect()}
    assert got == {i: v[1] for i, v in near_components(chain, 3, 85).items()}
    assert set(got.values()) == {0}


def test_null_and_repeated_ids_and_empty_tables(spark):
    rows = [(None, LINE), (None, None), (1, LINE), (1, LINE), (2, ""), (2, "other words of another text here")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, 1, False), (None, None, True), (1, 1, True), (1, 1, True), (2, 2, True), (2, 2, True)], key=repr)
    assert near_duplicates(frame(spark, [])).collect() == []


def test_densified_signature_depends_on_the_set_only():
    probes = probe_table(120)
    one = np.sort(np.random.default_rng(1).integers(0, 2**63, 7, dtype=np.uint64))
    assert (signature(one, probes) == signature(one.copy(), probes)).all()
    assert set(signature(one, probes)) == set(one)
    more = np.sort(np.append(one, np.uint64(2**63 + 11)))
    same = (signature(one, probes) == signature(more, probes)).mean()
    assert 0.7 < same < 1  # 7 / 8 in the mean


def test_shingles_across_texts():
    data = np.frombuffer(b"A b\x0bcab c", np.uint8)
    sets = shingle_sets(data, np.array([0, 5, 5]), np.array([5, 0, 4]), 3)
    assert [len(s) for s in sets] == [1, 0, 1]
    assert sets[0] != sets[2]  # "a b c" and "ab c"


def test_linked_groups_follow_chains():
    sets = [np.arange(i, i + 40, dtype=np.uint64) for i in range(8)] + [np.arange(1000, 1010, dtype=np.uint64)]
    assert linked_groups(sets, 85).tolist() == [0] * 8 + [8]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
