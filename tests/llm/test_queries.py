"""The queries themselves, against their SQL or what the operators' own tests compute, on the smallest tables."""

import hashlib
import os
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import compare, connect  # noqa: E402
from test_bpe import RANKS, library  # noqa: E402, F401
from test_merkle import h, leaf, tree  # noqa: E402

from paperfield.llm.queries import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def documents(con):
    return con.execute("select doc_id, text, lang, source, n_chars from documents").fetchall()


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_as_sql(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], ORACLES[name]) is None


def test_op12(spark, con, library):  # noqa: F811
    want = []
    for doc_id, text, *_ in documents(con):
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, QUERIES["op12_two_tier_bpe"](spark, FOLDER).collect())) == sorted(want)


def test_op13(spark, con):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    rows = documents(con)
    groups = {}
    for r in sorted(rows, key=lambda r: r[0]):
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([leaf(r, r[1]) for r in groups[g]], 8) for g in order]
    root, above = tree([subroot for subroot, _ in trees], 8)
    want = []
    for g, (subroot, paths), rest in zip(order, trees, above):
        for r, path in zip(groups[g], paths):
            node = leaf(r, r[1].translate(lower) if r[1] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else r[1])
            for left, right in path + rest:
                node = h(left + node + right)
            want.append((r[0], leaf(r, r[1]), subroot, root, h("".join(a + b for a, b in path + rest)), node, node == root))
    found = QUERIES["op13_merkle_manifest"](spark, FOLDER)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert {r[6] for r in want} == {True, False}
