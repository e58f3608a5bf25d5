import hashlib
import random

import pytest
from pyspark.sql import functions as F

from paperfield.llm.merkle import coordinates, folded, leaf_digest, manifest, proof

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return h(field(row[0]) + field(row[3]) + field(row[2]) + field(row[4]) + field(text))


def tree(digests, fanout):
    paths, level = [[] for _ in digests], [(d, [i]) for i, d in enumerate(digests)]
    while len(level) > 1:
        over = []
        for at in range(0, len(level), fanout):
            run = level[at : at + fanout]
            for k, (_, members) in enumerate(run):
                for m in members:
                    paths[m].append(("".join(x for x, _ in run[:k]), "".join(x for x, _ in run[k + 1 :])))
            over.append((h("".join(x for x, _ in run)), [m for _, members in run for m in members]))
        level = over
    return level[0][0], paths


def brute(rows, fanout=8):
    """(doc_id, leaf, subroot, root, proof, root folded from the text in lower case)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(((r[0] is not None, r[0] or 0, leaf(r, r[1])), r))
    for members in groups.values():
        members.sort(key=lambda m: m[0])
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([key[2] for key, _ in groups[g]], fanout) for g in order]
    root, above = tree([subroot for subroot, _ in trees], fanout)
    found = []
    for g, (subroot, paths), rest in zip(order, trees, above):
        for (key, r), path in zip(groups[g], paths):
            node = leaf(r, r[1] and r[1].lower())
            for left, right in path + rest:
                node = h(left + node + right)
            found.append((r[0], key[2], subroot, root, h("".join(a + b for a, b in path + rest)), node))
    return sorted(found, key=repr)


def frame(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("leaf", "group", "pos", "members", "_word", "_id", "payload"):
        docs = docs.selectExpr("*", f"'clash' as `{name}`")
    return docs.repartition(5)


def collect(docs, fanout=8):
    found = manifest(docs, fanout=fanout, received=leaf_digest(text=F.lower("text")))
    again = folded(F.col("received"), F.col("path"))
    return sorted(map(tuple, found.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")), again).collect()), key=repr)


def odd_rows(n=700):
    r = random.Random(3)
    rows = [(i * (1 if i % 2 else 70_000) - 900, "Ab c é" * (i % 5), r.choice(["en", "en", "de", None, "", "日"]), "s", i) for i in range(n)]
    rows += [(None, "x", "en", None, 1), (None, "y", "en", "s", None), (7, None, "en", "s", 1), (7, "", "en", "s", 1), (7, "Q", "en", "s", 1), (7, "Q", "en", "s", 1)]
    return rows + [(2**63 - 1, "Z", "lone", "s", 1), (-(2**63), "Z", "en", "s", 1), (2**63 - 1, "Z" * 3_000_000, "en", "s", 1)]


@pytest.mark.parametrize("fanout", [8, 3])
def test_same_as_plain_tree(spark, fanout):
    assert collect(frame(spark, odd_rows()), fanout) == brute(odd_rows(), fanout)


def test_few_documents(spark):
    assert collect(frame(spark, [])) == []
    one = [(5, None, None, None, None)]
    assert collect(frame(spark, one)) == brute(one)
    assert collect(frame(spark, one))[0][1] == collect(frame(spark, one))[0][3]


def test_places_are_ranks(spark):
    ids = [None, None, -(2**63), -1, 0, 1, 63, 64, 64, 64, 4095, 4096, 10**12, 2**63 - 1]
    rows = spark.createDataFrame([("g", i, f"{n:02}", n) for n, i in enumerate(ids)] + [("h", 64, "x", 0)], "`group` string, doc_id long, leaf string, want long")
    assert all(r.pos == r.want and r.members == (14 if r.group == "g" else 1) for r in coordinates(rows).collect())


def test_tampering_shows(spark):
    rows = [(i, "Upper" if i % 3 else "lower", "en", "s", 5) for i in range(100)]
    found = manifest(frame(spark, rows), received=leaf_digest(text=F.lower("text")))
    bad = {r.doc_id for r in found.filter(folded(F.col("received"), F.col("path")) != F.col("root")).collect()}
    assert bad == {i for i, t, *_ in rows if t == "Upper"}
