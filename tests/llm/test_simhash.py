import random

from corpus import corpus, frame

from paperfield.llm import simhash


def bits(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


def test_edited_texts_and_likeness(spark):
    rows = corpus()
    found = sorted(simhash.fingerprint_documents(frame(spark, rows)).collect(), key=lambda r: r.doc_id)
    rows = sorted(rows)
    prints = {}
    for k, (r, (i, text)) in enumerate(zip(found, rows)):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        assert (r.doc_id, r.n_chars, r.edited) == (i, len(text), text[: len(text) - half] + after[:half])
        assert r.near_edited == 1 - bits(r.fingerprint, r.edited_fingerprint) / 128
        assert r.near_next == 1 - bits(r.fingerprint, found[(k + 1) % len(found)].fingerprint) / 128
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint and len(r.fingerprint) == 32
    long = [r for r in found if r.n_chars > 100]
    assert sum(r.near_edited for r in long) > sum(r.near_next for r in long) + 0.1 * len(long)


def test_one_row_null_and_repeated_ids_and_none(spark):
    one = simhash.fingerprint_documents(frame(spark, [(1, "abcd")])).collect()[0]
    assert (one.edited, one.near_next) == ("abab", 1)
    rows = [(None, "first text here"), (2, "a b"), (2, "a b"), (2, "c d"), (3, None)]
    found = sorted(((r.doc_id, r.edited) for r in simhash.fingerprint_documents(frame(spark, rows)).collect()), key=repr)
    assert found == sorted([(None, "first tea b"), (2, "a c"), (2, "a c"), (2, "c "), (3, "")], key=repr)
    assert simhash.fingerprint_documents(frame(spark, [])).collect() == []


def test_votes_are_those_of_weighted_terms(spark):
    """The bits agree with a count over the terms one by one."""
    text = "One two three two one two three four five five"
    words = text.lower().split()
    pairs = list(zip(words, [*words[1:], ""]))
    hashed = spark.createDataFrame(pairs, "a string, b string").selectExpr("a", "b", "xxhash64(a, b) h0", "xxhash64(1, a, b) h1").collect()
    votes, total = [0] * 128, 0
    for r in hashed:
        weight = 1 + min((len(r.a) + len(r.b)) // 4, 6)
        total += weight
        for k, h in enumerate((r.h0, r.h1)):
            for i in range(64):
                votes[64 * k + i] += weight * (h >> i & 1)
    want = [sum(1 << i for i in range(64) if 2 * votes[64 * k + i] > total) for k in (0, 1)]
    got = simhash.fingerprints(spark.createDataFrame([(1, text)], "_id long, text string")).collect()[0]
    assert [got.f0 % 2**64, got.f1 % 2**64] == want


def test_block_tables_find_all_within_the_radius(spark):
    r = random.Random(2)
    base = [r.getrandbits(128) for _ in range(12)]
    prints = list(base)
    for b in base:
        for n in (1, 2, 3, 4, 6):
            for bit in r.sample(range(128), n):
                b ^= 1 << bit
            prints.append(b)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    rows = [(i, signed(p & (2**64 - 1)), signed(p >> 64)) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "id long, f0 long, f1 long")
    got = {(x.query, x.id): x.distance for x in simhash.within_radius(df.filter("id % 3 = 0"), df, radius=3).collect()}
    want = {(i, j): bin(p ^ q).count("1") for i, p in enumerate(prints) if i % 3 == 0 for j, q in enumerate(prints) if bin(p ^ q).count("1") <= 3}
    assert got == want
    assert any(0 < d <= 3 for d in want.values())
