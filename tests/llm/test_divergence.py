import re
from collections import Counter

import pytest
from corpus import ASCII_LOWER

from paperfield.llm.divergence import Audit, _count, document_terms, kept_terms, source_divergence

ODD = [
    (1, "The cat, the CAT's hat été ÉTÉ", "en", "a"), (2, "the cat sat", "en", "a"), (3, "The dog; the cat.", "en", "b"), (4, "the x1y2z3 über", "en", "c"),
    (5, None, "en", "d"), (6, "", "en", None), (6, "the end", "en", None), (6, "the end", "en", None), (None, "the end", None, None), (8, "lone words", None, "x"),
    (9, "q" * 70 + " " + "q" * 71, "fr", "a"), (10, "q" * 70, "fr", "a"), (11, "q" * 70 + "-" + "q" * 69 + "é", "fr", "b"), (12, "la la", "fr", "b"), (13, "la", "fr", "c"), (14, "la 東京 東京", "fr", "c"),
    (15, "東京 東", "fr", "a"), (16, "東京", "fr", "d"), (17, "ab", "es", "a"), (18, "abc", "es", "a"), (19, "abcd", "es", "b"), (20, "abd ab", "es", "c"),
]


def frame(spark, rows):
    docs = spark.createDataFrame([(i, t, g, s) for i, t, g, s in rows], "doc_id long, text string, lang string, source string")
    for name in ("terms", "counts", "prefix", "n", "v", "value", "rank", "_id"):
        docs = docs.selectExpr("*", f"'clash' as {name}")
    return docs.repartition(3)


def kept(rows, least=3):
    docs = {}
    for _, text, lang, _ in rows:
        for term in set(words(text)):
            docs[lang or "", term] = docs.get((lang or "", term), 0) + 1
    return {k: n for k, n in docs.items() if n >= least}


def words(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def brute(rows, top=200):
    terms = {}
    for lang, term in kept(rows):
        terms.setdefault(lang, []).append(term)
    groups, whole = {}, {}
    for _, text, lang, source in rows:
        counts = Counter(w for w in words(text) if w in terms.get(lang or "", ()))
        groups.setdefault((lang or "", source or ""), Counter()).update(counts)
        whole.setdefault(lang or "", Counter()).update(counts)

    def share(counts, term, lang):
        return 1 + 1_000_000_000 * (counts[term] + 1) // (sum(counts.values()) + len(terms[lang]))

    found = []
    for (lang, source), counts in groups.items():
        own = {t: share(counts, t, lang) for t in terms.get(lang, ())}
        pairs = []
        for (other_lang, item), there in groups.items():
            if other_lang == lang and item != source:
                theirs = {t: share(there, t, lang) for t in own}
                pairs.append((item, sum((own[t] - theirs[t]) ** 2 // theirs[t] for t in own)))
        over = [(t, (own[t] - q) ** 2 // q) for t in own if counts[t] and own[t] > (q := share(whole[lang], t, lang))]
        for part, items, limit in (("pair", pairs, None), ("term", over, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
            found += [(lang, source, part, item, value, n + 1) for n, (item, value) in enumerate(ranked)]
    return sorted(found)


@pytest.mark.parametrize("audit", [Audit(), Audit(first=1, filter_bits=64, top=2), Audit(documents=1, first=3)])
def test_same_as_plain_python(spark, audit):
    docs = frame(spark, ODD)
    terms = document_terms(docs)
    found = {(r.lang, bytes(r.term).decode()): r.documents for r in kept_terms(terms, audit).collect()}
    assert found == kept(ODD, audit.documents)
    if audit.documents == 3:
        assert sorted(map(tuple, source_divergence(docs, audit).collect())) == brute(ODD, audit.top)


def test_no_documents_and_no_terms(spark):
    assert source_divergence(frame(spark, []).limit(0)).collect() == []
    few = [(1, "a", "en", "s"), (2, "b", "en", "t")]
    assert sorted(map(tuple, source_divergence(frame(spark, few)).collect())) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_long_text_in_pieces():
    text = ("Ab cd  é " * 400_000 + "z" * 3_000_000 + " end").encode()
    assert _count(text) == Counter(re.findall(rb"[A-Za-z\x80-\xff]+", text.lower()))


def test_equal_hashes_are_told_apart(monkeypatch):
    import numpy as np

    import paperfield.llm.divergence as module

    monkeypatch.setattr(module._Spans, "hashes", lambda self: np.zeros(len(self.size), np.uint64))
    words_ = [b"bb ", b"a ", b"bb ", b"a ", b"a ", b"a "]
    data = np.frombuffer(b"".join(words_) + bytes(8), np.uint8)
    sizes = np.array([len(w) for w in words_])
    code = np.array([0, 0, 0, 0, 1, 0])
    order, first = module._groups(code, module._Spans(data, np.cumsum(sizes) - sizes, sizes))
    groups = [[(code[i], words_[i]) for i in order[a:b]] for a, b in zip(first, [*first[1:], len(order)])]
    assert groups == [[(0, b"a ")] * 3, [(0, b"bb ")] * 2, [(1, b"a ")]]


def test_blocks_do_not_change_counts(spark, monkeypatch):
    import paperfield.llm.divergence as module

    docs = frame(spark, ODD)
    monkeypatch.setattr(module, "BLOCK", 8)  # in this process only; the pieces are compared below
    import pyarrow as pa

    rows = document_terms(docs).select("terms").toArrow().to_batches()
    for batch in rows:
        cut = [(r, s.values().to_pylist()[i]) for _, _, row, s in module._blocks(batch, 0) for i, r in enumerate(row)]
        assert cut == [(r, t + b" ") for r, v in enumerate(batch.column(0).cast(pa.binary()).to_pylist()) for t in v.split(b" ")[:-1]]
