import random
from collections import Counter
from itertools import combinations
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus import corpus, frame

from paperfield.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_fill_comes_closest():
    r = random.Random(1)
    for _ in range(200):
        lengths = [r.randint(1, 40) for _ in range(r.randint(1, 9))]
        count = Counter(lengths)
        chosen = packing.fill(sorted(count), count.__getitem__, 50)
        rest = Counter(lengths)
        rest[max(lengths)] -= 1
        others = list(rest.elements())
        sums = {sum(c) for n in range(len(others) + 1) for c in combinations(others, n)}
        assert sum(chosen) == max(max(lengths) + s for s in sums if max(lengths) + s <= 50)
        assert not Counter(chosen) - count


@pytest.mark.parametrize("sizes", [[], [5], [2048], [4097, 1], [1500] * 7, [1] * 5000, [2047] * 30, list(range(1, 900))])
def test_pack_keeps_every_token_and_pads_one_sequence(sizes):
    sequences = packing.pack(np.array(sizes, np.int64), 2048)
    seen = sorted((d, s, n) for q in sequences for d, s, n in q)
    for doc, size in enumerate(sizes):
        at = 0
        for _, s, n in [p for p in seen if p[0] == doc]:
            assert s == at and n > 0
            at += n
        assert at == size
    assert all(sum(n for *_, n in q) <= 2048 for q in sequences)
    assert len(sequences) == -(-sum(sizes) // 2048)


ODD = ["a<|ENDOFTEXT|>", "<|endoftext|>.", "…...", "x…...", "12.5,,", "'s.", "don't..", "İ.", "Σ!", "ΑΣ Σ", "x'", "é!'", "é.", "", None, "  ", "a<|endoftext|>b x", "É é", "x\x1cy\x85z q", "it's they're 123 4.5!!", "日本語 한국어.", "²² ½.", "a̸≠ b."]


def test_encoding_by_words_is_that_of_the_library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    texts = ODD + [t for _, t in corpus(40)]
    for by_words in (True, False):
        encoder = packing.Encoder(PATH, by_words)
        for _ in range(2):  # the second time all is known
            ids, counts = encoder.encode(pa.array(texts))
            want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END] for t in texts]
            assert counts.tolist() == [len(w) for w in want]
            assert ids.tolist() == [i for w in want for i in w]


def test_runs_are_cut_at_once_and_kept_as_one_array():
    marks = packing.Encoder.MARKS
    r = random.Random(2)
    runs = sorted({"".join(r.choices("aZ9'.,!-é²İ中\u0300", k=r.randint(0, 6))) for _ in range(500)} | {"", "...", "x...", "İ."})
    encoder = packing.Encoder(PATH, True)
    heads, tails = encoder._cut(pa.array(["unused", *runs]).slice(1))
    for run, head, tail in zip(runs, heads.to_pylist(), tails.to_pylist(), strict=True):
        bare = run.rstrip(marks)
        closed = bare != "" and bare[-1].lower()[-1].isalnum()
        assert (head, tail) == ((bare, run[len(bare) :]) if closed else (run, ""))
    for _ in range(2):
        encoder.encode(pa.array([" ".join(runs)]))
        assert isinstance(encoder.ids, np.ndarray) and encoder.bounds[-1] == len(encoder.ids)  # not an array a part
        assert len(encoder.bounds) == len(encoder.places) + 1


def test_pieces_and_sequences(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 1 << 9)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    rows = corpus() + [(None, "no id"), (1, "one"), (1, "one")]
    packed = packing.pieces(frame(spark, rows), PATH, window=64).cache()
    found = packed.collect()
    want = Counter(tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for _, t in rows)
    assert sum(r.length for r in found) == sum(len(k) * n for k, n in want.items())
    by_doc = {}
    for r in found:
        assert crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in rows:
        if i not in (None, 1):
            parts = sorted(by_doc[i], key=lambda r: r.start)
            ids = np.frombuffer(b"".join(bytes(r.ids) for r in parts), "<u4").tolist()
            assert ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
            assert {r.doc_tokens for r in parts} == {len(ids)}
            assert [r.start for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
    tokens = {r.sequence_id: r.tokens for r in packing.sequences(packed).collect()}
    for number in tokens:
        parts = sorted((r for r in found if r.sequence_id == number), key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
        assert tokens[number] == np.frombuffer(b"".join(bytes(r.ids) for r in parts), "<u4").tolist()
        assert len(tokens[number]) <= 64
    assert packing.pieces(frame(spark, []), PATH).collect() == []
