import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from paperfield.llm.bpe import Bpe, PerfectHash, Splitter, decode_documents, encode_documents, unknown_points

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return Bpe(open(RANKS, "rb").read()), Splitter(public_tokenizers.PATTERN, unknown_points(public_tokenizers.PATTERN))


def texts():
    r = random.Random(5)
    points = lambda: chr(r.choice([r.randrange(32, 127), 32, 10, 0x3000, 0xE9, r.randrange(0x80, 0xD800), r.randrange(0xE000, 0x110000)]))
    odd = ["", " ", "\n\n  x", "it's they'LL 's", "word", " word", "<|endoftext|>", "\x00\x1c\x85", "a" * 5000, " " * 5000, "x1²½٣", "՘a࢏", "👨‍👩‍👧é"]
    odd += ["".join(points() for _ in range(r.randrange(200))) for _ in range(300)]
    return odd + ["".join(r.choice("ab \n'stllé") for _ in range(400)) for _ in range(100)]


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64))
    table = PerfectHash(keys)
    assert sorted(table.find(keys).tolist()) == list(range(len(keys)))
    other = table.find(keys + np.uint64(1))
    assert other.min() >= -1 and other.max() < len(keys)
    assert len(PerfectHash(keys[:0]).find(keys)) == len(keys)
    with pytest.raises(ValueError):
        PerfectHash(np.array([7, 7], np.uint64))


def test_same_as_library(coder, library):
    found = [ids.tolist() for ids in coder[0].encode(texts(), coder[1])]
    assert found == [library.encode_ordinary(t) for t in texts()]


def test_first_tier_has_whole_tokens_only(coder, library):
    tokens = [" the", "the", "zzqx", "ing", "b", "x" * 200]
    data = "".join(tokens).encode() + bytes(8)
    content = np.frombuffer(data, np.uint8)
    sizes = np.array([len(t) for t in tokens])
    from paperfield.llm.bpe import _words

    found = coder[0].whole(_words(content), np.cumsum(sizes) - sizes, sizes).tolist()
    single = [library.encode_ordinary(t) for t in tokens]
    assert found == [ids[0] if len(ids) == 1 else -1 for ids in single]


def test_second_tier_merges_every_token_to_itself(coder):
    sample = random.Random(2).sample(list(coder[0].ranks), 2000)
    assert all(list(coder[0].merged(t)) == [coder[0].ranks[t]] for t in sample)


def test_long_text_in_stretches(coder, library):
    text = "Wörter and words\n" * 130_000 + "q" * 100_000
    assert [i.tolist() for i in coder[0].encode(["a", text, "b"], coder[1])] == [library.encode_ordinary(t) for t in ("a", text, "b")]


def test_documents(spark, library):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no id"), (3, "again"), (3, "again"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'clash' as ids", "1 as decoded", "2 as _id").repartition(4)
    encoded = encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    found = sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in decode_documents(encoded, RANKS).collect()), key=repr)
    assert found == sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=repr)
    assert encode_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []
    with pytest.raises(Exception, match="not in the vocabulary"):
        decode_documents(spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>"), RANKS).collect()
    assert bytes(decode_documents(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), RANKS).first().decoded) == b""
