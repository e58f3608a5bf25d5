import zlib

import pytest
from corpus import corpus, frame
from pyspark.sql import functions as F

from paperfield.llm.kdshard import kd_shards, shard_documents


def sizes(found):
    total = {}
    for r in found:
        total[r.shard] = total.get(r.shard, 0) + r.size
    return total


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_sizes_are_near_equal(spark, shards):
    rows = [(i, "word " * (i * 7 % 40)) for i in range(4000)] + [(10_000 + i, "copy " * 20) for i in range(2000)]
    found = shard_documents(frame(spark, rows), shards=shards).collect()
    total = sizes(found)
    assert sorted(total) == list(range(shards)) and len(found) == len(rows)
    mean = sum(total.values()) / shards
    assert max(abs(t - mean) for t in total.values()) < 0.02 * mean + 8 * 220
    for s in total:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    texts = dict(rows)
    assert all(r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in found)


def test_odd_rows(spark):
    rows = corpus(40) + [(None, None), (None, "x"), (7_000, "same"), (7_000, "same")]
    found = shard_documents(frame(spark, rows), target_bytes=2000).collect()
    assert len(found) == len(rows) and len(sizes(found)) > 5
    assert {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    assert shard_documents(frame(spark, []), shards=40).collect() == []
    assert shard_documents(frame(spark, []), target_bytes=10).collect() == []


def test_cuts_follow_the_widest_dimension(spark):
    """Two clusters far apart on one axis are parted there; then each is cut along the other."""
    rows = spark.range(800).select(F.lit(1).cast("long").alias("size"), F.xxhash64("id").alias("tie"), (F.col("id") % 2 * 100).cast("double").alias("x"), F.when(F.col("id") > 3, F.floor(F.col("id") / 2).cast("double")).alias("y"))
    found = kd_shards(rows, ["x", "y"], 4).collect()
    assert sorted(sum(1 for r in found if r.shard == s) for s in range(4)) == [200] * 4
    for s in range(4):
        assert len({r.x for r in found if r.shard == s}) == 1
