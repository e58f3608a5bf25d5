"""Keyed state of micro-batches: hash buckets, a delta a batch, compaction, and a Bloom filter a bucket.

Batch n writes its rows below ``rows/v<n>`` and, last, ``index/v<n>``: for every bucket the versions that hold its rows
and the filter of its keys.  A replayed batch overwrites both, so no batch counts twice, and what a batch reads
depends on the buckets of its own keys, not on the size of the state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperfield.operators.skew import first_per_key
from paperfield.session import materialize

BUCKETS = 64
DELTAS = 8  # a bucket with more is written anew
FILTER_WORDS = 1024  # 64-bit words of the Bloom filter of a bucket
HASHES = 3

_INDEX = "bucket int, versions array<string>, filter array<bigint>"


class BucketedState:
    """Rows of ``schema``, one a key: the first by ``order``, or where it is None the one written last."""

    def __init__(
        self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], order: Sequence[Column] | None = None, buckets: int = BUCKETS, deltas: int = DELTAS
    ):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, list(keys)
        self.order, self.buckets, self.deltas = order, buckets, deltas
        self._stored = StructType([*schema.fields]).add("_version", "integer")

    def _index(self, number: int) -> DataFrame:
        if number < 0:
            return self.spark.createDataFrame([], _INDEX)
        return self.spark.read.schema(_INDEX).parquet(f"{self.root}/index/v{number}")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the keys of ``rows``; at most ``buckets`` numbers reach the driver."""
        return [r["b"] for r in rows.select(self.bucket().alias("b")).distinct().collect()]

    def _folders(self, number: int, buckets: Sequence[int] | None) -> list[str]:
        """Folders with the rows of buckets; at most ``buckets`` * (``deltas`` + 1)."""
        index = self._index(number)
        if buckets is not None:
            index = index.filter(F.col("bucket").isin(list(buckets)))
        return [f"{self.root}/rows/v{v}/bucket={r['bucket']}" for r in index.select("bucket", "versions").collect() for v in r["versions"]]

    def read(self, number: int, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows after batch ``number``, of all buckets or of some."""
        return self._current(self._folders(number, buckets)).select(self.schema.names)

    def _current(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._stored)
        rows = self.spark.read.schema(self._stored).parquet(*folders)
        return first_per_key(rows, self.keys, [*(self.order or []), F.desc("_version")])

    def lookup(self, keys: DataFrame, number: int) -> DataFrame:
        """The rows of the keys in ``keys``, a written table; only their buckets are read."""
        return self.read(number, self.touched(keys)).join(keys.select(*self.keys).distinct(), self.keys, "left_semi")

    def _bits(self) -> Column:
        """Places of a key in the filter of its bucket."""
        return F.array(*[F.pmod(F.xxhash64(F.lit(i), *self.keys), F.lit(64 * FILTER_WORDS)) for i in range(HASHES)])

    def unseen(self, rows: DataFrame, number: int) -> DataFrame:
        """The rows of ``rows``, a written table, whose key the state lacks after batch ``number``.

        Keys that the filter rules out need no look at the state; for the others their buckets are read.
        """
        filters = self._index(number).select(F.col("bucket").alias("_b"), "filter")
        joined = rows.withColumn("_b", self.bucket()).join(filters, "_b", "left")

        def is_set(at: Column) -> Column:
            word = F.col("filter")[F.shiftright(at, 6).cast("int")]
            return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))) != 0

        doubtful = F.col("filter").isNotNull() & F.forall(self._bits(), is_set)
        screened = materialize(joined.withColumn("_doubtful", F.coalesce(doubtful, F.lit(False))).drop("_b", "filter"), "screened")
        fresh = screened.filter(~F.col("_doubtful")).select(rows.columns)
        checked = screened.filter("_doubtful").select(rows.columns)
        known = self.read(number, self.touched(checked)).select(*self.keys)
        return fresh.unionByName(checked.join(known, self.keys, "left_anti"))

    def write(self, rows: DataFrame, number: int) -> None:
        """Add the rows of batch ``number``: at most one a key. Rows of the same key give way to them, as the order has it."""
        delta = rows.select(self.schema.names).withColumn("_version", F.lit(number)).withColumn("bucket", self.bucket())
        path = f"{self.root}/rows/v{number}"
        delta.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        written = self.spark.read.schema(StructType([*self._stored.fields]).add("bucket", "integer")).parquet(path)
        word = F.shiftright("_at", 6)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_at").bitwiseAND(63).cast("int"))
        words = written.select("bucket", F.explode(self._bits()).alias("_at")).groupBy("bucket", word.alias("w")).agg(F.bit_or(bit).alias("bits"))
        dense = words.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m"))
        added = dense.select("bucket", F.transform(F.sequence(F.lit(0), F.lit(FILTER_WORDS - 1)), lambda w: F.coalesce(F.col("m")[w.cast("long")], F.lit(0).cast("long"))).alias("_added"))
        joined = self._index(number - 1).join(added, "bucket", "full_outer")
        versions = F.coalesce("versions", F.array().cast("array<string>"))
        both = F.zip_with("filter", "_added", lambda a, b: a.bitwiseOR(b))
        index = joined.select(
            "bucket",
            F.when(F.col("_added").isNotNull(), F.array_append(versions, F.lit(str(number)))).otherwise(versions).alias("versions"),
            F.coalesce(both, "filter", "_added").alias("filter"),
        )
        target = f"{self.root}/index/v{number}"
        index.coalesce(1).write.mode("overwrite").parquet(target)
        index = self._index(number)
        long = index.filter(F.size("versions") > self.deltas + 1).select("bucket", "versions").collect()
        if long:
            folders = [f"{self.root}/rows/v{v}/bucket={r['bucket']}" for r in long for v in r["versions"]]
            merged = self._current(folders).withColumn("bucket", self.bucket())
            merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}c")
            index = materialize(index.withColumn("versions", F.when(F.size("versions") > self.deltas + 1, F.array(F.lit(f"{number}c"))).otherwise(F.col("versions"))), "index")
            index.coalesce(1).write.mode("overwrite").parquet(target)
