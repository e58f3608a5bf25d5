"""First sighting of every key over the whole life of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperfield.operators.skew import first_per_key
from paperfield.session import materialize, new_location
from paperfield.streaming.runner import run_available
from paperfield.streaming.state import BUCKETS, DELTAS, BucketedState


def first_seen_batch(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    return first_per_key(rows, [key], [F.col(c) for c in order])


def first_seen_stream(
    stream: DataFrame, key: str, order: list[str], root: str | None = None, event_time: str | None = None, delay: str = "1 hour",
    buckets: int = BUCKETS, deltas: int = DELTAS,
) -> DataFrame:
    """Rows with a key that no earlier batch held.

    Exact: each batch is cut to one row per key; keys that the Bloom filter of their bucket does not rule out are anti
    joined with the rows of those buckets.  A batch adds a delta to the buckets of its new keys and rewrites a bucket
    only when its deltas have become many.  With ``event_time`` a state store first drops near repeats, which then keeps
    any one of them.
    """
    spark = stream.sparkSession
    root = root or new_location(spark, "first-seen")
    index = BucketedState(spark, f"{root}/index", StructType(stream.schema.fields), [key], buckets=buckets, deltas=deltas)
    if event_time:
        stream = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])

    def handle(batch: DataFrame, number: int) -> None:
        firsts = materialize(first_seen_batch(batch, key, order), "firsts")
        index.write(index.unseen(firsts, number - 1), number)

    return index.read(run_available(stream, handle, f"{root}/checkpoint"))
