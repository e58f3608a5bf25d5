"""Leases that ran out before the next sign of life of their job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from paperfield.functions.retry import CRAWL_LEASE_SECONDS, plus_seconds
from paperfield.operators.skew import with_next
from paperfield.session import materialize, new_location
from paperfield.streaming.runner import VersionedTable, run_available

_EVENT = StructType(
    [StructField("job", StringType()), StructField("ts", TimestampType()), StructField("event_id", LongType()), StructField("kind", StringType())]
)
EXPIRED = StructType(
    [StructField("job", StringType()), StructField("claimed_at", TimestampType()), StructField("locked_until", TimestampType())]
)


def _expired(events: DataFrame, horizon: Column, lease_seconds: int) -> DataFrame:
    """Events with ``locked_until`` and whether the lease ran out before the next event or the horizon."""
    ahead = with_next(events, "job", "ts", "event_id").withColumn("_horizon", horizon)
    lock = F.when(F.col("kind") == "claim", plus_seconds(F.col("ts"), F.lit(lease_seconds)))
    locked = ahead.withColumn("locked_until", lock)
    return locked.withColumn(
        "expired", F.coalesce(F.col("locked_until") < F.coalesce("next_ts", "_horizon"), F.lit(False))
    )


def expired_leases(events: DataFrame, delay_seconds: int = 0, lease_seconds: int = CRAWL_LEASE_SECONDS) -> DataFrame:
    """Batch form over events (job, ts, event_id, kind), kind ``claim`` or anything else."""
    judged = _expired(events, _horizon(events, delay_seconds), lease_seconds).filter("expired")
    return judged.select("job", F.col("ts").alias("claimed_at"), "locked_until")


def _horizon(events: DataFrame, delay_seconds: int) -> Column:
    """Event time reached, less the delay; one value."""
    latest = events.agg(F.max("ts")).first()[0]
    return F.lit(latest).cast("timestamp") - F.make_dt_interval(secs=F.lit(delay_seconds))


def expired_leases_stream(
    stream: DataFrame, root: str | None = None, delay_seconds: int = 0, lease_seconds: int = CRAWL_LEASE_SECONDS
) -> DataFrame:
    """The same over a stream.  A lease runs out when event time passes it, whether or not its job has an event then.

    Between batches the last event is kept of jobs with an open lease, and of others until event time, less the
    delay, has passed it: finished jobs leave the state.
    """
    spark = stream.sparkSession
    root = root or new_location(spark, "leases")
    state = VersionedTable(spark, f"{root}/state", _EVENT)
    out = VersionedTable(spark, f"{root}/expired", EXPIRED)

    def handle(batch: DataFrame, number: int) -> None:
        events = batch.select(*_EVENT.names).unionByName(state.version(number - 1))
        horizon = _horizon(events, delay_seconds)
        judged = materialize(_expired(events, horizon, lease_seconds), "judged")
        out.write(judged.filter("expired").select("job", F.col("ts").alias("claimed_at"), "locked_until"), number)
        kind = F.when(F.col("expired"), "released").otherwise(F.col("kind"))
        last = F.max_by(F.struct("ts", "event_id", kind.alias("kind")), F.struct("ts", "event_id")).alias("_last")
        lasts = judged.groupBy("job").agg(last).select("job", "_last.*")
        state.write(lasts.filter((F.col("kind") == "claim") | (F.col("ts") >= horizon)), number)

    return out.up_to(run_available(stream, handle, f"{root}/checkpoint"))
