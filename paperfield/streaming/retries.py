"""Retry state of jobs folded from their outcome events, whatever the order in which the events come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType, TimestampType

from paperfield.functions.retry import DOWNLOAD_RETRIES, backoff_seconds, plus_seconds
from paperfield.session import materialize, new_location
from paperfield.streaming.runner import run_available
from paperfield.streaming.state import BUCKETS, BucketedState

_EVENT = StructType([StructField("ts", TimestampType()), StructField("event_id", LongType())])
HISTORY = StructType([StructField("job", StringType()), StructField("won", _EVENT), StructField("failed", ArrayType(_EVENT))])


def outcome_history(events: DataFrame, retries: int = DOWNLOAD_RETRIES) -> DataFrame:
    """What can matter of the outcome events (job, ts, event_id, ok) of each job: first success, first failures.

    A job ends with its first success or its failure number ``retries + 1``, so later ones are dropped before the
    shuffle, and what a task holds of a job is bounded however many events it has.
    """
    window = Window.partitionBy("job", "ok").orderBy("ts", "event_id")
    ranked = events.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= retries + 1)
    event = F.struct("ts", F.col("event_id").cast("long").alias("event_id"))
    return ranked.groupBy("job").agg(
        F.min(F.when(F.col("ok"), event)).alias("won"), F.array_sort(F.collect_list(F.when(~F.col("ok"), event))).alias("failed")
    )


def merge_histories(old: DataFrame, new: DataFrame, retries: int = DOWNLOAD_RETRIES) -> DataFrame:
    """Histories of the jobs of ``new`` with what ``old`` has of them; the order of the two does not matter.

    An event that both have counts once.
    """
    earlier = old.select("job", F.col("won").alias("_won"), F.col("failed").alias("_failed"))
    joined = new.join(earlier, "job", "left")
    failed = F.array_distinct(F.concat("failed", F.coalesce("_failed", F.array().cast(ArrayType(_EVENT)))))
    won = F.when(F.col("won").isNull() | (F.col("_won") < F.col("won")), F.col("_won")).otherwise(F.col("won"))
    return joined.select("job", won.alias("won"), F.slice(F.array_sort(failed), 1, retries + 1).alias("failed"))


def job_states(histories: DataFrame, retries: int = DOWNLOAD_RETRIES) -> DataFrame:
    """(job, status, failures, changed_at, next_attempt) of each job."""
    before = F.filter("failed", lambda f: F.col("won").isNull() | (f < F.col("won")))
    tried = histories.select("job", "won", before.alias("_f")).withColumn("failures", F.size("_f"))
    lost = F.col("failures") > retries
    status = F.when(lost, "failed").when(F.col("won").isNotNull(), "completed").otherwise("queued")
    last = F.when(F.col("failures") > 0, F.element_at("_f", -1)["ts"])
    at: Column = F.when(lost | F.col("won").isNull(), last).otherwise(F.col("won.ts"))
    return with_next_attempt(tried.select("job", status.alias("status"), "failures", at.alias("changed_at")))


def with_next_attempt(state: DataFrame) -> DataFrame:
    """When a job that failed so far is due again."""
    wait = backoff_seconds(F.col("job"), F.greatest(F.col("failures") - 1, F.lit(1)))
    waiting = (F.col("status") == "queued") & (F.col("failures") > 0)
    return state.withColumn("next_attempt", F.when(waiting, plus_seconds(F.col("changed_at"), wait)))


def retry_states(events: DataFrame, retries: int = DOWNLOAD_RETRIES) -> DataFrame:
    """Batch form."""
    return job_states(outcome_history(events, retries), retries)


def retry_states_stream(stream: DataFrame, root: str | None = None, retries: int = DOWNLOAD_RETRIES, buckets: int = BUCKETS) -> DataFrame:
    """The same over a stream.  Histories are merged in their buckets, so late events give what the batch form gives."""
    spark = stream.sparkSession
    root = root or new_location(spark, "retries")
    state = BucketedState(spark, f"{root}/state", HISTORY, ["job"], buckets=buckets)

    def handle(batch: DataFrame, number: int) -> None:
        new = materialize(outcome_history(batch, retries), "outcomes")
        state.write(merge_histories(state.lookup(new, number - 1), new, retries), number)

    return job_states(state.read(run_available(stream, handle, f"{root}/checkpoint")), retries)
