"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Call-site capture costs several round trips to the JVM per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "paperfield", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs are designed for; keep the cluster's own where given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a scratch one in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="paperfield-"))
    return context.getCheckpointDir()


def new_location(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table or stream checkpoint."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage, survives the loss of executors and, unlike a row checkpoint, lets later steps
    prune columns and push filters into the scan.
    """
    path = new_location(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like :func:`materialize`, bucketed by ``key`` into as many buckets as there are shuffle partitions.

    A loop that joins the table on ``key`` again and again shuffles only its other side.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_location(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    spread = df.repartition(buckets, key)
    spread.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)
