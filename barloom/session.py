"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results: day boundaries are UTC days, and bad arithmetic raises.
CORRECTNESS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Of a name that occurs twice in a JSON object the last counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that only change speed. Shuffle partitions start high and are merged at
# run time; joins pick a broadcast only from measured sizes; skewed join and
# rebalance partitions are split.
SPEED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def use_utc(spark: SparkSession) -> SparkSession:
    """Apply the result-changing settings to a session somebody else built."""
    for name, value in CORRECTNESS.items():
        spark.conf.set(name, value)
    return spark


def build_session(
    app_name: str = "barloom",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**SPEED, **CORRECTNESS, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a job's tables in the shared folder the cluster names.

    Only where none is named and all tasks run on this machine is a temporary folder used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back: later steps see the same rows whatever is lost."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
