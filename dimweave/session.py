"""Session helpers: building a session for tests/bench and finding scratch space.

Scratch space always lies in the folder that the session names in
``spark.checkpoint.dir`` (or that its context was given): the shared folder a
cluster uses for lineage cuts and staged tables.  Only a session that names
none gets one beside its warehouse; on a cluster that must then be a store that
all executors share, or it is an error.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "dimweave") -> SparkSession:
    """A local session configured the way the operators expect on a cluster:
    adaptive execution with partition coalescing and skew-join splitting on,
    and no UI server."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.bucketing.coalesceBucketsInJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def beside_warehouse(master: str, warehouse: str) -> str:
    """The folder of a session that names none; an error if executors on other
    machines could not see it."""
    one_machine = master == "local" or master.startswith("local[")
    if not one_machine and (warehouse.startswith(("file:", "/")) or "://" not in warehouse):
        raise ValueError(f"spark.checkpoint.dir is not set, and {warehouse} is local to the driver: "
                         "name a folder that all executors share")
    return warehouse.rstrip("/") + "/_checkpoints"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; set once, only if the session has none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not held.isDefined():
        named = named or beside_warehouse(spark.sparkContext.master, spark.conf.get("spark.sql.warehouse.dir"))
        spark.sparkContext.setCheckpointDir(named)
    return named or held.get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/dimweave/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
