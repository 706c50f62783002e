"""Session construction and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Key under which a cluster names its shared folder for checkpoints and
#: intermediate tables.
SHARED_DIR_KEY = "spark.checkpoint.dir"

#: Stored bytes that a task sorts at a time: some million rows, which stay in memory.
TASK_BYTES = 16 << 20


def local_session(app: str = "kpiloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_base(spark: SparkSession) -> str:
    """The folder for tables that all executors see: under the one the cluster
    names in ``spark.checkpoint.dir`` or, where that is unset, in the warehouse."""
    base = spark.conf.get(SHARED_DIR_KEY, None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    return f"{base.rstrip('/')}/kpiloom"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one job's tables or stream checkpoints, so that a lost
    executor costs nothing but a retry."""
    return f"{shared_base(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def small_tasks(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs run inside read and shuffle a source of ``size`` bytes in tasks of
    ``TASK_BYTES`` at most. Stored rows are several times larger once they are
    sorted, and what a task cannot hold it spills, so a task must not grow with
    the source. Only for jobs that start and end inside."""
    split, parts = "spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions"
    before = {key: spark.conf.get(key) for key in (split, parts)}
    spark.conf.set(split, str(TASK_BYTES))
    spark.conf.set(parts, str(max(int(before[parts]), -(-size // TASK_BYTES))))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
