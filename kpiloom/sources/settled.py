"""Tables derived from a source once for each state it is in."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kpiloom.session import shared_base, small_tasks
from kpiloom.sources import files

#: Bytes of source for each file written.
FILE_BYTES = 32 << 20


def source_state(source: DataFrame, path: str) -> tuple[str, int]:
    """A digest of the table's files, and their bytes.

    Names and total size tell states apart, and for a table of a single file the
    time it was written as well. Nothing of the table is read.
    """
    where, system = files.located(source.sparkSession, path)
    summary, status = system.getContentSummary(where), system.getFileStatus(where)
    parts = [*sorted(source.inputFiles()), str(summary.getLength())]
    if status.isFile():
        parts.append(str(status.getModificationTime()))
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:24], summary.getLength()


def settled(source: DataFrame, path: str, name: str, build: Callable[[int], DataFrame]) -> str:
    """The folder of what ``build`` derives from the source in its present state.

    ``build`` is given the number of files to write. The table is written under a
    name of its own and then moved, so readers see all of it or none, and a job
    that dies leaves nothing behind that is taken for the table. Later sessions
    with the same shared folder find it.
    """
    spark = source.sparkSession
    state, size = source_state(source, path)
    final = f"{shared_base(spark)}/settled/{name}-{state}"
    table = f"{final}/{name}.parquet"
    if not files.exists(spark, f"{table}/_SUCCESS"):
        own = f"{final}-{uuid.uuid4().hex}"
        parallel = spark.sparkContext.defaultParallelism
        with small_tasks(spark, size):
            build(max(parallel, -(-size // FILE_BYTES))).write.parquet(f"{own}/{name}.parquet")
        # Should another job have been faster, its table stays.
        if not files.move(spark, own, final):
            files.remove(spark, own)
    return table
