"""Tables written once and read many times.

Iterative fits and multi-pass operators read their input several times. They read it from a
table in a folder that all executors share, which outlives the executors and still lets Spark
prune columns. As such a table has a known size, Spark can choose by itself whether to broadcast it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_STAGED: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.

    Where that is not set, a folder in the warehouse, which must then be shared: a warehouse on
    the local disk is accepted on a single machine only.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        single = context.master == "local" or context.master.startswith("local[")
        if not single and (":" not in warehouse or warehouse.startswith("file:")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{warehouse.rstrip('/')}/_staged"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir() or folder
    return folder


def new_path(spark: SparkSession) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def staged(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    The table stays until :func:`clear_staged`, as results computed later may read it.
    """
    path = new_path(df.sparkSession)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession, keep: int = 0) -> None:
    """Delete what this process has staged (but the first ``keep``), once no result needs it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while len(_STAGED) > keep:
        path = hadoop.Path(_STAGED.pop())
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Whatever is staged inside is deleted at the end: use results before that."""
    before = len(_STAGED)
    try:
        yield
    finally:
        clear_staged(spark, before)
