"""Session helpers: durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, which all machines can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, which has no other
    machine to share with, falls back to a new temporary folder.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="loomwire-"))
        folder = context.getCheckpointDir()
    return folder


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written inside go to one folder, which is deleted at the end.

    Store the results inside the block: they are read from these tables.
    """
    folder = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    token = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and go on from there.

    The table outlives lost executors. Unlike a checkpoint it is computed once and has a known size,
    from which Spark chooses its joins.
    """
    spark = df.sparkSession
    path = f"{_SCRATCH.get() or shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_tasks(df: DataFrame) -> DataFrame:
    """For joins with a table that grows with the input: merged by key in the tasks, not broadcast through the driver.

    Sorted columns of numbers take few bytes in files and shuffles, by which Spark judges whether a table is small, and
    twenty times as many in a broadcast.
    """
    return df.hint("merge")
