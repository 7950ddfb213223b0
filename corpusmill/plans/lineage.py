"""Lineage cuts that survive lost executors, and access to the input tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; only Spark's reader ever opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A row group's usual size. Below it for each core, a table of few files is dealt out.
ROW_GROUP = 128 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df``'s rows dealt to all cores where its files are fewer than the cores and small.

    A file of one row group is one task, whatever its expressions cost. Larger inputs have row groups enough
    and aren't moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * ROW_GROUP and len(df.inputFiles()) < cores else df


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one where none is set, as in tests."""
    set_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if set_dir:
        return set_dir
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="corpusmill-")
    spark.sparkContext.setCheckpointDir(f"file://{made}")
    return f"file://{made}"


_passing: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables cut inside are removed at its end, but those cut with ``keep``; so nothing lazy that leaves it may read the others."""
    _passing.append([])
    try:
        yield
    finally:
        for name in _passing.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return a scan of it.

    A later job that loses an executor re-reads the files instead of running
    everything above again, and readers prune the columns they don't need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _passing and not keep:
        _passing[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)
