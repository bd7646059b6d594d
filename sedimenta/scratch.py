"""Where intermediate tables go: the shared folder named by the session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    A local-mode session without the setting gets a temporary folder of its own;
    a cluster session must name a folder every executor can reach.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="sedimenta-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path under the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables materialized within are removed at its end, when nothing reads them."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            place, files = file_system(spark, path)
            files.delete(place, True)


def file_system(spark: SparkSession, path: str):
    """A path and its file system, as Hadoop's interface has them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(place), files


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage like a checkpoint, but the parquet copy is columnar (later stages
    read only the columns they need) and carries true sizes for join planning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def remove(table: DataFrame) -> None:
    """Delete the folder of a materialized table that nothing will read any more."""
    place, files = file_system(table.sparkSession, table.scratch_path)
    files.delete(place, True)


def local_frame(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A small frame from driver-side lists, with a size Spark knows when it plans
    joins (one made from Python rows counts as arbitrarily large)."""
    return spark.createDataFrame(pa.table(columns))
