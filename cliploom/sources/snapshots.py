"""Sinks: versioned snapshots published by their success marker, and append logs."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

PREFIX = "snapshot-"


def folder_of(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def snapshots(spark: SparkSession, root: str) -> list[str]:
    """Complete snapshots under ``root``, oldest first."""
    system, path = folder_of(spark, root)
    if not system.exists(path):
        return []
    names = [s.getPath() for s in system.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith(PREFIX)]
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(str(p.toString()) for p in names if system.exists(marker(p, "_SUCCESS")))


def latest_snapshot(spark: SparkSession, root: str) -> str:
    found = snapshots(spark, root)
    if not found:
        raise FileNotFoundError(f"no complete snapshot under {root}")
    return found[-1]


def snapshot(df: DataFrame, root: str, format: str = "parquet") -> str:
    """Write the next snapshot; readers keep the previous one until this is complete."""
    target = f"{root}/{PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.format(format).save(target)
    return target


def write_index(df: DataFrame, root: str, order: str) -> str:
    """Full index rebuild as ordered JSON lines, published as one snapshot."""
    return snapshot(df.orderBy(order), root, "json")


def many_folders(writer: DataFrameWriter) -> DataFrameWriter:
    """For a write of very many folders: tasks move their own to the target, and the driver need not move each after the other.

    Rows of a folder must lie in one task.
    """
    return writer.option("mapreduce.fileoutputcommitter.algorithm.version", 2)


def append_events(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
