"""Session helpers: a tuned builder for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "cliploom", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for local runs; on a cluster the submitter supplies its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where the cluster names one.

    Only a local master, which is one machine, may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="cliploom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/cliploom/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table under the shared folder, on whatever file system it lies."""
    if "/cliploom/" not in path:
        raise ValueError(f"not a scratch path: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage and cut its lineage.

    Used where a result depends on how rows were placed (range slices) or where a
    driver loop would otherwise grow the plan each round; a lost executor then
    re-reads files instead of recomputing a placement.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
