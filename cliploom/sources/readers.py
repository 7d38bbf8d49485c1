"""Scans of manifests, registries, table snapshots, records and feature documents."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom import schemas
from cliploom.sources.snapshots import folder_of, latest_snapshot


def read_manifest(spark: SparkSession, path: str, schema: str, keep_corrupt: bool = False) -> DataFrame:
    """JSON-lines manifest with an explicit schema; malformed lines kept on request."""
    if keep_corrupt:
        schema = f"{schema}, _corrupt_record string"
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_registry(spark: SparkSession, path: str, schema: str = schemas.REGISTRY) -> DataFrame:
    """Tab-separated registry with a header line."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("enforceSchema", False).csv(path)


def read_table(spark: SparkSession, root: str, name: str, columns: list[str] | None = None,
               predicate: Column | str | None = None) -> DataFrame:
    """Newest complete snapshot of a table; predicate and columns reach the Parquet scan."""
    df = spark.read.parquet(latest_snapshot(spark, f"{root}/{name}"))
    if predicate is not None:
        df = df.filter(predicate)
    return df.select(*columns) if columns else df


def read_records(spark: SparkSession, root: str, schema: str = schemas.RECORD, pattern: str = "*/*/*.json") -> DataFrame:
    """One nested JSON document per clip folder, with the file it came from.

    Folders are listed by tasks, and of the files found those stay whose path fits the pattern.
    """
    reader = spark.read.schema(schema).option("multiLine", True)
    if not re.fullmatch(r"[\w.*?/-]+", pattern):  # other patterns are left to the file system, which expands them in the driver
        return reader.json(f"{root}/{pattern}").select("*", F.col("_metadata.file_path").alias("record_path"))
    found = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern.rsplit("/", 1)[-1]).json(root)
    system, folder = folder_of(spark, root)
    depth = len([x for x in system.makeQualified(folder).toUri().getPath().split("/") if x])
    fits = "^/" + "[^/]+/" * depth + re.escape(pattern).replace(r"\*", "[^/]*").replace(r"\?", "[^/]") + "$"
    below = F.regexp_replace(F.col("_metadata.file_path"), "^[A-Za-z0-9+.-]+:(//[^/]*)?", "")
    return found.select("*", F.col("_metadata.file_path").alias("record_path"), below.alias("_below")).filter(F.col("_below").rlike(fits)).drop("_below")


def read_features(spark: SparkSession, path: str, schema: str = schemas.FEATURES, one_document: bool = True) -> DataFrame:
    """Feature or catalogue documents; gzip is recognised by extension."""
    return (
        spark.read.schema(schema).option("multiLine", one_document).json(path)
        .select("*", F.col("_metadata.file_path").alias("feature_file"))
    )
