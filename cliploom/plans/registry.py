"""Registry of the queries that run over the supplied tables.

A query is a callable ``(spark, tables_dir) -> DataFrame``; where ANSI SQL can express
it, the same result is stated as SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOGUE: dict[str, Entry] = {}


class Tables:
    """Lazy access to the supplied Parquet tables by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``."""

    def keep(fn: Callable[[Tables], DataFrame]):
        if name in CATALOGUE:
            raise ValueError(f"query registered twice: {name}")
        CATALOGUE[name] = Entry(lambda spark, folder: fn(Tables(spark, folder)), sql)
        return fn

    return keep
