"""Connected components of large graphs by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom.session import remove_path, scratch_path

MAX_ROUNDS = 60
#: Rows of an Arrow batch while tables of whole texts are written; the default holds ten times as many.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of few rows inside the block, where texts may be long; the session's setting afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, lost executors read it again."""
    path = scratch_path(df.sparkSession, label)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")


def are_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge down and no node has edges on both sides."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("down")))).alias("e")).select("e.*")
    seen = ends.groupBy("node").agg(F.sum("down").alias("down"), F.count("*").alias("all"))
    return seen.where("down > 1 or (down > 0 and all > down)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; a component is named by its smallest node.

    A round joins every edge with the smallest neighbour of one end, found by an aggregation
    that combines before the shuffle, so a node with very many edges is never gathered in one
    task; the aggregation is written first, so that the join on that node's edges can be split.
    Rounds end when every component is a star: a logarithmic number in practice. Tables of
    earlier rounds are removed.
    """
    spark, made = edges.sparkSession, []

    def kept(df: DataFrame, label: str) -> DataFrame:
        made.append(scratch_path(spark, label))
        df.write.parquet(made[-1])
        return spark.read.schema(df.schema).parquet(made[-1])

    now = kept(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if are_stars(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
        around = both_ways(now)
        least = kept(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = around.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct()
        large = kept(large, "large-star")
        least = kept(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e")).select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
        now = kept(small.where(F.col("a") != F.col("b")).distinct(), "small-star")
        for path in made[:-1]:
            remove_path(spark, path)
        del made[:-1]
    raise RuntimeError("components did not settle")
