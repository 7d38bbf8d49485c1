"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom.llm import curriculum, ngram_join, packing, queries, recompression, toxicity
from cliploom.session import scratch_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels outside its held-out fold, scores below one half."""
    return toxicity.drop_toxic(docs, queries.table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs)


def without_long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that occur elsewhere, too; texts left empty stay as rows."""
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns))  # so that no name clashes
    cut = recompression.without_repeats(docs.select(own.alias("own"), "text"))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("own.n_chars") if "n_chars" in docs.columns else None)}
    return cut.select(*(changed.get(c, F.col(f"own.`{c}`")).alias(c) for c in docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as training reads them, once for each pass, each source up to its target."""
    return curriculum.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two length."""
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_near_copies),
    ("substring dedup", without_long_repeats),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]

#: The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
