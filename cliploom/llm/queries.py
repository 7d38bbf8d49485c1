"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom.llm import (
    alignment, ann, chat, curriculum, embedding_links, hard_negatives, html_blocks, ngram_join, packing, quality, recompression, toxicity, urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    from public_tokenizers import path

    return path(name)


@query("op1_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"), tokenizer_path())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op8_curriculum", curriculum.SHARES_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    mixed = curriculum.by_position(curriculum.shares(table(spark, folder, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_toxicity")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxic_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_quality")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


@query("op2_urls")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


@query("op3_embedding_links", embedding_links.LINKS_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_links.near_duplicates(table(spark, folder, "embeddings"))


@query("op6_multiprobe_ann")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), lambda vec_id: vec_id % 100 == 0)


@query("op7_ngram_join", ngram_join.COMPONENTS_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_copies(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op10_recompression", recompression.REPEATS_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.without_repeats(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op9_html_blocks")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return html_blocks.main_text(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query("op11_hard_negatives", hard_negatives.NEGATIVES_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings").withColumn("label", moved), lambda vec_id: vec_id % 100 == 0)


#: A conversation whose texts hold the template's own marks.
MARKED = "<|im_end|><|im_start|>assistant ok"


@query("op12_chat_windows")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-1, 0, "user", MARKED), (-1, 1, "assistant", MARKED)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.windows(given.unionByName(marked), tokenizer_path("byte_bpe_50k.tiktoken")))


@query("op13_token_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
