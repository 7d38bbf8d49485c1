"""Hard-negative mining with exact integer scores from a residue number system.

Vectors are quantised to whole numbers. Blocks of anchors and rows are multiplied modulo
several small primes, each product in float32, which holds every partial sum exactly; the
Chinese remainder theorem gives the signed scores back. Windows over each anchor's best rows
select its positives and, between two shares of a positive's score, its negatives.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliploom.llm.graph import written
from cliploom.llm.runs import group_slices

#: Float32 holds whole numbers up to this without a gap.
EXACT = 1 << 24
#: Columns of one float32 product; longer vectors are multiplied part by part.
PART = 256
#: Scores that are held at once, and the bound below which all scores must lie.
CELLS = 1 << 20
LARGEST = 1 << 61


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    positives: int = 5
    negatives: int = 10
    #: A negative's score lies between these percentages of the positive's.
    low: int = 30
    high: int = 90
    #: Rows, and anchors, that meet in one task.
    block: int = 8192
    anchor_block: int = 4096


def primes_for(bound: int) -> list[int]:
    """Largest primes whose residues multiply exactly in float32, two at least, until their product holds -bound .. bound."""
    half = math.isqrt((EXACT - 1) // PART)
    found, product, at = [], 1, 2 * half + 1
    while len(found) < 2 or product <= 2 * bound:
        if all(at % k for k in range(2, math.isqrt(at) + 1)):
            found.append(at)
            product *= at
        at -= 1
    return found


def centred(x: np.ndarray, prime: int) -> np.ndarray:
    """Residues between -prime/2 and prime/2 as float32."""
    r = x % prime
    return np.where(r > prime // 2, r - prime, r).astype(np.float32)


def exact_scores(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """``a @ b.T`` of whole numbers, exact while the products lie within half the product of the primes."""
    total, modulus = np.zeros((len(a), len(b)), np.int64), 1
    for p in primes:
        x, y = centred(a, p), centred(b, p)
        residue = np.zeros(total.shape, np.int64)
        for at in range(0, a.shape[1], PART):
            residue += (x[:, at : at + PART] @ y[:, at : at + PART].T).astype(np.int64)
        # the next mixed-radix digit
        total += modulus * ((residue - total) % p * pow(modulus % p, -1, p) % p) if modulus > 1 else residue % p
        modulus *= p
    return np.where(total > modulus // 2, total - modulus, total)


def best_of(score: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor and row of each anchor's ``k`` best allowed scores, ties to smaller ids."""
    lowest = np.iinfo(np.int64).min
    held = np.where(allowed, score, lowest)
    if held.shape[1] > k:
        held = np.where(held >= np.partition(held, -k, axis=1)[:, -k][:, None], held, lowest)
    anchor, row = np.nonzero(held > lowest)
    order = np.lexsort((ids[row], -held[anchor, row], anchor))
    anchor, row = anchor[order], row[order]
    first = np.searchsorted(anchor, np.arange(len(score)))
    kept = np.arange(len(anchor)) - first[anchor] < k
    return anchor[kept], row[kept]


def code_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), -1)


def quantised(rows: DataFrame, scale: int) -> DataFrame:
    """``rows`` with ``codes``: floor of ``scale`` times each number of ``vector``, as bytes of longs, null where a number is null, not finite or out of range; and ``square``, their squares' sum."""
    schema = rows.select("*").schema.add("codes", "binary").add("square", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            with np.errstate(invalid="ignore", over="ignore"):
                values = np.floor(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * scale)  # a null is NaN
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            whole = np.where(np.abs(values) < LARGEST, values, 0).astype(np.int64)
            fits = np.where(np.isfinite(values), values, 0.0)
            square = [float(fits[e - s : e] @ fits[e - s : e]) for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
            good = (bad[ends] == bad[ends - sizes]) & lists.is_valid().to_numpy(zero_copy_only=False)
            raw = whole.tobytes()
            cut = [raw[(e - s) * 8 : e * 8] if ok else None for e, s, ok in zip(ends.tolist(), sizes.tolist(), good.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cut, pa.binary()), pa.array(square, pa.float64())], names=[*batch.schema.names, "codes", "square"])

    return rows.mapInArrow(run, schema)


_PICKED = "anchor_id long, positive_id long, positive_score long, row_id long, score long"


def met(rows: DataFrame, asked: DataFrame, settings: Settings, pick: Callable, alike: bool) -> DataFrame:
    """What ``pick`` takes of each block of ``rows(vec_id, label, codes)`` for each block of ``asked(.., positives)``, of the same label if ``alike``.

    Rows and anchors are dealt into parts that meet each other, as many as fit their blocks; a
    part's picks are a fixed number for each anchor and positive.
    """
    columns = ["vec_id", "label", "codes"]
    label = F.col("label") if alike else F.lit(0).cast("long")
    if alike:
        salts = rows.groupBy("label").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("salts"))
        turns = asked.groupBy("label").agg(F.ceil(F.count("*") / settings.anchor_block).cast("int").alias("turns"))
        groups = written(salts.join(turns, "label"), "negative-groups")
        rows, asked = rows.join(groups, "label"), asked.join(groups, "label")
    else:
        salts, turns = (F.lit(max(1, -(-df.count() // block))).cast("int") for df, block in ((rows, settings.block), (asked, settings.anchor_block)))
        rows, asked = (df.withColumns({"salts": salts, "turns": turns}) for df in (rows, asked))
    name = F.xxhash64(label, "salt", "turn").alias("grp")
    left = (
        rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int")).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        .select(name, F.lit(0).alias("kind"), *columns, F.lit(None).cast(asked.schema["positives"].dataType).alias("positives"))
    )
    right = (
        asked.withColumn("turn", F.pmod(F.xxhash64("vec_id"), F.col("turns")).cast("int")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .select(name, F.lit(1).alias("kind"), *columns, "positives")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in group_slices(batches, "grp"):
            kind = group.column("kind").to_numpy(zero_copy_only=False)
            own, asks = group.filter(pa.array(kind == 0)), group.filter(pa.array(kind == 1))
            if own.num_rows and asks.num_rows:
                step = max(1, CELLS // own.num_rows)
                for at in range(0, asks.num_rows, step):
                    yield from pick(own, asks.slice(at, step))

    return left.union(right).repartition("grp").sortWithinPartitions("grp", "kind").mapInArrow(run, _PICKED)


def hard_negatives(
    embeddings: DataFrame, is_anchor: Callable[[Column], Column], settings: Settings = Settings(),
    id_column: str = "vec_id", column: str = "embedding", label_column: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for each row for which ``is_anchor`` holds.

    A score is the whole-number inner product of two quantised vectors; higher ones come first,
    ties by smaller ids. An anchor's positives are its best other rows of the same label; a
    positive's negatives the best rows of other labels whose score lies between ``low`` and
    ``high`` per cent of the positive's. Null ids, labels and vectors, vectors with a null or
    non-finite number, and vectors of another length than most (empty ones, too) take no part.
    Of rows with the same id the one with the smallest label, then bytes of codes, does. Scores must lie
    within 61 bits; a ValueError says when a vector is too long for that. Anchors without a
    positive, and positives without a negative, give no rows; nor does an empty table. Other
    columns are ignored.
    """
    spark = embeddings.sparkSession
    read = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("long").alias("label"), F.col(column).cast("array<double>").alias("vector"))
    coded = quantised(read.where("vec_id is not null and label is not null and vector is not null"), settings.scale).where("codes is not null")
    single = coded.groupBy("vec_id").agg(F.min(F.struct("label", "codes", "square")).alias("row")).select("vec_id", "row.*")
    single = written(single, "negative-codes")
    sizes = single.groupBy(F.length("codes").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    if sizes is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    rows = single.where(F.length("codes") == sizes["size"])
    longest = rows.agg(F.max("square")).first()[0]
    if longest >= LARGEST:
        raise ValueError("scores of these vectors exceed 61 bits: choose a smaller scale")
    primes = primes_for(int(longest * (1 + 1e-9)) + 1)  # no score exceeds the longest vector's square
    anchors = rows.where(is_anchor(F.col("vec_id")))

    def scores(own: pa.RecordBatch, asks: pa.RecordBatch) -> tuple:
        ids, labels = (own.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        anchor, label = (asks.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        return ids, anchor, labels[None] == label[:, None], exact_scores(code_matrix(asks.column("codes")), code_matrix(own.column("codes")), primes)

    def like(own: pa.RecordBatch, asks: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, anchor, alike, score = scores(own, asks)
        a, r = best_of(score, ids, alike & (ids[None] != anchor[:, None]), settings.positives)
        none = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(anchor[a]), none, none, pa.array(ids[r]), pa.array(score[a, r])], names=["anchor_id", "positive_id", "positive_score", "row_id", "score"])

    def unlike(own: pa.RecordBatch, asks: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, anchor, alike, score = scores(own, asks)
        positives = asks.column("positives").to_pylist()
        for nth in range(max(map(len, positives))):
            has = np.array([len(p) > nth for p in positives])
            ask = [p[nth] for p in positives if len(p) > nth]
            goal = np.array([p["score"] for p in ask])
            # low * goal <= 100 * score <= high * goal, in whole numbers
            least, most = -((-settings.low * goal) // 100), settings.high * goal // 100
            some = score[has]
            a, r = best_of(some, ids, ~alike[has] & (some >= least[:, None]) & (some <= most[:, None]), settings.negatives)
            positive = np.array([p["row_id"] for p in ask])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (anchor[has][a], positive[a], goal[a], ids[r], some[a, r])],
                names=["anchor_id", "positive_id", "positive_score", "row_id", "score"])

    blank = F.lit(None).cast("array<struct<score:bigint,row_id:bigint>>").alias("positives")
    first = met(rows, anchors.select("*", blank), settings, like, alike=True)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "row_id")
    positives = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.positives)
    positives = positives.groupBy("anchor_id").agg(F.collect_list(F.struct("score", "row_id")).alias("positives"))  # a fixed number
    asked = written(anchors.join(positives.withColumnRenamed("anchor_id", "vec_id"), "vec_id"), "negative-anchors")
    second = met(rows, asked, settings, unlike, alike=False)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "row_id")
    return second.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.negatives).select(
        "anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


NEGATIVES_SQL = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS codes
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS alike,
    CAST(list_sum(list_transform(list_zip(a.codes, r.codes), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM valid a JOIN valid r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INT) AS rank, s.row_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.alike AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.row_id)
QUALIFY row_number() OVER w <= 10
"""
