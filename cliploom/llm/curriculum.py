"""Mixing sources to target weights along a time-varying curriculum.

Every source is a stream of its documents in a fixed pseudo-random order, read again from the
start until its target is used up. Over training time t from 0 to 1 a source is asked for
words at the rate ``target * (1 + tilt * (2 t - 1))``; a place in its stream therefore has the
time at which the integral of that rate reaches it, a quadratic that is solved for t.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the order key that name a block; a source's running total is summed by block first.
BLOCK_DIGITS = 3


@dataclass(frozen=True)
class Plan:
    """Weights and tilts go to the sources by name, over and over; null is the last source.

    ``share`` times all words are asked for, from no source more than ``repeats`` times its own.
    Tilts lie between -1 (all early) and 1 (all late).
    """

    weights: tuple[float, ...] = (5, 2, 1)
    tilts: tuple[float, ...] = (-0.5, 0.25, 0.75)
    share: float = 1.5
    repeats: int = 2


def turn(values: tuple[float, ...], rank: Column) -> Column:
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), (rank % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``sizes(skey, source_size)`` with each source's rank, tilt and target.

    Sources in the order of cap / weight: up to some source all stop at their caps, from it on
    the rest is dealt by weight. One row for each source is sorted in one task.
    """
    rank = F.row_number().over(Window.orderBy("skey")) - 1
    ranked = sizes.select("skey", "source_size", rank.alias("rank")).select(
        "*", turn(plan.weights, F.col("rank")).alias("weight"), turn(plan.tilts, F.col("rank")).alias("tilt"),
        (F.lit(plan.repeats) * F.col("source_size")).alias("cap"),
    )
    upward = Window.orderBy(F.col("cap") / F.col("weight"), "skey")
    everything = Window.partitionBy()
    level = (plan.share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(upward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / F.sum("weight").over(upward.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.select("*", level.alias("level"), F.row_number().over(upward).alias("place"))
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("place"))
    shared = F.min_by("level", fits).over(everything)
    return levels.withColumn("shared", shared).select(
        "skey", "source_size", "tilt", F.least(F.col("weight") * F.col("shared"), F.col("cap").cast("double")).alias("target")
    )


def shares(docs: DataFrame, plan: Plan = Plan(), carry: tuple[str, ...] = ()) -> DataFrame:
    """What the mix takes of each row of ``docs(doc_id, text, source)``.

    Columns: doc_id, source, size, source_size, target, tilt, before (words of the source ahead
    of it), taken, and those of ``docs`` named in ``carry``, as struct ``own``. Null text has size 0; sizes are words. Rows with the same id and size are
    interchangeable, so reruns agree. Other columns are ignored; an empty table gives no rows.
    Only ids, sources and sizes are shuffled, once, by source and block, so a source that holds
    most rows is spread over its blocks.
    """
    own = [F.struct(*carry).alias("own")] if carry else []
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(
        "doc_id", "source", *own, F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source")).alias("skey"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"),
    ).withColumn("block", F.substring("key", 1, BLOCK_DIGITS)).repartition("skey", "block")
    blocks = sized.groupBy("skey", "block").agg(F.sum("size").alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("skey").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    targets = source_targets(blocks.groupBy("skey").agg(F.sum("n").alias("source_size")), plan)
    offsets = blocks.select("skey", "block", ahead.alias("ahead")).join(targets, "skey")
    inside = Window.partitionBy("skey", "block").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sized.withColumn("within", F.sum("size").over(inside) - F.col("size")).join(offsets, ["skey", "block"])
    before = F.col("ahead") + F.col("within")
    return placed.select(
        "doc_id", "source", *(["own"] if carry else []), "size", "source_size", "target", "tilt", "key", before.alias("before"),
        sum((taken_in(k, before) for k in range(plan.repeats)), F.lit(0).cast("long")).alias("taken"),
    )


def taken_in(k: int, before: Column) -> Column:
    """Words taken in the k-th pass over the source: the part of the document that lies below the target."""
    goal = F.floor(F.col("target") + 0.5)
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), goal - k * F.col("source_size") - before))


def position(start: Column, target: Column, tilt: Column) -> Column:
    """Time at which ``target * ((1 - tilt) t + tilt t^2)`` reaches ``start``."""
    y, b = start / target, 1 - tilt
    return F.when(tilt == 0, y).otherwise((F.sqrt(F.greatest(b * b + 4 * tilt * y, F.lit(0.0))) - b) / (2 * tilt))


def first_position(share: DataFrame) -> Column:
    return F.when(share["taken"] > 0, position(share["before"].cast("double"), share["target"], share["tilt"]))


def by_position(share: DataFrame) -> DataFrame:
    """Shares in training order, each at its first position; those without one come last.

    A range sort, with the order key behind the position so that equal or absent positions split.
    """
    return share.withColumn("position", first_position(share)).sort(F.asc_nulls_last("position"), "key").drop("key")


def placements(share: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """One row for each document and pass that the mix reads, in training order: shares' columns, pass, words, position."""
    passes = F.array(*(F.struct(F.lit(k).alias("pass"), taken_in(k, F.col("before")).alias("words")) for k in range(plan.repeats)))
    rows = share.withColumn("p", F.explode(passes)).select("*", "p.*").drop("p").where("words > 0")
    start = (F.col("before") + F.col("pass") * F.col("source_size")).cast("double")
    return rows.withColumn("position", position(start, F.col("target"), F.col("tilt"))).sort("position", "key").drop("key")


def mixed(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The documents that training reads, in training order, with the columns of ``docs``.

    A document read in several passes has as many rows; where a source's target ends inside a
    document its row has the words up to there, joined by single spaces, and ``n_chars``, if
    there is such a column, is counted anew.
    """
    rows = placements(shares(docs, plan, tuple(docs.columns)), plan)
    words = F.array_join(F.slice(F.regexp_extract_all(F.col("own.text"), F.lit(WORD), F.lit(0)), F.lit(1), F.col("words").cast("int")), " ")
    text = F.when(F.col("words") < F.col("size"), words).otherwise(F.col("own.text"))
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*(changed.get(c, F.col(f"own.`{c}`")).alias(c) for c in docs.columns))


SHARES_SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents
), sources AS (
  SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY skey
), ranked AS (
  SELECT skey, source_size, 2 * source_size AS cap,
    [5.0::DOUBLE, 2.0, 1.0][CAST((row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS INT)] AS weight FROM sources
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY cap / weight, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked
), targets AS (
  SELECT skey, source_size, least(weight * (SELECT level FROM levels WHERE level <= cap / weight ORDER BY cap / weight, skey LIMIT 1), CAST(cap AS DOUBLE)) AS target FROM levels
), placed AS (
  SELECT s.*, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
    CAST(sum(size) OVER (PARTITION BY s.skey ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS before
  FROM sized s JOIN targets t USING (skey)
)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(size, goal - before)) + greatest(0, least(size, goal - source_size - before)) AS BIGINT) AS taken
FROM placed
"""
