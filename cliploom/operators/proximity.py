"""Nearest-point checks between named regions of a moving surface.

Coordinates are divided by the height of their frame, so one cell size serves all frames.
Points meet only in neighbouring cells of an equi-join; obstacles of a cell travel as
short lists and each (query point, list) pair yields one number, never the pairs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.functions.text import contains_any
from cliploom.session import pin

# Close distance, severe distance (body heights) and severe share of close points.
CLOSE = 0.004
SEVERE_DISTANCE = 0.0015
SEVERE_FRACTION = 0.03
PAIRS = {
    "left_hand_to_body": ("left_hand", "torso_and_legs"),
    "right_hand_to_body": ("right_hand", "torso_and_legs"),
    "left_to_right_hand": ("left_hand", "right_hand"),
}
# Group-name parts and least weight of each region.
TORSO_LEG_WORDS = ("def-spine", "def-thigh", "def-pelvis", "def-breast", "spine_", "thigh_", "pelvis")
LIST_POINTS = 256
SALTS = 16


def region_of(group: Column, weight: Column) -> Column:
    """Region of a weighted vertex group name, else null."""
    name = F.lower(group)
    return (
        F.when((name.contains("def-hand.l") | name.endswith("hand_l")) & (weight >= 0.70), "left_hand")
        .when((name.contains("def-hand.r") | name.endswith("hand_r")) & (weight >= 0.70), "right_hand")
        .when(contains_any(name, TORSO_LEG_WORDS) & (weight >= 0.60), "torso_and_legs")
    )


def is_finite(*columns: str) -> Column:
    """Whether all coordinates are numbers: neither null, NaN nor infinite."""
    fine = F.lit(True)
    for c in columns:
        fine = fine & F.coalesce(F.abs(F.col(c).cast("double")) < F.lit(float("inf")), F.lit(False))
    return fine


def _normalised(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coordinates in heights of their frame; the height meets the points salted."""
    height = points.groupBy(*keys).agg(F.greatest(F.max("z") - F.min("z"), F.lit(1e-6)).alias("_h"))
    copies = height.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    salted = points.withColumn("_salt", F.pmod(F.xxhash64("x", "y", "z"), F.lit(SALTS)))
    return salted.join(copies, [*keys, "_salt"]).select(
        *keys, "region", *[(F.col(a) / F.col("_h")).alias(a) for a in ("x", "y", "z")]
    )


def _cells(size: float) -> list[Column]:
    return [F.floor(F.col(a) / F.lit(size)).cast("long").alias(f"c{a}") for a in ("x", "y", "z")]


def _nearest_in_cells(queries: DataFrame, obstacles: DataFrame, keys: Sequence[str], size: float) -> DataFrame:
    """Distance to the nearest obstacle in the 27 cells around each query point, if any."""
    cell = [*keys, "cx", "cy", "cz"]
    placed = obstacles.select(*keys, "x", "y", "z", *_cells(size)).withColumn("_salt", F.pmod(F.xxhash64("x", "y", "z"), F.lit(SALTS)))
    counts = placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / LIST_POINTS).alias("_lists"))
    counts = counts.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    lists = (
        placed.join(counts, [*cell, "_salt"])
        .withColumn("_list", F.pmod(F.hash("x", "y", "z"), F.col("_lists")))
        .groupBy(*cell, "_list")
        .agg(F.collect_list(F.struct("x", "y", "z")).alias("_points"))
    )
    shift = F.explode(F.array(*[F.lit(d).cast("long") for d in (-1, 0, 1)]))
    around = queries.select(*keys, "x", "y", "z", *_cells(size))
    for axis in ("x", "y", "z"):
        around = around.withColumn("_d", shift).withColumn(f"c{axis}", F.col(f"c{axis}") + F.col("_d")).drop("_d")
    gap = lambda p: sum(((F.col(a) - p[a]) * (F.col(a) - p[a]) for a in ("y", "z")), (F.col("x") - p["x"]) * (F.col("x") - p["x"]))
    met = around.join(lists, cell).withColumn("_sq", F.array_min(F.transform("_points", gap)))
    return met.groupBy(*keys, "x", "y", "z").agg(F.sqrt(F.min("_sq")).alias("distance"))


BOXES = 8  # boxes along a cell's edge


def _nearest_boxes(queries: DataFrame, obstacles: DataFrame, keys: Sequence[str], size: float) -> tuple[DataFrame, DataFrame]:
    """Points of both sides whose boxes can hold the nearest pair of their group.

    Points become small boxes; of neighbouring boxes the least and the largest possible
    distance are known, and pairs of boxes whose least one exceeds the smallest of the
    largest ones are out. Rows are boxes, not points, however many points a cell holds.
    """
    axes = ("x", "y", "z")
    fine = [F.floor(F.col(a) / F.lit(size / BOXES)).cast("long").alias(f"b{a}") for a in axes]
    box = [*keys, *[f"b{a}" for a in axes]]

    def boxes(side: DataFrame, name: str) -> DataFrame:
        ends = [f(a).alias(f"{name}{end}{a}") for a in axes for f, end in ((F.min, "l"), (F.max, "h"))]
        made = side.select(*keys, *axes, *fine).groupBy(*box).agg(*ends)
        return made.select(*keys, *[F.col(f"b{a}").alias(f"{name}b{a}") for a in axes], *[f"{name}{e}{a}" for a in axes for e in "lh"],
                           *[F.floor(F.col(f"b{a}") / BOXES).cast("long").alias(f"c{a}") for a in axes])

    around = boxes(queries, "q")
    for a in axes:
        around = around.withColumn("_d", F.explode(F.array(*[F.lit(d).cast("long") for d in (-1, 0, 1)]))).withColumn(f"c{a}", F.col(f"c{a}") + F.col("_d")).drop("_d")
    apart, reach = F.lit(0.0), F.lit(0.0)
    for a in axes:
        gap = F.greatest(F.col(f"ql{a}") - F.col(f"oh{a}"), F.col(f"ol{a}") - F.col(f"qh{a}"), F.lit(0.0))
        span = F.greatest(F.col(f"qh{a}") - F.col(f"ol{a}"), F.col(f"oh{a}") - F.col(f"ql{a}"))
        apart, reach = apart + gap * gap, reach + span * span
    met = pin(around.join(boxes(obstacles, "o"), [*keys, "cx", "cy", "cz"]).select(*keys, *[f"{n}b{a}" for n in "qo" for a in axes], apart.alias("_apart"), reach.alias("_reach")))
    bound = met.groupBy(*keys).agg(F.min("_reach").alias("_bound"))
    # rounding must not part a pair from its box
    kept = met.join(bound, list(keys)).filter(F.col("_apart") <= F.col("_bound") * (1 + 1e-9))
    own = lambda side, n: side.select("*", *fine).join(kept.select(*keys, *[F.col(f"{n}b{a}").alias(f"b{a}") for a in axes]).distinct(), box, "left_semi").drop(*[f"b{a}" for a in axes])
    return own(queries, "q"), own(obstacles, "o")


def pair_points(points: DataFrame, keys: Sequence[str], pairs: Mapping[str, tuple[str, str]] = PAIRS) -> tuple[DataFrame, DataFrame]:
    """Distinct query points with their multiplicity, and distinct obstacles, per pair; only finite points take part."""
    scaled = _normalised(points.filter(is_finite("x", "y", "z")), keys)
    side = lambda i: F.array_compact(F.array(*[F.when(F.col("region") == regions[i], F.lit(name)) for name, regions in pairs.items()]))
    exploded = lambda i: scaled.select(*keys, F.explode(side(i)).alias("pair"), "x", "y", "z")
    queries = exploded(0).groupBy(*keys, "pair", "x", "y", "z").agg(F.count(F.lit(1)).alias("copies"))
    return queries, exploded(1).distinct()


def proximity_frames(points: DataFrame, clip: Sequence[str] = ("clip",), frame: str = "frame",
                     pairs: Mapping[str, tuple[str, str]] = PAIRS, close: float = CLOSE) -> DataFrame:
    """Per (clip, frame, pair): smallest distance, close points and their share.

    Close points are found at the close distance's own cell size. Where a frame has none,
    the cells are doubled until the smallest distance lies within one cell; of both sides
    only points in boxes that can hold the nearest pair are compared then. Points that are
    not finite take no part; ``invalid_points`` counts them per pair.
    """
    keys = [*clip, frame]
    queries, obstacles = (pin(side) for side in pair_points(points, keys, pairs))
    group = [*keys, "pair"]
    totals = queries.groupBy(*group).agg(F.sum("copies").alias("points"))
    totals = pin(totals.join(obstacles.select(*group).distinct(), group, "left_semi"))
    near = _nearest_in_cells(queries, obstacles, group, close).filter(F.col("distance") <= close)
    found = near.join(queries, [*group, "x", "y", "z"]).groupBy(*group).agg(
        F.min("distance").alias("minimum"), F.sum("copies").alias("close_points")
    )
    solved = pin(found)
    layers = [solved]
    open_groups = pin(totals.select(*group).join(solved.select(*group), group, "left_anti"))
    size = close
    while open_groups.limit(1).count():
        size *= 2.0
        some = _nearest_in_cells(
            *_nearest_boxes(queries.join(open_groups, group, "left_semi"), obstacles.join(open_groups, group, "left_semi"), group, size), group, size
        ).groupBy(*group).agg(F.min("distance").alias("minimum")).filter(F.col("minimum") <= size)
        solved = pin(some.withColumn("close_points", F.lit(0).cast("long")))
        layers.append(solved)
        open_groups = pin(open_groups.join(solved.select(*group), group, "left_anti"))
    result = layers[0]
    for layer in layers[1:]:
        result = result.unionByName(layer)
    named = F.explode(F.array_compact(F.array(*[F.when(F.col("region").isin(*regions), F.lit(name)) for name, regions in pairs.items()]))).alias("pair")
    broken = points.filter(~is_finite("x", "y", "z")).select(*keys, named).groupBy(*group).agg(F.count(F.lit(1)).alias("invalid_points"))
    return totals.join(result, group).join(broken, group, "left").select(
        *group, "minimum", "close_points", "points", (F.col("close_points") / F.col("points")).alias("close_fraction"),
        F.coalesce("invalid_points", F.lit(0)).alias("invalid_points"),
    )


def proximity_qc(frames: DataFrame, clip: Sequence[str] = ("clip",)) -> DataFrame:
    """Worst values per (clip, pair) and whether the pair is severe."""
    worst = frames.groupBy(*clip, "pair").agg(
        F.min("minimum").alias("minimum"), F.max("close_points").alias("max_close_points"), F.max("close_fraction").alias("max_close_fraction")
    )
    return worst.withColumn("severe", (F.col("minimum") < SEVERE_DISTANCE) & (F.col("max_close_fraction") > SEVERE_FRACTION))


def collision_status(clips: DataFrame, qc: DataFrame, clip: Sequence[str] = ("clip",), pairs: int = len(PAIRS)) -> DataFrame:
    """Per clip: failed, passed, or not_available where a region is missing.

    A missing region leaves the decision to the geometry check, so the gate still passes.
    """
    summed = qc.groupBy(*clip).agg(F.count(F.lit(1)).alias("_pairs"), F.max("severe").alias("_severe"))
    status = (
        F.when(F.coalesce(F.col("_pairs"), F.lit(0)) < pairs, "not_available").when(F.col("_severe"), "failed").otherwise("passed")
    )
    out = clips.select(*clip).distinct().join(summed, list(clip), "left").withColumn("collision_status", status)
    return out.withColumn("gate", F.when(F.col("collision_status") == "failed", "failed").otherwise("passed")).drop("_pairs", "_severe")
