"""Feature catalogue: vectors, robust scaling, contracts and used ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.functions.text import json_field
from cliploom.functions.vectors import clamp, norm, total
from cliploom.operators import kernels as K
from cliploom.schemas import OBSERVATION_SCHEMA, OBSERVATION_VERSION

# Joints summed into the arm and leg extents, minimum catalogue size, scale floor.
ARM_JOINTS = ("lefthand", "righthand", "leftforearm", "rightforearm")
LEG_JOINTS = ("leftfoot", "rightfoot", "leftleg", "rightleg")
MINIMUM_CATALOG = 1908
SCALE_FLOOR = 1e-5
CLIP = 3.0


def _extent(ranges: Column, joints: Sequence[str]) -> Column:
    parts = [F.coalesce(total(F.element_at(ranges, j)), F.lit(0.0)) for j in joints]
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out


def raw_vector(metrics: Column, frame_count: Column) -> Column:
    """14 numbers from nested motion metrics; missing parts count as zero."""
    field = lambda name: F.coalesce(metrics[name], F.lit(0.0))
    side = lambda name, key: F.coalesce(F.element_at(metrics[name], key).cast("double"), F.lit(0.0))
    summed = lambda name: F.coalesce(total(F.map_values(metrics[name])), F.lit(0.0))
    ranges = metrics["joint_axis_ranges"]
    return F.array(
        F.log1p(frame_count.cast("double")),
        F.log1p(field("motion_energy")),
        field("root_path_length"),
        F.coalesce(norm(metrics["root_displacement"]), F.lit(0.0)),
        field("body_yaw_range_deg") / 180.0,
        field("body_yaw_path_deg") / 360.0,
        side("contact_fraction", "left"),
        side("contact_fraction", "right"),
        side("contact_transitions", "left"),
        side("contact_transitions", "right"),
        _extent(ranges, ARM_JOINTS),
        _extent(ranges, LEG_JOINTS),
        summed("knee_angle_ranges") / 180.0,
        summed("elbow_angle_ranges") / 180.0,
    )


def valid_observations(observations: DataFrame, features: DataFrame) -> DataFrame:
    """Finished observations whose feature document exists in the supported version."""
    supported = features.filter(
        (F.col("schema") == OBSERVATION_SCHEMA) & (F.col("observation_version") == OBSERVATION_VERSION)
    ).drop("schema", "observation_version")
    return observations.filter(F.col("status") == "done").join(supported, "segment_id")


def catalog_floor(observations: DataFrame, minimum: int = MINIMUM_CATALOG) -> DataFrame:
    """One row: how many observations there are and whether a catalogue may be built from them."""
    return observations.agg(F.count(F.lit(1)).alias("observations")).withColumn(
        "verdict", F.when(F.col("observations") < minimum, "too_few_observations").otherwise("ok")
    )


def robust_stats(df: DataFrame, vector: str, group_rows: int | None = None) -> DataFrame:
    """Centre and scale per axis: upper median and quartile gap at fixed ranks."""
    long = df.select(F.posexplode(vector).alias("axis", "value"))
    picked = K.order_stats(
        long, ["axis"], "value",
        {"center": K.middle, "_low": K.lower_quartile, "_high": K.upper_quartile}, group_rows,
    )
    return picked.select("axis", "center", F.greatest(F.col("_high") - F.col("_low"), F.lit(SCALE_FLOOR)).alias("scale"))


def robust_scale(df: DataFrame, stats: DataFrame, vector: str, out: str = "vector") -> DataFrame:
    """Centre, scale and clip to ±3. Stats are one row per axis, folded to one row of arrays."""
    folded = stats.agg(F.array_sort(F.collect_list(F.struct("axis", "center", "scale"))).alias("_stats"))  # one element per axis
    scaled = F.zip_with(F.col(vector), F.col("_stats"), lambda v, s: clamp((v - s["center"]) / s["scale"], -CLIP, CLIP))
    return df.crossJoin(F.broadcast(folded)).withColumn(out, scaled).drop("_stats")


def unused(candidates: DataFrame, designs: DataFrame, key: str, path: str, payload: str = "action_params_json") -> DataFrame:
    """Candidates whose id is in no design payload; malformed payloads are ignored."""
    used = designs.select(json_field(F.col(payload), path).alias(key)).filter(F.coalesce(F.col(key), F.lit("")) != "").distinct()
    return candidates.join(used.withColumn(key, F.col(key).cast(candidates.schema[key].dataType)), key, "left_anti")


def distribution(
    df: DataFrame, by: Sequence[str], value: str, names: DataFrame | None = None, empty: float = 0.0,
    group_rows: int | None = None,
) -> DataFrame:
    """Count, mean, p95 and maximum per group; groups only listed in ``names`` get ``empty``."""
    by = list(by)
    p95 = K.order_stats(df, by, value, {"p95": K.p95_rank}, group_rows).select(*by, "p95")
    rest = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.max(value).alias("max")
    )
    out = rest.join(p95, by) if by else rest.crossJoin(F.broadcast(p95))
    if names is not None:
        out = names.select(*by).distinct().join(out, by, "left").fillna(0, ["count"]).fillna(empty, ["mean", "p95", "max"])
    return out
