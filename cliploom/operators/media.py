"""Pixel statistics, lighting response, camera motion and image headers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.functions.media import luminance, png_fields
from cliploom.functions.vectors import clamp
from cliploom.operators import kernels as K

# Ranks of the luminance summary and the band averaged for the tint.
RANKS = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
BAND = (0.2, 0.65)
TINT_FLOOR = 0.65


def image_stats(pixels: DataFrame, by: Sequence[str], group_rows: int | None = None) -> DataFrame:
    """Luminance ranks, contrast and tint per image from (r, g, b) in 0–255.

    Pixels are ordered by (luminance, r, g, b). Equal pixels are counted first, so a flat
    image is a few rows; each colour then knows the rank interval it fills.
    """
    by, group_rows = list(by), group_rows or K.GROUP_ROWS
    r, g, b = (F.col(c) / 255.0 for c in ("r", "g", "b"))
    colours = pixels.groupBy(*by, "r", "g", "b").agg(F.count(F.lit(1)).alias("_n")).withColumn("_lum", luminance(r, g, b))
    ranked = K.running_total(colours, by, ["_lum", "r", "g", "b"], "_n", "_upto", group_rows)
    totals = colours.groupBy(*by).agg(F.sum("_n").alias("_all"))
    ranked = ranked.withColumn("_part", F.floor(F.col("_upto") / group_rows))
    totals = totals.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_all") / group_rows))))
    rows = ranked.join(totals, [*by, "_part"])
    n = F.col("_all")
    low = F.floor(n * F.lit(BAND[0]))
    high = F.greatest(low + 1, F.floor(n * F.lit(BAND[1])))
    before = F.col("_upto") - F.col("_n")
    inside = F.greatest(F.lit(0), F.least(F.col("_upto"), high) - F.greatest(before, low))
    stats = rows.groupBy(*by).agg(
        F.max("_all").alias("pixels"),
        *[F.min(F.when(F.col("_upto") > K.fraction_rank(q)(n), F.col("_lum"))).alias(name) for name, q in RANKS.items()],
        *[(F.sum(F.col(c) / 255.0 * inside) / F.sum(inside)).alias(f"mean_{c}") for c in ("r", "g", "b")],
    )
    top = F.greatest("mean_r", "mean_g", "mean_b", F.lit(0.001))
    contrast = (F.col("p90") - F.col("p10")) / F.greatest(F.lit(0.05), F.col("p90") + F.col("p10"))
    return stats.select(
        *by, "pixels", *RANKS, contrast.alias("contrast"),
        *[F.greatest(F.lit(TINT_FLOOR), F.col(f"mean_{c}") / top).alias(f"tint_{c}") for c in ("r", "g", "b")],
    )


def lighting_response(stats: DataFrame, direction: Column) -> DataFrame:
    """Bounded light gains from image statistics; missing or dark backgrounds are skipped."""
    p50, p90 = F.col("p50"), F.col("p90")
    reason = F.when(p90.isNull(), "missing_background_reference").when(p90 < 0.06, "background_too_dark_for_reliable_statistics")
    fill = F.greatest(F.lit(0.45), F.least(F.lit(1.0), F.lit(1.5) * p50 / F.greatest(F.lit(0.05), p90)))
    size = F.greatest(F.lit(0.5), F.lit(1.0) - F.lit(0.5) * clamp(F.col("contrast"), 0.0, 1.0))
    size = F.when(F.coalesce(direction, F.lit("unknown")).isin("diffuse", "unknown"), F.greatest(F.lit(0.85), size)).otherwise(size)
    out = stats.withColumn("reason", reason)
    used = F.col("reason").isNull()
    return out.withColumn("lighting_status", F.when(used, "adapted").otherwise("skipped")).withColumn(
        "fill_gain", F.when(used, fill)
    ).withColumn("size_gain", F.when(used, size))


# Grey frame size, compared lattice and offsets.
WIDTH, HEIGHT = 64, 36
LATTICE_X = (8, 56, 2)
LATTICE_Y = (6, 30, 2)
REACH = 4


def frame_pixels(gray: DataFrame, clip: Sequence[str], frame: str) -> DataFrame:
    """One row per frame with its grey values in scan order and whether all are there."""
    place = F.col("y") * WIDTH + F.col("x")
    packed = gray.groupBy(*clip, frame).agg(F.array_sort(F.collect_list(F.struct(place.alias("p"), F.col("gray").alias("g")))).alias("_px"))
    complete = F.size(F.array_distinct(F.transform("_px", lambda p: p["p"]))) == WIDTH * HEIGHT
    return packed.select(*clip, frame, F.transform("_px", lambda p: p["g"]).alias("pixels"), (complete & (F.size("_px") == WIDTH * HEIGHT)).alias("complete"))


def pack_frames(gray: DataFrame, clip: Sequence[str], frame: str) -> DataFrame:
    """The complete frames only, with their grey values in scan order."""
    return frame_pixels(gray, clip, frame).filter("complete").drop("complete")


def _best_shift():
    """Arrow-batched search over the 81 offsets: one vector operation per offset and batch."""
    offsets = [(dy, dx) for dy in range(-REACH, REACH + 1) for dx in range(-REACH, REACH + 1)]

    @F.pandas_udf("score double, dx int, dy int")
    def best_shift(first: pd.Series, second: pd.Series) -> pd.DataFrame:
        a = np.stack(first.to_numpy()).astype(np.int64).reshape(-1, HEIGHT, WIDTH)
        b = np.stack(second.to_numpy()).astype(np.int64).reshape(-1, HEIGHT, WIDTH)
        ys, xs = np.arange(*LATTICE_Y), np.arange(*LATTICE_X)
        base = a[:, ys[:, None], xs]
        # with this lattice every shifted point stays inside the frame
        scores = np.stack([np.abs(base - b[:, (ys + dy)[:, None], xs + dx]).mean(axis=(1, 2)) for dy, dx in offsets], axis=1)
        best = scores.argmin(axis=1)
        return pd.DataFrame({
            "score": scores[np.arange(len(best)), best],
            "dx": [offsets[i][1] for i in best], "dy": [offsets[i][0] for i in best],
        })

    return best_shift


def frame_shifts(frames: DataFrame, clip: Sequence[str], frame: str) -> DataFrame:
    """Best integer shift between each frame and the next, by mean absolute difference.

    Each pair of neighbouring frames meets once by an equi-join; the 81 offsets are tried
    inside the row, first in scan order wins ties.
    """
    first = frames.select(*clip, F.col(frame).cast("long").alias(frame), F.col("pixels").alias("_a"))
    second = frames.select(*clip, (F.col(frame) - 1).cast("long").alias(frame), F.col("pixels").alias("_b"))
    pairs = first.join(second, [*clip, frame])
    return pairs.select(*clip, frame, _best_shift()("_a", "_b").alias("_best")).select(*clip, frame, "_best.score", "_best.dx", "_best.dy")


def camera_motion(frames: DataFrame, clip: Sequence[str], frame: str) -> DataFrame:
    """Mean shift per clip, and its class: static, slow_pan, fast_pan, or unknown without a pair."""
    shifts = frame_shifts(frames, clip, frame)
    mean = shifts.groupBy(*clip).agg(
        F.avg("dx").alias("_dx"), F.avg("dy").alias("_dy"), (F.avg("score") / 255.0).alias("activity"),
        F.count(F.lit(1)).alias("measured_frame_pairs"),
    )
    out = frames.select(*clip).distinct().join(mean, list(clip), "left")
    size = F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy"))
    pan = lambda c: F.coalesce(clamp(F.col(c) / float(REACH), -1.0, 1.0), F.lit(0.0))
    return out.select(
        *clip,
        F.when(size.isNull(), "unknown").when(size < 0.35, "static").when(size < 1.5, "slow_pan").otherwise("fast_pan").alias("motion_class"),
        pan("_dx").alias("pan_x"), pan("_dy").alias("pan_y"), F.coalesce("activity", F.lit(0.0)).alias("activity"),
        F.coalesce("measured_frame_pairs", F.lit(0)).alias("measured_frame_pairs"),
    )


def png_header(files: DataFrame, content: str = "content") -> DataFrame:
    fields = png_fields(F.col(content))
    return files.select(*[c for c in files.columns if c != content], *[v.alias(k) for k, v in fields.items()])


def verify_images(files: DataFrame, plan: DataFrame, width: int, height: int, depth: int, color_type: int) -> DataFrame:
    """Per planned clip: exactly frames 1..n, every header valid and as expected.

    ``files`` holds clip, stem (the five-digit name) and content; ``plan`` clip and frame_count.
    """
    heads = png_header(files)
    fits = (F.col("width") == width) & (F.col("height") == height) & (F.col("depth") == depth) & (F.col("color_type") == color_type)
    number = F.when(F.col("stem").rlike("^[0-9]{5}$"), F.col("stem").cast("long"))
    seen = heads.withColumn("_f", number).groupBy("clip").agg(
        F.count(F.lit(1)).alias("files"), F.countDistinct("_f").alias("_frames"), F.min("_f").alias("_first"), F.max("_f").alias("_last"),
        F.count_if(~F.col("valid")).alias("invalid"), F.count_if(F.col("valid") & ~fits).alias("unexpected"),
    )
    out = plan.join(seen, "clip", "left").fillna(0, ["files", "_frames", "invalid", "unexpected"])
    verdict = (
        F.when(F.col("files") != F.col("frame_count"), "frame_count")
        .when(~((F.col("_frames") == F.col("frame_count")) & (F.col("_first") == 1) & (F.col("_last") == F.col("frame_count"))), "non_contiguous")
        .when(F.col("invalid") > 0, "invalid_image").when(F.col("unexpected") > 0, "unexpected_format").otherwise("ok")
    )
    return out.select("clip", "frame_count", "files", "invalid", "unexpected", verdict.alias("verdict"))


def throughput(runs: DataFrame, samples: DataFrame) -> DataFrame:
    """Benchmark summary per run: completed per hour (0 on failure), peak memory, mean utilisation."""
    side = samples.groupBy("run").agg(F.max("memory_used_mib").alias("peak_memory_mib"), F.avg("utilization").alias("mean_utilization"))
    hourly = F.when(F.col("success"), F.col("concurrency") * 3600 / F.col("wall_seconds")).otherwise(0.0)
    return runs.join(side, "run", "left").withColumn("completed_per_hour", hourly).fillna(0.0, ["peak_memory_mib", "mean_utilization"])
