"""Frame-series operators: conditioning, resampling and motion checks.

A series has one row per (clip, frame) with dense frames from 0. Lags and short filters
run in haloed chunks, clip-wide facts come from partial aggregates, and anything that must
meet every frame is attached per (clip, chunk); no task ever holds a whole long clip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cliploom.functions.vectors import clamp, dist, dot, half_even, norm, sq_dist
from cliploom.operators import kernels as K
from cliploom.operators.catalog import distribution
from cliploom.session import pin

# Smoothing weights.
BINOMIAL_5 = (1.0, 4.0, 6.0, 4.0, 1.0)
TRIANGLE_5 = (1.0, 2.0, 3.0, 2.0, 1.0)
SOFT_3 = (0.25, 0.5, 0.25)


def clip_length(df: DataFrame, clip: Sequence[str], frame: str) -> DataFrame:
    """Last frame and frame count per clip."""
    return df.groupBy(*clip).agg(F.max(frame).cast("long").alias("last")).withColumn("frames", F.col("last") + 1)


def clip_ends(df: DataFrame, clip: Sequence[str], frame: str, columns: Sequence[str]) -> DataFrame:
    """First and last value of columns per clip, found by equi-joins on the frame number."""
    ends = clip_length(df, clip, frame)
    first = df.filter(F.col(frame) == 0).select(*clip, *[F.col(c).alias(f"first_{c}") for c in columns])
    last = df.select(*clip, F.col(frame).cast("long").alias("last"), *[F.col(c).alias(f"last_{c}") for c in columns])
    return ends.join(first, list(clip)).join(last, [*clip, "last"])


# ---- conditioning ------------------------------------------------------------------

def unwrap_degrees(df: DataFrame, clip: Sequence[str], frame: str, angle: str, out: str) -> DataFrame:
    """Remove full-turn jumps from a degree series.

    Each step is taken the short way round; the turns so far are a running sum. A step of
    exactly half a turn keeps its sign.
    """
    def columns(w):
        step = F.col(angle) - F.lag(angle).over(w)
        # turns to add so that the step lies within half a turn
        down = F.ceil((step - 180.0) / 360.0)
        up = F.ceil((-180.0 - step) / 360.0)
        return {"_turn": F.coalesce(F.when(step > 180.0, -down).when(step < -180.0, up), F.lit(0)).cast("double")}

    turned = K.in_chunks(df, clip, frame, columns)
    summed = K.series_running_sum(turned, clip, frame, "_turn", "_turns")
    return summed.withColumn(out, F.col(angle) + F.lit(360.0) * F.col("_turns")).drop("_turn", "_turns")


def smooth(
    df: DataFrame, clip: Sequence[str], frame: str, columns: Sequence[str],
    taps: Sequence[float] = BINOMIAL_5, passes: int = 2,
) -> DataFrame:
    """Zero-phase smoothing with edge values repeated; all passes share one shuffle.

    The halo is as wide as all passes together, so a frame's own value never depends on
    where the chunk was cut.
    """
    reach = len(taps) // 2
    norm_by = sum(taps)
    rows = K.spread(df, frame, reach * passes, reach * passes)
    w = K.chunk_window(clip, frame)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for _ in range(passes):
        updates = {}
        for column in columns:
            terms = None
            for offset, weight in zip(range(-reach, reach + 1), taps):
                if offset < 0:
                    value = F.coalesce(F.lag(column, -offset).over(w), F.first(column).over(whole))
                elif offset > 0:
                    value = F.coalesce(F.lead(column, offset).over(w), F.last(column).over(whole))
                else:
                    value = F.col(column)
                terms = F.lit(weight) * value if terms is None else terms + F.lit(weight) * value
            updates[column] = terms / F.lit(norm_by)
        rows = rows.withColumns(updates)
    return K.owned(rows)


def activity_time(df: DataFrame, clip: Sequence[str], frame: str, change: str, out: str = "activity_time") -> DataFrame:
    """Time warp by activity: 0.9 of the share of change so far plus 0.1 of linear time.

    Ends are pinned to 0 and 1; a clip without change keeps linear time.
    """
    summed = K.series_running_sum(df, clip, frame, change, "_sum")
    totals = df.groupBy(*clip).agg(F.sum(change).alias("_all"), F.max(frame).cast("long").alias("_last"))
    rows = K.attach_per_clip(summed, totals, clip, frame, "_last")
    linear = F.col(frame) / F.greatest(F.lit(1), F.col("_last"))
    warped = F.lit(0.9) * F.col("_sum") / F.when(F.col("_all") >= 1e-6, F.col("_all")) + F.lit(0.1) * linear
    value = (
        F.when(F.col("_all") < 1e-6, linear)
        .when(F.col(frame) == F.col("_last"), 1.0)
        .when(F.col(frame) == 0, 0.0)
        .otherwise(warped)
    )
    return rows.withColumn(out, value).drop("_sum", "_all", "_last")


def resample(
    df: DataFrame, clip: Sequence[str], frame: str, vector: str, n: int, windows: DataFrame | None = None,
    bias: Column | float = 1.0, nearest: Sequence[str] = (),
) -> DataFrame:
    """``n`` output frames per clip: linear between neighbours, nearest for flag columns.

    Positions are start + phase^bias × (count − 1), the bias held to 0.85–1.15. ``windows``
    (clip, start, count) limits the source range; by default the whole clip is used.
    """
    clip = list(clip)
    lengths = clip_length(df, clip, frame).select(*clip, "frames")
    if windows is None:
        windows = lengths.select(*clip, F.lit(0).cast("long").alias("start"), F.col("frames").alias("count"))
    grid = windows.join(lengths, clip)
    bias = bias if isinstance(bias, Column) else F.lit(float(bias))
    phase = F.col("out_frame") / F.lit(max(1, n - 1))
    position = F.col("start") + F.pow(phase, clamp(bias, 0.85, 1.15)) * (F.col("count") - 1)
    grid = (
        grid.withColumn("out_frame", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
        .withColumn("position", position)
        .withColumn("_low", F.floor("position"))
        .withColumn("_high", F.least(F.col("frames") - 1, F.col("_low") + 1))
        .withColumn("_near", half_even(F.col("position")).cast("long"))
        .withColumn("_weight", F.col("position") - F.col("_low"))
    )
    at = lambda key, cols: df.select(*clip, F.col(frame).cast("long").alias(key), *cols)
    out = grid.join(at("_low", [F.col(vector).alias("_a")]), [*clip, "_low"]).join(
        at("_high", [F.col(vector).alias("_b")]), [*clip, "_high"]
    )
    if nearest:
        out = out.join(at("_near", [F.col(c) for c in nearest]), [*clip, "_near"])
    mixed = F.zip_with("_a", "_b", lambda x, y: x + (y - x) * F.col("_weight"))
    return out.select(*clip, "out_frame", "position", mixed.alias(vector), *nearest)


def best_window(
    df: DataFrame, clip: Sequence[str], frame: str, joints: str, root: str, n: int, events: DataFrame | None = None
) -> DataFrame:
    """Start of the most active window of ``n`` frames per clip.

    Candidate starts are every ``n // 12`` frames, the (clamped) phase events and the last
    possible start. Score is the energy inside minus three times the energy at the two
    edges; ties prefer a calmer edge, then an earlier start. Clips no longer than ``n`` are
    used whole.
    """
    clip = list(clip)

    def columns(w):
        moved = sq_dist(F.col(joints), F.lag(joints).over(w)) + F.lit(4.0) * sq_dist(F.col(root), F.lag(root).over(w))
        return {"energy": F.coalesce(moved, F.lit(0.0))}

    energy = K.in_chunks(df, clip, frame, columns).select(*clip, F.col(frame).cast("long").alias("f"), "energy")
    prefix = K.series_running_sum(energy, clip, "f", "energy", "upto")
    lengths = clip_length(df, clip, frame).select(*clip, "frames")
    long = lengths.filter(F.col("frames") > n)
    grid = F.explode(F.sequence(F.lit(0).cast("long"), F.col("frames") - n, F.lit(max(1, n // 12)).cast("long")))
    starts = long.select(*clip, grid.alias("start")).unionByName(long.select(*clip, (F.col("frames") - n).alias("start")))
    if events is not None:
        moved = events.join(long, clip).select(
            *clip, F.greatest(F.lit(0), F.least(F.col("frames") - n, F.col("frame_index"))).cast("long").alias("start")
        )
        starts = starts.unionByName(moved)
    starts = starts.distinct().withColumn("_end", F.col("start") + (n - 1))
    head = prefix.select(*clip, F.col("f").alias("start"), (F.col("upto") - F.col("energy")).alias("_before"), F.col("energy").alias("_e0"))
    tail = prefix.select(*clip, F.col("f").alias("_end"), F.col("upto").alias("_upto"), F.col("energy").alias("_e1"))
    scored = starts.join(head, [*clip, "start"]).join(tail, [*clip, "_end"])
    boundary = F.col("_e0") + F.col("_e1")
    key = F.struct(
        (F.col("_upto") - F.col("_before") - F.lit(3.0) * boundary).alias("score"), (-boundary).alias("calm"), (-F.col("start")).alias("early")
    )
    best = scored.groupBy(*clip).agg(F.max(key).alias("_b")).select(
        *clip, (-F.col("_b.early")).alias("start"), F.lit(n).cast("long").alias("count"), F.col("_b.score").alias("score")
    )
    short = lengths.filter(F.col("frames") <= n).select(
        *clip, F.lit(0).cast("long").alias("start"), F.col("frames").alias("count"), F.lit(None).cast("double").alias("score")
    )
    return best.unionByName(short)


def sample_frames(rule: str, n: Column) -> Column:
    """Frame numbers (from 1) looked at by the checks: ``quartiles``, ``quarter_points`` or ``stride``."""
    n = n.cast("long")
    one = F.lit(1).cast("long")
    if rule == "quartiles":  # list indices 0, n//4, n//2, 3n//4, n-1 of the frames 1..n
        picks = F.array(one, F.floor(n / 4) + 1, F.floor(n / 2) + 1, F.floor(3 * n / 4) + 1, n)
        return F.array_sort(F.array_distinct(picks))
    if rule == "quarter_points":
        at = lambda q: F.greatest(one, half_even(n * F.lit(q)).cast("long"))
        return F.array_sort(F.array_distinct(F.array(one, at(0.25), at(0.5), at(0.75), n)))
    if rule == "stride":  # about thirty frames and the last
        step = F.greatest(one, F.floor(n / 30))
        return F.array_sort(F.array_distinct(F.concat(F.sequence(one, n, step), F.array(n))))
    raise ValueError(rule)


# ---- measures and checks -----------------------------------------------------------

STATE_POINTS = ("torso", "hand_l", "hand_r", "foot_l", "foot_r")
# Scale of each angle and blend in the feature vector.
STATE_WEIGHTS = {
    "yaw": 0.28, "pitch": 0.28, "head_yaw": 0.20, "head_pitch": 0.20,
    "foot_yaw_l": 0.12, "foot_yaw_r": 0.12, "hand_blend_l": 0.12, "hand_blend_r": 0.12,
}
# Limits of the checks, in body heights and per frame.
PRESET_LIMITS = {
    "amplitude": 0.075, "velocity": 0.10, "acceleration": 0.060, "start_end": 0.035, "terminal_velocity": 0.0035,
    "hand": 0.34, "foot": 0.24, "ground": -1e-6, "yaw_deg": 58.0, "pitch_deg": 40.0, "foot_yaw_deg": 24.0,
    "foot_side": -0.14, "hand_side": 0.12,
}
EARLY_PRESET_LIMITS = PRESET_LIMITS | {"amplitude": 0.05}
CLIP_LIMITS = {
    "amplitude": 0.05, "velocity": 0.10, "acceleration": 0.060, "start_end": 0.035, "ground": -1e-5,
    "hold_delta": 0.004, "hold_velocity": 0.003, "root_drift": 0.002, "foot_drift": 0.002,
}
OBSERVED_LIMITS = {"amplitude": 0.075, "velocity": 0.16, "acceleration": 0.10}
OUTWARD_ARMS = ("outward_sweep", "balance_open")


def state_features(height: Column | float = 1.0) -> Column:
    """Feature vector of a state: the five points, then scaled angles and blends."""
    height = height if isinstance(height, Column) else F.lit(float(height))
    scaled = [F.coalesce(F.col(c), F.lit(0.0)) * height * F.lit(k) for c, k in STATE_WEIGHTS.items()]
    return F.concat(*[F.col(p) for p in STATE_POINTS], F.array(*scaled))


def motion_steps(df: DataFrame, clip: Sequence[str], frame: str, vector: str) -> DataFrame:
    """Add the step length and its change from the frame before."""
    def columns(w):
        one, two = F.lag(vector, 1).over(w), F.lag(vector, 2).over(w)
        step = dist(F.col(vector), one)
        return {"velocity": step, "acceleration": F.abs(step - dist(one, two))}

    return K.in_chunks(df, clip, frame, columns, before=2)


def trajectory_measures(states: DataFrame, clip: Sequence[str], frame: str, height: Column | float = 1.0) -> DataFrame:
    """Per clip: amplitude, velocity, acceleration, closing gap, terminal behaviour, reach and ordering.

    Lengths are divided by ``height``.
    """
    clip = list(clip)
    height = height if isinstance(height, Column) else F.lit(float(height))
    rows = states.withColumn("feature", state_features(height)).withColumn("_h", height)
    ends = clip_ends(rows, clip, frame, ["feature", "torso", "foot_l", "foot_r"])
    stepped = motion_steps(rows, clip, frame, "feature")
    full = K.attach_per_clip(stepped, ends, clip, frame, "last")
    tail = F.greatest(F.lit(6), half_even(F.col("frames") * F.lit(0.04)).cast("long"))
    hold = F.greatest(F.lit(4), half_even(F.col("frames") * F.lit(0.04)).cast("long"))
    held = F.col(frame) >= F.col("frames") - hold
    foot = F.greatest(norm(F.col("foot_l")), norm(F.col("foot_r")))
    hand = F.greatest(norm(F.col("hand_l")), norm(F.col("hand_r")))
    top = lambda value, name: F.max(value / F.col("_h")).alias(name)
    zero = lambda value, name: F.coalesce(F.max(value / F.col("_h")), F.lit(0.0)).alias(name)
    return full.groupBy(*clip).agg(
        F.max("frames").alias("frames"),
        top(dist(F.col("feature"), F.col("first_feature")), "amplitude"),
        zero(F.col("velocity"), "velocity"),
        zero(F.col("acceleration"), "acceleration"),
        top(dist(F.col("first_feature"), F.col("last_feature")), "start_end"),
        zero(F.when(F.col(frame) >= F.col("frames") - tail, F.col("velocity")), "terminal_velocity"),
        F.max(hold).alias("hold_frames"),
        zero(F.when(held, dist(F.col("feature"), F.col("last_feature"))), "hold_delta"),
        zero(F.when(F.col(frame) > F.col("frames") - hold, F.col("velocity")), "hold_velocity"),
        zero(F.when(held, dist(F.col("torso"), F.col("last_torso"))), "root_drift"),
        zero(F.when(held, F.greatest(dist(F.col("foot_l"), F.col("last_foot_l")), dist(F.col("foot_r"), F.col("last_foot_r")))), "foot_drift"),
        top(hand, "hand"),
        top(foot, "foot"),
        F.min(F.least(F.col("foot_l")[2], F.col("foot_r")[2]) / F.col("_h")).alias("ground"),
        F.max(F.degrees(F.abs("yaw"))).alias("yaw_deg"),
        F.max(F.degrees(F.abs("pitch"))).alias("pitch_deg"),
        F.max(F.degrees(F.greatest(F.abs("foot_yaw_l"), F.abs("foot_yaw_r")))).alias("foot_yaw_deg"),
        F.min(F.col("foot_l")[0] - F.col("foot_r")[0]).alias("foot_side"),
        F.max(F.col("hand_l")[0] - F.col("hand_r")[0]).alias("hand_side"),
    )


def _verdict(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    found = F.array_compact(F.array(*[F.when(test, name) for name, test in tests.items()]))
    return df.withColumn("failures", found).withColumn("status", F.when(F.size("failures") == 0, "passed").otherwise("failed"))


def preset_verdict(measures: DataFrame, arms: Column, limits: dict[str, float] = PRESET_LIMITS) -> DataFrame:
    """Every failure of a preset's sampled trajectory. ``arms`` is the arm channel column."""
    m, lim = F.col, limits
    return _verdict(measures, {
        "nearly_static": m("amplitude") < lim["amplitude"],
        "frame_velocity": m("velocity") > lim["velocity"],
        "frame_acceleration": m("acceleration") > lim["acceleration"],
        "unnatural_recovery": (m("start_end") > lim["start_end"]) | (m("terminal_velocity") > lim["terminal_velocity"]),
        "hand_reach": m("hand") > lim["hand"],
        "foot_reach_or_ground": (m("foot") > lim["foot"]) | (m("ground") < lim["ground"]),
        "torso_joint_limit": (m("yaw_deg") > lim["yaw_deg"]) | (m("pitch_deg") > lim["pitch_deg"]),
        "foot_yaw_limit": m("foot_yaw_deg") > lim["foot_yaw_deg"],
        "leg_crossing_proxy": m("foot_side") < lim["foot_side"],
        "outward_arm_semantics": arms.isin(*OUTWARD_ARMS) & (m("hand_side") < lim["hand_side"]),
    })


def clip_verdict(measures: DataFrame, limits: dict[str, float] = CLIP_LIMITS) -> DataFrame:
    """Failures of an authored clip, with its settling at the end."""
    m, lim = F.col, limits
    return _verdict(measures, {
        "amplitude_too_small": m("amplitude") < lim["amplitude"],
        "velocity_too_high": m("velocity") > lim["velocity"],
        "acceleration_discontinuity": m("acceleration") > lim["acceleration"],
        "no_natural_recovery": m("start_end") > lim["start_end"],
        "ground_penetration": m("ground") < lim["ground"],
        "no_settle": (m("hold_delta") > lim["hold_delta"]) | (m("hold_velocity") > lim["hold_velocity"]),
        "terminal_drift": (m("root_drift") > lim["root_drift"]) | (m("foot_drift") > lim["foot_drift"]),
    })


def observed_verdict(measures: DataFrame, limits: dict[str, float] = OBSERVED_LIMITS) -> DataFrame:
    m, lim = F.col, limits
    return _verdict(measures, {
        "amplitude_too_small": m("amplitude") < lim["amplitude"],
        "discontinuous": (m("velocity") > lim["velocity"]) | (m("acceleration") > lim["acceleration"]),
    })


def descriptor(samples: DataFrame, clip: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """Per channel the minimum, maximum and relative place of the first largest magnitude.

    ``samples`` is long (clip, frame, channel, value); the result is one array of three
    numbers per channel in the given channel order, rounded to six digits.
    """
    clip = list(clip)
    stats = samples.groupBy(*clip, "channel").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.max(F.struct(F.abs("value").alias("a"), (-F.col("frame")).alias("f"))).alias("peak"),
        F.max("frame").alias("last"),
    )
    place = F.array_position(F.array(*[F.lit(c) for c in channels]), F.col("channel"))
    three = F.array(F.col("lo"), F.col("hi"), -F.col("peak.f") / F.greatest(F.lit(1), F.col("last")))
    rows = stats.filter(place > 0).select(*clip, F.struct(place.alias("p"), three.alias("v")).alias("c"))
    ordered = F.flatten(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["v"]))  # one entry per channel
    return rows.groupBy(*clip).agg(F.transform(ordered, lambda v: F.round(v, 6)).alias("trajectory_descriptor"))


# Share of the height below which points are left out of the frame.
FRAMING_CUTOFF = {"fullbody": 0.0, "halfbody": 0.40, "closeup_hair": 0.67}


def bounds(points: DataFrame, clip: Sequence[str], frame: str, framing: Column, group_rows: int = K.GROUP_ROWS) -> DataFrame:
    """Box per (clip, frame) of the points above the framing's cut-off height.

    Points are shuffled once: a window finds the height limits of its frame and the boxes are
    grouped where they are. Frames of more than ``group_rows`` points, which are fewer than one in
    so many points, are counted first; their limits are broadcast and their points only aggregated.
    """
    keys = [*clip, frame]
    heights = (F.min("z").alias("_lo"), F.max("z").alias("_hi"))
    share = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in FRAMING_CUTOFF.items() for x in kv]), F.col("_framing")), F.lit(0.0))
    cutoff = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * share
    keyed = points.withColumn("_framing", framing)
    for key in keys:
        keyed = keyed.filter(F.col(key).isNotNull())
    box = [*[F.min(a).alias(f"low_{a}") for a in ("x", "y", "z")], *[F.max(a).alias(f"high_{a}") for a in ("x", "y", "z")]]
    boxes = lambda rows: rows.filter(F.col("z") >= cutoff).groupBy(*keys).agg(*box)
    inside = lambda rows: boxes(rows.withColumns({h: f(F.col("z")).over(Window.partitionBy(*keys)) for h, f in (("_lo", F.min), ("_hi", F.max))}))
    if K.largest_group(keyed, keys) <= group_rows:
        return inside(keyed)
    dense = pin(keyed.groupBy(*keys).agg(*heights, F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > group_rows).drop("_n"))
    return inside(keyed.join(F.broadcast(dense), keys, "left_anti")).unionByName(boxes(keyed.join(F.broadcast(dense), keys)))


def envelope(frame_bounds: DataFrame, clip: Sequence[str]) -> DataFrame:
    """Union box of all frames of a clip."""
    return frame_bounds.groupBy(*clip).agg(
        *[F.min(f"low_{a}").alias(f"low_{a}") for a in ("x", "y", "z")], *[F.max(f"high_{a}").alias(f"high_{a}") for a in ("x", "y", "z")]
    )


# Limits of limb and geometry checks.
SEGMENT_RANGE = (0.985, 1.015)
FOOT_RANGE = (0.99, 1.01)
ARM_FOLD = 0.16
KNEE_FLOOR, KNEE_SHARE, KNEE_INWARD = 0.008, 0.72, -0.008
ANKLE_FLOOR, ANKLE_SHARE = 0.008, 0.35
ANKLE_LOWER = ("squat", "crouch_shift", "side_lunge")


def limb_qc(bones: DataFrame, clip: Sequence[str]) -> DataFrame:
    """Segment stability per (clip, chain): ratios to the first frame, reach, and failures.

    ``bones`` holds frame, chain, first, second and reach. A ratio's extremes are the
    extremes of the length over its first value, so one aggregation is enough.
    """
    start = lambda c: F.greatest(F.max(F.when(F.col("frame") == 0, F.col(c))), F.lit(1e-7))
    out = bones.groupBy(*clip, "chain").agg(
        (F.min("first") / start("first")).alias("first_min"), (F.max("first") / start("first")).alias("first_max"),
        (F.min("second") / start("second")).alias("second_min"), (F.max("second") / start("second")).alias("second_max"),
        F.min("reach").alias("reach_min"), F.max("reach").alias("reach_max"),
    )
    low, high = SEGMENT_RANGE
    changed = (F.least("first_min", "second_min") < low) | (F.greatest("first_max", "second_max") > high)
    folded = F.col("chain").startswith("arm_") & (F.col("reach_min") < ARM_FOLD)
    return out.withColumn("failures", F.array_compact(F.array(
        F.when(changed, F.concat("chain", F.lit(":segment_length_changed"))), F.when(folded, F.concat("chain", F.lit(":arm_fold"))),
    )))


def leg_order_qc(rows: DataFrame, clip: Sequence[str], lower: Column) -> DataFrame:
    """Side separation of knees and ankles, knees turning inward, and foot length per clip.

    ``rows`` holds frame, knee_gap, ankle_gap, knee_out_l, knee_out_r, foot_l and foot_r.
    """
    start = lambda c: F.max(F.when(F.col("frame") == 0, F.col(c)))
    foot = lambda c: [(F.min(c) / F.greatest(start(c), F.lit(1e-7))).alias(f"{c}_min"), (F.max(c) / F.greatest(start(c), F.lit(1e-7))).alias(f"{c}_max")]
    out = rows.withColumn("_lower", lower).groupBy(*clip).agg(
        F.min("knee_gap").alias("knee_min"), start("knee_gap").alias("knee_rest"),
        F.min("ankle_gap").alias("ankle_min"), start("ankle_gap").alias("ankle_rest"),
        F.min("knee_out_l").alias("knee_out_l_min"), F.min("knee_out_r").alias("knee_out_r_min"),
        *foot("foot_l"), *foot("foot_r"), F.max("_lower").alias("_lower"),
    )
    low, high = FOOT_RANGE
    tests = {
        "foot_L:foot_shape_changed": (F.col("foot_l_min") < low) | (F.col("foot_l_max") > high),
        "foot_R:foot_shape_changed": (F.col("foot_r_min") < low) | (F.col("foot_r_max") > high),
        "knee_ordering": F.col("knee_min") < F.greatest(F.lit(KNEE_FLOOR), F.col("knee_rest") * KNEE_SHARE),
        "knee_valgus_L": F.col("knee_out_l_min") < KNEE_INWARD,
        "knee_valgus_R": F.col("knee_out_r_min") < KNEE_INWARD,
        "crossed_ankles": F.col("_lower").isin(*ANKLE_LOWER) & (F.col("ankle_min") < F.greatest(F.lit(ANKLE_FLOOR), F.col("ankle_rest") * ANKLE_SHARE)),
    }
    return _verdict(out, tests).drop("_lower")


EXTENT_RANGE = (0.55, 1.45)
MAX_SIZE, MAX_ESCAPE, MIN_TRAVEL, MIN_TURN_DEG = 2.4, 0.8, 0.005, 2.0


def geometry_qc(boxes: DataFrame, clip: Sequence[str], height: Column) -> DataFrame:
    """Extent stability on five sampled frames per clip.

    ``boxes`` holds frame (from 0), size and center vectors, and per frame the control
    travel and turn against the first frame.
    """
    clip = list(clip)
    lengths = clip_length(boxes, clip, "frame")
    wanted = lengths.select(*clip, F.explode(sample_frames("quartiles", F.col("frames"))).alias("_f")).withColumn("frame", F.col("_f") - 1).drop("_f")
    picked = boxes.withColumn("frame", F.col("frame").cast("long")).join(wanted, [*clip, "frame"])
    base = boxes.filter("frame = 0").select(*clip, F.col("size").alias("_size0"), F.col("center").alias("_center0"), height.alias("_given"))
    rows = picked.join(base, clip)  # five rows per clip
    tall = F.greatest(F.col("_given"), F.col("_size0")[2], F.lit(1e-6))
    ratio = norm(F.col("size")) / F.greatest(norm(F.col("_size0")), F.lit(1e-6))
    out = rows.groupBy(*clip).agg(
        F.min(F.array_min("size")).alias("smallest_side"),
        F.min(ratio).alias("extent_min"), F.max(ratio).alias("extent_max"),
        F.max(F.array_max("size") / tall).alias("size_max"),
        F.max(dist(F.col("center"), F.col("_center0")) / tall).alias("escape_max"),
        F.max(F.col("travel") / tall).alias("travel_max"), F.max("turn_deg").alias("turn_max_deg"),
    )
    low, high = EXTENT_RANGE
    return _verdict(out, {
        "invalid_geometry": ~(F.col("smallest_side") > 1e-6),
        "extent_changed": (F.col("extent_min") < low) | (F.col("extent_max") > high),
        "geometry_exploded": F.col("size_max") > MAX_SIZE,
        "center_escaped": F.col("escape_max") > MAX_ESCAPE,
        "nearly_static": (F.col("travel_max") < MIN_TRAVEL) & (F.col("turn_max_deg") < MIN_TURN_DEG),
    })


PLANTED_STEP = 0.0025  # fixed value: a source step below this counts as planted


def planted_slip(df: DataFrame, clip: Sequence[str], frame: str, source: str, target: str) -> DataFrame:
    """Target steps of frames where the source foot stands still."""
    def columns(w):
        return {
            "source_step": dist(F.col(source), F.lag(source).over(w)),
            "slip": dist(F.col(target), F.lag(target).over(w)),
        }

    stepped = K.in_chunks(df, clip, frame, columns)
    return stepped.filter(F.col("source_step") < PLANTED_STEP)


def planted_slip_stats(df: DataFrame, clip: Sequence[str], frame: str, source: str, target: str, by: Sequence[str]) -> DataFrame:
    names = df.select(*by).distinct()
    return distribution(planted_slip(df, clip, frame, source, target), by, "slip", names, 0.0)


def rotation_angle_deg(a: Column, b: Column) -> Column:
    """Smallest angle between two unit quaternions."""
    return F.degrees(F.lit(2.0) * F.acos(F.least(F.lit(1.0), F.abs(dot(a, b)))))


def rotation_jump(df: DataFrame, clip: Sequence[str], frame: str, quaternion: str, by: Sequence[str]) -> DataFrame:
    """Largest and mean frame-to-frame rotation change."""
    stepped = K.in_chunks(df, clip, frame, lambda w: {"jump": rotation_angle_deg(F.col(quaternion), F.lag(quaternion).over(w))})
    return stepped.groupBy(*by).agg(F.max("jump").alias("max_jump_deg"), F.avg("jump").alias("mean_change_deg"))


# Limits of the retarget gate.
RETARGET_LIMITS = {
    "max_jump_deg": 60.0, "mean_change_deg": 0.15, "mean_error_deg": 5.0, "p95_error_deg": 12.0,
    "endpoint_p95": 0.08, "slip_p95": 0.0025, "slip_max": 0.0030,
}


def retarget_gate(measures: DataFrame) -> DataFrame:
    """Ordered limits on retarget measures; ``endpoint_p95`` is the worst of head and feet."""
    m, lim = F.col, RETARGET_LIMITS
    return _verdict(measures, {
        "rotation_jump": m("max_jump_deg") > lim["max_jump_deg"],
        "too_static": m("mean_change_deg") < lim["mean_change_deg"],
        "mean_angular_error": m("mean_error_deg") > lim["mean_error_deg"],
        "p95_angular_error": m("p95_error_deg") > lim["p95_error_deg"],
        "endpoint_trajectory": m("endpoint_p95") > lim["endpoint_p95"],
        "planted_slip_p95": m("slip_p95") > lim["slip_p95"],
        "planted_slip_max": m("slip_max") > lim["slip_max"],
        "mesh_collision": ~m("collision_status").eqNullSafe(F.lit("passed")),
    })


TRAVEL_CAP = 0.45  # fixed value: root travel allowed, in body heights


def travel_cap(df: DataFrame, clip: Sequence[str], frame: str, root: str, gain: Column) -> DataFrame:
    """Largest distance from the first frame and the motion gain it allows."""
    clip = list(clip)
    base = clip_length(df, clip, frame).join(df.filter(F.col(frame) == 0).select(*clip, F.col(root).alias("_origin")), clip)
    rows = K.attach_per_clip(df.withColumn("_gain", gain), base, clip, frame, "last")
    out = rows.groupBy(*clip).agg(F.max(dist(F.col(root), F.col("_origin"))).alias("extent"), F.max("_gain").alias("uncapped_gain"))
    capped = F.when(F.col("extent") > 1e-6, F.least(F.col("uncapped_gain"), F.lit(TRAVEL_CAP) / F.col("extent"))).otherwise(F.col("uncapped_gain"))
    return out.withColumn("gain", capped)


# ---- single-row geometry -----------------------------------------------------------

def place_window(start: Column, duration: Column, frames: Column, fps: int = 30) -> Column:
    """Clip start held so that the clip and 0.1 s fit into the background."""
    return F.least(start, F.greatest(F.lit(0.0), duration - frames / fps - 0.1))


def sample_instants(start: Column, duration: Column, frames: Column, fps: int = 30) -> Column:
    """Background instants (seconds) behind the quarter-point frames."""
    return F.transform(
        sample_frames("quarter_points", frames), lambda f: F.least(duration - 0.05, start + (f - 1) / F.lit(float(fps)))
    )


def fullbody_fit(
    z_min: Column, z_max: Column, x_span: Column, aspect: Column, height_fraction: Column, foot_y: Column,
    head_margin: float = 0.06, foot_margin: float = 0.06,
) -> Column:
    """Vertical fit of a standing figure; null for invalid bounds, aspect or fraction."""
    fraction = F.least(height_fraction, F.lit(1 - head_margin - foot_margin))
    valid = (z_max > z_min) & (aspect > 0) & (fraction > 0)
    tall = z_max - z_min
    span = F.greatest(tall / F.when(valid, fraction), x_span / F.when(valid, aspect * 0.88))
    share = tall / span
    foot = F.greatest(F.lit(head_margin) + share, F.least(F.lit(1 - foot_margin), foot_y))
    return F.when(valid, F.struct(
        (span * aspect).alias("ortho_scale"), (z_min + (foot - 0.5) * span).alias("center_z"),
        (foot - share).alias("top_y"), foot.alias("foot_y"), share.alias("height_fraction"),
    ))


def segment_clearance(point: Column, start: Column, end: Column, radius: Column, fallback: Column) -> Column:
    """Push a point out of a capsule around a segment; struct(point, correction)."""
    axis = F.zip_with(end, start, lambda a, b: a - b)
    length_sq = dot(axis, axis)
    offset = F.zip_with(point, start, lambda a, b: a - b)
    place = clamp(dot(offset, axis) / F.when(length_sq >= 1e-10, length_sq), 0.0, 1.0)
    place = F.coalesce(place, F.lit(0.0))
    closest = F.zip_with(start, axis, lambda s, a: s + a * place)
    away = F.zip_with(point, closest, lambda a, b: a - b)
    gap = norm(away)
    flat = norm(fallback)
    direction = F.when(gap > 1e-6, F.transform(away, lambda v: v / gap)).otherwise(F.transform(fallback, lambda v: v / flat))
    push = F.when(gap < radius, radius - gap).otherwise(0.0)
    return F.struct(F.zip_with(point, direction, lambda p, d: p + d * push).alias("point"), push.alias("correction"))
