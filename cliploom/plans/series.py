"""Frame-series queries: events of a user are the frames of a clip, embeddings give vector states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.functions.vectors import clamp, half_even, lerp, smooth01, sq_dist
from cliploom.operators import kernels as K
from cliploom.operators import recurrences as R
from cliploom.operators import series as S
from cliploom.operators.blueprint import ARM_CHANNELS
from cliploom.plans.registry import Tables, query

CLIP = ["clip"]
FR = """fr AS (SELECT user_id AS clip, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame, value, event_type,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events)"""
ST = FR + """, st AS (SELECT clip, frame, n, event_type, embedding::DOUBLE[] AS v FROM fr JOIN embeddings ON vec_id = k)"""


def frames(t: Tables) -> DataFrame:
    rows = t.events.select(
        F.col("user_id").alias("clip"), "ts", "event_id", "value", "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    return K.number_rows(rows, CLIP, ["ts", "event_id"], "frame", start=0).drop("ts", "event_id")


def vectors(t: Tables) -> DataFrame:
    side = t.embeddings.select(F.col("vec_id").alias("k"), F.col("embedding").cast("array<double>").alias("v"))
    return frames(t).join(side, "k").select("clip", "frame", "event_type", "v")


def states(t: Tables) -> DataFrame:
    v = F.col("v")
    points = [F.slice(v, 1 + 3 * i, 3).alias(name) for i, name in enumerate(S.STATE_POINTS)]
    angles = [v[15 + i].alias(name) for i, name in enumerate(S.STATE_WEIGHTS)]
    return vectors(t).select("clip", "frame", *points, *angles)


@query("unwrap_degrees", f"""WITH RECURSIVE {FR}, a AS (SELECT clip, frame, round((value * 7) % 360, 2) AS angle FROM fr),
u AS (SELECT clip, frame, angle, angle AS r FROM a WHERE frame = 0 UNION ALL
  SELECT a.clip, a.frame, a.angle, CASE WHEN a.angle - u.r > 180 THEN a.angle - 360 * ceil((a.angle - u.r - 180) / 360)
    WHEN a.angle - u.r < -180 THEN a.angle + 360 * ceil((-180 - (a.angle - u.r)) / 360) ELSE a.angle END
  FROM u JOIN a ON a.clip = u.clip AND a.frame = u.frame + 1)
SELECT clip, frame, round(r, 4) AS unwrapped FROM u""")
def unwrap_degrees(t: Tables) -> DataFrame:
    rows = frames(t).select("clip", "frame", F.round((F.col("value") * 7) % 360, 2).alias("angle"))
    return S.unwrap_degrees(rows, CLIP, "frame", "angle", "r").select("clip", "frame", F.round("r", 4).alias("unwrapped"))


def _smooth_sql(taps, passes: int, column: str = "value") -> str:
    reach, parts, source = len(taps) // 2, [], "fr"
    for i in range(passes):
        terms = []
        for offset, weight in zip(range(-reach, reach + 1), taps):
            if offset < 0:
                terms.append(f"{weight} * coalesce(lag({column}, {-offset}) OVER c, first_value({column}) OVER w)")
            elif offset > 0:
                terms.append(f"{weight} * coalesce(lead({column}, {offset}) OVER c, last_value({column}) OVER w)")
            else:
                terms.append(f"{weight} * {column}")
        parts.append(
            f"p{i} AS (SELECT * REPLACE (({' + '.join(terms)}) / {sum(taps)} AS {column}) FROM {source} WINDOW c AS (PARTITION BY clip ORDER BY frame), "
            "w AS (PARTITION BY clip ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"
        )
        source = f"p{i}"
    return ", ".join(parts)


@query("smooth_binomial", f"WITH {FR}, {_smooth_sql(S.BINOMIAL_5, 2)} SELECT clip, frame, round(value, 10) AS value FROM p1")
def smooth_binomial(t: Tables) -> DataFrame:
    out = S.smooth(frames(t), CLIP, "frame", ["value"], S.BINOMIAL_5, 2)
    return out.select("clip", "frame", F.round("value", 10).alias("value"))


@query("smooth_triangle", f"WITH {FR}, {_smooth_sql(S.TRIANGLE_5, 2)} SELECT clip, frame, round(value, 6) AS value FROM p1")
def smooth_triangle(t: Tables) -> DataFrame:
    out = S.smooth(frames(t), CLIP, "frame", ["value"], S.TRIANGLE_5, 2)
    return out.select("clip", "frame", F.round("value", 6).alias("value"))


@query("smooth_soft", f"WITH {FR}, {_smooth_sql(S.SOFT_3, 1)} SELECT clip, frame, round(value, 6) AS value FROM p0")
def smooth_soft(t: Tables) -> DataFrame:
    out = S.smooth(frames(t), CLIP, "frame", ["value"], S.SOFT_3, 1)
    return out.select("clip", "frame", F.round("value", 6).alias("value"))


def changes(t: Tables) -> DataFrame:
    return K.in_chunks(
        frames(t), CLIP, "frame",
        lambda w: {"change": F.coalesce(F.abs(F.col("value") - F.lag("value").over(w)), F.lit(0.0))},
    )


@query("activity_time", f"""WITH {FR}, c AS (SELECT clip, frame, n, coalesce(abs(value - lag(value) OVER (PARTITION BY clip ORDER BY frame)), 0) AS change FROM fr),
s AS (SELECT *, sum(change) OVER (PARTITION BY clip ORDER BY frame) AS upto, sum(change) OVER (PARTITION BY clip) AS total FROM c)
SELECT clip, frame, round(CASE WHEN total < 1e-6 THEN frame / greatest(1, n - 1) WHEN frame = n - 1 THEN 1.0 WHEN frame = 0 THEN 0.0
  ELSE 0.9 * upto / total + 0.1 * frame / greatest(1, n - 1) END, 8) AS activity_time FROM s""")
def activity_time(t: Tables) -> DataFrame:
    out = S.activity_time(changes(t), CLIP, "frame", "change")
    return out.select("clip", "frame", F.round("activity_time", 8).alias("activity_time"))


@query("resample", f"""WITH {FR}, ends AS (SELECT clip, max(n) AS n FROM fr GROUP BY clip),
g AS (SELECT clip, n, o AS out_frame, pow(o / 23.0, 1.1) * (n - 1) AS pos FROM ends, generate_series(0, 23) AS s(o))
SELECT g.clip, g.out_frame, round(a.value + (b.value - a.value) * (pos - floor(pos)), 6) AS value, c.event_type
FROM g JOIN fr a ON a.clip = g.clip AND a.frame = floor(pos) JOIN fr b ON b.clip = g.clip AND b.frame = least(g.n - 1, floor(pos) + 1)
JOIN fr c ON c.clip = g.clip AND c.frame = round_even(pos, 0)""")
def resample(t: Tables) -> DataFrame:
    rows = frames(t).withColumn("vec", F.array("value"))
    out = S.resample(rows, CLIP, "frame", "vec", 24, bias=1.1, nearest=["event_type"])
    return out.select("clip", "out_frame", F.round(F.col("vec")[0], 6).alias("value"), "event_type")


@query("best_window", f"""WITH {ST}, e AS (SELECT *, coalesce(pow(list_distance(v[1:9], lag(v[1:9]) OVER c), 2) + 4 * pow(list_distance(v[10:12], lag(v[10:12]) OVER c), 2), 0) AS energy
  FROM st WINDOW c AS (PARTITION BY clip ORDER BY frame)),
p AS (SELECT *, sum(energy) OVER (PARTITION BY clip ORDER BY frame) AS upto FROM e),
cand AS (SELECT clip, frame AS start FROM p WHERE n > 40 AND frame <= n - 40 AND frame % 3 = 0 UNION SELECT clip, n - 40 FROM p WHERE n > 40
  UNION SELECT clip, greatest(0, least(n - 40, frame)) FROM p WHERE n > 40 AND event_type = 'purchase'),
sc AS (SELECT c.clip, c.start, b.upto - a.upto + a.energy - 3 * (a.energy + b.energy) AS score, a.energy + b.energy AS edge
  FROM cand c JOIN p a ON a.clip = c.clip AND a.frame = c.start JOIN p b ON b.clip = c.clip AND b.frame = c.start + 39),
r AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY score DESC, edge, start) AS rn FROM sc)
SELECT clip, start, CAST(40 AS BIGINT) AS count, round(score, 6) AS score FROM r WHERE rn = 1
UNION ALL SELECT clip, 0, max(n), NULL FROM fr GROUP BY clip HAVING max(n) <= 40""")
def best_window(t: Tables) -> DataFrame:
    rows = vectors(t).withColumn("joints", F.slice("v", 1, 9)).withColumn("root", F.slice("v", 10, 3))
    events = rows.filter("event_type = 'purchase'").select("clip", F.col("frame").alias("frame_index"))
    out = S.best_window(rows, CLIP, "frame", "joints", "root", 40, events)
    return out.select("clip", "start", "count", F.round("score", 6).alias("score"))


@query("sample_frames", f"""WITH {FR}, c AS (SELECT clip, max(n) AS n FROM fr GROUP BY clip),
q AS (SELECT clip, list_sort(list_distinct([1, n // 4 + 1, n // 2 + 1, 3 * n // 4 + 1, n])) AS a,
  list_sort(list_distinct([1, greatest(1, CAST(round_even(n * 0.25::DOUBLE, 0) AS BIGINT)), greatest(1, CAST(round_even(n * 0.5::DOUBLE, 0) AS BIGINT)), greatest(1, CAST(round_even(n * 0.75::DOUBLE, 0) AS BIGINT)), n])) AS b,
  list_sort(list_distinct(list_concat(generate_series(1, n, greatest(1, n // 30)), [n]))) AS s FROM c)
SELECT clip, array_to_string(a, ',') AS quartiles, array_to_string(b, ',') AS quarter_points, array_to_string(s, ',') AS stride FROM q""")
def sample_frames(t: Tables) -> DataFrame:
    lengths = S.clip_length(frames(t), CLIP, "frame")
    text = lambda rule: F.array_join(S.sample_frames(rule, F.col("frames")), ",").alias(rule)
    return lengths.select("clip", text("quartiles"), text("quarter_points"), text("stride"))


FEATURE = "list_concat(v[1:15], [v[16] * 0.28, v[17] * 0.28, v[18] * 0.20, v[19] * 0.20, v[20] * 0.12, v[21] * 0.12, v[22] * 0.12, v[23] * 0.12])"
MEASURES = ST + f""", f AS (SELECT *, {FEATURE} AS f FROM st),
w AS (SELECT *, list_distance(f, lag(f) OVER c) AS vel, list_distance(f, first_value(f) OVER c) AS amp, list_distance(f, last_value(f) OVER u) AS to_end,
  list_distance(first_value(f) OVER u, last_value(f) OVER u) AS gap, list_distance(v[1:3], last_value(v[1:3]) OVER u) AS rd,
  greatest(list_distance(v[10:12], last_value(v[10:12]) OVER u), list_distance(v[13:15], last_value(v[13:15]) OVER u)) AS fd,
  greatest(4, CAST(round_even(n * 0.04::DOUBLE, 0) AS BIGINT)) AS hold, greatest(6, CAST(round_even(n * 0.04::DOUBLE, 0) AS BIGINT)) AS tail
  FROM f WINDOW c AS (PARTITION BY clip ORDER BY frame), u AS (PARTITION BY clip ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
a AS (SELECT *, abs(vel - lag(vel) OVER (PARTITION BY clip ORDER BY frame)) AS acc FROM w),
m AS (SELECT clip, max(amp) AS amplitude, max(vel) AS velocity, coalesce(max(acc), 0) AS acceleration, max(gap) AS start_end,
  coalesce(max(vel) FILTER (frame >= n - tail), 0) AS terminal_velocity, max(hold) AS hold_frames,
  max(to_end) FILTER (frame >= n - hold) AS hold_delta, coalesce(max(vel) FILTER (frame > n - hold), 0) AS hold_velocity,
  max(rd) FILTER (frame >= n - hold) AS root_drift, max(fd) FILTER (frame >= n - hold) AS foot_drift,
  max(greatest(list_distance(v[4:6], [0, 0, 0]), list_distance(v[7:9], [0, 0, 0]))) AS hand,
  max(greatest(list_distance(v[10:12], [0, 0, 0]), list_distance(v[13:15], [0, 0, 0]))) AS foot,
  min(least(v[12], v[15])) AS ground, max(degrees(abs(v[16]))) AS yaw_deg, max(degrees(abs(v[17]))) AS pitch_deg,
  max(degrees(greatest(abs(v[20]), abs(v[21])))) AS foot_yaw_deg, min(v[10] - v[13]) AS foot_side, max(v[4] - v[7]) AS hand_side
  FROM a GROUP BY clip)"""
MEASURED = ("amplitude", "velocity", "acceleration", "start_end", "terminal_velocity", "hold_delta", "hold_velocity", "root_drift",
            "foot_drift", "hand", "foot", "ground", "yaw_deg", "pitch_deg", "foot_yaw_deg", "foot_side", "hand_side")


@query("trajectory_measures", f"WITH {MEASURES} SELECT clip, hold_frames, {', '.join(f'round({c}, 6) AS {c}' for c in MEASURED)} FROM m")
def trajectory_measures(t: Tables) -> DataFrame:
    out = S.trajectory_measures(states(t), CLIP, "frame")
    return out.select("clip", "hold_frames", *[F.round(c, 6).alias(c) for c in MEASURED])


def _fail(*pairs: tuple[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in pairs)
    return f"concat_ws('|', {cases})"


ARMS_SQL = "[" + ", ".join(f"'{a}'" for a in ARM_CHANNELS) + "][clip % 40 + 1]"


@query("trajectory_qc_presets", f"""WITH {MEASURES} SELECT clip, {_fail(
    ('nearly_static', 'amplitude < 0.075'), ('frame_velocity', 'velocity > 0.10'), ('frame_acceleration', 'acceleration > 0.060'),
    ('unnatural_recovery', 'start_end > 0.035 OR terminal_velocity > 0.0035'), ('hand_reach', 'hand > 0.34'),
    ('foot_reach_or_ground', 'foot > 0.24 OR ground < -1e-6'), ('torso_joint_limit', 'yaw_deg > 58 OR pitch_deg > 40'),
    ('foot_yaw_limit', 'foot_yaw_deg > 24'), ('leg_crossing_proxy', 'foot_side < -0.14'),
    ('outward_arm_semantics', f"{ARMS_SQL} IN ('outward_sweep', 'balance_open') AND hand_side < 0.12"))} AS failures FROM m""")
def trajectory_qc_presets(t: Tables) -> DataFrame:
    measures = S.trajectory_measures(states(t), CLIP, "frame")
    arms = F.element_at(F.array(*[F.lit(a) for a in ARM_CHANNELS]), (F.col("clip") % 40 + 1).cast("int"))
    return S.preset_verdict(measures, arms).select("clip", F.array_join("failures", "|").alias("failures"))


@query("trajectory_qc_clips", f"""WITH {MEASURES} SELECT clip, {_fail(
    ('amplitude_too_small', 'amplitude < 0.05'), ('velocity_too_high', 'velocity > 0.10'), ('acceleration_discontinuity', 'acceleration > 0.060'),
    ('no_natural_recovery', 'start_end > 0.035'), ('ground_penetration', 'ground < -1e-5'),
    ('no_settle', 'hold_delta > 0.004 OR hold_velocity > 0.003'), ('terminal_drift', 'root_drift > 0.002 OR foot_drift > 0.002'))} AS failures FROM m""")
def trajectory_qc_clips(t: Tables) -> DataFrame:
    measures = S.trajectory_measures(states(t), CLIP, "frame")
    return S.clip_verdict(measures).select("clip", F.array_join("failures", "|").alias("failures"))


@query("trajectory_qc_observed", f"""WITH {MEASURES} SELECT clip, {_fail(
    ('amplitude_too_small', 'amplitude < 0.075'), ('discontinuous', 'velocity > 0.16 OR acceleration > 0.10'))} AS failures FROM m""")
def trajectory_qc_observed(t: Tables) -> DataFrame:
    measures = S.trajectory_measures(states(t), CLIP, "frame")
    return S.observed_verdict(measures).select("clip", F.array_join("failures", "|").alias("failures"))


CHANNELS = ("view", "click", "error", "signup", "purchase")


@query("trajectory_descriptor", f"""WITH {FR}, x AS (SELECT clip, frame, n, event_type, value - 50 AS v FROM fr),
g AS (SELECT clip, event_type, min(v) AS lo, max(v) AS hi, max(frame) AS last FROM x GROUP BY 1, 2),
p AS (SELECT clip, event_type, frame, row_number() OVER (PARTITION BY clip, event_type ORDER BY abs(v) DESC, frame) AS rn FROM x)
SELECT g.clip, g.event_type AS channel, round(lo, 6) AS lo, round(hi, 6) AS hi, round(p.frame / greatest(1, last), 6) AS peak
FROM g JOIN p ON p.clip = g.clip AND p.event_type = g.event_type AND p.rn = 1""")
def trajectory_descriptor(t: Tables) -> DataFrame:
    """One channel per event type; a user without some type has fewer numbers, so rows are keyed by channel."""
    samples = frames(t).select(F.col("clip"), F.col("event_type").alias("channel"), "frame", (F.col("value") - 50).alias("value"))
    out = S.descriptor(samples.withColumn("name", F.col("channel")), ["clip", "name"], CHANNELS)
    d = F.col("trajectory_descriptor")
    return out.select("clip", F.col("name").alias("channel"), d[0].alias("lo"), d[1].alias("hi"), d[2].alias("peak"))


# Points: lines of an order are the points of one frame; the part's brand groups them by region.
POINTS_SQL = """pts AS (SELECT l_suppkey AS clip, l_orderkey AS frame, l_quantity AS x, l_extendedprice / 1000 AS y, l_discount * 100 + l_tax AS z,
  CASE l_linestatus WHEN 'O' THEN 'halfbody' ELSE 'closeup_hair' END AS framing FROM lineitem)"""


def points(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("clip"), F.col("l_orderkey").alias("frame"), F.col("l_quantity").alias("x"),
        (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_discount") * 100 + F.col("l_tax")).alias("z"),
        F.when(F.col("l_linestatus") == "O", "halfbody").otherwise("closeup_hair").alias("framing"),
    )


BOUNDS_SQL = POINTS_SQL + """, lim AS (SELECT clip, frame, min(z) AS lo, max(z) AS hi FROM pts GROUP BY 1, 2),
b AS (SELECT p.clip, p.frame, min(x) AS low_x, max(x) AS high_x, min(y) AS low_y, max(y) AS high_y, min(z) AS low_z, max(z) AS high_z
  FROM pts p JOIN lim l ON l.clip = p.clip AND l.frame = p.frame
  WHERE z >= lo + (hi - lo) * CASE framing WHEN 'halfbody' THEN 0.40 ELSE 0.67 END GROUP BY 1, 2)"""


@query("frame_bounds", f"WITH {BOUNDS_SQL} SELECT clip, frame, low_x, high_x, low_z, high_z FROM b")
def frame_bounds(t: Tables) -> DataFrame:
    return S.bounds(points(t), CLIP, "frame", F.col("framing")).select("clip", "frame", "low_x", "high_x", "low_z", "high_z")


@query("clip_envelope", f"""WITH {BOUNDS_SQL} SELECT clip, min(low_x) AS low_x, max(high_x) AS high_x, min(low_y) AS low_y, max(high_y) AS high_y,
  min(low_z) AS low_z, max(high_z) AS high_z FROM b GROUP BY clip""")
def clip_envelope(t: Tables) -> DataFrame:
    return S.envelope(S.bounds(points(t), CLIP, "frame", F.col("framing")), CLIP)


@query("limb_qc", f"""WITH {FR}, b AS (SELECT clip, frame, event_type AS chain, 1 + value / 1000 AS first, 1 + (value % 10) / 1000 AS second, value / 490 AS reach FROM fr),
s AS (SELECT clip, chain, min(frame) AS f0 FROM b GROUP BY 1, 2),
g AS (SELECT b.clip, b.chain, greatest(max(first) FILTER (frame = f0), 1e-7) AS a0, greatest(max(second) FILTER (frame = f0), 1e-7) AS b0,
  min(first) AS a1, max(first) AS a2, min(second) AS b1, max(second) AS b2, min(reach) AS r1 FROM b JOIN s ON s.clip = b.clip AND s.chain = b.chain GROUP BY 1, 2)
SELECT clip, chain, round(a1 / a0, 8) AS first_min, round(a2 / a0, 8) AS first_max, round(b1 / b0, 8) AS second_min, round(b2 / b0, 8) AS second_max,
  concat_ws('|', CASE WHEN least(a1 / a0, b1 / b0) < 0.985 OR greatest(a2 / a0, b2 / b0) > 1.015 THEN chain || ':segment_length_changed' END) AS failures FROM g""")
def limb_qc(t: Tables) -> DataFrame:
    rows = frames(t).select(
        "clip", "frame", F.col("event_type").alias("chain"), (1 + F.col("value") / 1000).alias("first"),
        (1 + (F.col("value") % 10) / 1000).alias("second"), (F.col("value") / 490).alias("reach"),
    )
    start = rows.groupBy("clip", "chain").agg(F.min("frame").alias("_f0"))
    numbered = rows.join(start, ["clip", "chain"]).withColumn("frame", F.col("frame") - F.col("_f0")).drop("_f0")
    out = S.limb_qc(numbered, CLIP)
    return out.select("clip", "chain", *[F.round(c, 8).alias(c) for c in ("first_min", "first_max", "second_min", "second_max")],
                      F.array_join("failures", "|").alias("failures"))


LEGS = """legs AS (SELECT clip, frame, 0.05 + v[1] / 10 AS knee_gap, 0.1 + v[2] / 10 AS ankle_gap, v[3] / 20 AS ol, v[4] / 20 AS orr,
  1 + v[5] / 50 AS fl, 1 + v[6] / 50 AS fr FROM st)"""


@query("leg_order_qc", f"""WITH {ST}, {LEGS}, g AS (SELECT clip, min(knee_gap) AS k1, max(knee_gap) FILTER (frame = 0) AS k0, min(ankle_gap) AS a1,
  max(ankle_gap) FILTER (frame = 0) AS a0, min(ol) AS ol, min(orr) AS orr, min(fl) / max(fl) FILTER (frame = 0) AS l1, max(fl) / max(fl) FILTER (frame = 0) AS l2,
  min(fr) / max(fr) FILTER (frame = 0) AS r1, max(fr) / max(fr) FILTER (frame = 0) AS r2 FROM legs GROUP BY clip)
SELECT clip, round(k1, 6) AS knee_min, round(a1, 6) AS ankle_min, {_fail(
    ('foot_L:foot_shape_changed', 'l1 < 0.99 OR l2 > 1.01'), ('foot_R:foot_shape_changed', 'r1 < 0.99 OR r2 > 1.01'),
    ('knee_ordering', 'k1 < greatest(0.008, k0 * 0.72)'), ('knee_valgus_L', 'ol < -0.008'), ('knee_valgus_R', 'orr < -0.008'),
    ('crossed_ankles', 'clip % 2 = 0 AND a1 < greatest(0.008, a0 * 0.35)'))} AS failures FROM g""")
def leg_order_qc(t: Tables) -> DataFrame:
    v = F.col("v")
    rows = vectors(t).select(
        "clip", "frame", (0.05 + v[0] / 10).alias("knee_gap"), (0.1 + v[1] / 10).alias("ankle_gap"), (v[2] / 20).alias("knee_out_l"),
        (v[3] / 20).alias("knee_out_r"), (1 + v[4] / 50).alias("foot_l"), (1 + v[5] / 50).alias("foot_r"),
    )
    out = S.leg_order_qc(rows, CLIP, F.when(F.col("clip") % 2 == 0, "squat").otherwise("march"))
    return out.select("clip", F.round("knee_min", 6).alias("knee_min"), F.round("ankle_min", 6).alias("ankle_min"), F.array_join("failures", "|").alias("failures"))


@query("geometry_qc", f"""WITH {ST}, x AS (SELECT clip, frame, n, [1 + v[1], 1 + v[2], 2 + v[3]] AS size, v[4:6] AS center, abs(v[7]) / 20 AS travel, abs(v[8]) * 10 AS turn FROM st),
p AS (SELECT x.*, b.size AS s0, b.center AS c0, greatest(1.8, b.size[3], 1e-6) AS h FROM x JOIN x b ON b.clip = x.clip AND b.frame = 0
  WHERE x.frame IN (0, x.n // 4, x.n // 2, 3 * x.n // 4, x.n - 1)),
g AS (SELECT clip, min(list_min(size)) AS smallest, min(list_distance(size, [0, 0, 0]) / list_distance(s0, [0, 0, 0])) AS e1,
  max(list_distance(size, [0, 0, 0]) / list_distance(s0, [0, 0, 0])) AS e2, max(list_max(size) / h) AS sm, max(list_distance(center, c0) / h) AS es,
  max(travel / h) AS tr, max(turn) AS tu FROM p GROUP BY clip)
SELECT clip, round(e1, 6) AS extent_min, round(e2, 6) AS extent_max, round(es, 6) AS escape_max, {_fail(
    ('invalid_geometry', 'NOT smallest > 1e-6'), ('extent_changed', 'e1 < 0.55 OR e2 > 1.45'), ('geometry_exploded', 'sm > 2.4'),
    ('center_escaped', 'es > 0.8'), ('nearly_static', 'tr < 0.005 AND tu < 2.0'))} AS failures FROM g""")
def geometry_qc(t: Tables) -> DataFrame:
    v = F.col("v")
    boxes = vectors(t).select(
        "clip", "frame", F.array(1 + v[0], 1 + v[1], 2 + v[2]).alias("size"), F.slice(v, 4, 3).alias("center"),
        (F.abs(v[6]) / 20).alias("travel"), (F.abs(v[7]) * 10).alias("turn_deg"),
    )
    out = S.geometry_qc(boxes, CLIP, F.lit(1.8))
    return out.select("clip", *[F.round(c, 6).alias(c) for c in ("extent_min", "extent_max", "escape_max")], F.array_join("failures", "|").alias("failures"))


FEET = """feet AS (SELECT clip, frame, [round(v[1], 2) / 70, round(v[2], 2) / 70, 0] AS src, [v[4], v[5], v[6]] AS tgt, event_type FROM st),
sl AS (SELECT clip, list_distance(src, lag(src) OVER c) AS ss, list_distance(tgt, lag(tgt) OVER c) AS slip FROM feet WINDOW c AS (PARTITION BY clip ORDER BY frame)),
pl AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY slip) - 1 AS i, count(*) OVER (PARTITION BY clip) AS n FROM sl WHERE ss < 0.0025)"""


@query("planted_slip", f"""WITH {ST}, {FEET} SELECT f.clip, count(pl.slip) AS count, round(coalesce(avg(slip), 0), 6) AS mean, round(coalesce(max(slip), 0), 6) AS max,
  round(coalesce(max(slip) FILTER (i = least(n - 1, CAST(floor(0.95::DOUBLE * n) AS BIGINT))), 0), 6) AS p95
FROM (SELECT DISTINCT clip FROM feet) f LEFT JOIN pl ON pl.clip = f.clip GROUP BY f.clip""")
def planted_slip(t: Tables) -> DataFrame:
    v = F.col("v")
    rows = vectors(t).select(
        "clip", "frame", F.array(F.round(v[0], 2) / 70, F.round(v[1], 2) / 70, F.lit(0.0)).alias("src"), F.slice(v, 4, 3).alias("tgt")
    )
    out = S.planted_slip_stats(rows, CLIP, "frame", "src", "tgt", CLIP)
    return out.select("clip", "count", *[F.round(c, 6).alias(c) for c in ("mean", "max", "p95")])


@query("rotation_jump", f"""WITH {ST}, q AS (SELECT clip, frame, list_transform(v[1:4], lambda x: x / list_distance(v[1:4], [0, 0, 0, 0])) AS q FROM st),
j AS (SELECT clip, degrees(2 * acos(least(1.0, abs(list_inner_product(q, lag(q) OVER (PARTITION BY clip ORDER BY frame)))))) AS jump FROM q)
SELECT clip, round(max(jump), 4) AS max_jump_deg, round(avg(jump), 4) AS mean_change_deg FROM j GROUP BY clip""")
def rotation_jump(t: Tables) -> DataFrame:
    four = F.slice("v", 1, 4)
    length = F.sqrt(F.aggregate(four, F.lit(0.0), lambda a, x: a + x * x))
    rows = vectors(t).select("clip", "frame", F.transform(four, lambda x: x / length).alias("q"))
    out = S.rotation_jump(rows, CLIP, "frame", "q", CLIP)
    return out.select("clip", F.round("max_jump_deg", 4).alias("max_jump_deg"), F.round("mean_change_deg", 4).alias("mean_change_deg"))


@query("retarget_gate", """SELECT l_orderkey, l_linenumber, concat_ws('|', CASE WHEN l_quantity * 1.5 > 60 THEN 'rotation_jump' END,
  CASE WHEN l_discount * 3 < 0.15 THEN 'too_static' END, CASE WHEN l_quantity / 8 > 5 THEN 'mean_angular_error' END,
  CASE WHEN l_quantity / 4 > 12 THEN 'p95_angular_error' END, CASE WHEN l_tax + 0.005 > 0.08 THEN 'endpoint_trajectory' END,
  CASE WHEN l_tax / 20 > 0.0025 THEN 'planted_slip_p95' END, CASE WHEN l_tax / 15 > 0.0030 THEN 'planted_slip_max' END,
  CASE WHEN l_returnflag = 'R' THEN 'mesh_collision' END) AS failures FROM lineitem""")
def retarget_gate(t: Tables) -> DataFrame:
    c = F.col
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", (c("l_quantity") * 1.5).alias("max_jump_deg"), (c("l_discount") * 3).alias("mean_change_deg"),
        (c("l_quantity") / 8).alias("mean_error_deg"), (c("l_quantity") / 4).alias("p95_error_deg"), (c("l_tax") + 0.005).alias("endpoint_p95"),
        (c("l_tax") / 20).alias("slip_p95"), (c("l_tax") / 15).alias("slip_max"),
        F.when(c("l_returnflag") == "R", "failed").otherwise("passed").alias("collision_status"),
    )
    return S.retarget_gate(rows).select("l_orderkey", "l_linenumber", F.array_join("failures", "|").alias("failures"))


@query("travel_cap", f"""WITH {ST}, d AS (SELECT clip, list_distance(v[1:3], first_value(v[1:3]) OVER (PARTITION BY clip ORDER BY frame)) AS d FROM st)
SELECT clip, round(max(d), 6) AS extent, round(CASE WHEN max(d) > 1e-6 THEN least(0.94, 0.45 / max(d)) ELSE 0.94 END, 6) AS gain FROM d GROUP BY clip""")
def travel_cap(t: Tables) -> DataFrame:
    rows = vectors(t).select("clip", "frame", F.slice("v", 1, 3).alias("root"))
    out = S.travel_cap(rows, CLIP, "frame", "root", F.lit(0.94))
    return out.select("clip", F.round("extent", 6).alias("extent"), F.round("gain", 6).alias("gain"))


# ---- recurrences -------------------------------------------------------------------

@query("clamp_steps", f"""WITH RECURSIVE {ST}, u AS (SELECT clip, frame, v[1:3] AS p, false AS repaired FROM st WHERE frame = 0 UNION ALL
  SELECT s.clip, s.frame, CASE WHEN list_distance(s.v[1:3], u.p) <= 0.15 THEN s.v[1:3]
    ELSE list_transform([1, 2, 3], lambda i: u.p[i] + (s.v[i] - u.p[i]) / list_distance(s.v[1:3], u.p) * 0.15) END,
    list_distance(s.v[1:3], u.p) > 0.15 FROM u JOIN st s ON s.clip = u.clip AND s.frame = u.frame + 1)
SELECT clip, frame, round(p[1], 6) AS x, round(p[2], 6) AS y, round(p[3], 6) AS z, repaired FROM u""")
def clamp_steps(t: Tables) -> DataFrame:
    rows = vectors(t).select("clip", "frame", F.slice("v", 1, 3).alias("p"), F.lit(0.15).alias("limit"))
    out = R.clamp_steps(rows, CLIP, "frame", "p", "limit")
    p = F.col("clamped")
    return out.select("clip", "frame", *[F.round(p[i], 6).alias(a) for i, a in enumerate("xyz")], "repaired")


# Blend weights at one and two frames: smooth01(2/3) and smooth01(1/3).
_G = "CASE {0} WHEN 1 THEN 20.0 / 27 ELSE 7.0 / 27 END"


@query("contact_runs", f"""WITH RECURSIVE {ST}, x AS (SELECT clip, frame, n, v[1] AS p, event_type IN ('view', 'click') AS c FROM st),
b AS (SELECT *, CASE WHEN c AND NOT coalesce(lag(c) OVER (PARTITION BY clip ORDER BY frame), false) THEN 1 ELSE 0 END AS b FROM x),
r AS (SELECT *, sum(b) OVER (PARTITION BY clip ORDER BY frame) AS run FROM b),
runs AS (SELECT clip, run, min(frame) AS f0, max(frame) AS f1, count(*) AS k, sum(p) AS s, arg_min(p, frame) AS first FROM r WHERE c GROUP BY 1, 2),
a AS (SELECT clip, run, f0, f1, s / k AS anchor FROM runs WHERE run = 1 UNION ALL
  SELECT n.clip, n.run, n.f0, n.f1, CASE WHEN n.f0 - a.f1 = 2 THEN (n.s + 7.0 / 27 * (a.anchor - n.first)) / n.k ELSE n.s / n.k END
  FROM a JOIN runs n ON n.clip = a.clip AND n.run = a.run + 1),
h AS (SELECT r.clip, r.frame, CASE WHEN r.c THEN q.anchor WHEN r.frame - q.f1 BETWEEN 1 AND 2
    THEN r.p + (q.anchor - r.p) * {_G.format('r.frame - q.f1')} ELSE r.p END AS p, z.f0 - r.frame AS until, z.anchor AS nxt
  FROM r LEFT JOIN a q ON q.clip = r.clip AND q.run = r.run LEFT JOIN a z ON z.clip = r.clip AND z.run = r.run + 1)
SELECT clip, frame, round(CASE WHEN until BETWEEN 1 AND 2 THEN p + (nxt - p) * {_G.format('until')} ELSE p END, 6) AS p FROM h""")
def contact_runs(t: Tables) -> DataFrame:
    rows = vectors(t).select("clip", "frame", F.col("event_type").isin("view", "click").alias("contact"), F.slice("v", 1, 1).alias("p"))
    out = R.contact_runs(rows, CLIP, "frame", "contact", "p", dims=1)
    return out.select("clip", "frame", F.round(F.col("stabilized")[0], 6).alias("p"))


@query("place_window", """SELECT event_id, round(least(value, greatest(0.0, 300.0 - user_id / 30.0 - 0.1)), 9) AS start_sec FROM events""")
def place_window(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.round(S.place_window(F.col("value"), F.lit(300.0), F.col("user_id")), 9).alias("start_sec"))


@query("fullbody_fit", """WITH x AS (SELECT l_orderkey, l_linenumber, l_discount * 10 AS z0, l_tax * 30 AS z1, l_quantity / 10 AS xs, 16 / 9.0 AS asp, 0.5 + l_tax * 6 AS hf, l_discount * 10 AS fy FROM lineitem),
y AS (SELECT *, least(hf, 0.88) AS fr, z1 > z0 AS ok FROM x), s AS (SELECT *, greatest((z1 - z0) / fr, xs / (asp * 0.88)) AS span FROM y),
f AS (SELECT *, greatest(0.06 + (z1 - z0) / span, least(0.94, fy)) AS foot FROM s)
SELECT l_orderkey, l_linenumber, CASE WHEN ok THEN round(span * asp, 6) END AS ortho_scale, CASE WHEN ok THEN round(z0 + (foot - 0.5) * span, 6) END AS center_z,
  CASE WHEN ok THEN round(foot - (z1 - z0) / span, 6) END AS top_y FROM f""")
def fullbody_fit(t: Tables) -> DataFrame:
    c = F.col
    fit = S.fullbody_fit(c("l_discount") * 10, c("l_tax") * 30, c("l_quantity") / 10, F.lit(16 / 9.0), F.lit(0.5) + c("l_tax") * 6, c("l_discount") * 10)
    return t.lineitem.select("l_orderkey", "l_linenumber", fit.alias("f")).select(
        "l_orderkey", "l_linenumber", *[F.round(c(f"f.{n}"), 6).alias(n) for n in ("ortho_scale", "center_z", "top_y")]
    )


@query("segment_clearance", """WITH x AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
a AS (SELECT vec_id, v[1:3] AS p, v[4:6] AS s, list_transform([1, 2, 3], lambda i: v[i + 6] - v[i + 3]) AS ax FROM x),
c AS (SELECT *, greatest(0.0, least(1.0, list_inner_product(list_transform([1, 2, 3], lambda i: p[i] - s[i]), ax) / list_inner_product(ax, ax))) AS u FROM a),
d AS (SELECT *, list_transform([1, 2, 3], lambda i: p[i] - s[i] - ax[i] * u) AS away FROM c),
g AS (SELECT *, sqrt(list_inner_product(away, away)) AS gap FROM d)
SELECT vec_id, round(CASE WHEN gap < 0.2 THEN 0.2 - gap ELSE 0 END, 6) AS correction,
  round(p[1] + CASE WHEN gap < 0.2 THEN away[1] / gap * (0.2 - gap) ELSE 0 END, 6) AS x FROM g""")
def segment_clearance(t: Tables) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    out = S.segment_clearance(F.slice(v, 1, 3), F.slice(v, 4, 3), F.slice(v, 7, 3), F.lit(0.2), F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0)))
    return t.embeddings.select("vec_id", out.alias("o")).select(
        "vec_id", F.round("o.correction", 6).alias("correction"), F.round(F.col("o.point")[0], 6).alias("x")
    )


@query("math_functions", """SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS half_even,
  round(greatest(-1.0, least(1.0, l_quantity / 25 - 1)), 8) AS clamped,
  round(greatest(0.0, least(1.0, l_discount * 12)) * greatest(0.0, least(1.0, l_discount * 12)) * (3 - 2 * greatest(0.0, least(1.0, l_discount * 12))), 8) AS smoothed,
  round(pow(l_tax - l_discount, 2) + pow(l_discount - l_tax, 2), 8) AS sq, round(l_tax + (l_discount - l_tax) * 0.25, 8) AS mixed FROM lineitem""")
def math_functions(t: Tables) -> DataFrame:
    c = F.col
    a, b = F.array("l_tax", "l_discount"), F.array("l_discount", "l_tax")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", half_even(c("l_quantity") / 2).alias("half_even"),
        F.round(clamp(c("l_quantity") / 25 - 1, -1.0, 1.0), 8).alias("clamped"), F.round(smooth01(c("l_discount") * 12), 8).alias("smoothed"),
        F.round(sq_dist(a, b), 8).alias("sq"), F.round(lerp(a, b, F.lit(0.25))[0], 8).alias("mixed"),
    )
