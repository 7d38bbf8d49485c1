"""Catalogue queries over embeddings (presets), events (design payloads), lineitem and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom import schemas
from cliploom.functions.hashing import blueprint_signature, short_sha1, short_sha256, stable_mod, vector_fingerprint
from cliploom.operators import blueprint as B
from cliploom.operators import catalog as ops
from cliploom.operators import diversity
from cliploom.plans.registry import Tables, query

USED = "used AS (SELECT DISTINCT json_extract_string(props, '$.k') AS p FROM events)"
CAND = f"{USED}, cand AS (SELECT CAST(vec_id AS VARCHAR) AS preset_id, embedding FROM embeddings WHERE CAST(vec_id AS VARCHAR) NOT IN (SELECT p FROM used))"


def presets(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").cast("string").alias("preset_id"), F.col("embedding").cast("array<double>").alias("vector"))


def free_presets(t: Tables) -> DataFrame:
    return ops.unused(presets(t), t.events, "preset_id", "$.k", "props")


@query("unused_presets", f"WITH {CAND} SELECT preset_id FROM cand")
def unused_presets(t: Tables) -> DataFrame:
    return free_presets(t).select("preset_id")


def subject_history(t: Tables) -> DataFrame:
    """Vectors a user has been given: the presets named by the user's purchases."""
    given = t.events.filter("event_type = 'purchase'").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("subject_id"),
        F.get_json_object("props", "$.k").alias("preset_id"),
    )
    return given.distinct().join(presets(t), "preset_id").select("subject_id", "vector")


@query("pick_diverse", f"""WITH {CAND},
hist AS (SELECT DISTINCT user_id, json_extract_string(props, '$.k') AS p FROM events WHERE event_type = 'purchase'),
d AS (SELECT h.user_id AS id, c.preset_id, min(list_distance(c.embedding::DOUBLE[], e.embedding::DOUBLE[])) AS dist
  FROM hist h JOIN embeddings e ON CAST(e.vec_id AS VARCHAR) = h.p CROSS JOIN cand c GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist DESC,
  substr(sha1('U' || CAST(id AS VARCHAR) || ':' || CAST(id AS VARCHAR) || ':' || preset_id), 1, 16)) AS rn FROM d)
SELECT id, preset_id, round(dist * dist, 6) AS distance FROM r WHERE rn = 1""")
def pick_diverse(t: Tables) -> DataFrame:
    queue = t.events.select("user_id").distinct().select(
        F.col("user_id").alias("id"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("subject_id")
    )
    picked = diversity.pick_diverse(queue, free_presets(t), subject_history(t))
    return picked.select("id", "preset_id", F.round("distance", 6).alias("distance"))


@query("pick_cold", f"""WITH {CAND},
r AS (SELECT s_suppkey AS id, preset_id, row_number() OVER (PARTITION BY s_suppkey ORDER BY substr(sha1(s_name || ':' || preset_id), 1, 16)) AS rn
  FROM supplier CROSS JOIN cand)
SELECT id, preset_id FROM r WHERE rn = (SELECT count(*) // 3 + 1 FROM cand)""")
def pick_cold(t: Tables) -> DataFrame:
    queue = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("subject_id"))
    return diversity.pick_cold(queue, free_presets(t))


# One round after another: the wave is each subject's next job; the j-th job that wants a candidate first takes its j-th choice.
ROUNDS_SQL = f"""WITH RECURSIVE {CAND},
v AS (SELECT preset_id, embedding::DOUBLE[] AS e FROM cand),
jobs AS (SELECT s_suppkey AS id, CAST(s_nationkey AS VARCHAR) || '-' || CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) % 8 AS VARCHAR) AS subject_id FROM supplier),
rounds AS (SELECT 0 AS round, CAST([] AS STRUCT(id BIGINT, subject_id VARCHAR, preset_id VARCHAR)[]) AS won, CAST([] AS STRUCT(id BIGINT, subject_id VARCHAR, preset_id VARCHAR)[]) AS given
  UNION ALL
  SELECT round + 1, now, list_concat(given, now) FROM (
    SELECT r.round, r.given, (
      WITH had AS (SELECT x.id, x.subject_id, x.preset_id FROM (SELECT unnest(r.given) AS x)),
      free AS (SELECT * FROM v WHERE preset_id NOT IN (SELECT preset_id FROM had)),
      wave AS (SELECT min(id) AS id, subject_id FROM jobs WHERE id NOT IN (SELECT id FROM had) GROUP BY subject_id),
      far AS (SELECT w.id, w.subject_id, f.preset_id, min(list_distance(f.e, p.e)) AS d FROM wave w JOIN had h ON h.subject_id = w.subject_id JOIN v p ON p.preset_id = h.preset_id CROSS JOIN free f GROUP BY ALL),
      warm AS (SELECT id, subject_id, preset_id, row_number() OVER (PARTITION BY id ORDER BY d DESC, substr(sha1(subject_id || ':' || CAST(id AS VARCHAR) || ':' || preset_id), 1, 16)) AS choice FROM far),
      cold AS (SELECT w.id, w.subject_id, f.preset_id, row_number() OVER (PARTITION BY w.id ORDER BY substr(sha1(w.subject_id || ':' || f.preset_id), 1, 16)) - (SELECT count(*) // 3 FROM free) AS choice
        FROM wave w CROSS JOIN free f WHERE w.subject_id NOT IN (SELECT subject_id FROM had)),
      wanted AS (SELECT * FROM warm UNION ALL SELECT * FROM cold WHERE choice > 0),
      turns AS (SELECT id, row_number() OVER (PARTITION BY preset_id ORDER BY subject_id, id) AS choice FROM wanted WHERE choice = 1),
      claims AS (SELECT w.*, row_number() OVER (PARTITION BY preset_id ORDER BY subject_id, w.id) AS rn FROM wanted w JOIN turns t ON t.id = w.id AND t.choice = w.choice)
      SELECT list({{'id': id, 'subject_id': subject_id, 'preset_id': preset_id}}) FROM claims WHERE rn = 1) AS now
    FROM rounds r WHERE len(r.given) < (SELECT count(*) FROM jobs)))
SELECT x.id, x.subject_id, x.preset_id, round FROM (SELECT round, unnest(won) AS x FROM rounds)"""


@query("assign_rounds", ROUNDS_SQL)
def assign_rounds(t: Tables) -> DataFrame:
    """Suppliers as jobs; nation and balance digit as subject."""
    queue = t.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.concat_ws("-", F.col("s_nationkey").cast("string"), (F.floor(F.abs("s_acctbal")) % 8).cast("string")).alias("subject_id"),
    )
    history = t.spark.createDataFrame([], "subject_id string, vector array<double>")
    return diversity.assign_rounds(queue, free_presets(t), history)


@query("robust_stats", """WITH long AS (SELECT 0 AS axis, l_quantity AS v FROM lineitem UNION ALL SELECT 1, l_extendedprice FROM lineitem
  UNION ALL SELECT 2, l_discount FROM lineitem UNION ALL SELECT 3, l_tax FROM lineitem),
r AS (SELECT axis, v, row_number() OVER (PARTITION BY axis ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY axis) AS n FROM long)
SELECT CAST(axis AS INTEGER) AS axis, max(v) FILTER (i = n // 2) AS center,
  greatest(round(max(v) FILTER (i = 3 * n // 4) - max(v) FILTER (i = n // 4), 9), 1e-5) AS scale FROM r GROUP BY axis""")
def robust_stats(t: Tables) -> DataFrame:
    return ops.robust_stats(_line_vectors(t), "raw").select("axis", "center", F.round("scale", 9).alias("scale"))


def _line_vectors(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("raw"))


@query("robust_scale", """WITH long AS (SELECT 0 AS axis, l_quantity AS v FROM lineitem UNION ALL SELECT 1, l_extendedprice FROM lineitem
  UNION ALL SELECT 2, l_discount FROM lineitem UNION ALL SELECT 3, l_tax FROM lineitem),
r AS (SELECT axis, v, row_number() OVER (PARTITION BY axis ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY axis) AS n FROM long),
s AS (SELECT axis, max(v) FILTER (i = n // 2) AS c, greatest(max(v) FILTER (i = 3 * n // 4) - max(v) FILTER (i = n // 4), 1e-5) AS s FROM r GROUP BY axis)
SELECT l_orderkey, l_linenumber,
  round(greatest(-3.0, least(3.0, (l_quantity - (SELECT c FROM s WHERE axis = 0)) / (SELECT s FROM s WHERE axis = 0))), 6) AS q,
  round(greatest(-3.0, least(3.0, (l_extendedprice - (SELECT c FROM s WHERE axis = 1)) / (SELECT s FROM s WHERE axis = 1))), 6) AS p
FROM lineitem""")
def robust_scale(t: Tables) -> DataFrame:
    rows = _line_vectors(t)
    scaled = ops.robust_scale(rows, ops.robust_stats(rows, "raw"), "raw")
    return scaled.select("l_orderkey", "l_linenumber", F.round(F.col("vector")[0], 6).alias("q"), F.round(F.col("vector")[1], 6).alias("p"))


@query("raw_vector", """SELECT l_orderkey, l_linenumber, round(ln(1 + l_quantity), 8) AS frames,
  round(ln(1 + CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_extendedprice END), 8) AS energy,
  round(sqrt(l_tax * l_tax + l_discount * l_discount), 8) AS displacement, round(l_quantity / 180.0, 8) AS yaw,
  CASE WHEN l_linestatus = 'O' THEN l_discount ELSE 0 END AS contact_left,
  round(l_tax + 2 * l_discount, 8) AS arms, round(CASE WHEN l_returnflag = 'R' THEN l_tax ELSE 0 END, 8) AS legs,
  round((l_quantity + l_tax) / 180.0, 8) AS knees FROM lineitem""")
def raw_vector(t: Tables) -> DataFrame:
    number = lambda c: F.col(c)
    metrics = F.struct(
        F.when(F.col("l_returnflag") != "N", number("l_extendedprice")).alias("motion_energy"),
        F.lit(None).cast("double").alias("root_path_length"),
        F.array("l_tax", "l_discount").alias("root_displacement"),
        F.map_filter(
            F.create_map(
                F.lit("lefthand"), F.array("l_tax", "l_discount"), F.lit("rightforearm"), F.array("l_discount"),
                F.lit("leftleg"), F.array("l_tax"),
            ),
            lambda k, _: (k != "leftleg") | (F.col("l_returnflag") == "R"),
        ).alias("joint_axis_ranges"),
        F.when(F.col("l_linestatus") == "O", F.create_map(F.lit("left"), F.col("l_discount"))).alias("contact_fraction"),
        F.lit(None).cast("map<string,bigint>").alias("contact_transitions"),
        F.create_map(F.lit("left"), F.col("l_quantity"), F.lit("right"), F.col("l_tax")).alias("knee_angle_ranges"),
        F.lit(None).cast("map<string,double>").alias("elbow_angle_ranges"),
        F.col("l_quantity").alias("body_yaw_range_deg"),
        F.lit(None).cast("double").alias("body_yaw_path_deg"),
    )
    vector = ops.raw_vector(F.col("metrics"), F.col("l_quantity"))
    rows = t.lineitem.withColumn("metrics", metrics).withColumn("v", vector)
    at = lambda i, name: F.round(F.col("v")[i], 8).alias(name)
    return rows.select(
        "l_orderkey", "l_linenumber", at(0, "frames"), at(1, "energy"), at(3, "displacement"), at(4, "yaw"),
        at(6, "contact_left"), at(10, "arms"), at(11, "legs"), at(12, "knees"),
    )


@query("catalog_floor", """SELECT count(*) AS observations, CASE WHEN count(*) < 1908 THEN 'too_few_observations' ELSE 'ok' END AS verdict FROM orders
JOIN documents ON doc_id = o_orderkey WHERE o_orderstatus = 'F' AND lang = 'en' AND source <> 'src3'""")
def catalog_floor(t: Tables) -> DataFrame:
    return ops.catalog_floor(observed(t))


@query("valid_observations", """SELECT CAST(o_orderkey AS VARCHAR) AS segment_id, n_chars AS frame_count FROM orders
JOIN documents ON doc_id = o_orderkey WHERE o_orderstatus = 'F' AND lang = 'en' AND source <> 'src3'""")
def valid_observations(t: Tables) -> DataFrame:
    return observed(t).select("segment_id", "frame_count")


def observed(t: Tables) -> DataFrame:
    """Orders as observations, documents as their feature documents."""
    observations = t.orders.select(
        F.col("o_orderkey").cast("string").alias("segment_id"),
        F.when(F.col("o_orderstatus") == "F", "done").otherwise("open").alias("status"),
    )
    features = t.documents.select(
        F.col("doc_id").cast("string").alias("segment_id"), F.col("n_chars").alias("frame_count"),
        F.when(F.col("lang") == "en", schemas.OBSERVATION_SCHEMA).otherwise(1).alias("schema"),
        F.when(F.col("source") != "src3", schemas.OBSERVATION_VERSION).alias("observation_version"),
    )
    return ops.valid_observations(observations, features)


@query("distribution", """WITH names AS (SELECT DISTINCT event_type AS semantic FROM events UNION SELECT r_name FROM region),
r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT semantic, count(r.value) AS count, round(coalesce(avg(r.value), 180.0), 6) AS mean,
  coalesce(max(r.value) FILTER (i = least(n - 1, CAST(floor(0.95::DOUBLE * n) AS BIGINT))), 180.0) AS p95, coalesce(max(r.value), 180.0) AS max
FROM names LEFT JOIN r ON r.event_type = semantic GROUP BY semantic""")
def distribution(t: Tables) -> DataFrame:
    names = t.events.select(F.col("event_type").alias("semantic")).unionAll(t.region.select("r_name"))
    rows = t.events.select(F.col("event_type").alias("semantic"), "value")
    out = ops.distribution(rows, ["semantic"], "value", names, 180.0)
    return out.select("semantic", "count", F.round("mean", 6).alias("mean"), "p95", "max")


@query("hash_ids", """SELECT doc_id, substr(sha1(text), 1, 24) AS short_id, substr(sha256(text), 1, 16) AS token,
  CAST(('0x' || substr(sha1(source || ':' || CAST(doc_id AS VARCHAR)), 1, 16))::UBIGINT % 1009 AS INTEGER) AS bucket FROM documents""")
def hash_ids(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", short_sha1(F.col("text")).alias("short_id"), short_sha256(F.col("text")).alias("token"),
        stable_mod(F.concat_ws(":", "source", F.col("doc_id").cast("string")), 1009).alias("bucket"),
    )


@query("vector_fingerprints", """SELECT vec_id, substr(sha1(array_to_string(list_transform(embedding,
  lambda x: CASE WHEN abs(x::DOUBLE) < 5e-7 THEN '0.000000' ELSE printf('%.6f', x::DOUBLE) END), ',')), 1, 24) AS fingerprint FROM embeddings""")
def vector_fingerprints(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", vector_fingerprint(F.col("embedding").cast("array<double>")).alias("fingerprint"))


# Blueprints: channels and intensities drawn from the keys and rates of each line.
def _sql_list(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


BLUEPRINTS_SQL = f"""SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS preset_id,
  {_sql_list(B.LOWER_CHANNELS)}[l_partkey % 32 + 1] AS lower, {_sql_list(B.TORSO_CHANNELS)}[l_suppkey % 20 + 1] AS torso_channel,
  {_sql_list(B.ARM_CHANNELS)}[l_orderkey % 40 + 1] AS arms, {_sql_list(B.HEAD_CHANNELS)}[l_partkey % 16 + 1] AS head,
  {_sql_list(B.RHYTHMS)}[l_suppkey % 6 + 1] AS rhythm, CASE WHEN l_returnflag = 'A' THEN 'left' ELSE 'right' END AS leading_side,
  l_quantity / 50 AS lower_intensity, 1 - l_discount AS torso_intensity, 0.5 + l_tax * 5 AS arm_intensity, 0.6 + l_discount * 4 AS head_intensity,
  l_discount * 2 AS stride, l_tax AS lift, l_tax AS phase,
  CASE WHEN l_linenumber > 1 THEN 0.1 + l_discount / 2 END AS hip_width_ratio, CASE WHEN l_linenumber > 2 THEN 0.24 + l_tax END AS arm_length_ratio,
  l_returnflag = 'R' AS has_skirt_or_robe, l_linestatus = 'O' AS has_long_sleeve_or_cape, l_tax > 0.06 AS has_armor_or_bulky_shoulders FROM lineitem"""


def blueprints(t: Tables) -> DataFrame:
    pick = lambda names, key: F.element_at(F.array(*[F.lit(n) for n in names]), (F.col(key) % len(names) + 1).cast("int"))
    c = F.col
    return t.lineitem.select(
        F.concat_ws("-", c("l_orderkey").cast("string"), c("l_linenumber").cast("string")).alias("preset_id"),
        pick(B.LOWER_CHANNELS, "l_partkey").alias("lower"), pick(B.TORSO_CHANNELS, "l_suppkey").alias("torso_channel"),
        pick(B.ARM_CHANNELS, "l_orderkey").alias("arms"), pick(B.HEAD_CHANNELS, "l_partkey").alias("head"),
        pick(B.RHYTHMS, "l_suppkey").alias("rhythm"), F.when(c("l_returnflag") == "A", "left").otherwise("right").alias("leading_side"),
        (c("l_quantity") / 50).alias("lower_intensity"), (1 - c("l_discount")).alias("torso_intensity"),
        (F.lit(0.5) + c("l_tax") * 5).alias("arm_intensity"), (F.lit(0.6) + c("l_discount") * 4).alias("head_intensity"),
        (c("l_discount") * 2).alias("stride"), c("l_tax").alias("lift"), c("l_tax").alias("phase"),
        F.when(c("l_linenumber") > 1, F.lit(0.1) + c("l_discount") / 2).alias("hip_width_ratio"),
        F.when(c("l_linenumber") > 2, F.lit(0.24) + c("l_tax")).alias("arm_length_ratio"),
        (c("l_returnflag") == "R").alias("has_skirt_or_robe"), (c("l_linestatus") == "O").alias("has_long_sleeve_or_cape"),
        (c("l_tax") > 0.06).alias("has_armor_or_bulky_shoulders"),
    )


@query("blueprint_signatures", f"""WITH b AS ({BLUEPRINTS_SQL})
SELECT preset_id, substr(sha1(concat_ws('|', lower, torso_channel, arms, head, rhythm, leading_side, printf('%.4f', lower_intensity),
  printf('%.4f', torso_intensity), printf('%.4f', arm_intensity), printf('%.4f', phase))), 1, 24) AS signature FROM b""")
def blueprint_signatures(t: Tables) -> DataFrame:
    return blueprints(t).select("preset_id", blueprint_signature().alias("signature"))


def _in(column: str, *groups) -> str:
    return f"{column} IN (" + ", ".join(f"'{n}'" for g in groups for n in g) + ")"


def _mod(suffix: str, n: int) -> str:
    return f"(('0x' || substr(sha1(preset_id || '{suffix}'), 1, 16))::UBIGINT % {n} + 1)::INTEGER"


# One step per line: condition, changed columns, note expression.
_STEPS = (
    (_in("l0", B.DEEP_LOWER) + " AND t0 IN ('bow', 'body_wave')", {"torso_channel": "'athletic_lean'"}, "'deep_lower_with_flexion->athletic_lean'"),
    (_in("l0", B.DEEP_LOWER), {"lower_intensity": "least(lower_intensity, 0.78)", "torso_intensity": "least(torso_intensity, 0.66)",
      "arm_intensity": f"CASE WHEN {_in('a0', B.FORWARD_ARMS)} THEN least(arm_intensity, 0.58) WHEN {_in('a0', B.WIDE_ARMS)} THEN least(arm_intensity, 0.62) ELSE arm_intensity END"},
     f"CASE WHEN {_in('a0', B.FORWARD_ARMS)} THEN 'deep_lower_caps_forward_reach' WHEN {_in('a0', B.WIDE_ARMS)} THEN 'deep_lower_caps_wide_arms' END"),
    ("l0 = 'soft_jump' AND " + _in("a0", B.CROSSING_ARMS), {"arms": "'balance_open'"}, "'jump_with_crossing_arms->balance_open'"),
    (_in("l0", B.DYNAMIC_LOWER) + " AND " + _in("a0", B.HIGH_ARMS), {"arm_intensity": "least(arm_intensity, 0.72)"}, "'dynamic_lower_caps_high_arms'"),
    (_in("l0", B.DYNAMIC_LOWER) + " AND " + _in("a0", B.WIDE_ARMS), {"arm_intensity": "least(arm_intensity, 0.66)"}, "'dynamic_lower_caps_wide_arms'"),
    (_in("l0", B.TURNING_LOWER) + " AND torso_channel = 'counter_rotate'", {"torso_channel": "'neutral'"}, "'opposed_turn_channels->neutral_torso'"),
    (_in("a0", B.CROSSING_ARMS) + " AND torso_channel IN ('twist', 'look_back_twist')", {"arm_intensity": "least(arm_intensity, 0.68)"}, "'cross_body_with_twist_caps_arms'"),
    (_in("a0", B.HIGH_ARMS) + " AND " + _in("torso_channel", B.TORSO_EXTREMES), {"torso_intensity": "least(torso_intensity, 0.58)", "arm_intensity": "least(arm_intensity, 0.64)"}, "'high_arms_caps_extreme_torso'"),
    ("l0 IN ('controlled_kick', 'side_lunge') AND " + _in("a0", B.CROSSING_ARMS, B.HIGH_ARMS), {"arms": "'balance_open'", "arm_intensity": "least(arm_intensity, 0.66)"}, "'single_leg_excursion_replaces_conflicting_arms'"),
    (_in("l0", B.DEEP_LOWER) + " AND " + _in("a0", B.CROSSING_ARMS), {"arms": "'presentation'", "arm_intensity": "least(arm_intensity, 0.60)"}, "'deep_lower_replaces_crossing_arms'"),
    (_in("l0", B.DYNAMIC_LOWER) + " AND torso_channel = 'body_wave'", {"lower": f"['weight_shift', 'side_step', 'heel_tap'][{_mod(':lower', 3)}]",
      "lower_intensity": "least(lower_intensity, 0.82)", "stride": "least(stride, 0.112)", "lift": "least(lift, 0.055)", "torso_intensity": "least(torso_intensity, 0.72)"},
     f"'body_wave_replaces_dynamic_lower->' || ['weight_shift', 'side_step', 'heel_tap'][{_mod(':lower', 3)}]"),
    (_in("lower", B.NARROW_HIP_UNSAFE_LOWER) + " AND coalesce(hip_width_ratio, 0.14) < 0.115",
     {"lower": f"['step_touch', 'side_step', 'heel_tap', 'split_stance_rock'][{_mod(':hip', 4)}]", "lower_intensity": "least(lower_intensity, 0.82)",
      "stride": "least(stride, 0.102)", "lift": "least(lift, 0.050)",
      "arm_intensity": "CASE WHEN arms IN ('double_reach', 'push', 'guarded_extension') THEN least(arm_intensity, 0.55) ELSE arm_intensity END",
      "arms": "CASE WHEN arms IN ('double_reach', 'push', 'guarded_extension') THEN 'presentation' ELSE arms END"},
     f"'narrow_hip_profile_replaces_lateral_or_deep_lower->' || ['step_touch', 'side_step', 'heel_tap', 'split_stance_rock'][{_mod(':hip', 4)}] || "
     "CASE WHEN arms IN ('double_reach', 'push', 'guarded_extension') THEN '|narrow_hip_replaces_symmetric_forward_arms' ELSE '' END"),
    ("has_skirt_or_robe AND " + _in("lower", B.GARMENT_UNSAFE_LOWER), {"lower": f"['weight_shift', 'side_step', 'pivot_step', 'heel_tap'][{_mod('', 4)}]",
      "lower_intensity": "least(lower_intensity, 0.84)", "stride": "least(stride, 0.105)", "lift": "least(lift, 0.052)"},
     f"'skirt_replaces_leg_excursion->' || ['weight_shift', 'side_step', 'pivot_step', 'heel_tap'][{_mod('', 4)}]"),
    ("has_long_sleeve_or_cape AND " + _in("arms", B.GARMENT_UNSAFE_ARMS), {"arms": f"['natural_swing', 'presentation', 'outward_sweep', 'compact_gesture'][{_mod(':arms', 4)}]",
      "arm_intensity": "least(arm_intensity, 0.70)"},
     f"'long_sleeve_replaces_collision_prone_arms->' || ['natural_swing', 'presentation', 'outward_sweep', 'compact_gesture'][{_mod(':arms', 4)}]"),
    ("has_armor_or_bulky_shoulders", {"arm_intensity": "least(arm_intensity, 0.68)",
      "arms": f"CASE WHEN {_in('arms', B.CROSSING_ARMS, B.HIGH_ARMS)} THEN 'presentation' ELSE arms END"},
     f"CASE WHEN {_in('arms', B.CROSSING_ARMS, B.HIGH_ARMS)} THEN 'bulky_replaces_crossing_or_high_arms' END"),
    ("coalesce(arm_length_ratio, 0.30) < 0.27 AND " + _in("arms", B.FORWARD_ARMS, B.WIDE_ARMS), {"arm_intensity": "least(arm_intensity, 0.56)"}, "'short_arm_profile_caps_reach'"),
    (_in("lower", B.LOW_RISK_LOWER), {"lower_intensity": "least(0.98, lower_intensity * 1.08)", "stride": "least(0.158, stride * 1.06)"}, "NULL"),
    (_in("arms", B.LOW_RISK_ARMS), {"arm_intensity": "least(0.96, arm_intensity * 1.08)"}, "NULL"),
    ("torso_channel IN ('sway', 'twist', 'athletic_lean', 'rise_fall', 'neutral')", {"torso_intensity": "least(0.94, torso_intensity * 1.06)"}, "NULL"),
    ("true", {"head_intensity": "least(0.92, head_intensity * 1.04)"}, "NULL"),
)


def _repair_sql() -> str:
    parts = [f"WITH s0 AS (SELECT *, lower AS l0, torso_channel AS t0, arms AS a0, [] :: VARCHAR[] AS notes FROM ({BLUEPRINTS_SQL}))"]
    for i, (condition, changes, note) in enumerate(_STEPS):
        replaced = [f"CASE WHEN {condition} THEN {value} ELSE {column} END AS {column}" for column, value in changes.items()]
        replaced.append(f"CASE WHEN ({condition}) AND ({note}) IS NOT NULL THEN list_append(notes, {note}) ELSE notes END AS notes")
        parts.append(f"s{i + 1} AS (SELECT * REPLACE ({', '.join(replaced)}) FROM s{i})")
    numbers = ", ".join(f"round({c}, 6) AS {c}" for c in ("lower_intensity", "torso_intensity", "arm_intensity", "head_intensity", "stride", "lift"))
    return ", ".join(parts) + f" SELECT preset_id, lower, torso_channel, arms, {numbers}, array_to_string(notes, '|') AS repairs FROM s{len(_STEPS)}"


@query("repair_blueprints", _repair_sql())
def repair_blueprints(t: Tables) -> DataFrame:
    numbers = ("lower_intensity", "torso_intensity", "arm_intensity", "head_intensity", "stride", "lift")
    return B.repair_blueprints(blueprints(t)).select(
        "preset_id", "lower", "torso_channel", "arms", *[F.round(c, 6).alias(c) for c in numbers],
        F.array_join("compatibility_repairs", "|").alias("repairs"),
    )


@query("repair_early_blueprints", f"""WITH b AS (SELECT *, lower AS l0, arms AS a0 FROM ({BLUEPRINTS_SQL})),
deep AS (SELECT *, l0 IN ('squat', 'side_lunge', 'crouch_shift') AS d, l0 IN ('brisk_walk', 'jog_cycle', 'soft_jump', 'controlled_kick', 'dance_step') AS dyn,
  a0 IN ('double_reach', 'overhead_open', 'outward_sweep', 'balance_open', 'arm_circle', 'celebration') AS wide, a0 IN ('overhead_open', 'celebration', 'arm_circle') AS high,
  a0 IN ('clap', 'cross_body', 'near_face', 'push', 'pull', 'guarded_extension') AS crossing, a0 IN ('single_reach', 'double_reach', 'push', 'guarded_extension') AS fwd FROM b),
t1 AS (SELECT * REPLACE (CASE WHEN d AND torso_channel IN ('bow', 'body_wave') THEN 'athletic_lean' WHEN l0 IN ('pivot_step', 'dance_step') AND torso_channel = 'counter_rotate' THEN 'neutral' ELSE torso_channel END AS torso_channel,
  CASE WHEN l0 = 'soft_jump' AND crossing THEN 'balance_open' ELSE arms END AS arms), torso_channel AS t0 FROM deep),
t2 AS (SELECT *, torso_channel IN ('bow', 'body_wave', 'side_lean', 'look_back_twist') AS extreme, d AND coalesce(hip_width_ratio, 0.14) < 0.11 AS still FROM t1),
t3 AS (SELECT *, still AND arms IN ('double_reach', 'push', 'guarded_extension') AS still_arms FROM t2),
t4 AS (SELECT *, CASE WHEN still_arms THEN 'presentation' ELSE arms END AS a1 FROM t3),
t5 AS (SELECT *, has_long_sleeve_or_cape AND a1 IN ('double_reach', 'overhead_open', 'outward_sweep', 'balance_open', 'arm_circle', 'celebration') AS sleeve,
  has_armor_or_bulky_shoulders AND a1 IN ('clap', 'cross_body', 'near_face', 'push', 'pull', 'guarded_extension') AS bulky FROM t4),
t6 AS (SELECT *, CASE WHEN bulky THEN 'presentation' ELSE a1 END AS a2, has_skirt_or_robe AND l0 IN ('side_lunge', 'controlled_kick') AS skirt FROM t5),
t7 AS (SELECT *, coalesce(arm_length_ratio, 0.30) < 0.27 AND a2 IN ('single_reach', 'double_reach', 'push', 'guarded_extension', 'overhead_open', 'outward_sweep', 'balance_open', 'arm_circle', 'celebration') AS short FROM t6)
SELECT preset_id, CASE WHEN still THEN 'stable_stance' ELSE l0 END AS lower, CASE WHEN still THEN 'neutral' ELSE torso_channel END AS torso_channel, a2 AS arms,
  round(CASE WHEN still THEN 0 WHEN d THEN least(lower_intensity, 0.78) ELSE lower_intensity END, 6) AS lower_intensity,
  round(least(torso_intensity, CASE WHEN d THEN 0.66 ELSE 9 END, CASE WHEN high AND extreme THEN 0.58 ELSE 9 END), 6) AS torso_intensity,
  round(least(arm_intensity, CASE WHEN d AND fwd THEN 0.58 WHEN d AND wide THEN 0.62 ELSE 9 END, CASE WHEN dyn AND high THEN 0.72 ELSE 9 END, CASE WHEN dyn AND wide THEN 0.66 ELSE 9 END,
    CASE WHEN crossing AND torso_channel IN ('twist', 'look_back_twist') THEN 0.68 ELSE 9 END, CASE WHEN high AND extreme THEN 0.64 ELSE 9 END, CASE WHEN still_arms THEN 0.55 ELSE 9 END,
    CASE WHEN sleeve THEN 0.72 ELSE 9 END, CASE WHEN has_armor_or_bulky_shoulders THEN 0.68 ELSE 9 END, CASE WHEN short THEN 0.56 ELSE 9 END), 6) AS arm_intensity,
  round(head_intensity, 6) AS head_intensity, round(CASE WHEN skirt THEN least(stride, 0.105) ELSE stride END, 6) AS stride, round(CASE WHEN skirt THEN least(lift, 0.06) ELSE lift END, 6) AS lift,
  concat_ws('|', CASE WHEN d AND t0 IN ('bow', 'body_wave') THEN 'deep_lower_with_flexion->athletic_lean' END,
    CASE WHEN d AND fwd THEN 'deep_lower_caps_forward_reach' WHEN d AND wide THEN 'deep_lower_caps_wide_arms' END, CASE WHEN l0 = 'soft_jump' AND crossing THEN 'jump_with_crossing_arms->balance_open' END,
    CASE WHEN dyn AND high THEN 'dynamic_lower_caps_high_arms' END, CASE WHEN dyn AND wide THEN 'dynamic_lower_caps_wide_arms' END,
    CASE WHEN l0 IN ('pivot_step', 'dance_step') AND t0 = 'counter_rotate' THEN 'opposed_turn_channels->neutral_torso' END,
    CASE WHEN crossing AND torso_channel IN ('twist', 'look_back_twist') THEN 'cross_body_with_twist_caps_arms' END, CASE WHEN high AND extreme THEN 'high_arms_caps_extreme_torso' END,
    CASE WHEN still THEN 'narrow_hip_profile_replaces_deep_lower_with_stable_stance' END, CASE WHEN still_arms THEN 'narrow_hip_deep_lower_replaces_symmetric_forward_arms' END,
    CASE WHEN skirt THEN 'skirt_caps_leg_excursion' END, CASE WHEN sleeve THEN 'long_sleeve_caps_wide_arms' END, CASE WHEN bulky THEN 'bulky_replaces_crossing_arms' END,
    CASE WHEN short THEN 'short_arm_profile_caps_reach' END) AS repairs FROM t7""")
def repair_early_blueprints(t: Tables) -> DataFrame:
    numbers = ("lower_intensity", "torso_intensity", "arm_intensity", "head_intensity", "stride", "lift")
    return B.repair_blueprints(blueprints(t), B.EDITIONS["v3"]).select(
        "preset_id", "lower", "torso_channel", "arms", *[F.round(c, 6).alias(c) for c in numbers],
        F.array_join("compatibility_repairs", "|").alias("repairs"),
    )
