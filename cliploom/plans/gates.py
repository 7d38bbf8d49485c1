"""Gate queries: orders and lines carry quality reports, each spoilt in one place by its price."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.operators import gates as G
from cliploom.operators import provenance
from cliploom.operators import queue as Q
from cliploom.plans.common import JOBS_SQL, jobs
from cliploom.plans.registry import Tables, query
from cliploom.schemas import CATALOG_VERSION, GARMENT_VERSION, REPORT_VERSION

# Every report gets one of many faults (or none), by the whole part of the order's price.
FAULT = "CAST(floor(o_totalprice) AS BIGINT) % 24"


def faulty(t: Tables) -> DataFrame:
    return t.orders.withColumn("fault", F.floor("o_totalprice") % 24).withColumn("n", (F.col("o_custkey") % 6 + 1).cast("int"))


def unless(number: int, good: Column, bad: Column) -> Column:
    return F.when(F.col("fault") == number, bad).otherwise(good)


def task_pairs(t: Tables, stage: str) -> tuple[DataFrame, DataFrame]:
    rows = faulty(t)
    text = lambda prefix: F.concat(F.lit(prefix), F.col("o_orderkey").cast("string"))
    none = F.lit(None)
    jobs = rows.select(
        F.col("o_orderkey").alias("job_id"), text("S").alias("subject_id"), text("m").alias("motion_segment_id"),
        unless(13, text("d"), none.cast("string")).alias("action_design_id"), F.col("n").alias("frame_count"), text("a").alias("task_preflight_attempt"),
        F.sha2(text("f"), 256).alias("task_preflight_input_fingerprint"), (F.col("fault") == 1).alias("debug_skip_geometry_qc"),
        F.when(F.col("fault") == 2, F.array(F.lit(1), F.lit(99))).when(F.col("fault") == 3, F.sequence(F.lit(1), F.col("n"))).alias("prepass_render_frames"),
    )
    status = lambda number: F.struct(unless(number, F.lit("passed"), F.lit("failed")).alias("status"))
    reports = rows.filter("fault <> 4").select(
        F.col("o_orderkey").alias("job_id"), unless(5, F.lit(G.STATUS[stage]), F.lit("running")).alias("status"),
        unless(6, text("S"), text("X")).alias("subject_id"), unless(7, text("m"), none.cast("string")).alias("motion_segment_id"),
        unless(8, text("d"), text("e")).alias("action_design_id"), unless(9, F.col("n"), F.col("n") + 1).alias("frame_count"),
        unless(10, text("a"), text("b")).alias("task_preflight_attempt"), unless(11, F.sha2(text("f"), 256), F.lit("0")).alias("task_preflight_input_fingerprint"),
        unless(12, F.lit(REPORT_VERSION), F.lit("v0")).alias("task_preflight_version"), unless(14, F.lit(False), F.lit(True)).alias("source_animation_imported"),
        unless(15, F.sequence(F.lit(1), F.col("n")), F.array(F.lit(0))).alias("rendered_frame_subset"), status(16).alias("geometry_motion_qc"),
        F.struct(unless(17, F.lit("passed"), F.lit("failed")).alias("status"), unless(19, F.col("n"), F.col("n") - 1).alias("frame_count")).alias("limb_deformation_qc"),
        F.when(F.col("fault") != 18, status(99)).alias("collision_gate"),
    )
    return reports, jobs


TASK_SQL = f"""SELECT o_orderkey AS job_id, CASE {FAULT} WHEN 1 THEN 'geometry_check_skipped' WHEN 2 THEN 'partial_frames_requested' WHEN 4 THEN 'status' WHEN 5 THEN 'status'
  WHEN 6 THEN 'identity:subject_id' WHEN 7 THEN 'identity:motion_segment_id' WHEN 8 THEN 'identity:action_design_id' WHEN 9 THEN 'identity:frame_count'
  WHEN 10 THEN 'identity:task_preflight_attempt' WHEN 11 THEN 'identity:task_preflight_input_fingerprint' WHEN 12 THEN 'contract_version' WHEN 13 THEN 'identity:action_design_id'
  WHEN 14 THEN 'source_animation_imported' WHEN 15 THEN 'rendered_frames' WHEN 16 THEN 'geometry_motion_qc' WHEN 17 THEN 'limb_deformation_qc' WHEN 18 THEN 'collision_gate'
  WHEN 19 THEN 'limb_coverage' ELSE 'ok' END AS verdict FROM orders"""


@query("task_gate_prepass", TASK_SQL)
def task_gate_prepass(t: Tables) -> DataFrame:
    return G.validate_task_reports(*task_pairs(t, "prepass")).select("job_id", "verdict")


@query("task_gate_final", TASK_SQL)
def task_gate_final(t: Tables) -> DataFrame:
    return G.validate_task_reports(*task_pairs(t, "final"), stage="final").select("job_id", "verdict")


def garment_reports(t: Tables) -> DataFrame:
    """One report per order, its lines in order as measured frames."""
    line = F.struct("l_linenumber", "l_quantity", "l_discount", "l_tax")
    frames = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("ls"))  # lines of one order
    rows = faulty(t).join(frames, F.col("o_orderkey") == F.col("l_orderkey"))
    frame = F.transform("ls", lambda l, i: F.struct(
        (i + 1).alias("frame"), F.when(l["l_quantity"] > 49, 1).otherwise(0).alias("intersection_pairs"),
        F.when(l["l_discount"] > 0.095, 0).otherwise(10).alias("cloth_triangles"), F.lit(20).alias("obstacle_triangles"),
    ))
    count = F.size("ls")
    return rows.select(
        F.col("o_orderkey").alias("job_id"), count.alias("frame_count"), unless(1, F.lit(GARMENT_VERSION), F.lit("v0")).alias("version"),
        unless(2, G.policy_column(), F.lit(None)).alias("policy"), unless(3, F.lit("passed"), F.lit("needs_review")).alias("status"),
        unless(4, F.array().cast("array<string>"), F.array(F.lit("x"))).alias("failures"), unless(5, count, count + 1).alias("expected_frame_count"),
        F.struct(unless(6, frame, F.slice(frame, F.lit(2), F.size("ls"))).alias("frames")).alias("surface_qc"),
        F.struct(
            unless(7, F.create_map(F.lit("a"), F.lit("b")), F.expr("map()").cast("map<string,string>")).alias("root_to_thigh"),
            unless(8, F.array().cast("array<int>"), F.array(F.lit(3))).alias("clipped_frames"),
            F.when(F.col("fault") == 9, 8.5).when(F.col("fault") != 10, 2.0).alias("max_frame_rotation_degrees"),
        ).alias("adaptation"),
    )


LINES = f"""ln AS (SELECT o_orderkey AS job_id, {FAULT} AS fault, count(*) AS n, max(CASE WHEN l_quantity > 49 OR l_discount > 0.095 THEN 1 ELSE 0 END) AS bad,
  max(CASE WHEN l_discount > 0.095 THEN 1 ELSE 0 END) AS empty, count(*) FILTER (l_quantity > 49) AS crossing,
  arg_min(CASE WHEN l_quantity > 49 OR l_discount > 0.095 THEN 1 ELSE 0 END, [l_linenumber, l_quantity, l_discount, l_tax]) AS bad_first,
  arg_min(CASE WHEN l_discount > 0.095 THEN 1 ELSE 0 END, [l_linenumber, l_quantity, l_discount, l_tax]) AS empty_first,
  arg_min(CASE WHEN l_quantity > 49 THEN 1 ELSE 0 END, [l_linenumber, l_quantity, l_discount, l_tax]) AS crossing_first
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


@query("garment_gate", f"""WITH {LINES} SELECT job_id, CASE WHEN fault IN (1, 2) THEN 'incompatible_report' WHEN fault IN (3, 4, 5) THEN 'needs_review' WHEN fault = 6 THEN 'frame_coverage'
  WHEN bad = 1 THEN 'intersections_or_missing_geometry' WHEN fault IN (7, 8) THEN 'adaptation' WHEN fault IN (9, 10) THEN 'rotation_discontinuity' ELSE 'ok' END AS verdict FROM ln""")
def garment_gate(t: Tables) -> DataFrame:
    return G.validate_garment(garment_reports(t)).select("job_id", "verdict")


@query("garment_reasons", f"""WITH {LINES}, x AS (SELECT job_id, fault, CASE WHEN fault = 6 THEN crossing - crossing_first ELSE crossing END AS crossing FROM ln),
e AS (SELECT o_orderkey AS job_id, count(*) FILTER (l_discount > 0.095) AS empty FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT x.job_id, concat_ws('|', CASE WHEN e.empty - CASE WHEN x.fault = 6 THEN ln.empty_first ELSE 0 END > 0 THEN 'missing_evaluated_garment_or_obstacle_geometry' END,
  CASE WHEN x.crossing > 0 THEN 'garment_surface_crossing_requires_review' END, CASE WHEN x.fault = 8 THEN 'garment_rotation_limit_reached' END,
  CASE WHEN x.fault = 9 THEN 'garment_rotation_discontinuity' END) AS reasons, CAST(x.crossing AS INTEGER) AS problem_frames
FROM x JOIN e ON e.job_id = x.job_id JOIN ln ON ln.job_id = x.job_id""")
def garment_reasons(t: Tables) -> DataFrame:
    out = G.garment_failures(garment_reports(t))
    return out.select("job_id", F.array_join("derived_failures", "|").alias("reasons"), F.size("problem_frames").alias("problem_frames"))


def prepass_reports(t: Tables) -> DataFrame:
    text = lambda prefix: F.concat(F.lit(prefix), F.col("o_orderkey").cast("string"))
    none = F.lit(None)
    preset = F.col("o_orderpriority") != "5-LOW"
    params = F.struct(
        unless(1, F.when(preset, G.PRESET_DESIGN).otherwise(G.SUBJECT_DESIGN), F.lit("planned")).alias("design_status"),
        unless(2, F.lit(False), F.lit(True)).alias("source_bone_rotations_used"),
        unless(3, F.when(preset, G.PRESET_SOLVER_2).otherwise(G.SUBJECT_SOLVER), F.lit("other")).alias("motion_solver"),
        F.to_json(F.struct(unless(4, F.lit(CATALOG_VERSION), F.lit("old")).alias("catalog_version"))).alias("expanded_blueprint"),
        text("o").alias("observation_path"), text("t").alias("trajectory_fingerprint"),
    )
    trajectory = F.struct(
        unless(5, F.lit("passed"), F.lit("failed")).alias("status"), unless(6, F.lit(0.2), F.lit(0.05)).alias("amplitude_normalized"),
        F.when(F.col("fault") == 7, "stop").when(F.col("fault") == 8, G.FREE_ENDING).alias("terminal_policy"),
        unless(9, F.lit(4), F.lit(2)).alias("terminal_hold_frames"), unless(10, F.lit(0.001), none.cast("double")).alias("terminal_hold_delta_normalized"),
        F.lit(0.001).alias("terminal_hold_velocity_normalized"), F.lit(0.001).alias("terminal_root_drift_normalized"), F.lit(0.001).alias("terminal_foot_drift_normalized"),
    )
    return faulty(t).select(
        F.col("o_orderkey").alias("job_id"), text("d").alias("job_action_design_id"),
        F.when(F.col("o_orderstatus") == "F", "halfbody").otherwise("fullbody").alias("job_framing"), params.alias("action_params"),
        unless(11, F.lit(False), F.lit(True)).alias("source_animation_imported"), unless(12, text("d"), text("x")).alias("action_design_id"),
        trajectory.alias("authored_trajectory_qc"), F.array(unless(13, F.lit("Body"), F.lit("Body_Outline")), F.lit("PonyTail")).alias("visible_character_meshes"),
        unless(14, F.lit("passed"), F.lit("needs_hair_adapter")).alias("hair_motion_qc_status"), F.lit(True).alias("hair_dynamic_expected"),
        unless(15, F.lit(3.0), F.lit(1.0)).alias("hair_secondary_peak_deg"), F.when(F.col("o_orderstatus") == "F", "halfbody").otherwise("fullbody").alias("framing"),
        unless(16, F.lit(0.5), F.lit(0.2)).alias("framing_vertical_fraction"),
    )


@query("prepass_gate", f"""SELECT o_orderkey AS job_id, CASE {FAULT} WHEN 1 THEN 'design_contract' WHEN 2 THEN 'design_contract' WHEN 3 THEN 'design_contract'
  WHEN 4 THEN CASE WHEN o_orderpriority <> '5-LOW' THEN 'design_contract' ELSE 'ok' END WHEN 5 THEN 'trajectory_qc' WHEN 6 THEN 'amplitude' WHEN 7 THEN 'terminal_policy'
  WHEN 9 THEN 'terminal_hold' WHEN 10 THEN 'terminal_settle' WHEN 11 THEN 'source_animation' WHEN 12 THEN 'design_identity' WHEN 13 THEN 'helper_mesh_visible'
  WHEN 14 THEN 'hair_adapter' WHEN 15 THEN 'hair_response' WHEN 16 THEN CASE WHEN o_orderstatus = 'F' THEN 'halfbody_framing' ELSE 'ok' END ELSE 'ok' END AS verdict FROM orders""")
def prepass_gate(t: Tables) -> DataFrame:
    return G.prepass_gate(prepass_reports(t)).select("job_id", "verdict")


@query("settings_gate", f"""SELECT o_orderkey AS job_id, CASE {FAULT} WHEN 1 THEN 'resolution' WHEN 2 THEN 'cycles_max_samples' WHEN 3 THEN 'cycles_min_samples'
  WHEN 4 THEN 'cycles_adaptive_threshold' WHEN 5 THEN 'cycles_denoising' WHEN 6 THEN 'preview' WHEN 7 THEN 'preview' ELSE 'ok' END AS verdict FROM orders""")
def settings_gate(t: Tables) -> DataFrame:
    setting = t.spark.createDataFrame([([1920, 1080], 64, 16, 0.01, True)], "resolution array<int>, samples int, min_samples int, threshold double, denoising boolean")
    pair = lambda a, b: F.array(F.lit(a), F.lit(b))
    reports = faulty(t).select(
        F.col("o_orderkey").alias("job_id"), F.col("n").alias("frame_count"), unless(1, pair(1920, 1080), pair(1280, 720)).alias("resolution"),
        unless(2, F.lit(64), F.lit(32)).alias("cycles_max_samples"), unless(3, F.lit(16), F.lit(None).cast("int")).alias("cycles_min_samples"),
        unless(4, F.lit(0.01), F.lit(0.02)).alias("cycles_adaptive_threshold"), unless(5, F.lit(True), F.lit(False)).alias("cycles_denoising"),
        F.struct(unless(6, F.lit(960), F.lit(640)).alias("width"), F.lit(540).alias("height"), unless(7, F.col("n"), F.col("n") + 1).alias("frames")).alias("probe"),
    )
    return G.settings_gate(reports, setting).select("job_id", "verdict")


@query("answer_gate", """WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity / 5 AS s, l_returnflag = 'A' AS fb, l_tax < 0.07 AS p, l_discount < 0.09 AS v, l_linestatus = 'O' AS j FROM lineitem),
b AS (SELECT *, greatest(0.0, least(1.0, CASE WHEN s > 1 THEN s / 10 ELSE s END)) AS score, NOT (j OR s > 2) AS none, l_linenumber IN (4, 6) AS broken FROM a)
SELECT l_orderkey, l_linenumber, CASE WHEN NOT none AND NOT broken THEN round(score, 8) END AS score,
  CASE WHEN none THEN 'no_json' WHEN l_linenumber = 4 THEN 'bad_json' WHEN l_linenumber = 6 THEN 'bad_score'
    WHEN p AND (v OR NOT fb) AND score >= 0.70 AND l_linenumber <> 7 THEN 'passed' ELSE 'failed' END AS status FROM b""")
def answer_gate(t: Tables) -> DataFrame:
    """Answers by line number: 2 spells its score as text, 3 its flags as text and number, 4 is cut short, 6 has words for a score, 7 an empty flag."""
    line, number = F.col("l_linenumber"), (F.col("l_quantity") / 5).cast("string")
    score = F.when(line == 2, F.concat(F.lit('"'), number, F.lit('"'))).when(line == 6, '"high"').otherwise(number)
    truth = lambda c: F.when(c, "true").otherwise("false")
    block = F.concat(
        F.lit('{"score": '), score, F.lit(', "perspective_consistent": '), truth(F.col("l_tax") < 0.07),
        F.lit(', "scale_consistent": '), F.when(line == 3, '"yes"').when(line == 7, '""').otherwise("true"), F.lit(', "placement_stable": '), F.when(line == 3, "1").otherwise("true"),
        F.lit(', "physically_plausible": true, "person_on_valid_surface": '), truth(F.col("l_discount") < 0.09), F.when(line == 4, ", }").otherwise("}"),
    )
    shown = (F.col("l_linestatus") == "O") | (F.col("l_quantity") / 5 > 2)
    text = F.concat(F.lit("Here is\nmy answer: "), F.when(shown, block).otherwise("none"), F.lit("\nDone."))
    answers = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "A", "fullbody").otherwise("halfbody").alias("framing"), text.alias("response"))
    return G.answer_gate(answers).select("l_orderkey", "l_linenumber", F.round("score", 8).alias("score"), "status")


@query("json_fields", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_fields(t: Tables) -> DataFrame:
    from cliploom.functions.text import first_json, json_field

    wrapped = F.concat(F.lit("answer: "), "props", F.lit(" end"))
    return t.events.select("event_id", json_field(first_json(wrapped), "$.k").cast("long").alias("k"))


# Audit reports: a user's event types are the checks, the largest value decides their status.
def audits(t: Tables) -> DataFrame:
    names = F.expr("CASE event_type WHEN 'view' THEN 'active_textures' WHEN 'click' THEN 'geometry_motion' WHEN 'error' THEN 'garment' WHEN 'signup' THEN 'hair_motion' ELSE 'load' END")
    per_check = t.events.groupBy("user_id", names.alias("check")).agg(F.max("value").alias("top"))
    status = F.when(F.col("top") > 300, "failed").otherwise("passed")
    entry = F.struct("check", F.struct(
        status.alias("status"), F.when((F.col("check") == "geometry_motion") & (F.col("top") > 200), "needs_review").alias("result_status"),
        F.when((F.col("check") == "hair_motion") & (F.col("top") > 220), "needs_hair_adapter").alias("hair_status"),
    ))
    grouped = per_check.groupBy("user_id").agg(F.map_from_entries(F.collect_list(entry)).alias("checks"))  # at most five checks
    return grouped.select(
        F.col("user_id").alias("subject_id"), "checks", F.when(F.col("user_id") % 31 == 0, "crash").alias("inspection_error"),
        F.when(F.col("user_id") % 7 == 0, F.array(F.lit("torso"))).otherwise(F.array().cast("array<string>")).alias("missing_controls"),
        F.array_repeat(F.lit("p"), 3 - (F.col("user_id") % 5 == 0).cast("int")).alias("previews"), F.lit(None).cast("string").alias("load_warning"),
    )


AUDIT_SQL = """c AS (SELECT user_id, CASE event_type WHEN 'view' THEN 'active_textures' WHEN 'click' THEN 'geometry_motion' WHEN 'error' THEN 'garment' WHEN 'signup' THEN 'hair_motion' ELSE 'load' END AS chk,
   max(value) AS top FROM events GROUP BY 1, 2),
b AS (SELECT *, top > 300 OR (chk = 'geometry_motion' AND top > 200) OR (chk = 'hair_motion' AND top > 220) AS blocking FROM c),
a AS (SELECT user_id AS subject_id, coalesce(array_to_string(list_sort(list(chk) FILTER (blocking)), ','), '') AS blocking_checks, count(*) FILTER (blocking) AS nb,
   coalesce(max(CASE WHEN chk = 'active_textures' AND top <= 300 THEN 1 END), 0) AS textures, count(*) FILTER (chk = 'active_textures') AS looked FROM b GROUP BY 1),
v AS (SELECT *, CASE WHEN subject_id % 31 = 0 OR looked = 0 THEN 'inspection_failed' WHEN textures = 0 THEN 'needs_asset_repair' WHEN subject_id % 7 = 0 THEN 'needs_adapter'
   WHEN nb > 0 OR subject_id % 5 = 0 THEN 'needs_quality_review' ELSE 'ready_for_task_preflight' END AS status FROM a)"""


@query("subject_verdict", f"WITH {AUDIT_SQL} SELECT subject_id, blocking_checks, status FROM v")
def subject_verdict(t: Tables) -> DataFrame:
    return G.subject_verdict(audits(t)).select("subject_id", F.array_join("blocking_checks", ",").alias("blocking_checks"), "status")


@query("complete_reports", f"""WITH {AUDIT_SQL} SELECT c_custkey AS subject_id, CASE WHEN v.status IS NULL OR v.subject_id % 3 = 0 THEN 'inspection_failed' ELSE v.status END AS status,
  CASE WHEN v.status IS NULL THEN 'process_failed' WHEN v.subject_id % 3 = 0 THEN CASE WHEN v.subject_id % 2 = 0 THEN 'timeout' ELSE 'process_failed' END END AS failure_reason
FROM customer LEFT JOIN v ON v.subject_id = c_custkey""")
def complete_reports(t: Tables) -> DataFrame:
    reports = G.subject_verdict(audits(t)).select(
        "subject_id", "status", F.when(F.col("subject_id") % 3 == 0, -1).otherwise(0).alias("exit_code"), (F.col("subject_id") % 2 == 0).alias("timed_out")
    )
    subjects = t.customer.select(F.col("c_custkey").alias("subject_id"), F.col("c_name").alias("asset_path"), F.col("c_mktsegment").alias("status"))
    return G.complete_reports(subjects, reports).select("subject_id", "status", "failure_reason")


@query("reason_counts", f"""WITH {AUDIT_SQL} SELECT chk AS reason, count(*) AS reports FROM b WHERE blocking GROUP BY chk""")
def reason_counts(t: Tables) -> DataFrame:
    return G.reason_counts(G.subject_verdict(audits(t)))


@query("stage_matrix", """SELECT o_orderpriority AS stage, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""")
def stage_matrix(t: Tables) -> DataFrame:
    return G.stage_matrix(t.orders.select(F.col("o_orderpriority").alias("stage"), F.col("o_orderstatus").alias("status")))


@query("audit_progress", """SELECT count(DISTINCT user_id) AS completed, (SELECT count(*) FROM customer) AS total,
  count(DISTINCT user_id) = (SELECT count(*) FROM customer) AS complete FROM events WHERE user_id IN (SELECT c_custkey FROM customer)""")
def audit_progress(t: Tables) -> DataFrame:
    return G.progress(t.events.select(F.col("user_id").alias("subject_id")), t.customer.select(F.col("c_custkey").alias("subject_id")))


@query("verdict_crosstab", """SELECT o_orderpriority AS historical_status, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
  count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def verdict_crosstab(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_orderpriority").alias("historical_status"), F.col("o_orderstatus").alias("status"))
    return G.verdict_crosstab(rows, values=["F", "O", "P"])


@query("time_stamps", """SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S%fZ') AS stamp, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS unix FROM events""")
def time_stamps(t: Tables) -> DataFrame:
    from cliploom.functions.text import utc_stamp

    since = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return t.events.select("event_id", utc_stamp(F.col("ts")).alias("stamp"), since.alias("unix"))


def _assigned(t: Tables) -> DataFrame:
    """Orders as jobs that were given a preset of their own."""
    text = F.concat(F.lit("p"), F.col("o_orderkey").cast("string"))
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("subject_id"), (F.col("o_orderkey") % 12).cast("int").alias("subject_action_index"),
        F.lit(120).alias("frame_count"), text.alias("preset_id"), F.lit(CATALOG_VERSION).alias("catalog_version"), F.array(F.col("o_totalprice")).alias("trajectory_descriptor"),
        F.sha1(text).alias("trajectory_fingerprint"), F.sha1(text).alias("blueprint_signature"), text.alias("source_motion_path"),
        F.array(F.lit(10), F.lit(40)).cast("array<long>").alias("source_frames"), F.lit(30.0).alias("source_fps"), text.alias("source_segment_id"),
    )


def _earlier_designs(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("job_id"), F.lit(-1).cast("long").alias("design_seq"))


@query("design_rows", """SELECT o_orderkey AS job_id, row_number() OVER (ORDER BY 'S' || CAST(o_custkey AS VARCHAR), o_orderkey) - 1 AS design_seq,
  substr(sha1('expanded-preset-v1:S' || CAST(o_custkey AS VARCHAR) || ':' || CAST(o_orderkey AS VARCHAR) || ':p' || CAST(o_orderkey AS VARCHAR)), 1, 24) AS action_design_id,
  'p' || CAST(o_orderkey AS VARCHAR) AS preset_id, 31 AS source_frame_count FROM orders WHERE o_orderkey NOT IN (SELECT doc_id FROM documents)""")
def design_rows(t: Tables) -> DataFrame:
    rows, _ = Q.design_rows(_assigned(t), _earlier_designs(t))
    field = lambda name: F.get_json_object("action_params_json", f"$.{name}")
    return rows.select("job_id", "design_seq", "action_design_id", field("expanded_preset_id").alias("preset_id"), field("source_frame_count").cast("int").alias("source_frame_count"))


@query("designed_jobs", f"""WITH jobs AS ({JOBS_SQL})
SELECT id, status, attempts, subject_id, CASE WHEN d THEN 'expanded_preset' END AS recipe,
  CASE WHEN d THEN substr(sha1('expanded-preset-v1:' || subject_id || ':' || id || ':p' || id), 1, 24) END AS action_design_id,
  CASE WHEN d THEN 'p' || id ELSE action_params_json END AS preset, CASE WHEN d THEN 'p' || id END AS motion_segment_id,
  CASE WHEN d THEN 'p' || id ELSE 'old/' || id END AS motion_path, CASE WHEN d THEN 10 END AS source_start_frame
FROM (SELECT *, id NOT IN (SELECT doc_id FROM documents) AS d FROM jobs)""")
def designed_jobs(t: Tables) -> DataFrame:
    """The jobs table after the designs of ``design_rows``; jobs with an earlier design stay as they are."""
    assigned = _assigned(t)
    rows, _ = Q.design_rows(assigned, _earlier_designs(t))
    now = jobs(t).withColumn("motion_path", F.concat(F.lit("old/"), F.col("id").cast("string")))
    params = F.coalesce(F.get_json_object("action_params_json", "$.expanded_preset_id"), "action_params_json").alias("preset")
    return Q.designed_jobs(now, assigned, rows).select(
        "id", "status", "attempts", "subject_id", "recipe", "action_design_id", params, "motion_segment_id", "motion_path", "source_start_frame"
    )
