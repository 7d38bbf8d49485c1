"""Gates: nested quality reports to verdicts.

Every gate gives the first failed check (``verdict``, ``ok`` when none) and all failed
checks, from one pass over the report rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.functions.text import contains_any, first_json, is_helper_outline
from cliploom.schemas import CATALOG_VERSION, GARMENT_VERSION, REPORT_VERSION

# Identity keys, sub-checks and statuses of a task report.
IDENTITY = (
    "subject_id", "motion_segment_id", "action_design_id", "frame_count",
    "task_preflight_attempt", "task_preflight_input_fingerprint",
)
SUB_CHECKS = ("geometry_motion_qc", "limb_deformation_qc", "collision_gate")
STATUS = {"prepass": "passed_prepass", "final": "rendered_rgba"}


def verdicts(df: DataFrame, tests: Mapping[str, Column], drop: Sequence[str] = ()) -> DataFrame:
    """Attach ``failures`` (all, in order) and ``verdict`` (the first, or ok). Unknown counts as failed."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(True)), F.lit(name)) for name, test in tests.items()]))
    out = df.withColumn("failures", found)
    return out.withColumn("verdict", F.coalesce(F.get("failures", F.lit(0)), F.lit("ok"))).drop(*drop)


def _equal(a: Column, b) -> Column:
    return a.eqNullSafe(b if isinstance(b, Column) else F.lit(b))


def full_range(n: Column) -> Column:
    """1..n as an array; null for a count below one."""
    return F.when(n >= 1, F.sequence(F.lit(1), n.cast("int")))


def validate_task_reports(reports: DataFrame, jobs: DataFrame, stage: str = "prepass") -> DataFrame:
    """Fresh-report contract of a task: bypass flags, status, identity, version, frames, sub-checks.

    Reports are matched to jobs by ``job_id``; a job without report fails the status check.
    """
    jobs = jobs.select(F.col("job_id"), *[F.col(c).alias(f"_job_{c}") for c in (*IDENTITY, "debug_skip_geometry_qc", "prepass_render_frames")])
    rows = jobs.join(reports, "job_id", "left")
    wanted = full_range(F.col("_job_frame_count"))
    asked = F.col("_job_prepass_render_frames")
    tests: dict[str, Column] = {
        "geometry_check_skipped": F.coalesce(F.col("_job_debug_skip_geometry_qc"), F.lit(False)),
        "partial_frames_requested": F.when(asked.isNull(), False).otherwise(~_equal(asked, wanted)),
        "status": ~_equal(F.col("status"), STATUS[stage]),
    }
    for key in IDENTITY:
        tests[f"identity:{key}"] = F.col(f"_job_{key}").isNull() | ~_equal(F.col(key), F.col(f"_job_{key}"))
    tests["contract_version"] = ~_equal(F.col("task_preflight_version"), REPORT_VERSION)
    tests["source_animation_imported"] = ~_equal(F.col("source_animation_imported"), False)
    tests["rendered_frames"] = ~_equal(F.col("rendered_frame_subset"), wanted)
    for key in SUB_CHECKS:
        tests[key] = ~_equal(F.col(f"{key}.status"), "passed")
    tests["limb_coverage"] = ~_equal(F.col("limb_deformation_qc.frame_count"), F.col("_job_frame_count"))
    return verdicts(rows, tests, [c for c in rows.columns if c.startswith("_job_")])


# The garment policy a report must carry.
GARMENT_POLICY = {
    "version": GARMENT_VERSION, "enabled": True, "unknown_policy": "needs_review",
    "intersection_policy": "reject_any_surface_crossing", "all_frames": True,
    "max_rotation_degrees": 50, "max_frame_rotation_degrees": 8,
}


def policy_column() -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in GARMENT_POLICY.items()])


def garment_failures(reports: DataFrame) -> DataFrame:
    """Failure reasons derived from a garment report's measured frames."""
    frames = F.col("surface_qc.frames")
    crossing = F.filter(frames, lambda f: F.coalesce(f["intersection_pairs"], F.lit(0)) > 0)
    empty = F.exists(frames, lambda f: (F.coalesce(f["cloth_triangles"], F.lit(0)) == 0) | (F.coalesce(f["obstacle_triangles"], F.lit(0)) == 0))
    found = F.array_compact(F.array(
        F.when(empty, "missing_evaluated_garment_or_obstacle_geometry"),
        F.when(F.size(crossing) > 0, "garment_surface_crossing_requires_review"),
        F.when(F.size("adaptation.clipped_frames") > 0, "garment_rotation_limit_reached"),
        F.when(F.col("adaptation.max_frame_rotation_degrees") > GARMENT_POLICY["max_frame_rotation_degrees"], "garment_rotation_discontinuity"),
    ))
    out = reports.withColumn("derived_failures", found).withColumn("problem_frames", F.transform(crossing, lambda f: f["frame"]))
    return out.withColumn("derived_status", F.when(F.size("derived_failures") == 0, "passed").otherwise("needs_review"))


def validate_garment(reports: DataFrame, frame_count: str = "frame_count") -> DataFrame:
    """Garment contract: rejects stale, partial and inconsistent passes."""
    frames = F.col("surface_qc.frames")
    n = F.col(frame_count)
    velocity = F.col("adaptation.max_frame_rotation_degrees")
    clean = F.forall(frames, lambda f: _equal(f["intersection_pairs"], 0) & (F.coalesce(f["cloth_triangles"], F.lit(0)) > 0) & (F.coalesce(f["obstacle_triangles"], F.lit(0)) > 0))
    return verdicts(reports, {
        "incompatible_report": ~_equal(F.col("version"), GARMENT_VERSION) | ~_equal(F.col("policy"), policy_column()),
        "needs_review": ~_equal(F.col("status"), "passed") | (F.size(F.coalesce("failures", F.array().cast("array<string>"))) > 0) | ~_equal(F.col("expected_frame_count"), n),
        "frame_coverage": ~_equal(F.transform(frames, lambda f: f["frame"]), full_range(n)),
        "intersections_or_missing_geometry": ~clean,
        "adaptation": (F.coalesce(F.size("adaptation.root_to_thigh"), F.lit(0)) < 1) | ~(F.size("adaptation.clipped_frames") == 0),
        "rotation_discontinuity": ~(velocity <= GARMENT_POLICY["max_frame_rotation_degrees"]),
    })


# Design contracts and limits of the pre-render gate.
PRESET_DESIGN, SUBJECT_DESIGN = "expanded_safe_preset_v1_assigned_jit", "subject_action_blueprint_v4_assigned_jit"
PRESET_SOLVER, PRESET_SOLVER_2 = "target_native_safe_preset_ik_v1", "target_native_safe_preset_ik_v2"
SUBJECT_SOLVER = "subject_specific_landmark_ik_v4"
FREE_ENDING = "preserve_source_motion_without_forced_stop"
TERMINAL_LIMITS = {
    "terminal_hold_delta_normalized": 0.004, "terminal_hold_velocity_normalized": 0.003,
    "terminal_root_drift_normalized": 0.002, "terminal_foot_drift_normalized": 0.002,
}
MIN_AMPLITUDE, MIN_HOLD_FRAMES, MIN_HAIR_DEG, MIN_HALFBODY = 0.075, 3, 1.5, 0.35
VISIBLE_HAIR_WORDS = ("hair", "ponytail", "braid", "bang")


def design_contract(params: str = "action_params") -> Column:
    """First violated clause of an action's design contract, else null."""
    p = lambda name: F.col(f"{params}.{name}")
    given = lambda c: F.coalesce(c.cast("string"), F.lit("")) != ""
    catalog = F.get_json_object(p("expanded_blueprint"), "$.catalog_version")
    solver_ok = _equal(p("motion_solver"), PRESET_SOLVER) | (_equal(p("motion_solver"), PRESET_SOLVER_2) & _equal(catalog, CATALOG_VERSION))
    preset = _equal(p("design_status"), PRESET_DESIGN)
    subject = _equal(p("design_status"), SUBJECT_DESIGN)
    return (
        F.when(~(preset | subject), "no_design")
        .when(~_equal(p("source_bone_rotations_used"), False), "source_rotations")
        .when(preset & ~(solver_ok & given(p("expanded_blueprint"))), "preset_contract")
        .when(subject & ~(_equal(p("motion_solver"), SUBJECT_SOLVER) & given(p("observation_path")) & given(p("trajectory_fingerprint"))), "subject_contract")
    )


def prepass_gate(reports: DataFrame) -> DataFrame:
    """Pre-render gate on joined job and report columns.

    Job side: ``job_action_design_id``, ``job_framing``, ``action_params``; the rest is the report.
    """
    t = lambda name: F.col(f"authored_trajectory_qc.{name}")
    policy = t("terminal_policy")
    over = F.lit(False)
    for name, limit in TERMINAL_LIMITS.items():
        over = over | (F.coalesce(t(name), F.lit(float("inf"))) > limit)
    names = F.transform(F.coalesce("visible_character_meshes", F.array().cast("array<string>")), lambda n: F.lower(n))
    has_hair = F.exists(names, lambda n: contains_any(n, VISIBLE_HAIR_WORDS))
    helper = F.exists(names, lambda n: n.contains("outline") | n.startswith("shadow"))
    half = _equal(F.col("job_framing"), "halfbody")
    rows = reports.withColumn("visible_hair", has_hair)
    return verdicts(rows, {
        "design_contract": design_contract().isNotNull(),
        "source_animation": ~_equal(F.col("source_animation_imported"), False),
        "design_identity": ~_equal(F.col("action_design_id"), F.col("job_action_design_id")),
        "trajectory_qc": ~_equal(t("status"), "passed"),
        "amplitude": F.coalesce(t("amplitude_normalized"), F.lit(0.0)) < MIN_AMPLITUDE,
        "terminal_policy": policy.isNotNull() & (policy != FREE_ENDING),
        "terminal_hold": policy.isNull() & (F.coalesce(t("terminal_hold_frames"), F.lit(0)) < MIN_HOLD_FRAMES),
        "terminal_settle": policy.isNull() & over,
        "hair_adapter": _equal(F.col("hair_motion_qc_status"), "needs_hair_adapter"),
        "hair_response": has_hair & F.coalesce("hair_dynamic_expected", F.lit(False)) & (F.coalesce("hair_secondary_peak_deg", F.lit(0.0)) < MIN_HAIR_DEG),
        "helper_mesh_visible": helper,
        "halfbody_framing": half & (~_equal(F.col("framing"), "halfbody") | (F.coalesce("framing_vertical_fraction", F.lit(0.0)) < MIN_HALFBODY)),
    })


def settings_gate(reports: DataFrame, setting: DataFrame, probe: tuple[int, int] = (960, 540)) -> DataFrame:
    """Final report against the one-row settings table, and the preview's size and length."""
    one = setting.agg(*[F.first(c).alias(f"_set_{c}") for c in ("resolution", "samples", "min_samples", "threshold", "denoising")])
    rows = reports.crossJoin(F.broadcast(one))  # one settings row
    return verdicts(rows, {
        "resolution": ~_equal(F.col("resolution"), F.col("_set_resolution")),
        "cycles_max_samples": ~_equal(F.col("cycles_max_samples"), F.col("_set_samples")),
        "cycles_min_samples": ~_equal(F.col("cycles_min_samples"), F.col("_set_min_samples")),
        "cycles_adaptive_threshold": ~_equal(F.col("cycles_adaptive_threshold"), F.col("_set_threshold")),
        "cycles_denoising": ~_equal(F.col("cycles_denoising"), F.col("_set_denoising")),
        "preview": ~(_equal(F.col("probe.width"), probe[0]) & _equal(F.col("probe.height"), probe[1]) & _equal(F.col("probe.frames"), F.col("frame_count"))),
    }, [c for c in rows.columns if c.startswith("_set_")])


# Answer flags and the passing score.
ANSWER_FLAGS = ("perspective_consistent", "scale_consistent", "placement_stable", "physically_plausible")
FULLBODY_FLAG = "person_on_valid_surface"
PASSING_SCORE = 0.70


def _truth(value: Column) -> Column:
    """Whether a JSON value counts as yes: true, a number but 0, text or a container but an empty one."""
    kind, text = F.schema_of_variant(value), F.to_json(value)
    return F.coalesce(
        F.when(kind == "BOOLEAN", text == "true").when(kind == "VOID", F.lit(False))
        .when(kind == "STRING", text != '""').when(kind.startswith("ARRAY"), text != "[]").when(kind.startswith("OBJECT"), text != "{}")
        .otherwise(F.try_variant_get(value, "$", "double") != 0),
        F.lit(False),
    )


def answer_gate(answers: DataFrame, response: str = "response", framing: str = "framing") -> DataFrame:
    """Score and verdict from a free-text model answer that holds one JSON block.

    A score may be a number, a truth value or text that spells a number; flags count by
    their truth. ``bad_json``: the block does not parse; ``bad_score``: no number.
    """
    rows = answers.withColumn("_block", first_json(F.col(response))).withColumn("_a", F.try_parse_json("_block"))
    item = lambda name: F.try_variant_get("_a", f"$.{name}", "variant")
    given = item("score")
    kind = F.schema_of_variant(given)
    number = (
        F.when(given.isNull(), F.lit(0.0)).when(kind == "BOOLEAN", F.when(F.to_json(given) == "true", 1.0).otherwise(0.0))
        .otherwise(F.try_variant_get("_a", "$.score", "string").try_cast("double"))
    )
    number = F.when(F.isnan(number), F.lit(None)).otherwise(number)
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(number > 1.0, number / 10.0).otherwise(number)))
    yes = lambda name: _truth(item(name))
    flags = yes(ANSWER_FLAGS[0])
    for name in ANSWER_FLAGS[1:]:
        flags = flags & yes(name)
    flags = flags & (yes(FULLBODY_FLAG) | (F.col(framing) != "fullbody"))
    parsed = F.col("_a").isNotNull() & F.schema_of_variant("_a").startswith("OBJECT")
    rows = rows.withColumn("score", F.when(parsed & number.isNotNull(), score))
    return rows.withColumn(
        "status",
        F.when(F.col("_block").isNull(), "no_json").when(~F.coalesce(parsed, F.lit(False)), "bad_json").when(F.col("score").isNull(), "bad_score")
        .when(flags & (F.col("score") >= PASSING_SCORE), "passed").otherwise("failed"),
    ).drop("_block", "_a")


# Result fields that make a passed audit check blocking.
RESULT_CHECKS = ("geometry_motion", "limb_deformation", "hair_motion")
AUDIT_PREVIEWS = 3


def subject_verdict(audits: DataFrame) -> DataFrame:
    """Verdict per audit report by priority, with its sorted blocking checks.

    ``checks`` maps a check name to struct(status, result_status, hair_status);
    ``inspection_error``, ``missing_controls``, ``previews`` and ``load_warning`` complete it.
    """
    direct = F.map_keys(F.map_filter("checks", lambda _, v: ~F.coalesce(v["status"], F.lit("")).isin("passed", "skipped")))
    result = F.map_keys(F.map_filter("checks", lambda k, v: k.isin(*RESULT_CHECKS) & (
        F.coalesce(v["result_status"], F.lit("")).isin("failed", "needs_review") | _equal(v["hair_status"], "needs_hair_adapter"))))
    rows = audits.withColumn("blocking_checks", F.array_sort(F.array_union(direct, result)))
    textures = F.try_element_at("checks", F.lit("active_textures"))["status"]
    status = (
        F.when(F.col("inspection_error").isNotNull() | textures.isNull(), "inspection_failed")
        .when(~_equal(textures, "passed"), "needs_asset_repair")
        .when(F.size("missing_controls") > 0, "needs_adapter")
        .when((F.size("blocking_checks") > 0) | (F.coalesce("load_warning", F.lit("")) != "") | (F.size("previews") != AUDIT_PREVIEWS), "needs_quality_review")
        .otherwise("ready_for_task_preflight")
    )
    return rows.withColumn("status", status)


def complete_reports(subjects: DataFrame, reports: DataFrame) -> DataFrame:
    """One report row per audited subject; a missing or unfinished report is a failed inspection."""
    joined = subjects.select("subject_id", "asset_path", F.col("status").alias("historical_status")).join(
        reports.select("subject_id", F.col("status").alias("_status"), "exit_code", "timed_out"), "subject_id", "left"
    )
    broken = F.col("_status").isNull() | (F.coalesce("exit_code", F.lit(0)) != 0)
    return joined.select(
        "subject_id", "asset_path", "historical_status",
        F.when(broken, "inspection_failed").otherwise(F.col("_status")).alias("status"),
        F.when(broken, F.when(F.coalesce("timed_out", F.lit(False)), "timeout").otherwise("process_failed")).alias("failure_reason"),
        F.lit(False).alias("production_eligible"),
    )


def reason_counts(audits: DataFrame, reasons: str = "blocking_checks") -> DataFrame:
    """Reports per failure reason; a report with several reasons counts for each."""
    return audits.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("reports"))


def stage_matrix(stages: DataFrame) -> DataFrame:
    """Counts per (stage, status) with subtotals per stage and a grand total."""
    return stages.rollup("stage", "status").agg(F.count(F.lit(1)).alias("n"))


def progress(reports: DataFrame, plan: DataFrame, key: str = "subject_id") -> DataFrame:
    """One row: completed, total and whether the plan is complete."""
    done = reports.select(key).distinct().withColumn("_done", F.lit(True))
    counted = plan.join(done, key, "left").agg(F.count("_done").alias("completed"), F.count(F.lit(1)).alias("total"))
    return counted.withColumn("complete", F.col("completed") == F.col("total"))


def verdict_crosstab(reports: DataFrame, rows: str = "historical_status", columns: str = "status", values: Sequence[str] | None = None) -> DataFrame:
    """Earlier label by new verdict; pass the verdicts to spare the pass that finds them."""
    return reports.groupBy(rows).pivot(columns, list(values) if values else None).count().fillna(0)


MIN_DYNAMIC_CHAIN, MIN_STATIC_HAIR = 0.06, 0.22  # fixed values, in body heights


def hair_verdict(clips: DataFrame, branches: DataFrame, clip: Sequence[str] = ("clip",)) -> DataFrame:
    """Whether hair should move, and whether long visible hair has no moving branch.

    ``clips`` holds clip, height and visible_extent (null without a hair mesh); ``branches``
    clip and length.
    """
    longest = branches.groupBy(*clip).agg(F.max("length").alias("_longest"), F.count(F.lit(1)).alias("branches"))
    rows = clips.join(longest, list(clip), "left").fillna(0, ["branches"])
    chain = F.coalesce("_longest", F.lit(0.0)) / F.col("height")
    still = F.col("visible_extent").isNotNull() & (F.col("branches") == 0) & (F.col("visible_extent") / F.col("height") >= MIN_STATIC_HAIR)
    return rows.select(
        *clip, "branches", chain.alias("longest_chain"), (chain >= MIN_DYNAMIC_CHAIN).alias("dynamic_expected"),
        F.when(F.coalesce(still, F.lit(False)), "needs_hair_adapter").otherwise("passed").alias("hair_motion_qc_status"),
    )


def helper_meshes(objects: DataFrame, name: str = "name", label: str = "label") -> DataFrame:
    """Outline and shadow helper objects by name and material text."""
    return objects.withColumn("is_helper", is_helper_outline(F.col(name), F.col(label)))
