"""Job table operators: status, dispatch, pairing gates and state transitions.

Jobs are an immutable snapshot; a transition returns the next snapshot and, where it
applies, the event rows to append. Nothing here collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.functions.hashing import short_sha1
from cliploom.functions.text import failure_class, failure_status, framing_or_null, is_unsafe, json_field
from cliploom.operators.kernels import number_rows
from cliploom.schemas import PAIRING_VERSION

# States from which an explicit retry may start, and the activation states.
RETRYABLE = (
    "failed", "failed_prepass", "paused_subject_qc", "paused_motion_redesign",
    "waiting_adapter", "waiting_missing_background",
)
WAITING_REVIEW = "waiting_release_review"
WAITING_BACKGROUND = "waiting_missing_background"
PAUSED = "paused_subject_qc"
DESIGN_STATUS = "expanded_safe_preset_v1_assigned_jit"


# ---- status and audits -------------------------------------------------------------

def queue_status(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("status").agg(F.count(F.lit(1)).alias("jobs"))


def queue_overview(jobs: DataFrame) -> DataFrame:
    """One row: jobs, distinct subjects, running and pending counts."""
    return jobs.agg(
        F.count(F.lit(1)).alias("jobs"),
        F.countDistinct("subject_id").alias("subjects"),
        F.count_if(F.col("status") == "running").alias("running"),
        F.count_if(F.col("status") == "pending").alias("pending"),
    )


def running_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.filter(F.col("status") == "running").select("id", "worker_id", "pid")


def has_active(jobs: DataFrame) -> DataFrame:
    """One row: whether any job is pending or running; each task sends one value."""
    return jobs.agg(F.coalesce(F.bool_or(F.col("status").isin("pending", "running")), F.lit(False)).alias("active"))


def quota_audit(jobs: DataFrame, full: int = 6, half: int = 3, hair: int = 3) -> DataFrame:
    """Framing counts per subject against the plan of 6 / 3 / 3."""
    n = lambda name: F.count_if(F.col("framing") == name)
    counts = jobs.groupBy("subject_id").agg(
        F.count(F.lit(1)).alias("jobs"),
        n("fullbody").alias("fullbody"),
        n("halfbody").alias("halfbody"),
        n("closeup_hair").alias("closeup_hair"),
    )
    return counts.withColumn(
        "meets_plan",
        (F.col("fullbody") == full) & (F.col("halfbody") == half) & (F.col("closeup_hair") == hair)
        & (F.col("jobs") == full + half + hair),
    )


def attempts(events: DataFrame) -> DataFrame:
    return events.groupBy("job_id").agg(F.count_if(F.col("event") == "claimed").alias("attempts"))


def split_leakage(jobs: DataFrame, background: str = "background_path") -> DataFrame:
    """Backgrounds used by more than one split."""
    return (
        jobs.groupBy(background)
        .agg(F.min("split").alias("first_split"), F.max("split").alias("last_split"), F.count(F.lit(1)).alias("jobs"))
        .filter(F.col("first_split") != F.col("last_split"))
    )


def latest_state(events: DataFrame, job: str, order: list[str], columns: list[str]) -> DataFrame:
    """Last row per job in a total order; a partial aggregate, not a window."""
    packed = F.max(F.struct(*order, *columns)).alias("_last")
    return events.groupBy(job).agg(packed).select(job, *[F.col(f"_last.{c}").alias(c) for c in [*order, *columns]])


# ---- dispatch ----------------------------------------------------------------------

def dispatch_wave(jobs: DataFrame, k: int | None = None) -> DataFrame:
    """Next jobs to start: one per subject that has none running.

    Within a subject train jobs come first, then the smallest id. One aggregation per
    subject answers both questions, so a subject that owns many jobs is reduced before
    the shuffle and no join is needed.
    """
    pending = F.col("status") == "pending"
    train = F.min(F.when(pending & (F.col("split") == "train"), F.col("id")))
    any_split = F.min(F.when(pending, F.col("id")))
    best = (
        jobs.groupBy("subject_id")
        .agg(F.max(F.col("status") == "running").alias("busy"), train.alias("_train"), any_split.alias("_any"))
        .filter(~F.col("busy") & F.col("_any").isNotNull())
        .select(
            F.coalesce("_train", "_any").alias("id"),
            "subject_id",
            F.when(F.col("_train").isNotNull(), 0).otherwise(1).alias("split_rank"),
        )
    )
    if k is None:
        return best
    return best.orderBy("split_rank", "subject_id", "id").limit(k)


def next_seq(new: DataFrame, existing: DataFrame, seq: str, order: list[str]) -> DataFrame:
    """Continue a dense sequence: (largest existing, or -1) + 1, 2, … in ``order``."""
    top = existing.agg(F.coalesce(F.max(seq), F.lit(-1)).cast("long").alias("_top"))  # one row
    numbered = number_rows(new, [], order, "_n")
    return numbered.crossJoin(F.broadcast(top)).withColumn(seq, F.col("_top") + F.col("_n")).drop("_top", "_n")


# ---- gates -------------------------------------------------------------------------

def registry_gate(jobs: DataFrame, registry: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Verdict per job: registry purely human, subject unique in it, asset path equal and present."""
    whole = registry.agg(
        (F.count(F.lit(1)) > 0).alias("_any"),
        F.coalesce(F.max(F.coalesce(F.col("asset_kind"), F.lit("")) != "human"), F.lit(True)).alias("_foreign"),
    )  # one row
    per_subject = registry.groupBy("subject_id").agg(
        F.count(F.lit(1)).alias("_entries"), F.min("asset_path").alias("_registered")
    )
    joined = jobs.join(per_subject, "subject_id", "left").crossJoin(F.broadcast(whole))
    verdict = (
        F.when(~F.col("_any") | F.col("_foreign"), "registry_not_human_only")
        .when(F.coalesce(F.col("_entries"), F.lit(0)) != 1, "subject_not_unique")
        .when(~F.col("asset_path").eqNullSafe(F.col("_registered")), "asset_path_differs")
    )
    if files is not None:
        present = files.select(F.col("path").alias("asset_path")).distinct().withColumn("_present", F.lit(True))
        joined = joined.join(present, "asset_path", "left")
        verdict = verdict.when(F.col("_present").isNull(), "asset_missing")
    return joined.withColumn("registry_verdict", verdict.otherwise("ok")).drop(
        "_entries", "_registered", "_any", "_foreign", "_present"
    )


def resolve_refs(df: DataFrame, ref: str, roots: Mapping[str, str], out: str = "path") -> DataFrame:
    """``alias://relative`` to a path under the alias's root, with a verdict.

    Roots are a settings document of a few entries, so they are a literal map: a join on
    the alias would send every row of an alias to one task.
    """
    entries = [F.lit(x) for pair in roots.items() for x in pair]
    table = F.create_map(*entries) if entries else F.expr("map('', '')")
    has_separator = F.col(ref).contains("://")
    root = F.element_at(table, F.substring_index(F.col(ref), "://", 1))
    relative = F.expr(f"substring({ref}, instr({ref}, '://') + 3)")
    verdict = (
        F.when(~F.coalesce(has_separator, F.lit(False)) | root.isNull(), "unknown_reference")
        .when(is_unsafe(relative), "unsafe_path")
        .otherwise("ok")
    )
    return df.withColumn("ref_verdict", verdict).withColumn(
        out, F.when(F.col("ref_verdict") == "ok", F.concat(root, F.lit("/"), relative))
    )


def assign_pairings(jobs: DataFrame, pairs: DataFrame, roots: Mapping[str, str], files: DataFrame) -> DataFrame:
    """Join each job with its approved background; ordered verdict, nested struct when ok."""
    side = resolve_refs(
        pairs.select(
            "sample_id", "background_ref", "precheck_method", "placement_json",
            F.col("background_start_sec").alias("_start"), "compatibility_score",
            F.col("framing").alias("_frozen"), "approval_status", "manifest_version",
        ).withColumn("_listed", F.lit(True)),
        "background_ref", roots, "_path",
    )
    present = files.select(F.col("path").alias("_path")).distinct().withColumn("_present", F.lit(True))
    joined = jobs.join(side.join(present, "_path", "left"), "sample_id", "left")
    wanted = framing_or_null(F.coalesce(json_field(F.col("action_params_json"), "$.subject_action_index").cast("int"), F.lit(0)))
    verdict = (
        F.when(F.col("_listed").isNull(), "no_pairing")
        .when(~F.col("manifest_version").eqNullSafe(F.lit(PAIRING_VERSION)), "unsupported_version")
        .when(~F.col("approval_status").eqNullSafe(F.lit("approved")), "not_approved")
        .when(F.col("ref_verdict") != "ok", F.col("ref_verdict"))
        .when(F.col("_present").isNull(), "background_missing")
        .when(wanted.isNull(), "action_index_out_of_range")
        .when(~wanted.eqNullSafe(F.col("_frozen")), "framing_mismatch")
        .otherwise("ok")
    )
    ok = F.col("pairing_verdict") == "ok"
    pairing = F.struct(
        F.lit(PAIRING_VERSION).alias("version"),
        "background_ref",
        F.col("_start").alias("background_start_sec"),
        "compatibility_score", "precheck_method",
        F.from_json("placement_json", "map<string,double>").alias("placement"),
    )
    keep = [c for c in jobs.columns if c not in {
        "background_path", "background_start_sec", "framing", "background_motion_hint", "action_params_json"}]
    old = lambda name, kind: F.col(name) if name in jobs.columns else F.lit(None).cast(kind)
    joined = joined.withColumn("pairing_verdict", verdict).withColumn("scene_pairing", F.when(ok, pairing))
    return joined.select(
        *keep,
        F.when(ok, F.col("_path")).otherwise(old("background_path", "string")).alias("background_path"),
        F.when(ok, F.col("_start")).otherwise(old("background_start_sec", "double")).alias("background_start_sec"),
        F.when(ok, wanted).otherwise(old("framing", "string")).alias("framing"),
        F.when(ok, F.lit("frozen_offline_prechecked"))
        .otherwise(old("background_motion_hint", "string")).alias("background_motion_hint"),
        F.when(ok, with_field(F.col("action_params_json"), "scene_pairing", F.to_json("scene_pairing")))
        .otherwise(F.col("action_params_json")).alias("action_params_json"),
        "pairing_verdict", "scene_pairing",
    )


def with_field(json_text: Column, name: str, value_json: Column) -> Column:
    """Append one field to a JSON object text."""
    body = F.rtrim(F.coalesce(json_text, F.lit("{}")))
    opened = F.regexp_replace(body, r"\}\s*$", "")
    comma = F.when(F.trim(opened) == "{", "").otherwise(",")
    return F.concat(opened, comma, F.lit(f'"{name}":'), value_json, F.lit("}"))


# ---- transitions -------------------------------------------------------------------

def activate(jobs: DataFrame, registry: DataFrame, pairs: DataFrame, roots: Mapping[str, str], files: DataFrame) -> DataFrame:
    """Waiting jobs of registered humans become pending, or blocked without a background.

    Historic quality labels of the registry are not looked at.
    """
    humans = registry.filter(F.col("asset_kind") == "human").select("subject_id").distinct().withColumn("_human", F.lit(True))
    present = files.select(F.col("path").alias("_path")).distinct()
    ready = (
        resolve_refs(pairs.select("sample_id", "background_ref"), "background_ref", roots, "_path")
        .filter(F.col("ref_verdict") == "ok")
        .join(present, "_path", "left_semi")
        .select("sample_id").distinct().withColumn("_ready", F.lit(True))
    )
    waiting = (F.col("status") == WAITING_REVIEW) & F.col("_human").isNotNull()
    return (
        jobs.join(humans, "subject_id", "left")
        .join(ready, "sample_id", "left")
        .withColumn(
            "status",
            F.when(waiting & F.col("_ready").isNotNull(), "pending")
            .when(waiting, WAITING_BACKGROUND)
            .otherwise(F.col("status")),
        )
        .select(*jobs.columns)
    )


def retry_checks(
    jobs: DataFrame, requests: DataFrame, registry: DataFrame, pairs: DataFrame,
    roots: Mapping[str, str], files: DataFrame, done: DataFrame,
) -> DataFrame:
    """First reason against each requested retry; null when the job may be retried."""
    human = registry.filter(F.col("asset_kind") == "human").select("subject_id").distinct().withColumn("_human", F.lit(True))
    paths = files.select("path").distinct()
    asset = paths.select(F.col("path").alias("asset_path")).withColumn("_asset", F.lit(True))
    ready = (
        resolve_refs(pairs.select("sample_id", "background_ref"), "background_ref", roots, "path")
        .join(paths, "path", "left_semi").select("sample_id").distinct().withColumn("_ready", F.lit(True))
    )
    finished = done.select("split", "sample_id").distinct().withColumn("_done", F.lit(True))
    wanted = requests.select(F.col("job_id").alias("id")).distinct()
    reason = (
        F.when(F.col("status").isNull() | ~F.col("status").isin(*RETRYABLE), "absent_or_not_retryable")
        .when(F.col("_human").isNull(), "subject_not_human")
        .when(F.col("_asset").isNull(), "asset_missing")
        .when(F.col("_ready").isNull(), "background_missing")
        .when(F.col("_done").isNotNull(), "output_exists")
    )
    return (
        wanted.join(jobs.select("id", "subject_id", "sample_id", "split", "status", "asset_path"), "id", "left")
        .join(human, "subject_id", "left")
        .join(asset, "asset_path", "left")
        .join(ready, "sample_id", "left")
        .join(finished, ["split", "sample_id"], "left")
        .select("id", F.col("status").alias("previous_status"), reason.alias("reason"))
    )


def retry(jobs: DataFrame, checks: DataFrame, explanation: str) -> tuple[DataFrame, DataFrame]:
    """All-or-nothing retry from ``retry_checks``: next snapshot and new events.

    One invalid request, a running job, or no request at all leaves every job as it is.
    """
    if not explanation.strip():
        raise ValueError("a retry needs an explanation")
    gate = (
        checks.agg(F.count(F.lit(1)).alias("_asked"), F.count("reason").alias("_bad"))
        .crossJoin(jobs.agg(F.count_if(F.col("status") == "running").alias("_running")))
        .select(((F.col("_asked") > 0) & (F.col("_bad") == 0) & (F.col("_running") == 0)).alias("_go"))
    )  # one row
    granted = checks.crossJoin(F.broadcast(gate)).filter("_go").select("id").withColumn("_granted", F.lit(True))
    hit = F.col("_granted").isNotNull()
    cleared = {"worker_id", "pid", "started_at", "finished_at", "error"}
    fields = jobs.schema
    joined = jobs.join(granted, "id", "left")
    columns = [
        F.when(hit, F.lit("pending")).otherwise(F.col(c)).alias(c) if c == "status"
        else F.when(~hit, F.col(c)).cast(fields[c].dataType).alias(c) if c in cleared
        else F.col(c)
        for c in jobs.columns
    ]
    events = granted.select(F.col("id").alias("job_id"), F.lit("explicit_retry").alias("event"), F.lit(explanation).alias("detail"))
    return joined.select(*columns), events


def recover_stale(jobs: DataFrame, live: DataFrame) -> DataFrame:
    """Running jobs whose process is not alive return to pending."""
    alive = live.select("pid").distinct().withColumn("_alive", F.lit(True))
    stale = (F.col("status") == "running") & F.col("_alive").isNull()
    joined = jobs.join(alive, "pid", "left")
    changed = {
        "status": F.when(stale, F.lit("pending")).otherwise(F.col("status")),
        "error": F.when(stale, F.lit("recovered stale worker")).otherwise(F.col("error")),
        "worker_id": F.when(~stale, F.col("worker_id")),
        "pid": F.when(~stale, F.col("pid")),
        "started_at": F.when(~stale, F.col("started_at")),
    }
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in jobs.columns])


def cascade_pause(jobs: DataFrame, failures: DataFrame) -> DataFrame:
    """A pre-render failure pauses every other pending job of its subject.

    ``failures`` has job_id, subject_id and detail; the earliest failing job of a subject
    supplies the error text.
    """
    blocking = (
        failures.filter(failure_class(F.col("detail")) != "other")
        .groupBy("subject_id")
        .agg(F.min_by("detail", "job_id").alias("_detail"))
    )
    failed = failures.select(F.col("job_id").alias("id")).distinct().withColumn("_failed", F.lit(True))
    hit = (F.col("status") == "pending") & F.col("_detail").isNotNull() & F.col("_failed").isNull()
    joined = jobs.join(blocking, "subject_id", "left").join(failed, "id", "left")
    changed = {
        "status": F.when(hit, F.lit(PAUSED)).otherwise(F.col("status")),
        "error": F.when(hit, F.col("_detail")).otherwise(F.col("error")),
    }
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in jobs.columns])


def set_status(jobs: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Terminal states: ``results`` has job_id and detail (null for success)."""
    outcome = results.select(
        F.col("job_id").alias("id"),
        F.when(F.col("detail").isNull(), "done").otherwise(failure_status(F.col("detail"))).alias("_status"),
        F.col("detail").alias("_detail"),
    )
    hit = F.col("_status").isNotNull()
    joined = jobs.join(outcome, "id", "left")
    changed = {
        "status": F.coalesce("_status", "status"),
        "error": F.when(hit, F.col("_detail")).otherwise(F.col("error")),
        "finished_at": F.when(hit, F.current_timestamp()).otherwise(F.col("finished_at")),
    }
    nxt = joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in jobs.columns])
    events = outcome.select(F.col("id").alias("job_id"), F.col("_status").alias("event"), F.col("_detail").alias("detail"))
    return nxt, events


def apply_wave(jobs: DataFrame, wave: DataFrame, worker: Column | str) -> tuple[DataFrame, DataFrame]:
    """Claim effects of a dispatch wave: running, one more attempt, a ``claimed`` event."""
    worker = F.lit(worker) if isinstance(worker, str) else worker
    picked = wave.select("id").withColumn("_worker", worker)
    hit = F.col("_worker").isNotNull()
    joined = jobs.join(picked, "id", "left")
    changed = {
        "status": F.when(hit, F.lit("running")).otherwise(F.col("status")),
        "worker_id": F.when(hit, F.col("_worker")).otherwise(F.col("worker_id")),
        "attempts": F.col("attempts") + F.when(hit, 1).otherwise(0),
        "started_at": F.when(hit, F.current_timestamp()).otherwise(F.col("started_at")),
        "error": F.when(~hit, F.col("error")),
    }
    nxt = joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in jobs.columns])
    events = picked.select(F.col("id").alias("job_id"), F.lit("claimed").alias("event"), F.col("_worker").alias("detail"))
    return nxt, events


def design_rows(assigned: DataFrame, designs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Design rows and events for jobs that were given a preset.

    ``assigned`` holds id, subject_id, subject_action_index, frame_count and the preset's
    columns; jobs already listed in ``designs`` are skipped.
    """
    fresh = assigned.join(designs.select(F.col("job_id").alias("id")).distinct(), "id", "left_anti")
    numbered = next_seq(fresh, designs, "design_seq", ["round", "subject_id", "id"] if "round" in fresh.columns else ["subject_id", "id"])
    action = short_sha1(F.concat_ws(":", F.lit("expanded-preset-v1"), "subject_id", F.col("id").cast("string"), "preset_id"))
    params = F.to_json(F.struct(
        F.lit(DESIGN_STATUS).alias("design_status"),
        "design_seq", "subject_action_index",
        F.col("catalog_version").alias("expanded_preset_catalog_version"),
        F.col("preset_id").alias("expanded_preset_id"),
        F.struct("preset_id", "catalog_version", "trajectory_descriptor").alias("expanded_blueprint"),
        "trajectory_fingerprint", "blueprint_signature", "source_motion_path", "source_frames",
        (F.element_at("source_frames", 2) - F.element_at("source_frames", 1) + 1).alias("source_frame_count"),
        "source_fps",
        F.col("frame_count").cast("int").alias("output_frame_count"),
        F.lit("target_native_safe_preset_ik_v1").alias("motion_solver"),
        F.lit(False).alias("source_bone_rotations_used"),
        F.lit(1.0).alias("hair_gain"),
        F.lit(0.84).alias("camera_follow_gain"),
    ))
    rows = numbered.select(
        F.col("id").alias("job_id"), "design_seq", "subject_id", "subject_action_index",
        action.alias("action_design_id"), F.col("source_segment_id").alias("inspiration_signature"),
        "blueprint_signature", params.alias("action_params_json"),
    )
    events = rows.select(
        "job_id", F.lit("expanded_safe_preset_assigned_jit").alias("event"),
        F.to_json(F.struct(
            "design_seq",
            F.get_json_object("action_params_json", "$.expanded_preset_id").alias("expanded_preset_id"),
            "blueprint_signature",
            F.get_json_object("action_params_json", "$.trajectory_fingerprint").alias("trajectory_fingerprint"),
            F.get_json_object("action_params_json", "$.source_motion_path").alias("motion_path"),
        )).alias("detail"),
    )
    return rows, events


def designed_jobs(jobs: DataFrame, assigned: DataFrame, rows: DataFrame, recipe: str = "expanded_preset") -> DataFrame:
    """The next jobs snapshot behind ``design_rows``: six columns follow the design, other jobs stay as they are.

    ``assigned`` is what the rows were made from. Columns that ``jobs`` lacks are added, null
    for jobs without a design.
    """
    made = rows.select(F.col("job_id").alias("id"), "action_design_id", "action_params_json").join(
        assigned.select(
            "id", F.col("source_segment_id").alias("motion_segment_id"), F.col("source_motion_path").alias("motion_path"),
            F.element_at("source_frames", 1).cast("long").alias("source_start_frame"),
        ), "id",
    ).withColumn("recipe", F.lit(recipe))
    fields = ("recipe", "action_design_id", "action_params_json", "motion_segment_id", "motion_path", "source_start_frame")
    joined = jobs.join(made.select("id", F.struct(*fields).alias("_design")), "id", "left")
    kept = lambda c: F.col(c) if c in jobs.columns else F.lit(None)
    changed = {c: F.when(F.col("_design").isNotNull(), F.col(f"_design.{c}")).otherwise(kept(c)).alias(c) for c in fields}
    return joined.select(*[changed.get(c, F.col(c)) for c in jobs.columns], *[changed[c] for c in fields if c not in jobs.columns])
