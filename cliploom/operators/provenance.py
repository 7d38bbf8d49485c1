"""Provenance records, source references and the index built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.sources.snapshots import many_folders

SOURCE_ROLES = ("asset_path", "motion_path", "background_path")
# Where each output of a clip lies below its folder.
OUTPUTS = {
    "video": "video/preview_960x540.mp4",
    "composite_frames": "composite/%05d.jpg",
    "alpha_frames": "mask/%05d.png",
    "metadata": "metadata.json",
    "render_report": "render_report.json",
    "task_preflight": "task_preflight.json",
    "done": "DONE",
}
FPS = 30
FILE_MANIFEST = "manifests/files.jsonl"
#: Columns of the binding of a workspace to its data set; ``files_sha256`` is the hash of the file manifest at hand.
BINDING = (
    "repo_id string, repo_url string, resolved_revision string, origin string, manifest_sha256 map<string,string>, "
    "video_root string, files_sha256 string"
)
REFERENCE = (
    "struct<repo_id string, repo_url string, revision string, origin string, file_manifest_sha256 string, "
    "archive_path string, path_in_root string, sha256 string>"
)
SALTS = 16  # copies of the listed sources, so that one named by very many jobs is not gathered
ENVIRONMENT = ("python", "blender_bin", "gpu_uuid", "cuda_visible_devices")


def relocate(df: DataFrame, roots: Mapping[str, str]) -> DataFrame:
    """Replace root tokens literally in every text column, one projection for all tokens."""
    def moved(name: str) -> Column:
        column = F.col(name)
        for token, value in roots.items():
            column = F.replace(column, F.lit(token), F.lit(value))
        return column.alias(name)

    return df.select(*[moved(f.name) if f.dataType.typeName() == "string" else F.col(f.name) for f in df.schema])


def unique_name() -> Column:
    return F.concat_ws("/", F.col("split"), F.col("sample_id"), F.lit(OUTPUTS["video"]))


def only_row(df: DataFrame, name: str) -> DataFrame:
    """The one row of ``df`` as a struct, null where there is none, and ``_n``, how many there are."""
    return F.broadcast(df.agg(F.first(F.struct(*df.columns)).alias(name), F.count(F.lit(1)).alias("_n")))


def source_refs(
    jobs: DataFrame, files: DataFrame, facts: DataFrame, binding: DataFrame, root: str | None = None, roles: Sequence[str] = SOURCE_ROLES,
    data_set: str | None = None,
) -> DataFrame:
    """Trace the source paths of each job to the bound file manifest.

    One row per job: the verdict of the first bad role, and the map role -> reference.
    ``binding`` has one row of ``BINDING``: without it jobs are ``not_bound``; one that names no
    data set, another one than ``data_set`` where that is given, or another file manifest than
    ``files_sha256``, is an ``invalid_binding``. Neither gives references, which carry the data
    set's id and address as the binding has them. Paths lie below ``root``, or else below the
    binding's ``video_root``.
    """
    expected = F.try_element_at("_bound.manifest_sha256", F.lit(FILE_MANIFEST))
    valid = (F.col("_n") == 1) & (F.col("_bound.repo_id").isNotNull() if data_set is None else F.col("_bound.repo_id").eqNullSafe(data_set)) & expected.isNotNull() & expected.eqNullSafe(F.col("_bound.files_sha256"))
    unbound = F.when(F.col("_n") == 0, "not_bound").when(~valid, "invalid_binding")
    origin = only_row(binding, "_bound").select(
        unbound.alias("_unbound"), F.concat(F.rtrim(F.lit(root) if root is not None else F.col("_bound.video_root"), F.lit("/")), F.lit("/")).alias("_prefix"),
        F.col("_bound.resolved_revision").alias("_revision"), F.col("_bound.origin").alias("_origin"), expected.alias("_manifest"),
        F.col("_bound.repo_id").alias("_repo_id"), F.col("_bound.repo_url").alias("_repo_url"),
    )
    long = jobs.select("id", *roles).unpivot("id", list(roles), "role", "source_path").crossJoin(F.broadcast(origin.select("_prefix")))
    inside = F.col("source_path").startswith(F.col("_prefix"))
    rel = F.when(inside, F.substring(F.col("source_path"), F.length("_prefix") + 1, F.length("source_path")))
    at = F.array_position(F.array(*[F.lit(r) for r in roles]), F.col("role")).cast("int")
    long = long.select("id", at.alias("_at"), rel.alias("rel"))
    listed = files.select(F.col("path").alias("rel"), "archive", F.col("sha256").alias("_listed"))
    found = facts.select(F.col("path").alias("rel"), F.col("sha256").alias("_found"))
    verdict = (
        F.when(F.col("rel").isNull(), "outside_root")
        .when(F.col("_listed").isNull() | ~F.col("_listed").eqNullSafe(F.col("_found")), "missing_changed_or_unlisted")
    )
    role = lambda place: F.element_at(F.array(*[F.lit(r) for r in roles]), place)
    entry = lambda e: F.struct(
        F.col("_repo_id").alias("repo_id"), F.col("_repo_url").alias("repo_url"), F.col("_revision").alias("revision"), F.col("_origin").alias("origin"),
        F.col("_manifest").alias("file_manifest_sha256"), e["archive"].alias("archive_path"), e["rel"].alias("path_in_root"), e["_listed"].alias("sha256"),
    )
    # Many jobs may share a source, and paths outside the root have no key at all: a source's rows are spread over copies of the listing.
    salted = long.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    known = listed.join(found, "rel", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    # What is the same for all jobs joins last, when nothing is shuffled any more; a bad role travels as a place and a verdict alone.
    refs = F.transform("_good", lambda e: F.struct(role(e["_at"]).alias("role"), entry(e).alias("ref")))
    return (
        salted.join(known, ["rel", "_salt"], "left")
        .withColumn("_bad", verdict)
        .select("id", "_at", "_bad", *[F.when(F.col("_bad").isNull(), F.col(c)).alias(c) for c in ("archive", "rel", "_listed")])
        .repartition("id")
        .groupBy("id")  # one row per role
        .agg(
            F.min(F.when(F.col("_bad").isNotNull(), F.struct("_at", "_bad"))).alias("_first"),
            F.collect_list(F.when(F.col("_bad").isNull(), F.struct("_at", "archive", "rel", "_listed"))).alias("_good"),
        )
        .crossJoin(F.broadcast(origin))
        .select(
            "id", F.coalesce("_unbound", F.when(F.col("_first").isNotNull(), F.concat_ws(":", "_first._bad", role(F.col("_first._at"))))).alias("problem"),
            F.map_from_entries(F.when(F.col("_unbound").isNull(), refs).otherwise(F.filter(refs, lambda e: F.lit(False)))).alias("refs"),
        )
    )


def file_fact(prefix: str) -> Column:
    """A nested file fact from the columns ``attach_facts`` added."""
    path = F.col(prefix)
    there = F.coalesce(F.col(f"_{prefix}_exists"), F.lit(False))
    return F.when(path.isNotNull(), F.struct(
        path.alias("path"), there.alias("exists"), F.col(f"_{prefix}_bytes").alias("bytes"),
        F.col(f"_{prefix}_mtime_ns").alias("mtime_ns"), F.col(f"_{prefix}_sha256").alias("sha256"),
    ))


def attach_facts(jobs: DataFrame, facts: DataFrame, column: str) -> DataFrame:
    names = ("exists", "bytes", "mtime_ns", "sha256")
    side = facts.select(F.col("path").alias(column), *[F.col(n).alias(f"_{column}_{n}") for n in names])
    return jobs.join(side, column, "left")


FACT = ("exists", "bytes", "mtime_ns", "sha256")


def facts_by_id(jobs: DataFrame, facts: DataFrame, roles: Sequence[str] = SOURCE_ROLES) -> DataFrame:
    """Job id and ``_facts``, all there is about its sources: only ids, paths and facts are shuffled, never the jobs' other columns."""
    paths = jobs.filter(F.col("id").isNotNull()).select("id", F.explode(F.array_distinct(F.array(*roles))).alias("path")).distinct()
    salted = paths.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))  # many jobs may share a source
    known = facts.select("path", *FACT).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    found = salted.join(known, ["path", "_salt"]).select("id", "path", *FACT).repartition("id")
    return found.groupBy("id").agg(F.collect_list(F.struct("path", *FACT)).alias("_facts"))


def with_facts(rows: DataFrame, column: str) -> DataFrame:
    """As ``attach_facts``, from the ``_facts`` at hand: a row for each fact of the path, or one without."""
    own = F.filter("_facts", lambda f: f["path"] == F.col(column))
    each = rows.select("*", F.explode_outer(own).alias("_fact"))
    return each.select(*rows.columns, *[F.col(f"_fact.{n}").alias(f"_{column}_{n}") for n in FACT])


def build_records(
    jobs: DataFrame, facts: DataFrame, reports: DataFrame, output_root: str, setting: Mapping[str, str], refs: DataFrame | None = None,
    binding: DataFrame | None = None, release: DataFrame | None = None, setting_path: str | None = None, limitations: str | None = None,
) -> DataFrame:
    """Assemble one provenance record per job.

    ``reports`` gives job_id, status, error, attempt and the runtime report JSON, and in columns
    named as in ``ENVIRONMENT`` what the worker ran in. The code and setting hashes are one
    literal map for the whole batch. ``refs`` is what ``source_refs`` returns; a job with a problem
    has no references. ``binding`` and ``release`` have one row for the batch, ``limitations`` is
    what the batch says about its records; these and other fields that nothing gives are null.
    """
    rows = jobs.join(facts_by_id(jobs, facts), "id", "left")
    for role in SOURCE_ROLES:
        rows = with_facts(rows, role)
    rows = rows.drop("_facts")
    folder = F.concat_ws("/", F.lit(output_root.rstrip("/")), F.col("split"), F.col("sample_id"))
    side = reports.select(
        F.col("job_id").alias("id"), F.col("status").alias("_status"), F.col("error").alias("_error"),
        F.col("attempt").alias("_attempt"), F.col("runtime_report").alias("_runtime"),
        F.struct(*[(F.col(c) if c in reports.columns else F.lit(None)).cast("string").alias(c) for c in ENVIRONMENT]).alias("_environment"),
    )
    rows = rows.join(side, "id")
    if refs is not None:
        traced = refs.select("id", F.when(F.col("problem").isNull(), F.col("refs")).alias("dataset_source_refs"))
        rows = rows.drop("dataset_source_refs").join(traced, "id", "left")
    elif "dataset_source_refs" not in jobs.columns:
        rows = rows.withColumn("dataset_source_refs", F.lit(None).cast(f"map<string, {REFERENCE}>"))
    for name, one, kind in (("asset_source_binding", binding, f"struct<{BINDING}>"), ("asset_release", release, "string")):
        rows = rows.drop(name)
        rows = rows.withColumn(name, F.lit(None).cast(kind)) if one is None else rows.crossJoin(only_row(one, name).drop("_n"))
    given = facts.filter(F.col("path") == F.lit(setting_path)).select("exists", "bytes", "mtime_ns", "sha256")
    rows = rows.crossJoin(only_row(given, "_set").drop("_n"))
    setting_file = F.when(F.lit(setting_path).isNotNull(), F.struct(
        F.lit(setting_path).cast("string").alias("path"), F.coalesce(F.col("_set.exists"), F.lit(False)).alias("exists"),
        *[F.col(f"_set.{n}").alias(n) for n in ("bytes", "mtime_ns", "sha256")],
    ))
    runtime = F.when(F.col("_status") == "completed", F.col("_runtime"))
    codes = F.create_map(*[F.lit(x) for pair in sorted(setting.items()) for x in pair])
    optional = lambda name, kind: F.col(name) if name in jobs.columns else F.lit(None).cast(kind)
    return rows.select(
        F.lit(1).alias("schema_version"),
        F.col("_status").alias("status"),
        F.unix_timestamp().alias("updated_unix"),
        F.col("id").alias("job_id"), "sample_id", "split", "subject_id",
        F.col("_attempt").alias("attempt_id"),
        "asset_source_binding", "dataset_source_refs", "asset_release",
        file_fact("asset_path").alias("asset"),
        file_fact("background_path").alias("background"),
        file_fact("motion_path").alias("motion"),
        optional("background_start_sec", "double").alias("background_start_seconds_requested"),
        optional("background_start_sec_actual", "double").alias("background_start_seconds_actual"),
        optional("motion_segment_id", "string").alias("motion_segment_id"),
        optional("action_design_id", "string").alias("action_design_id"),
        optional("action_params_json", "string").alias("action_parameters"),
        optional("source_start_frame", "bigint").alias("motion_source_start_frame"),
        optional("frame_count", "int").alias("frame_count"),
        F.lit(FPS).alias("fps"),
        optional("framing", "string").alias("framing"),
        optional("camera_angle_deg", "double").alias("camera_angle_deg"),
        F.get_json_object(runtime, "$.action_params").alias("runtime_action_parameters"),
        F.from_json(F.get_json_object(runtime, "$.visible_character_meshes"), "array<string>").alias("visible_character_meshes"),
        F.get_json_object(runtime, "$.hair_variant_visibility").alias("hair_variant_visibility"),
        optional("production_setting", "string").alias("setting"),
        setting_file.alias("setting_file"),
        codes.alias("code_files_sha256"),
        F.struct(*[F.concat_ws("/", folder, F.lit(rel)).alias(name) for name, rel in OUTPUTS.items()]).alias("outputs"),
        F.lit(OUTPUTS["video"].rsplit("/", 1)[-1]).alias("video_name"),
        unique_name().alias("video_unique_name"),
        F.col("_error").alias("error"),
        F.col("_environment").alias("environment"),
        F.to_json(F.struct(*jobs.columns)).alias("replay_job"),
        F.lit(limitations).cast("string").alias("limitations"),
    )


def write_records(records: DataFrame, root: str) -> None:
    """One folder per clip below its split; rows are dealt out by clip, however few tasks hold them."""
    keyed = records.withColumn("_split", F.col("split")).withColumn("_sample", F.col("sample_id"))
    width = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, as small rows would be put together
    many_folders(keyed.repartition(width, "_split", "_sample").write).mode("overwrite").partitionBy("_split", "_sample").json(root)


def index_records(records: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Index rows with ``done_exists`` / ``video_exists``, and finished folders without a record."""
    paths = files.select("path").distinct()
    done = paths.select(F.col("path").alias("_done")).withColumn("_has_done", F.lit(True))
    video = paths.select(F.col("path").alias("_video")).withColumn("_has_video", F.lit(True))
    index = (
        records.withColumn("_done", F.col("outputs.done")).withColumn("_video", F.col("outputs.video"))
        .join(done, "_done", "left").join(video, "_video", "left")
        .withColumn("done_exists", F.col("_has_done").isNotNull())
        .withColumn("video_exists", F.col("_has_video").isNotNull())
        .drop("_done", "_video", "_has_done", "_has_video")
    )
    finished = paths.filter(F.col("path").endswith("/DONE")).select(F.expr("substring(path, 1, length(path) - 5)").alias("folder"))
    recorded = records.select(F.regexp_replace("record_path", r"/[^/]*$", "").alias("folder"))
    return index, finished.join(recorded, "folder", "left_anti")


def input_fingerprint(jobs: DataFrame, facts: DataFrame, roles: Sequence[str] = SOURCE_ROLES, out: str = "input_fingerprint") -> DataFrame:
    """Hash of the job's own fields and the size and time of its three sources.

    Fields are taken in name order; the fingerprint itself and later answers are left out.
    A job of which a source has no path, size or time gets no fingerprint, and the first such
    source's role in ``missing_source``.
    """
    ignored = {"task_preflight_input_fingerprint", "scene_composite_vlm_qc"}
    own = sorted(c for c in jobs.columns if c not in ignored)
    rows = jobs
    for role in roles:
        rows = attach_facts(rows, facts, role)
    source = [F.struct(F.col(r).alias("path"), F.col(f"_{r}_bytes").alias("bytes"), F.col(f"_{r}_mtime_ns").alias("mtime_ns")).alias(f"source_{r}") for r in roles]
    text = F.to_json(F.struct(*own, *source), {"ignoreNullFields": "false"})
    missing = F.coalesce(*[F.when(F.col(r).isNull() | F.col(f"_{r}_bytes").isNull() | F.col(f"_{r}_mtime_ns").isNull(), r) for r in roles])
    return rows.withColumn("missing_source", missing).withColumn(out, F.when(missing.isNull(), F.sha2(text, 256))).select(*jobs.columns, out, "missing_source")


def _digest(entries: Column) -> Column:
    """One hash for a map's entries in the order of their keys."""
    return F.sha2(F.array_join(F.transform(F.array_sort(entries), lambda e: F.concat(F.length(e["key"]).cast("string"), F.lit(":"), e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), "\n"), 256)


def code_drift(records: DataFrame, current: DataFrame, setting_sha256: str | None = None, key: str = "record") -> DataFrame:
    """What changed in code and settings since each record: ``record, path, old, new, change``.

    ``records`` has the key, ``code_files_sha256`` and ``setting_file``; ``current`` has path and
    sha256 of the code files there are now, one batch's few. The map of each record is compared
    by its digest, and only maps that differ are taken apart; no rows are shuffled. A setting
    that differs is a row named ``setting``. Records without a map have drifted in every file.
    """
    now = current.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("path").alias("key"), F.col("sha256").alias("value"))))).alias("_now"))
    now = F.broadcast(now.withColumn("_digest", _digest(F.map_entries("_now"))))  # one row
    was = F.coalesce("code_files_sha256", F.create_map().cast("map<string,string>"))
    rows = records.select(F.col(key).alias("record"), was.alias("_was"), F.col("setting_file.sha256").alias("_setting")).crossJoin(now)
    differs = ~_digest(F.map_entries("_was")).eqNullSafe(F.col("_digest"))
    paths = F.when(differs, F.array_union(F.map_keys("_was"), F.map_keys("_now"))).otherwise(F.array().cast("array<string>"))
    each = F.transform(paths, lambda p: F.struct(p.alias("path"), F.try_element_at("_was", p).alias("old"), F.try_element_at("_now", p).alias("new")))
    setting = F.struct(F.lit("setting").alias("path"), F.col("_setting").alias("old"), F.lit(setting_sha256).cast("string").alias("new"))
    moved = F.filter(F.concat(each, F.array(setting)), lambda e: ~e["old"].eqNullSafe(e["new"]))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return rows.select("record", F.explode(moved).alias("e")).select("record", "e.*").withColumn("change", change)


def replay_gate(records: DataFrame, facts: DataFrame, code: DataFrame, drift: DataFrame, note: str = "") -> DataFrame:
    """Whether each record may be replayed.

    Needs a complete job and three unchanged sources; records listed in ``drift`` (changed code
    or settings, see ``code_drift``) also need a note. ``code`` names the record key and its replay fields.
    """
    roles = ("asset", "motion", "background")
    long = records.select("record", F.explode(F.array(*[
        F.struct(F.lit(r).alias("role"), F.col(f"{r}.path").alias("path"), F.col(f"{r}.sha256").alias("sha256")) for r in roles
    ])).alias("s")).select("record", "s.*")
    now = facts.select("path", F.col("sha256").alias("_now"))
    place = F.array_position(F.array(*[F.lit(r) for r in roles]), F.col("role")).cast("int")
    bad = (  # good sources go no further
        long.withColumn("_place", place).drop("role").join(now, "path", "left")
        .filter(F.col("sha256").isNull() | ~F.col("sha256").eqNullSafe(F.col("_now")))
        .groupBy("record")  # three rows each
        .agg(F.element_at(F.array(*[F.lit(r) for r in roles]), F.min("_place")).alias("_role"))
    )
    changed = drift.select("record").distinct().withColumn("_drift", F.lit(True))
    fields = ("asset_path", "motion_path", "background_path", "action_params_json")
    complete = code.select(
        "record", F.forall(F.array(*[F.coalesce(F.col(f), F.lit("")) for f in fields]), lambda v: v != "").alias("_complete")
    )
    verdict = (
        F.when(~F.coalesce(F.col("_complete"), F.lit(False)), "incomplete_job")
        .when(F.col("_role").isNotNull(), F.concat(F.lit("source_changed:"), F.col("_role")))
        .when(F.col("_drift").isNotNull() & F.lit(not note.strip()), "change_note_required")
        .otherwise("ok")
    )
    return (
        records.select("record").join(complete, "record", "left").join(bad, "record", "left").join(changed, "record", "left")
        .select("record", verdict.alias("replay_verdict"))
    )
