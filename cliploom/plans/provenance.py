"""Provenance queries: references, records, index, replay and path relocation."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.operators import provenance as ops
from cliploom.plans.common import FACTS_SQL, JOBS_SQL, MANIFEST_SQL, facts, jobs, manifest
from cliploom.plans.registry import Tables, query

CTX = f"WITH jobs AS ({JOBS_SQL}), manifest AS ({MANIFEST_SQL}), facts AS ({FACTS_SQL})"


@query("relocate_paths", """SELECT page_id, replace(replace(url, 'http://', 'mirror://'), '.example.', '.local.') AS url,
  sha1(replace(replace(html, 'http://', 'mirror://'), '.example.', '.local.')) AS html_sha1 FROM pages""")
def relocate_paths(t: Tables) -> DataFrame:
    moved = ops.relocate(t.pages, {"http://": "mirror://", ".example.": ".local."})
    return moved.select("page_id", "url", F.sha1("html").alias("html_sha1"))


@query("unique_clip_name", f"WITH jobs AS ({JOBS_SQL}) SELECT id, split || '/' || sample_id || '/video/preview_960x540.mp4' AS name FROM jobs")
def unique_clip_name(t: Tables) -> DataFrame:
    return jobs(t).select("id", ops.unique_name().alias("name"))


# Sources of a job: document of its customer, of its key, and of its day; odd prices lie outside the root.
SOURCES = """src AS (SELECT id, '/video/' || CAST(pid AS VARCHAR) AS asset_path, '/video/' || CAST(id % 1000 AS VARCHAR) AS motion_path,
  CASE WHEN price > 400000 THEN '/other/' ELSE '/video/' END || CAST(attempts AS VARCHAR) AS background_path FROM jobs)"""


def job_sources(t: Tables) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    return jobs(t).select(
        "id",
        F.concat(F.lit("/video/"), text("pid")).alias("asset_path"),
        F.concat(F.lit("/video/"), (F.col("id") % 1000).cast("string")).alias("motion_path"),
        F.concat(F.when(F.col("price") > 400000, "/other/").otherwise("/video/"), text("attempts")).alias("background_path"),
    )


BOUND = {"repo_id": "tables/documents", "repo_url": "file:///tables/documents", "resolved_revision": "r1", "origin": "local_release"}


def binding(t: Tables) -> DataFrame:
    """The binding of the workspace to its data set; the manifest at hand is the one it names."""
    listed = F.sha2(F.lit("documents"), 256)
    return t.spark.range(1).select(
        *[F.lit(value).alias(name) for name, value in BOUND.items()], F.create_map(F.lit(ops.FILE_MANIFEST), listed).alias("manifest_sha256"),
        F.lit("/video").alias("video_root"), listed.alias("files_sha256"),
    )


def found(t: Tables) -> DataFrame:
    """``facts`` with both forms of a text hashed before the join, so that no text is shuffled."""
    whole = t.documents.select("doc_id", "n_chars", F.sha2("text", 256).alias("_whole"), F.sha2(F.concat("text", F.lit("!")), 256).alias("_altered"))
    return whole.join(t.labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("path"), F.lit(True).alias("exists"),
        F.when(F.col("toxic") == 1, F.col("_altered")).otherwise(F.col("_whole")).alias("sha256"),
        F.when(F.col("quality") == 0, F.col("n_chars") - 1).otherwise(F.col("n_chars")).alias("bytes"),
    )


# Verdict of each source of each job, and what is listed for it.
TRACED = """long AS (SELECT id, 1 AS k, 'asset_path' AS role, asset_path AS p FROM src UNION ALL SELECT id, 2, 'motion_path', motion_path FROM src
  UNION ALL SELECT id, 3, 'background_path', background_path FROM src),
v AS (SELECT l.*, m.archive, m.sha256, CASE WHEN NOT starts_with(p, '/video/') THEN 'outside_root'
   WHEN m.path IS NULL OR m.sha256 IS DISTINCT FROM f.sha256 THEN 'missing_changed_or_unlisted' END AS bad
  FROM long l LEFT JOIN manifest m ON starts_with(p, '/video/') AND m.path = substr(p, 8)
  LEFT JOIN facts f ON starts_with(p, '/video/') AND f.path = substr(p, 8)),
problems AS (SELECT id, arg_min(bad || ':' || role, k) FILTER (bad IS NOT NULL) AS problem FROM v GROUP BY id)"""


@query("source_refs", CTX + f""", {SOURCES}, {TRACED}
SELECT v.id, v.role, p.problem, CASE WHEN bad IS NULL THEN '{BOUND["repo_id"]}' END AS repo_id, CASE WHEN bad IS NULL THEN '{BOUND["repo_url"]}' END AS repo_url,
  CASE WHEN bad IS NULL THEN '{BOUND["resolved_revision"]}' END AS revision, CASE WHEN bad IS NULL THEN '{BOUND["origin"]}' END AS origin,
  CASE WHEN bad IS NULL THEN sha256('documents') END AS file_manifest_sha256, CASE WHEN bad IS NULL THEN archive END AS archive_path,
  CASE WHEN bad IS NULL THEN substr(v.p, 8) END AS path_in_root, CASE WHEN bad IS NULL THEN v.sha256 END AS sha256
FROM v JOIN problems p ON p.id = v.id""")
def source_refs(t: Tables) -> DataFrame:
    """Every job and role with the eight fields of its reference, null where the source cannot be traced."""
    out = ops.source_refs(job_sources(t), manifest(t), found(t), binding(t))
    each = out.select("id", "problem", "refs", F.explode(F.array(*[F.lit(r) for r in ops.SOURCE_ROLES])).alias("role"))
    return each.select("id", "role", "problem", F.try_element_at("refs", F.col("role")).alias("ref")).select("id", "role", "problem", "ref.*")


DONE_FILES = """done AS (SELECT DISTINCT split, sample_id FROM jobs j JOIN lineitem l ON l.l_orderkey = j.id WHERE l_returnflag = 'A'),
videos AS (SELECT DISTINCT split, sample_id FROM jobs j JOIN lineitem l ON l.l_orderkey = j.id WHERE l_returnflag = 'R')"""


def _index(t: Tables):
    queue = jobs(t)
    folder = F.concat_ws("/", F.lit("/out"), "split", "sample_id")
    records = queue.filter("status = 'done'").select(
        "sample_id", "split",
        F.struct(F.concat(folder, F.lit("/video/preview_960x540.mp4")).alias("video"), F.concat(folder, F.lit("/DONE")).alias("done")).alias("outputs"),
        F.concat(folder, F.lit("/render_record.json")).alias("record_path"),
    )
    lines = t.lineitem.select(F.col("l_orderkey").alias("id"), "l_returnflag")
    files = (
        queue.select("id", folder.alias("folder")).join(lines.filter("l_returnflag <> 'N'"), "id")
        .select(F.concat("folder", F.when(F.col("l_returnflag") == "A", "/DONE").otherwise("/video/preview_960x540.mp4")).alias("path"))
    )
    return ops.index_records(records, files)


@query("index_records", f"""WITH jobs AS ({JOBS_SQL}), {DONE_FILES}
SELECT sample_id, (split, sample_id) IN (SELECT (split, sample_id) FROM done) AS done_exists,
  (split, sample_id) IN (SELECT (split, sample_id) FROM videos) AS video_exists FROM jobs WHERE status = 'done'""")
def index_records(t: Tables) -> DataFrame:
    return _index(t)[0].select("sample_id", "done_exists", "video_exists")


@query("done_without_record", f"""WITH jobs AS ({JOBS_SQL}), {DONE_FILES}
SELECT '/out/' || split || '/' || sample_id AS folder FROM done WHERE sample_id NOT IN (SELECT sample_id FROM jobs WHERE status = 'done')""")
def done_without_record(t: Tables) -> DataFrame:
    return _index(t)[1]


def _file_facts(t: Tables, rows: DataFrame | None = None) -> DataFrame:
    return (rows or facts(t)).withColumn("path", F.concat(F.lit("/video/"), "path")).withColumn("mtime_ns", F.col("bytes") * 1000)


# What a job may say about itself, beside its sources.
DETAILS = {
    "background_start_sec": "pid * 0.5D", "background_start_sec_actual": "pid * 0.25D", "motion_segment_id": "concat('seg-', action_index)",
    "action_design_id": "concat('design-', id)", "source_start_frame": "attempts * 30", "frame_count": "CAST(90 + action_index AS INT)",
    "framing": "CASE WHEN action_index < 4 THEN 'full' END", "camera_angle_deg": "attempts * 1.5D", "production_setting": "concat('setting-', split)",
}
RUNTIME = '{"action_params":{"speed":%s},"visible_character_meshes":["body","hair"],"hair_variant_visibility":{"short":true}}'
CODE = {"worker.py": "0" * 64, "a_rules.py": "1" * 64}
SETTING_PATH = "/video/7"


def _fact_sql(path: str, side: str) -> str:
    return f"concat_ws('|', {path}, CASE WHEN {side}.present THEN 'true' ELSE 'false' END, {side}.bytes, {side}.bytes * 1000, {side}.sha256)"


@query("build_records", CTX + f""", {SOURCES}, {TRACED}, traced AS (SELECT id, string_agg(role || '=' || substr(p, 8) || ':' || sha256, ',' ORDER BY k) AS refs FROM v GROUP BY id)
SELECT 1 AS schema_version, CASE WHEN j.status = 'done' THEN 'completed' ELSE 'failed' END AS status, true AS updated, j.id AS job_id, j.sample_id, j.split, j.subject_id,
  sha1(CAST(j.id AS VARCHAR)) AS attempt_id, '{"|".join(BOUND.values())}|' || sha256('documents') || '|/video|' || sha256('documents') AS asset_source_binding,
  CASE WHEN p.problem IS NULL THEN r.refs END AS dataset_source_refs, 'v1' AS asset_release,
  {_fact_sql("s.asset_path", "a")} AS asset, {_fact_sql("s.background_path", "b")} AS background, {_fact_sql("s.motion_path", "m")} AS motion,
  pid * 0.5::DOUBLE AS background_start_seconds_requested, pid * 0.25::DOUBLE AS background_start_seconds_actual, 'seg-' || action_index AS motion_segment_id,
  'design-' || j.id AS action_design_id, action_params_json AS action_parameters, attempts * 30 AS motion_source_start_frame, CAST(90 + action_index AS INT) AS frame_count, 30 AS fps,
  CASE WHEN action_index < 4 THEN 'full' END AS framing, attempts * 1.5::DOUBLE AS camera_angle_deg,
  CASE WHEN j.status = 'done' THEN '{{"speed":' || action_index || '}}' END AS runtime_action_parameters, CASE WHEN j.status = 'done' THEN 'body,hair' END AS visible_character_meshes,
  CASE WHEN j.status = 'done' THEN '{{"short":true}}' END AS hair_variant_visibility, 'setting-' || j.split AS setting,
  {_fact_sql(f"'{SETTING_PATH}'", "z")} AS setting_file, '{",".join(f"{k}={v}" for k, v in sorted(CODE.items()))}' AS code_files_sha256,
  {" || '|' || ".join(f"'/out/' || j.split || '/' || j.sample_id || '/{rel}'" for rel in ops.OUTPUTS.values())} AS outputs,
  'preview_960x540.mp4' AS video_name, j.split || '/' || j.sample_id || '/video/preview_960x540.mp4' AS video_unique_name,
  CASE WHEN j.status <> 'done' THEN 'E-' || j.id END AS error, '3.11|GPU-' || pid AS environment, j.sample_id || '|' || s.asset_path AS replay_job, 'one batch' AS limitations
FROM src s JOIN jobs j ON j.id = s.id JOIN problems p ON p.id = s.id JOIN traced r ON r.id = s.id
LEFT JOIN facts a ON '/video/' || a.path = s.asset_path LEFT JOIN facts m ON '/video/' || m.path = s.motion_path
LEFT JOIN facts b ON '/video/' || b.path = s.background_path LEFT JOIN facts z ON '/video/' || z.path = '{SETTING_PATH}'""")
def build_records(t: Tables) -> DataFrame:
    """All 37 fields of every job's record; nested ones are joined into text, the time of writing is checked to be one."""
    details = [F.expr(e).alias(c) for c, e in DETAILS.items()]
    queue = jobs(t).select("id", "sample_id", "split", "subject_id", "status", "action_params_json", "action_index", "pid", *details).join(job_sources(t), "id")
    done = F.col("status") == "done"
    reports = queue.select(
        F.col("id").alias("job_id"), F.when(done, "completed").otherwise("failed").alias("status"), F.when(~done, F.concat(F.lit("E-"), "id")).alias("error"),
        F.sha1(F.col("id").cast("string")).alias("attempt"), F.format_string(RUNTIME, F.col("action_index").cast("string")).alias("runtime_report"),
        F.lit("3.11").alias("python"), F.concat(F.lit("GPU-"), "pid").alias("gpu_uuid"),
    )
    refs = ops.source_refs(job_sources(t), manifest(t), found(t), binding(t), data_set=BOUND["repo_id"])
    release = t.spark.range(1).select(F.lit("v1").alias("tag"))
    records = ops.build_records(queue, _file_facts(t, found(t)), reports, "/out", CODE, refs, binding(t), release, SETTING_PATH, "one batch")
    joined = lambda *c: F.concat_ws("|", *[F.col(x).cast("string") for x in c])
    fact = lambda c: joined(*(f"{c}.{x}" for x in ("path", "exists", "bytes", "mtime_ns", "sha256"))).alias(c)
    bound = "asset_source_binding"
    role = lambda r: F.concat_ws(":", F.concat(F.lit(r + "="), F.expr(f"dataset_source_refs['{r}'].path_in_root")), F.expr(f"dataset_source_refs['{r}'].sha256"))
    made = {
        "asset": fact("asset"), "background": fact("background"), "motion": fact("motion"), "setting_file": fact("setting_file"),
        "updated_unix": (F.col("updated_unix") > 1_600_000_000).alias("updated"), "asset_release": F.col("asset_release.tag").alias("asset_release"),
        bound: F.concat_ws("|", *[F.col(f"{bound}.{c}") for c in BOUND], F.element_at(f"{bound}.manifest_sha256", ops.FILE_MANIFEST), f"{bound}.video_root", f"{bound}.files_sha256").alias(bound),
        "dataset_source_refs": F.when(F.col("dataset_source_refs").isNotNull(), F.concat_ws(",", *[role(r) for r in ops.SOURCE_ROLES])).alias("dataset_source_refs"),
        "visible_character_meshes": F.array_join("visible_character_meshes", ",").alias("visible_character_meshes"),
        "code_files_sha256": F.array_join(F.transform(F.array_sort(F.map_entries("code_files_sha256")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("code_files_sha256"),
        "outputs": joined(*(f"outputs.{c}" for c in ops.OUTPUTS)).alias("outputs"), "environment": joined(*(f"environment.{c}" for c in ops.ENVIRONMENT)).alias("environment"),
        "replay_job": F.concat_ws("|", F.get_json_object("replay_job", "$.sample_id"), F.get_json_object("replay_job", "$.asset_path")).alias("replay_job"),
    }
    return records.select(*[made.get(c, F.col(c)) for c in records.columns])


@query("changed_inputs", CTX + f""", {SOURCES}
SELECT s.id, CASE WHEN a.path IS NULL THEN 'asset_path' WHEN m.path IS NULL THEN 'motion_path' WHEN b.path IS NULL THEN 'background_path' END AS missing_source,
  coalesce(a.path IS NOT NULL AND m.path IS NOT NULL AND b.path IS NOT NULL AND EXISTS (SELECT 1 FROM facts f JOIN labels l ON CAST(l.doc_id AS VARCHAR) = f.path
    WHERE l.quality = 0 AND '/video/' || f.path IN (s.asset_path, s.motion_path, s.background_path)), false) AS changed
FROM src s LEFT JOIN facts a ON '/video/' || a.path = s.asset_path LEFT JOIN facts m ON '/video/' || m.path = s.motion_path LEFT JOIN facts b ON '/video/' || b.path = s.background_path""")
def changed_inputs(t: Tables) -> DataFrame:
    """For each job whether its input fingerprint changes when the shortened copies are restored, or which source is missing."""
    queue = job_sources(t)
    whole = _file_facts(t).join(manifest(t).select(F.concat(F.lit("/video/"), "path").alias("path"), F.col("bytes").alias("full")), "path")
    restored = whole.withColumn("bytes", F.col("full"))
    now = ops.input_fingerprint(queue, _file_facts(t)).select("id", "input_fingerprint", "missing_source")
    then = ops.input_fingerprint(queue, restored, out="restored").select("id", "restored")
    return now.join(then, "id").select("id", "missing_source", (~F.col("input_fingerprint").eqNullSafe(F.col("restored"))).alias("changed"))


def _code_then_and_now(t: Tables) -> tuple[DataFrame, DataFrame, str]:
    """Nations as code files: what each job's record says of them, what they are now, and the setting's hash now.

    Of five records one has another hash of one file, one lacks a file, one another setting.
    """
    current = t.nation.select(F.concat("n_name", F.lit(".py")).alias("path"), F.sha2("n_name", 256).alias("sha256"), "n_nationkey")
    files = F.broadcast(current.agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "path", "sha256"))).alias("_files")))  # 25 rows
    rows = jobs(t).select("id").crossJoin(files)
    own = lambda f: f["n_nationkey"] == F.col("id") % 25
    held = F.filter("_files", lambda f: ~((F.col("id") % 5 == 1) & own(f)))
    entry = lambda f: F.struct(f["path"].alias("key"), F.when((F.col("id") % 5 == 0) & own(f), F.reverse(f["sha256"])).otherwise(f["sha256"]).alias("value"))
    records = rows.select(
        F.col("id").alias("record"), F.map_from_entries(F.transform(held, entry)).alias("code_files_sha256"),
        F.struct(F.when(F.col("id") % 5 == 2, F.sha2(F.lit("old"), 256)).otherwise(F.sha2(F.lit("setting"), 256)).alias("sha256")).alias("setting_file"),
    )
    return records, current, hashlib.sha256(b"setting").hexdigest()


@query("code_drift", f"""WITH jobs AS ({JOBS_SQL})
SELECT j.id AS record, n_name || '.py' AS path, CASE WHEN j.id % 5 = 1 THEN 'added' ELSE 'changed' END AS change,
  CASE WHEN j.id % 5 = 0 THEN reverse(sha256(n_name)) END AS old, sha256(n_name) AS new
FROM jobs j JOIN nation ON n_nationkey = j.id % 25 WHERE j.id % 5 < 2
UNION ALL SELECT id, 'setting', 'changed', sha256('old'), sha256('setting') FROM jobs WHERE id % 5 = 2""")
def code_drift(t: Tables) -> DataFrame:
    return ops.code_drift(*_code_then_and_now(t)).select("record", "path", "change", "old", "new")


@query("replay_gate", CTX + f""", {SOURCES},
long AS (SELECT id, 1 AS k, 'asset' AS role, asset_path AS p FROM src UNION ALL SELECT id, 2, 'motion', motion_path FROM src
  UNION ALL SELECT id, 3, 'background', background_path FROM src),
bad AS (SELECT l.id, arg_min(role, k) AS role FROM long l
  LEFT JOIN manifest m ON '/video/' || m.path = l.p LEFT JOIN facts f ON '/video/' || f.path = l.p
  WHERE m.sha256 IS NULL OR m.sha256 IS DISTINCT FROM f.sha256 GROUP BY l.id)
SELECT j.id AS record, CASE WHEN j.status = 'pending' THEN 'incomplete_job' WHEN bad.role IS NOT NULL THEN 'source_changed:' || bad.role
  WHEN j.id % 5 < 3 THEN 'change_note_required' ELSE 'ok' END AS replay_verdict
FROM jobs j LEFT JOIN bad ON bad.id = j.id""")
def replay_gate(t: Tables) -> DataFrame:
    queue = jobs(t).select("id", "split", "status", "action_params_json").join(job_sources(t), "id")
    listed = manifest(t).select(F.concat(F.lit("/video/"), "path").alias("path"), F.col("sha256"))
    records = queue.withColumn("record", F.col("id"))
    for role in ("asset", "motion", "background"):
        side = listed.select(F.col("path").alias(f"{role}_path"), F.col("sha256").alias(f"_{role}"))
        records = records.join(side, f"{role}_path", "left").withColumn(
            role, F.struct(F.col(f"{role}_path").alias("path"), F.col(f"_{role}").alias("sha256"))
        )
    code = queue.select(
        F.col("id").alias("record"), "asset_path", "motion_path", "background_path",
        F.when(F.col("status") != "pending", F.col("action_params_json")).alias("action_params_json"),
    )
    return ops.replay_gate(records, _file_facts(t, found(t)), code, ops.code_drift(*_code_then_and_now(t)))
