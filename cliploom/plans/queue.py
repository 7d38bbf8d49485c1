"""Job-table queries over orders (jobs), lineitem (pairings), customer (registry) and events (log)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.functions.text import failure_class, failure_status, framing_of
from cliploom.operators import queue as ops
from cliploom.plans.common import JOBS_SQL, LOG_SQL, event_log, jobs
from cliploom.plans.registry import Tables, query

JOBS = f"WITH jobs AS ({JOBS_SQL})"
LOG = f"WITH log AS ({LOG_SQL})"
FRAMING = (
    "CASE WHEN action_index <= 5 THEN 'fullbody' WHEN action_index <= 8 THEN 'halfbody' ELSE 'closeup_hair' END"
)


@query("dispatch_wave", JOBS + """
, ready AS (
  SELECT *, CASE split WHEN 'train' THEN 0 ELSE 1 END AS split_rank,
    row_number() OVER (PARTITION BY subject_id ORDER BY CASE split WHEN 'train' THEN 0 ELSE 1 END, id) AS rn
  FROM jobs j WHERE status = 'pending'
    AND NOT EXISTS (SELECT 1 FROM jobs a WHERE a.status = 'running' AND a.subject_id = j.subject_id))
SELECT id, subject_id, CAST(split_rank AS INTEGER) AS split_rank FROM ready WHERE rn = 1""")
def dispatch_wave(t: Tables) -> DataFrame:
    return ops.dispatch_wave(jobs(t)).select("id", "subject_id", "split_rank")


@query("dispatch_first_k", JOBS + """
, ready AS (
  SELECT *, CASE split WHEN 'train' THEN 0 ELSE 1 END AS split_rank,
    row_number() OVER (PARTITION BY subject_id ORDER BY CASE split WHEN 'train' THEN 0 ELSE 1 END, id) AS rn
  FROM jobs j WHERE status = 'pending'
    AND NOT EXISTS (SELECT 1 FROM jobs a WHERE a.status = 'running' AND a.subject_id = j.subject_id))
SELECT id, subject_id FROM ready WHERE rn = 1 ORDER BY split_rank, subject_id, id LIMIT 8""")
def dispatch_first_k(t: Tables) -> DataFrame:
    return ops.dispatch_wave(jobs(t), 8).select("id", "subject_id")


@query("queue_status", JOBS + " SELECT status, count(*) AS jobs FROM jobs GROUP BY status")
def queue_status(t: Tables) -> DataFrame:
    return ops.queue_status(jobs(t))


@query("queue_overview", JOBS + """
SELECT count(*) AS jobs, count(DISTINCT subject_id) AS subjects,
  count(*) FILTER (status = 'running') AS running, count(*) FILTER (status = 'pending') AS pending FROM jobs""")
def queue_overview(t: Tables) -> DataFrame:
    return ops.queue_overview(jobs(t))


@query("running_jobs", JOBS + " SELECT id, pid FROM jobs WHERE status = 'running'")
def running_jobs(t: Tables) -> DataFrame:
    return ops.running_jobs(jobs(t)).select("id", "pid")


@query("active_work_exists", JOBS + " SELECT count(*) > 0 AS active FROM jobs WHERE status IN ('pending', 'running')")
def active_work_exists(t: Tables) -> DataFrame:
    return ops.has_active(jobs(t))


@query("framing_class", JOBS + f" SELECT id, {FRAMING} AS framing FROM jobs")
def framing_class(t: Tables) -> DataFrame:
    return jobs(t).select("id", framing_of(F.col("action_index")).alias("framing"))


@query("quota_audit", JOBS + f"""
, f AS (SELECT subject_id, {FRAMING} AS framing FROM jobs)
SELECT subject_id, count(*) AS jobs, count(*) FILTER (framing = 'fullbody') AS fullbody,
  count(*) FILTER (framing = 'halfbody') AS halfbody, count(*) FILTER (framing = 'closeup_hair') AS closeup_hair,
  count(*) FILTER (framing = 'fullbody') = 6 AND count(*) FILTER (framing = 'halfbody') = 3
    AND count(*) FILTER (framing = 'closeup_hair') = 3 AS meets_plan
FROM f GROUP BY subject_id""")
def quota_audit(t: Tables) -> DataFrame:
    return ops.quota_audit(jobs(t).withColumn("framing", framing_of(F.col("action_index"))))


@query("job_attempts", LOG + " SELECT job_id, count(*) FILTER (event = 'claimed') AS attempts FROM log GROUP BY job_id")
def job_attempts(t: Tables) -> DataFrame:
    return ops.attempts(event_log(t))


@query("latest_job_state", LOG + """
, r AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts DESC, event_id DESC) AS rn FROM log)
SELECT job_id, event_id, event, detail FROM r WHERE rn = 1""")
def latest_job_state(t: Tables) -> DataFrame:
    return ops.latest_state(event_log(t), "job_id", ["ts", "event_id"], ["event", "detail"]).drop("ts")


@query("failure_classes", LOG + """
SELECT CASE WHEN contains(detail, 'GARMENT_QC:') THEN 'garment_qc' WHEN contains(detail, 'PREPASS:') THEN 'prepass'
  ELSE 'other' END AS failure,
  CASE WHEN contains(detail, 'GARMENT_QC:') OR contains(detail, 'PREPASS:') THEN 'failed_prepass' ELSE 'failed' END AS status,
  count(*) AS n FROM log GROUP BY 1, 2""")
def failure_classes(t: Tables) -> DataFrame:
    log = event_log(t).select(
        failure_class(F.col("detail")).alias("failure"), failure_status(F.col("detail")).alias("status")
    )
    return log.groupBy("failure", "status").agg(F.count(F.lit(1)).alias("n"))


# Backgrounds: the part of an order's first line is its background clip.
PAIRS_SQL = """SELECT 'clip-' || CAST(l_orderkey AS VARCHAR) AS sample_id,
  CASE WHEN l_tax > 0.07 THEN 'tape' ELSE 'library' END || '://' ||
    CASE WHEN l_discount > 0.09 THEN '../' ELSE '' END || 'bg' || CAST(l_partkey AS VARCHAR) || '.mp4' AS background_ref,
  l_quantity AS background_start_sec, l_discount AS compatibility_score,
  CASE WHEN l_tax < 0.01 THEN 'v0' ELSE 'frozen-pairing-v1-6-3-3' END AS manifest_version,
  CASE WHEN l_returnflag = 'R' THEN 'rejected' ELSE 'approved' END AS approval_status,
  CASE WHEN l_linestatus = 'O' THEN 'fullbody' ELSE 'halfbody' END AS framing
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
        FROM lineitem) WHERE rn = 1"""
FILES_SQL = "SELECT '/bg/bg' || CAST(p_partkey AS VARCHAR) || '.mp4' AS path FROM part WHERE p_size > 10"


def pairings(t: Tables) -> DataFrame:
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    first = (
        t.lineitem.groupBy("l_orderkey")
        .agg(F.min(F.struct(order.alias("o"), "l_tax", "l_discount", "l_returnflag", "l_linestatus")).alias("f"))
        .select("l_orderkey", "f.o.*", "f.l_tax", "f.l_discount", "f.l_returnflag", "f.l_linestatus")
    )
    return first.select(
        F.concat(F.lit("clip-"), F.col("l_orderkey").cast("string")).alias("sample_id"),
        F.concat(
            F.when(F.col("l_tax") > 0.07, "tape").otherwise("library"), F.lit("://"),
            F.when(F.col("l_discount") > 0.09, "../").otherwise(""),
            F.lit("bg"), F.col("l_partkey").cast("string"), F.lit(".mp4"),
        ).alias("background_ref"),
        F.col("l_quantity").alias("background_start_sec"),
        F.col("l_discount").alias("compatibility_score"),
        F.lit("offline").alias("precheck_method"),
        F.to_json(F.struct(F.col("l_tax").alias("x"))).alias("placement_json"),
        F.when(F.col("l_tax") < 0.01, "v0").otherwise("frozen-pairing-v1-6-3-3").alias("manifest_version"),
        F.when(F.col("l_returnflag") == "R", "rejected").otherwise("approved").alias("approval_status"),
        F.when(F.col("l_linestatus") == "O", "fullbody").otherwise("halfbody").alias("framing"),
    )


def background_files(t: Tables) -> DataFrame:
    return t.part.filter("p_size > 10").select(
        F.concat(F.lit("/bg/bg"), F.col("p_partkey").cast("string"), F.lit(".mp4")).alias("path")
    )


ROOTS = {"library": "/bg"}
RESOLVED = """resolved AS (SELECT p.*, '/bg/' || substr(background_ref, strpos(background_ref, '://') + 3) AS bpath,
   CASE WHEN NOT starts_with(background_ref, 'library://') THEN 'unknown_reference'
        WHEN contains(background_ref, '../') THEN 'unsafe_path' ELSE 'ok' END AS ref_verdict FROM pairs p)"""


@query("assign_pairings", JOBS + f""", pairs AS ({PAIRS_SQL}), files AS ({FILES_SQL}), {RESOLVED},
v AS (SELECT j.id, {FRAMING} AS wanted, r.*, f.path AS found,
  CASE WHEN r.sample_id IS NULL THEN 'no_pairing'
    WHEN r.manifest_version <> 'frozen-pairing-v1-6-3-3' THEN 'unsupported_version'
    WHEN r.approval_status <> 'approved' THEN 'not_approved'
    WHEN r.ref_verdict <> 'ok' THEN r.ref_verdict
    WHEN f.path IS NULL THEN 'background_missing'
    WHEN {FRAMING} <> r.framing THEN 'framing_mismatch' ELSE 'ok' END AS pairing_verdict
  FROM jobs j LEFT JOIN resolved r ON r.sample_id = j.sample_id LEFT JOIN files f ON r.ref_verdict = 'ok' AND f.path = r.bpath)
SELECT id, pairing_verdict, CASE WHEN pairing_verdict = 'ok' THEN bpath END AS background_path,
  CASE WHEN pairing_verdict = 'ok' THEN background_start_sec END AS background_start_sec,
  CASE WHEN pairing_verdict = 'ok' THEN background_ref END AS background_ref,
  CASE WHEN pairing_verdict = 'ok' THEN wanted END AS framing FROM v""")
def assign_pairings(t: Tables) -> DataFrame:
    out = ops.assign_pairings(jobs(t), pairings(t), ROOTS, background_files(t))
    return out.select(
        "id", "pairing_verdict", "background_path", "background_start_sec",
        F.get_json_object("action_params_json", "$.scene_pairing.background_ref").alias("background_ref"), "framing",
    )


@query("resolve_refs", f"""WITH pairs AS ({PAIRS_SQL}), {RESOLVED}
SELECT sample_id, ref_verdict, CASE WHEN ref_verdict = 'ok' THEN bpath END AS path FROM resolved""")
def resolve_refs(t: Tables) -> DataFrame:
    return ops.resolve_refs(pairings(t), "background_ref", ROOTS).select("sample_id", "ref_verdict", "path")


# customer as registry: two market segments are no people, and a few paths differ.
REGISTRY_SQL = """SELECT 'S' || CAST(c_custkey AS VARCHAR) AS subject_id,
  'human' AS asset_kind, CASE WHEN c_acctbal < 0 THEN 'moved/' ELSE 'assets/' END || CAST(c_custkey AS VARCHAR) || '.bin' AS asset_path
  FROM customer WHERE c_mktsegment <> 'MACHINERY'
  UNION ALL SELECT 'S' || CAST(c_custkey AS VARCHAR), 'human', 'assets/' || CAST(c_custkey AS VARCHAR) || '.bin'
  FROM customer WHERE c_mktsegment = 'BUILDING'"""


def registry(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    entry = lambda folder: [
        F.concat(F.lit("S"), key).alias("subject_id"), F.lit("human").alias("asset_kind"),
        F.concat(folder, key, F.lit(".bin")).alias("asset_path"),
    ]
    kept = t.customer.filter("c_mktsegment <> 'MACHINERY'").select(
        *entry(F.when(F.col("c_acctbal") < 0, "moved/").otherwise("assets/"))
    )
    return kept.unionAll(t.customer.filter("c_mktsegment = 'BUILDING'").select(*entry(F.lit("assets/"))))


@query("registry_gate", JOBS + f""", registry AS ({REGISTRY_SQL}),
per AS (SELECT subject_id, count(*) AS n, min(asset_path) AS p FROM registry GROUP BY subject_id)
SELECT j.id, CASE WHEN (SELECT count(*) FROM registry) = 0 OR (SELECT count(*) FROM registry WHERE asset_kind <> 'human') > 0
    THEN 'registry_not_human_only'
  WHEN coalesce(per.n, 0) <> 1 THEN 'subject_not_unique'
  WHEN j.asset_path IS DISTINCT FROM per.p THEN 'asset_path_differs' ELSE 'ok' END AS registry_verdict
FROM jobs j LEFT JOIN per ON per.subject_id = j.subject_id""")
def registry_gate(t: Tables) -> DataFrame:
    return ops.registry_gate(jobs(t), registry(t)).select("id", "registry_verdict")


@query("split_leakage", JOBS + f""", pairs AS ({PAIRS_SQL})
SELECT background_ref, min(split) AS first_split, max(split) AS last_split, count(*) AS jobs
FROM jobs j JOIN pairs p ON p.sample_id = j.sample_id GROUP BY background_ref HAVING count(DISTINCT split) > 1""")
def split_leakage(t: Tables) -> DataFrame:
    used = jobs(t).select("sample_id", "split").join(pairings(t).select("sample_id", "background_ref"), "sample_id")
    return ops.split_leakage(used, "background_ref")


@query("next_design_seq", """WITH existing AS (SELECT max(o_orderkey) AS top FROM orders WHERE o_orderstatus = 'F'),
fresh AS (SELECT c_custkey FROM customer)
SELECT c_custkey, coalesce(top, -1) + row_number() OVER (ORDER BY c_custkey) AS design_seq FROM fresh, existing""")
def next_design_seq(t: Tables) -> DataFrame:
    existing = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("design_seq"))
    return ops.next_seq(t.customer.select("c_custkey"), existing, "design_seq", ["c_custkey"])


ACTIVATE_JOBS = JOBS_SQL.replace("ELSE 'pending' END AS status", "ELSE 'waiting_release_review' END AS status")


@query("activate_subjects", f"""WITH jobs AS ({ACTIVATE_JOBS}), registry AS ({REGISTRY_SQL}),
pairs AS ({PAIRS_SQL}), files AS ({FILES_SQL}), {RESOLVED},
ready AS (SELECT DISTINCT sample_id FROM resolved r JOIN files f ON f.path = r.bpath WHERE ref_verdict = 'ok'),
nxt AS (SELECT j.id, CASE WHEN status = 'waiting_release_review' AND subject_id IN (SELECT subject_id FROM registry WHERE asset_kind = 'human')
  THEN CASE WHEN sample_id IN (SELECT sample_id FROM ready) THEN 'pending' ELSE 'waiting_missing_background' END
  ELSE status END AS status FROM jobs j)
SELECT id, status FROM nxt""")
def activate_subjects(t: Tables) -> DataFrame:
    waiting = jobs(t).withColumn(
        "status", F.when(F.col("status") == "pending", "waiting_release_review").otherwise(F.col("status"))
    )
    return ops.activate(waiting, registry(t), pairings(t), ROOTS, background_files(t)).select("id", "status")


# A retry over a queue with nothing running: finished orders stay done, the rest had failed.
RETRY_SQL = JOBS_SQL.replace("WHEN 'O' THEN 'running' ELSE 'pending' END AS status", "ELSE 'failed' END AS status")


def failed_jobs(t: Tables) -> DataFrame:
    return jobs(t).withColumn("status", F.when(F.col("status") == "done", "done").otherwise("failed"))


def _retry_inputs(t: Tables):
    queue = failed_jobs(t)
    requests = event_log(t).filter("event = 'claimed'").select("job_id")
    people = t.customer.select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("subject_id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "machine").otherwise("human").alias("asset_kind"),
    )
    files = background_files(t).unionAll(
        t.customer.filter("c_acctbal > 0").select(F.concat(F.lit("assets/"), F.col("c_custkey").cast("string"), F.lit(".bin")).alias("path"))
    )
    done = queue.filter("status = 'done' AND price > 200000").select("split", "sample_id")
    return queue, ops.retry_checks(queue, requests, people, pairings(t), ROOTS, files, done)


@query("retry_checks", f"""WITH jobs AS ({RETRY_SQL}), log AS ({LOG_SQL}), pairs AS ({PAIRS_SQL}), files AS ({FILES_SQL}), {RESOLVED},
ready AS (SELECT DISTINCT sample_id FROM resolved r JOIN files f ON f.path = r.bpath WHERE ref_verdict = 'ok'),
asked AS (SELECT DISTINCT job_id AS id FROM log WHERE event = 'claimed')
SELECT a.id, j.status AS previous_status,
  CASE WHEN j.status IS NULL OR j.status <> 'failed' THEN 'absent_or_not_retryable'
    WHEN c.c_custkey IS NULL OR c.c_mktsegment = 'MACHINERY' THEN 'subject_not_human'
    WHEN c.c_acctbal <= 0 THEN 'asset_missing'
    WHEN j.sample_id NOT IN (SELECT sample_id FROM ready) THEN 'background_missing' END AS reason
FROM asked a LEFT JOIN jobs j ON j.id = a.id LEFT JOIN customer c ON 'S' || CAST(c.c_custkey AS VARCHAR) = j.subject_id""")
def retry_checks(t: Tables) -> DataFrame:
    return _retry_inputs(t)[1]


@query("retry_all_or_nothing", f"""WITH jobs AS ({RETRY_SQL}) SELECT status, count(*) AS jobs FROM jobs GROUP BY status""")
def retry_all_or_nothing(t: Tables) -> DataFrame:
    """Some requests are invalid, so no job may change."""
    queue, checks = _retry_inputs(t)
    nxt, _ = ops.retry(queue, checks, "backgrounds restored")
    return ops.queue_status(nxt)


@query("retry_valid_requests", f"""WITH jobs AS ({RETRY_SQL}) SELECT
  CASE status WHEN 'failed' THEN 'pending' ELSE status END AS status, count(*) AS jobs FROM jobs GROUP BY 1""")
def retry_valid_requests(t: Tables) -> DataFrame:
    queue = failed_jobs(t)
    checks = queue.filter("status = 'failed'").select("id", F.col("status").alias("previous_status"), F.lit(None).cast("string").alias("reason"))
    nxt, _ = ops.retry(queue, checks, "backgrounds restored")
    return ops.queue_status(nxt)


@query("recover_stale", JOBS + """, live AS (SELECT DISTINCT user_id AS pid FROM events)
SELECT id, CASE WHEN status = 'running' AND live.pid IS NULL THEN 'pending' ELSE status END AS status,
  CASE WHEN status = 'running' AND live.pid IS NULL THEN 'recovered stale worker' END AS error,
  CASE WHEN status = 'running' AND live.pid IS NULL THEN NULL ELSE jobs.pid END AS pid
FROM jobs LEFT JOIN live ON live.pid = jobs.pid""")
def recover_stale(t: Tables) -> DataFrame:
    live = t.events.select(F.col("user_id").alias("pid"))
    return ops.recover_stale(jobs(t), live).select("id", "status", "error", "pid")


# Failures: the first failing event of each user, whose order of that key gives the subject.
FAILURES_SQL = f"""SELECT job_id, arg_min(detail, event_id) AS detail FROM ({LOG_SQL}) WHERE event IN ('error', 'view', 'signup') GROUP BY job_id"""


def failures(t: Tables) -> DataFrame:
    first = (
        event_log(t).filter(F.col("event").isin("error", "view", "signup"))
        .groupBy("job_id").agg(F.min_by("detail", "event_id").alias("detail"))
    )
    return first.join(jobs(t).select(F.col("id").alias("job_id"), "subject_id"), "job_id")


@query("cascade_pause", JOBS + f""", failures AS (SELECT f.*, j.subject_id FROM ({FAILURES_SQL}) f JOIN jobs j ON j.id = f.job_id),
blocking AS (SELECT subject_id, arg_min(detail, job_id) AS d FROM failures
  WHERE contains(detail, 'GARMENT_QC:') OR contains(detail, 'PREPASS:') GROUP BY subject_id)
SELECT j.id, CASE WHEN j.status = 'pending' AND b.d IS NOT NULL AND f.job_id IS NULL THEN 'paused_subject_qc' ELSE j.status END AS status,
  CASE WHEN j.status = 'pending' AND b.d IS NOT NULL AND f.job_id IS NULL THEN b.d END AS error
FROM jobs j LEFT JOIN blocking b ON b.subject_id = j.subject_id LEFT JOIN failures f ON f.job_id = j.id""")
def cascade_pause(t: Tables) -> DataFrame:
    return ops.cascade_pause(jobs(t), failures(t)).select("id", "status", "error")


@query("set_status", JOBS + f""", failures AS ({FAILURES_SQL})
SELECT j.id, CASE WHEN f.job_id IS NULL THEN j.status WHEN f.detail IS NULL THEN 'done'
  WHEN contains(f.detail, 'GARMENT_QC:') OR contains(f.detail, 'PREPASS:') THEN 'failed_prepass' ELSE 'failed' END AS status,
  f.detail AS error FROM jobs j LEFT JOIN failures f ON f.job_id = j.id""")
def set_status(t: Tables) -> DataFrame:
    return ops.set_status(jobs(t), failures(t).select("job_id", "detail"))[0].select("id", "status", "error")


@query("claim_effects", JOBS + """
, ready AS (
  SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY CASE split WHEN 'train' THEN 0 ELSE 1 END, id) AS rn
  FROM jobs j WHERE status = 'pending'
    AND NOT EXISTS (SELECT 1 FROM jobs a WHERE a.status = 'running' AND a.subject_id = j.subject_id)),
wave AS (SELECT id FROM ready WHERE rn = 1)
SELECT j.id, CASE WHEN w.id IS NULL THEN j.status ELSE 'running' END AS status,
  j.attempts + CASE WHEN w.id IS NULL THEN 0 ELSE 1 END AS attempts,
  CASE WHEN w.id IS NULL THEN NULL ELSE 'worker-1' END AS worker_id
FROM jobs j LEFT JOIN wave w ON w.id = j.id""")
def claim_effects(t: Tables) -> DataFrame:
    queue = jobs(t)
    return ops.apply_wave(queue, ops.dispatch_wave(queue), "worker-1")[0].select("id", "status", "attempts", "worker_id")
