"""Views of the supplied tables used by several queries, as expressions both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.plans.registry import Tables

# orders seen as the job table
JOB_EXPRS = (
    "o_orderkey AS id",
    "'S' || CAST(o_custkey AS VARCHAR(20)) AS subject_id",
    "'assets/' || CAST(o_custkey AS VARCHAR(20)) || '.bin' AS asset_path",
    "'clip-' || CAST(o_orderkey AS VARCHAR(20)) AS sample_id",
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'test' ELSE 'train' END AS split",
    "CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'running' ELSE 'pending' END AS status",
    "CAST(o_orderkey % 12 AS INT) AS action_index",
    "'{\"subject_action_index\":' || CAST(o_orderkey % 12 AS VARCHAR(20)) || '}' AS action_params_json",
    "o_custkey AS pid",
    "CAST(o_orderkey % 7 AS BIGINT) AS attempts",
    "CAST(NULL AS VARCHAR(20)) AS worker_id",
    "CAST(NULL AS VARCHAR(20)) AS error",
    "CAST(NULL AS TIMESTAMP) AS started_at",
    "CAST(NULL AS TIMESTAMP) AS finished_at",
    "o_totalprice AS price",
)
JOBS_SQL = "SELECT " + ", ".join(JOB_EXPRS) + " FROM orders"


def jobs(t: Tables) -> DataFrame:
    return t.orders.selectExpr(*JOB_EXPRS)


# events seen as the event log
LOG_EXPRS = (
    "user_id AS job_id",
    "event_id",
    "CASE event_type WHEN 'click' THEN 'claimed' ELSE event_type END AS event",
    "CASE event_type WHEN 'error' THEN 'GARMENT_QC: ' || props WHEN 'view' THEN 'PREPASS: ' || props ELSE props END AS detail",
    "ts",
    "value",
)
LOG_SQL = "SELECT " + ", ".join(LOG_EXPRS) + " FROM events"


def event_log(t: Tables) -> DataFrame:
    return t.events.selectExpr(*LOG_EXPRS)


# documents seen as the file manifest, labels as what was found on disk
MANIFEST_EXPRS = ("CAST(doc_id AS VARCHAR(20)) AS path", "source AS archive", "n_chars AS bytes")


def manifest(t: Tables) -> DataFrame:
    return t.documents.select(
        F.col("doc_id").cast("string").alias("path"),
        F.col("source").alias("archive"),
        F.sha2("text", 256).alias("sha256"),
        F.col("n_chars").alias("bytes"),
    )


MANIFEST_SQL = (
    "SELECT CAST(doc_id AS VARCHAR) AS path, source AS archive, sha256(text) AS sha256, n_chars AS bytes FROM documents"
)

# A copy on disk exists for labelled documents; a toxic one was altered, a low-quality one cut short.
FACTS_SQL = """SELECT CAST(d.doc_id AS VARCHAR) AS path, true AS present,
  sha256(CASE WHEN l.toxic = 1 THEN d.text || '!' ELSE d.text END) AS sha256,
  CASE WHEN l.quality = 0 THEN d.n_chars - 1 ELSE d.n_chars END AS bytes
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id"""


def facts(t: Tables) -> DataFrame:
    joined = t.documents.join(t.labels, "doc_id")
    return joined.select(
        F.col("doc_id").cast("string").alias("path"),
        F.lit(True).alias("exists"),
        F.sha2(F.when(F.col("toxic") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("sha256"),
        F.when(F.col("quality") == 0, F.col("n_chars") - 1).otherwise(F.col("n_chars")).alias("bytes"),
    )
