"""Sources and sinks: each query writes rows of a supplied table and reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom import schemas
from cliploom.plans.registry import Tables, query
from cliploom.session import scratch_path
from cliploom.sources import files as file_source
from cliploom.sources import readers, snapshots


@query("manifest_scan", "SELECT CAST(doc_id AS VARCHAR) AS path, source AS archive, sha256(text) AS sha256 FROM documents")
def manifest_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "manifest")
    t.documents.select(F.col("doc_id").cast("string").alias("path"), F.col("source").alias("archive"), F.sha2("text", 256).alias("sha256")).write.json(path)
    return readers.read_manifest(t.spark, path, schemas.FILES)


@query("registry_scan", """SELECT c_name AS subject_id, 'human' AS asset_kind, c_mktsegment AS status, 'assets/' || c_name AS asset_path FROM customer""")
def registry_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "registry")
    rows = t.customer.select(
        F.col("c_name").alias("subject_id"), F.lit("human").alias("asset_kind"),
        F.col("c_mktsegment").alias("status"), F.concat(F.lit("assets/"), "c_name").alias("asset_path"),
    )
    rows.write.option("sep", "\t").option("header", True).csv(path)
    return readers.read_registry(t.spark, path)


@query("table_scan", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'")
def table_scan(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "tables")
    snapshots.snapshot(t.orders, f"{root}/jobs")
    return readers.read_table(t.spark, root, "jobs", ["o_orderkey", "o_custkey"], "o_orderstatus = 'P'")


@query("snapshot_sink", "SELECT o_orderkey, 'done' AS status FROM orders")
def snapshot_sink(t: Tables) -> DataFrame:
    """Two snapshots; the reader takes the newer one."""
    root = scratch_path(t.spark, "tables")
    snapshots.snapshot(t.orders.select("o_orderkey", F.lit("pending").alias("status")), f"{root}/jobs")
    snapshots.snapshot(readers.read_table(t.spark, root, "jobs").withColumn("status", F.lit("done")), f"{root}/jobs")
    return readers.read_table(t.spark, root, "jobs")


@query("append_sink", "SELECT user_id AS job_id, event_type AS event, props AS detail FROM events")
def append_sink(t: Tables) -> DataFrame:
    """Two appends, by whether the event is an error."""
    path = scratch_path(t.spark, "log")
    rows = t.events.select(F.col("user_id").alias("job_id"), F.col("event_type").alias("event"), F.col("props").alias("detail"))
    snapshots.append_events(rows.filter("event = 'error'"), path)
    snapshots.append_events(rows.filter("event <> 'error'"), path)
    return t.spark.read.parquet(path)


@query("index_sink", "SELECT 'clip-' || CAST(o_orderkey AS VARCHAR) AS record_path, o_orderstatus AS status FROM orders")
def index_sink(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "index")
    rows = t.orders.select(F.concat(F.lit("clip-"), F.col("o_orderkey").cast("string")).alias("record_path"), F.col("o_orderstatus").alias("status"))
    target = snapshots.write_index(rows, root, "record_path")
    return readers.read_manifest(t.spark, target, "record_path string, status string")


@query("record_scan", """SELECT 'clip-' || CAST(s_suppkey AS VARCHAR) AS sample_id, n_name AS split, s_name AS subject_id,
  s_name || '.bin' AS asset_path, CAST(s_acctbal * 100 AS BIGINT) AS asset_bytes FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def record_scan(t: Tables) -> DataFrame:
    from cliploom.operators.provenance import write_records

    root = scratch_path(t.spark, "records")
    rows = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select(
        F.lit(1).alias("schema_version"), F.lit("completed").alias("status"),
        F.concat(F.lit("clip-"), F.col("s_suppkey").cast("string")).alias("sample_id"),
        F.col("n_name").alias("split"), F.col("s_name").alias("subject_id"),
        F.struct(F.concat("s_name", F.lit(".bin")).alias("path"), F.lit(True).alias("exists"),
                 F.round(F.col("s_acctbal") * 100).cast("long").alias("bytes")).alias("asset"),
    )
    write_records(rows, root)
    found = readers.read_records(t.spark, root)
    return found.select("sample_id", "split", "subject_id", F.col("asset.path").alias("asset_path"), F.col("asset.bytes").alias("asset_bytes"))


@query("feature_scan", """SELECT CAST(vec_id AS VARCHAR) AS segment_id, CAST(label AS BIGINT) AS frame_count,
  round(CAST(embedding[1] AS DOUBLE), 6) AS motion_energy FROM embeddings""")
def feature_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "features")
    t.embeddings.select(
        F.col("vec_id").cast("string").alias("segment_id"), F.lit(2).alias("schema"),
        F.lit(schemas.OBSERVATION_VERSION).alias("observation_version"), F.col("label").cast("long").alias("frame_count"),
        F.struct(F.element_at("embedding", 1).cast("double").alias("motion_energy")).alias("metrics"),
    ).write.option("compression", "gzip").json(path)
    found = readers.read_features(t.spark, path, one_document=False)
    return found.select("segment_id", "frame_count", F.round("metrics.motion_energy", 6).alias("motion_energy"))


def _page_files(t: Tables) -> str:
    """A file for each page."""
    root = scratch_path(t.spark, "files")
    file_source.write_text_files(t.pages, root, "page_id", "html")
    return root


def _page_id(path: str = "path"):
    return F.regexp_extract(path, r"page_id=(\d+)", 1).cast("long").alias("page_id")


@query("file_facts", "SELECT page_id, CAST(octet_length(encode(html)) + 1 AS BIGINT) AS bytes, sha256(html || chr(10)) AS sha256 FROM pages")
def file_facts(t: Tables) -> DataFrame:
    """Files above 8 KiB take the block-wise path, the rest the whole-file path."""
    return file_source.file_facts(t.spark, _page_files(t), "*.txt", whole_bytes=8192).select(_page_id(), "bytes", "sha256")


@query("list_files", "SELECT page_id, CAST(octet_length(encode(html)) + 1 AS BIGINT) AS bytes FROM pages")
def list_files(t: Tables) -> DataFrame:
    return file_source.list_files(t.spark, _page_files(t), "*.txt").select(_page_id(), "bytes")
