"""Structured Streaming operators over the event log, reports and telemetry.

Sources are file streams; sinks are either append files or per-epoch deltas. A delta
folder is overwritten when its epoch is repeated, so a restarted query stays exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def drain_deltas(stream: DataFrame, root: str) -> None:
    """Process what is there; each micro-batch's updated rows go to their epoch folder."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/deltas/epoch={epoch}")

    query = (
        stream.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(write).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def fold_deltas(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Newest row per key over all epochs."""
    rows = spark.read.parquet(f"{root}/deltas")
    values = [c for c in rows.columns if c not in (*keys, "epoch")]
    last = F.max_by(F.struct(*values), "epoch").alias("_last")
    return rows.groupBy(*keys).agg(last).select(*keys, "_last.*")


def drain_append(stream: DataFrame, root: str) -> DataFrame:
    """Process what is there into append files and read them back."""
    query = (
        stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start(f"{root}/rows")
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/rows")


def stream_latest(events: DataFrame, job: str = "job_id", order: Sequence[str] = ("ts", "event_id"), event: str = "event") -> DataFrame:
    """Last event per job, kept in state; update mode."""
    return events.groupBy(job).agg(F.max(F.struct(*order, event)).alias("_last")).select(job, F.col(f"_last.{event}").alias(event))


def stream_status(spark: SparkSession, events: DataFrame, root: str) -> DataFrame:
    """Live status counts: jobs per last event."""
    drain_deltas(stream_latest(events), root)
    return fold_deltas(spark, root, ["job_id"]).groupBy("event").agg(F.count(F.lit(1)).alias("jobs"))


def stream_stale(events: DataFrame, timeout: str, job: str = "job_id") -> DataFrame:
    """Moments after which a job stayed silent longer than the timeout, by event time.

    A session of a job goes on while each event follows within the timeout; its last event is
    reported once the watermark has passed the session's end. Sessions are combined before
    the shuffle and only their bounds are kept as state, however many events they hold.
    """
    watched = events.select(F.col(job).alias("job_id"), "ts").withWatermark("ts", timeout)
    sessions = watched.groupBy("job_id", F.session_window("ts", timeout).alias("_w")).agg(F.max("ts").alias("silent_since"))
    return sessions.select("job_id", "silent_since")


def stream_telemetry(samples: DataFrame, width: str, delay: str) -> DataFrame:
    """Peak memory and mean utilisation per run and tumbling window; later rows are dropped."""
    windows = samples.withWatermark("ts", delay).groupBy("run", F.window("ts", width).alias("w")).agg(
        F.max("memory_used_mib").alias("peak_memory_mib"), F.avg("utilization").alias("mean_utilization"), F.count(F.lit(1)).alias("samples")
    )
    return windows.select("run", F.col("w.start").alias("window_start"), "peak_memory_mib", "mean_utilization", "samples")


def stream_seen(reports: DataFrame, key: str = "subject_id") -> DataFrame:
    """Subjects reported so far, kept in state; update mode."""
    return reports.groupBy(key).agg(F.count(F.lit(1)).alias("reports"))


def stream_progress(spark: SparkSession, reports: DataFrame, plan: DataFrame, root: str, key: str = "subject_id") -> DataFrame:
    """Audit progress against the plan after the reports so far."""
    from cliploom.operators.gates import progress

    drain_deltas(stream_seen(reports, key), root)
    return progress(fold_deltas(spark, root, [key]), plan, key)


def stream_reports(reports: DataFrame, jobs: DataFrame, delay: str) -> DataFrame:
    """Reports of the current attempt only, repeats within the watermark dropped.

    ``jobs`` is static with job_id and attempt; a report of an older attempt finds no match.
    """
    current = reports.withWatermark("ts", delay).join(jobs.select("job_id", "attempt"), ["job_id", "attempt"])
    return current.dropDuplicatesWithinWatermark(["job_id", "attempt"])


def stream_live_reports(reports: DataFrame, claims: DataFrame, delay: str, horizon: str) -> DataFrame:
    """Reports that speak for the attempt that was current when they were made; both sides may be streams.

    ``reports`` has job_id, attempt and ts; ``claims`` has job_id, attempt, ts and claim_id and
    tells when an attempt took its job over. A report counts for the last claim of its job at or
    before it, of claims at the same time that with the largest claim_id, if that names the same
    attempt and is at most ``horizon`` old. Equal reports are one row.

    Both sides wait for ``delay``; a claim is held until no report can reach it and a report until
    no claim can precede it, so the state is what arrives within ``delay`` and ``horizon``. Rows
    later than that are dropped. A stream tells a report once it is older than ``delay`` and
    ``horizon`` together; static tables give the same rows without waiting.
    """
    made = reports.select("job_id", "attempt", "ts").withWatermark("ts", delay)
    taken = claims.select(
        F.col("job_id").alias("_job"), F.col("ts").alias("claimed_at"), "claim_id", F.col("attempt").alias("_attempt")
    ).withWatermark("claimed_at", delay)
    near = made.join(taken, F.expr(f"job_id = _job AND claimed_at <= ts AND claimed_at >= ts - INTERVAL {horizon}"))
    last = F.max(F.struct("claimed_at", "claim_id", "_attempt")).alias("_last")
    current = near.groupBy("job_id", "attempt", "ts").agg(last).where(F.col("_last._attempt") == F.col("attempt"))
    return current.select("job_id", "attempt", F.col("ts").alias("reported_at"), "_last.claimed_at", "_last.claim_id")
