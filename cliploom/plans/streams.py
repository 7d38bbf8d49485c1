"""Streaming queries: the events table arrives as a file stream in order of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.plans.common import LOG_SQL
from cliploom.plans.registry import Tables, query
from cliploom.session import scratch_path
from cliploom.streaming import streams as S

ARRIVALS = 4
FILE_ROWS = 10_000
TIMEOUT_S = 6 * 3600


def arriving(t: Tables, columns: list, schema: str) -> DataFrame:
    """The whole events table written in four steps of equal time, then read as a stream."""
    path = scratch_path(t.spark, "arrivals")
    rows = t.events.withColumn("ts", F.expr("make_timestamp_ltz(year(ts), month(ts), day(ts), hour(ts), minute(ts), extract(SECOND FROM ts), 'UTC')"))
    ends = rows.agg(F.unix_micros(F.min("ts")).alias("a"), F.unix_micros(F.max("ts")).alias("z")).first()
    width = max(1, (ends["z"] - ends["a"]) // ARRIVALS + 1)
    step = F.floor((F.unix_micros("ts") - ends["a"]) / width)
    counts = {r["step"]: r["count"] for r in rows.groupBy(step.alias("step")).count().collect()}
    files = max(1, min(counts.get(i, 0) for i in range(ARRIVALS)) // FILE_ROWS)  # as many for each step, so that a batch is a step
    for i in range(ARRIVALS):
        rows.filter(step == i).select(*columns).repartition(files).write.mode("append").parquet(path)
    return S.file_stream(t.spark, path, schema, files_per_batch=files)


LOG_SCHEMA = "job_id long, event_id long, event string, ts timestamp"


def log_columns() -> list:
    event = F.expr("CASE event_type WHEN 'click' THEN 'claimed' ELSE event_type END").alias("event")
    return [F.col("user_id").alias("job_id"), "event_id", event, "ts"]


@query("stream_status", f"""WITH log AS ({LOG_SQL}), r AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts DESC, event_id DESC) AS rn FROM log)
SELECT event, count(*) AS jobs FROM r WHERE rn = 1 GROUP BY event""")
def stream_status(t: Tables) -> DataFrame:
    return S.stream_status(t.spark, arriving(t, log_columns(), LOG_SCHEMA), scratch_path(t.spark, "status"))


@query("stream_stale", f"""WITH g AS (SELECT user_id AS job_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt, (SELECT max(ts) FROM events) AS top FROM events)
SELECT job_id, CAST(epoch_us(ts) AS BIGINT) AS silent_since FROM g
WHERE coalesce(nxt - ts > INTERVAL {TIMEOUT_S} SECOND, true) AND ts + INTERVAL {TIMEOUT_S} SECOND <= date_trunc('millisecond', top) - INTERVAL {TIMEOUT_S} SECOND""")
def stream_stale(t: Tables) -> DataFrame:
    stream = S.stream_stale(arriving(t, log_columns(), LOG_SCHEMA), f"{TIMEOUT_S} seconds")
    out = S.drain_append(stream, scratch_path(t.spark, "stale"))
    return out.select("job_id", F.unix_micros("silent_since").alias("silent_since"))


@query("stream_telemetry", """SELECT user_id AS run, CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) AS window_start, max(value) AS peak_memory_mib,
  round(avg(value % 100), 6) AS mean_utilization, count(*) AS samples FROM events GROUP BY 1, 2""")
def stream_telemetry(t: Tables) -> DataFrame:
    columns = [F.col("user_id").alias("run"), "ts", F.col("value").alias("memory_used_mib"), (F.col("value") % 100).alias("utilization")]
    stream = arriving(t, columns, "run long, ts timestamp, memory_used_mib double, utilization double")
    root = scratch_path(t.spark, "telemetry")
    S.drain_deltas(S.stream_telemetry(stream, "1 hour", "2 hours"), root)
    out = S.fold_deltas(t.spark, root, ["run", "window_start"])
    return out.select("run", F.unix_timestamp("window_start").alias("window_start"), "peak_memory_mib", F.round("mean_utilization", 6).alias("mean_utilization"), "samples")


@query("stream_progress", """SELECT count(DISTINCT user_id) AS completed, (SELECT count(*) FROM customer) AS total,
  count(DISTINCT user_id) = (SELECT count(*) FROM customer) AS complete FROM events WHERE user_id IN (SELECT c_custkey FROM customer)""")
def stream_progress(t: Tables) -> DataFrame:
    stream = arriving(t, [F.col("user_id").alias("subject_id"), "ts"], "subject_id long, ts timestamp")
    return S.stream_progress(t.spark, stream, t.customer.select(F.col("c_custkey").alias("subject_id")), scratch_path(t.spark, "progress"))


@query("stream_reports", """SELECT DISTINCT user_id AS job_id, event_type AS attempt FROM events JOIN orders ON o_orderkey = user_id
WHERE event_type = CASE o_orderstatus WHEN 'F' THEN 'purchase' WHEN 'O' THEN 'view' ELSE 'signup' END""")
def stream_reports(t: Tables) -> DataFrame:
    stream = arriving(t, [F.col("user_id").alias("job_id"), F.col("event_type").alias("attempt"), "ts"], "job_id long, attempt string, ts timestamp")
    current = F.when(F.col("o_orderstatus") == "F", "purchase").when(F.col("o_orderstatus") == "O", "view").otherwise("signup")
    jobs = t.orders.select(F.col("o_orderkey").alias("job_id"), current.alias("attempt"))
    return S.drain_append(S.stream_reports(stream, jobs, "400 days"), scratch_path(t.spark, "reports")).select("job_id", "attempt")


HORIZON_H, DELAY_H = 72, 2


@query("stream_live_reports", f"""WITH log AS ({LOG_SQL}), r AS (SELECT DISTINCT job_id, event_id % 3 AS attempt, ts FROM log WHERE event = 'purchase'),
c AS (SELECT job_id, event_id % 3 AS attempt, ts, event_id FROM log WHERE event = 'claimed'),
near AS (SELECT r.job_id, r.attempt, r.ts, c.attempt AS claimed, c.ts AS claimed_at, c.event_id AS claim_id,
  row_number() OVER (PARTITION BY r.job_id, r.attempt, r.ts ORDER BY c.ts DESC, c.event_id DESC) AS rn
  FROM r JOIN c ON r.job_id = c.job_id AND c.ts <= r.ts AND c.ts >= r.ts - INTERVAL {HORIZON_H} HOUR),
seen AS (SELECT date_trunc('millisecond', least((SELECT max(ts) FROM c), (SELECT max(ts) FROM r))) - INTERVAL {DELAY_H} HOUR AS watermark)
SELECT job_id, attempt, CAST(epoch_us(ts) AS BIGINT) AS reported_at, CAST(epoch_us(claimed_at) AS BIGINT) AS claimed_at, claim_id
FROM near, seen WHERE rn = 1 AND claimed = attempt AND ts + INTERVAL {HORIZON_H} HOUR <= watermark""")
def stream_live_reports(t: Tables) -> DataFrame:
    log = arriving(t, log_columns(), LOG_SCHEMA).withColumn("attempt", F.col("event_id") % 3)
    claims = log.where("event = 'claimed'").withColumn("claim_id", F.col("event_id"))
    stream = S.stream_live_reports(log.where("event = 'purchase'"), claims, f"{DELAY_H} hours", f"{HORIZON_H} HOURS")
    out = S.drain_append(stream, scratch_path(t.spark, "live-reports"))
    return out.withColumns({c: F.unix_micros(c) for c in ("reported_at", "claimed_at")})
