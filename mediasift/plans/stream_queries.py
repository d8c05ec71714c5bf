"""Registered Structured Streaming queries: incremental dedup and stage monitors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasift.plans.dedup_queries import ORACLE as DEDUP_ORACLE
from mediasift.plans.dedup_queries import PHASH
from mediasift.session import checkpoint_dir, materialize
from mediasift.sources.fixtures import FAR_COPY, NEAR_COPY, clone_frames, phash_signatures
from mediasift.streaming import backlog, monitor
from mediasift.streaming.incremental import run_incremental

WATERMARK = "1 hour"
TUMBLE = "1 hour"
SLIDE_LEN, SLIDE_STEP = "2 hours", "1 hour"
SESSION_GAP = "30 minutes"
IDLE_HOURS, HOUR_US = 12, 3_600_000_000


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/mediasift-streams/{name}-{uuid.uuid4().hex}"


def incremental_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Clone-fixture signatures arrive as three id ranges (originals, near
    copies, far copies), each written as its own set of files; the stream
    takes one file per micro-batch, oldest first."""
    sigs = phash_signatures(clone_frames(spark, sf))
    base = _scratch(spark, "incremental")
    source = f"{base}/source"
    bounds = [(None, NEAR_COPY[0]), (NEAR_COPY[0], FAR_COPY[0]), (FAR_COPY[0], None)]
    for lo, hi in bounds:
        part = sigs
        if lo is not None:
            part = part.where(F.col("video_id") >= lo)
        if hi is not None:
            part = part.where(F.col("video_id") < hi)
        part.write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    out = run_incremental(spark, source, schema, PHASH, f"{base}/state")
    return out.select("video_id", "primary_id", F.round("score", 6).alias("score"), "is_unique")


def _events(spark: SparkSession, sf: str):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return monitor.event_stream(spark, sf, schema, WATERMARK, "events.parquet")


def _windows(spark: SparkSession, sf: str, agg, group: str) -> DataFrame:
    """Windows that the stream has closed, and from a batch pass those that the watermark still holds open
    when the input ends."""
    closed = monitor.flatten_windows(spark, monitor.run_to_table(agg(_events(spark, sf)), _scratch(spark, "windows")))
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    # written first: an anti-join pushed below a session aggregation would see sessions before they merge
    rest = materialize(monitor.window_columns(agg(events)), "windows").join(closed, ["window_start", group], "left_anti")
    return closed.unionByName(rest.select(*closed.columns))


def stage_rate_windows(spark: SparkSession, sf: str) -> DataFrame:
    agg = lambda ev: monitor.windowed_counts(ev, TUMBLE)
    return _windows(spark, sf, agg, "event_type").select("window_start", "window_end", "event_type", "n",
                                       F.round("latency_sum", 6).alias("latency_sum"))


def stage_sliding_windows(spark: SparkSession, sf: str) -> DataFrame:
    agg = lambda ev: monitor.windowed_counts(ev, SLIDE_LEN, SLIDE_STEP)
    return _windows(spark, sf, agg, "event_type").select("window_start", "window_end", "event_type", "n",
                                       F.round("latency_sum", 6).alias("latency_sum"))


def worker_sessions(spark: SparkSession, sf: str) -> DataFrame:
    agg = lambda ev: monitor.sessions(ev, SESSION_GAP)
    return _windows(spark, sf, agg, "worker").select("window_start", "window_end", "worker", "n")


def stage_backlog(spark: SparkSession, sf: str) -> DataFrame:
    """Users are items, event types their stages, a move to ``error`` is a failure of the stage left. Hourly
    arrivals, departures, failures and backlog; users without an event for 12 hours leave their stage."""
    stream = backlog.stage_moves(_events(spark, sf), IDLE_HOURS * HOUR_US, "user_id", "event_type")
    closed = backlog.run_moves(stream, _scratch(spark, "backlog"))
    events = spark.read.parquet(f"{sf}/events.parquet")
    rest = backlog.open_moves(closed, events, HOUR_US, IDLE_HOURS * HOUR_US, "user_id", "event_type")
    return backlog.backlog_windows(closed.unionByName(rest), 1, F.col("to_stage") == "error")


QUERIES = {
    "incremental_dedup": incremental_dedup,
    "stage_rate_windows": stage_rate_windows,
    "stage_sliding_windows": stage_sliding_windows,
    "worker_sessions": worker_sessions,
    "stage_backlog": stage_backlog,
}

ORACLE = {
    "incremental_dedup": DEDUP_ORACLE["phash_leaders"],
    "stage_rate_windows": f"""SELECT * FROM (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
         event_type, count(*) AS n, round(sum(value), 6) AS latency_sum
  FROM events GROUP BY 1, 2, 3)""",
    "stage_sliding_windows": f"""SELECT * FROM (
  SELECT s AS window_start, s + INTERVAL 2 HOUR AS window_end, event_type, count(*) AS n,
         round(sum(value), 6) AS latency_sum
  FROM (SELECT event_type, value, unnest([date_trunc('hour', ts) - INTERVAL 1 HOUR, date_trunc('hour', ts)]) AS s
        FROM events)
  GROUP BY 1, 2, 3)""",
    "worker_sessions": f"""WITH o AS (
  SELECT user_id AS worker, ts,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                   OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE
              THEN 1 ELSE 0 END AS brk
  FROM events),
s AS (SELECT *, sum(brk) OVER (PARTITION BY worker ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
      FROM o)
SELECT * FROM (
  SELECT min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, worker, count(*) AS n
  FROM s GROUP BY worker, sid)""",
    "stage_backlog": f"""WITH e AS (
  SELECT ts, event_type, lag(event_type) OVER w AS prev, lag(ts) OVER w AS prev_ts, lead(ts) OVER w AS next_ts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
m AS (
  SELECT ts, CASE WHEN ts <= prev_ts + INTERVAL {IDLE_HOURS} HOUR THEN prev END AS src, event_type AS dst FROM e
  UNION ALL
  SELECT ts + INTERVAL {IDLE_HOURS} HOUR, event_type, NULL FROM e
  WHERE (next_ts IS NULL OR next_ts > ts + INTERVAL {IDLE_HOURS} HOUR)
    AND ts + INTERVAL {IDLE_HOURS} HOUR <= (SELECT max(ts) FROM events)),
c AS (
  SELECT ts, dst AS stage, 1 AS came, 0 AS gone, 0 AS bad FROM m WHERE src IS DISTINCT FROM dst AND dst IS NOT NULL
  UNION ALL
  SELECT ts, src, 0, 1, CASE WHEN dst = 'error' THEN 1 ELSE 0 END FROM m
  WHERE src IS DISTINCT FROM dst AND src IS NOT NULL),
p AS (SELECT date_trunc('hour', ts) AS window_start, stage, sum(came) AS came, sum(gone) AS gone, sum(bad) AS failed
      FROM c GROUP BY 1, 2)
SELECT window_start, stage, came::BIGINT AS came, gone::BIGINT AS gone, failed::BIGINT AS failed,
       CASE WHEN gone > 0 THEN round(failed / gone, 6) END AS error_rate,
       (sum(came - gone) OVER (PARTITION BY stage ORDER BY window_start))::BIGINT AS backlog
FROM p""",
}
