"""Stage monitoring over an event stream.

Events are (event_id, ts, worker, stage, latency). The stream is read from
files, ``ts`` is cast from TIMESTAMP_NTZ to TIMESTAMP (``withWatermark`` needs
it), a watermark bounds state, and windowed counts are emitted in append mode:
a window appears once the watermark passes its end, so late rows older than
the watermark are dropped and the last open windows are not emitted.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def event_stream(spark: SparkSession, path: str, schema: T.StructType, watermark: str,
                 file_glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """``path`` is a folder of event files; ``file_glob`` keeps only matching names."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    s = r.parquet(path)
    return s.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)


def windowed_counts(events: DataFrame, duration: str, slide: str | None = None,
                    stage_col: str = "event_type", latency_col: str = "value") -> DataFrame:
    w = F.window("ts", duration, slide) if slide else F.window("ts", duration)
    return (events.groupBy(w.alias("w"), F.col(stage_col).alias("event_type"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(latency_col).alias("latency_sum")))


def sessions(events: DataFrame, gap: str, worker_col: str = "user_id") -> DataFrame:
    return (events.groupBy(F.session_window("ts", gap).alias("w"), F.col(worker_col).alias("worker"))
            .agg(F.count(F.lit(1)).alias("n")))


def run_to_table(agg: DataFrame, out_dir: str) -> str:
    """Run an append-mode aggregation until the available input is consumed.

    Each micro-batch is written under ``batch_id=<n>`` with overwrite, so a
    replayed batch after a failure replaces its own output.
    """
    path = os.path.join(out_dir, f"windows-{uuid.uuid4().hex}")

    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    q = (agg.writeStream.outputMode("append").foreachBatch(sink)
         .option("checkpointLocation", path + "_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return path


def flatten_windows(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df if "w" not in df.columns else window_columns(df)


def window_columns(df: DataFrame) -> DataFrame:
    return df.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                     *[c for c in df.columns if c not in ("w", "batch_id")])
