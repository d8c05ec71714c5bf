"""Operational tables: stage counts and throughput (A5, A6, P1), resume (D19),
stale labels (D20), review routing and human corrections (D18, D27),
label distributions with rollup (D26)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the event type that marks completion of an item.
COMPLETED = "purchase"


def stage_counts(events: DataFrame, stage_col: str = "event_type", ts_col: str = "ts",
                 worker_col: str = "user_id", latency_col: str = "value") -> DataFrame:
    """Per stage: n, workers, mean latency, share of all events and rate per hour."""
    per = events.groupBy(stage_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(worker_col).alias("workers"),
        F.avg(latency_col).alias("mean_latency"),
        F.min(ts_col).alias("t0"), F.max(ts_col).alias("t1"))
    total = events.count()  # one scalar; the shares divide by it
    per = per.withColumn("total", F.lit(total))
    span_h = (F.unix_micros(F.col("t1").cast("timestamp")) - F.unix_micros(F.col("t0").cast("timestamp"))) / 3.6e9
    return (per
            .select(F.col(stage_col).alias("event_type"), "n", "workers",
                    F.round("mean_latency", 6).alias("mean_latency"),
                    F.round(F.col("n") / F.col("total"), 6).alias("share"),
                    F.round(F.when(span_h > 0, F.col("n") / span_h), 6).alias("rate_per_hour")))


def latest_status(log: DataFrame, key: str, status_col: str, ts_col: str) -> DataFrame:
    """(key, status, ts) of the latest log row per key (ties: larger status text)."""
    return (log.groupBy(key).agg(F.max(F.struct(ts_col, status_col)).alias("m"))
            .select(key, F.col(f"m.{status_col}").alias("status"), F.col(f"m.{ts_col}").alias("ts")))


def resume_pending(items: DataFrame, log: DataFrame, key: str, status_col: str = "status",
                   ts_col: str = "ts", done: str = COMPLETED) -> DataFrame:
    """Items whose latest logged status is not ``done`` (or never logged)."""
    finished = latest_status(log, key, status_col, ts_col).where(F.col("status") == done).select(key)
    return items.select(key).join(finished, key, "left_anti")


def stale_labels(labels: DataFrame, version_col: str, target: int, key: str = "doc_id",
                 items: DataFrame | None = None) -> DataFrame:
    """Keys to label again: version below ``target`` or unknown; with ``items`` also those that were never labelled."""
    old = labels.where(F.coalesce(F.col(version_col) < target, F.lit(True))).select(key)
    return old if items is None else old.unionByName(items.select(key).join(labels.select(key), key, "left_anti"))


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``order``, kept as a running top list per task."""
    return df.orderBy(*order).limit(n)


def review_routing(preds: DataFrame, human: DataFrame, key: str, pred_col: str, conf_col: str,
                   human_col: str, min_conf: float) -> DataFrame:
    """Route every item: human label wins ('human' or 'corrected' when it differs
    from the model, or the model has no prediction); otherwise low confidence goes
    to 'review', the rest 'auto'. Items that only a human labelled are kept."""
    j = preds.join(human.select(key, F.col(human_col).alias("_h")), key, "full")
    route = (F.when(F.col("_h").isNotNull() & (F.col("_h") != F.col(pred_col)), "corrected")
             .when(F.col("_h").isNotNull(), "human")
             .when(F.col(conf_col) < min_conf, "review")
             .otherwise("auto"))
    return j.select(key, route.alias("route"),
                    F.when(F.col("_h").isNotNull(), F.col("_h"))
                    .when(F.col(conf_col) >= min_conf, F.col(pred_col)).alias("final_quality"))


def stable_sample(key_col: str, percent: int) -> Column:
    """Reproducible sample membership by the first 32 bits of the key's MD5 (any key, no overflow)."""
    digest = F.conv(F.substring(F.md5(F.col(key_col).cast("string")), 1, 8), 16, 10).cast("bigint")
    return digest % 100 < percent


def least_hashed(df: DataFrame, id_col: str, limit: int) -> DataFrame:
    """The ``limit`` rows with the least hash of the id (ties by the id).

    The sort is of a cut of the hash that a few more rows pass; over the whole table each of its tasks
    would send ``limit`` rows to the driver.
    """
    n, h = df.count(), F.xxhash64(id_col)
    share, some = 1.5 * limit / n if n else 1.0, df
    while share < 1:
        some = df.where(h <= int(-2**63 + share * 2**64))
        if some.count() >= limit:
            break
        share, some = 2 * share, df  # few different ids
    return some.orderBy(h, id_col).limit(limit)


def label_rollup(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and quality rate by (lang, source) with ROLLUP subtotals."""
    j = docs.select(key, "lang", "source").join(labels.select(key, "quality", "toxic"), key, "left")
    return (j.rollup("lang", "source")
            .agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("labeled"),
                 F.round(F.avg("quality").cast("double"), 6).alias("quality_rate"),
                 F.round(F.avg("toxic").cast("double"), 6).alias("toxic_rate")))


def label_cube(docs: DataFrame, labels: DataFrame, key: str = "doc_id", chars: str = "n_chars") -> DataFrame:
    """Counts, rates and length distribution by every subset of (lang, source).

    ``level`` is the grouping id (0: both columns, 1: lang, 2: source, 3: all rows), which tells a subtotal row from
    a null key. Lengths are counts by power of ten, so cubes of parts add up to the cube of the whole. Labels must be
    one row per key; rows without a label or a length count in ``n`` only. All aggregates are partial before the shuffle.
    """
    j = docs.select(key, "lang", "source", F.col(chars).alias("_len")).join(labels.select(key, "quality", "toxic"), key, "left")
    size = F.col("_len")
    return (j.cube("lang", "source")
            .agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n"), F.count("quality").alias("labeled"),
                 F.round(F.avg("quality").cast("double"), 6).alias("quality_rate"),
                 F.round(F.avg("toxic").cast("double"), 6).alias("toxic_rate"),
                 F.min(size).cast("long").alias("min_chars"), F.max(size).cast("long").alias("max_chars"),
                 F.count_if(size < 100).alias("below_100"), F.count_if((size >= 100) & (size < 1000)).alias("below_1000"),
                 F.count_if((size >= 1000) & (size < 10000)).alias("below_10000"),
                 F.count_if(size >= 10000).alias("from_10000")))


# Sketches: numbers kept by a quantile sketch (exact up to as many rows; a rank is off by about 2 / K, with
# certainty 99 %), and 2^bits registers of a distinct sketch (standard error 1.04 / sqrt(2^bits), 0.8 %).
QUANTILE_K, DISTINCT_BITS = 4096, 14


def value_sketches(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Per group: n, quantile sketch and distinct sketch of ``value`` as binary columns (D11). Sketches of parts, days
    or sources can be stored and merged; null values count in ``n`` only. Partial before the shuffle."""
    v = F.col(value).cast("long")
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint(v, QUANTILE_K).alias("quantiles"),
                                   F.hll_sketch_agg(v, DISTINCT_BITS).alias("distinct"))


def sketch_cube(sketches: DataFrame, groups: list[str], shares: dict[str, float]) -> DataFrame:
    """Sketches merged over every subset of ``groups`` (``level``: grouping id), and what they say: n, number of
    distinct values, and the value at each share of the rows (``shares``: column name to share)."""
    merged = sketches.cube(*groups).agg(
        F.grouping_id().cast("int").alias("level"), F.sum("n").alias("n"),
        F.kll_merge_agg_bigint("quantiles", QUANTILE_K).alias("q"), F.hll_union_agg("distinct").alias("d"))
    some = F.kll_sketch_get_n_bigint("q") > 0
    return merged.select(*groups, "level", "n", F.hll_sketch_estimate("d").alias("distinct_values"),
                         *[F.when(some, F.kll_sketch_get_quantile_bigint("q", F.lit(s))).alias(c) for c, s in shares.items()])
