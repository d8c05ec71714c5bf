"""Stage moves of items from an event stream, with keyed state and event-time timers.

An item is in the stage of its latest event. Events may arrive out of order and more than once: repeats of an event
id inside the watermark are dropped, and an item's events wait in its state until the watermark has passed them, so
that moves come out in event time. An item without an event for ``idle`` leaves its stage at that moment and its
state goes, so state is bounded by the items active within ``idle``.

Of one item at most ``ROUND`` waiting events are in memory: more are read in several passes, in order.

Moves: (item, ts, event_id, from_stage, to_stage). An item's first event (or first after an idle end) has no
``from_stage``; an idle end has no ``to_stage`` and no ``event_id``. Ties in time go by event id. Events without a
time never pass the watermark and are left out; events of a null item belong to one item; a null stage is no stage
(the item is in none). Events older than the watermark are dropped, as in every watermarked query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from mediasift.functions.timecols import epoch_micros

ROUND = 100_000
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
MOVES = "item long, ts timestamp, event_id long, from_stage string, to_stage string"


def _ceil_ms(micros: int) -> int:
    return -(-micros // 1000)


class StageMoves(StatefulProcessor):
    """One item: its waiting events in two lists (one in use), and (stage, time, alarm, list in use)."""

    def __init__(self, idle_us: int, round_size: int = ROUND):
        self.idle_us = idle_us
        self.round_size = round_size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = [handle.getListState(f"waiting{i}", "us long, event_id long, stage string") for i in (0, 1)]
        self.at = handle.getValueState("at", "stage string, us long, alarm long, used int")

    def _alarm(self, old: int | None, target: int | None) -> None:
        if old == target:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if target is not None:
            self.handle.registerTimer(target)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stage, us, alarm, used = self.at.get() if self.at.exists() else (None, None, None, 0)
        first = None
        for pdf in rows:
            new = [(int(u), None if pd.isna(e) else int(e), None if pd.isna(s) else s)
                   for u, e, s in zip(pdf["us"], pdf["event_id"], pdf["stage"])]
            if new:
                self.waiting[used].appendList(new)
                low = min(n[0] for n in new)
                first = low if first is None else min(first, low)
        if first is not None:
            target = _ceil_ms(first) if alarm is None else min(alarm, _ceil_ms(first))
            self._alarm(alarm, target)
            self.at.update((stage, us, target, used))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.at.exists():
            return
        stage, us, alarm, used = self.at.get()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        if fired != alarm:
            return  # replaced by an earlier one that has done this work
        now = timerValues.getCurrentWatermarkInMs() * 1000
        item = key[0]
        done = None
        while True:  # rounds in order of (time, id); one for all but huge items
            ready = (((u, e is not None, e or 0), s) for u, e, s in self.waiting[used].get() if u <= now)
            part = heapq.nsmallest(self.round_size, (r for r in ready if done is None or r[0] > done), key=lambda r: r[0])
            if not part:
                break
            out = []
            for (u, has_id, e), s in part:
                if us is not None and u > us + self.idle_us:
                    if stage is not None:
                        out.append((item, us + self.idle_us, None, stage, None))
                    stage = None
                out.append((item, u, e if has_id else None, stage, s))
                stage, us = s, u
            done = part[-1][0]
            yield self._frame(out)
            if len(part) < self.round_size:
                break
        if us is not None and us + self.idle_us <= now:
            if stage is not None:
                yield self._frame([(item, us + self.idle_us, None, stage, None)])
            stage = us = None
        other, rest, low = self.waiting[1 - used], [], None
        for w in self.waiting[used].get():
            if w[0] > now:
                low = w[0] if low is None else min(low, w[0])
                rest.append(tuple(w))
                if len(rest) == 1000:
                    other.appendList(rest)
                    rest = []
        if rest:
            other.appendList(rest)
        self.waiting[used].clear()
        ends = [_ceil_ms(t) for t in (low, None if us is None else us + self.idle_us) if t is not None]
        if ends:
            target = min(ends)
            self.handle.registerTimer(target)
            self.at.update((stage, us, target, 1 - used))
        else:
            self.at.clear()

    @staticmethod
    def _frame(moves: list) -> pd.DataFrame:
        pdf = pd.DataFrame(moves, columns=["item", "ts", "event_id", "from_stage", "to_stage"])
        pdf["ts"] = pd.to_datetime(pdf["ts"], unit="us")
        return pdf.astype({"item": "Int64", "event_id": "Int64"})

    def close(self) -> None:
        pass


def stage_moves(events: DataFrame, idle_us: int, item: str, stage: str, event_id: str = "event_id",
                round_size: int = ROUND) -> DataFrame:
    """Moves of a watermarked stream of events (time column ``ts``)."""
    once = events.dropDuplicatesWithinWatermark([event_id])
    cols = once.select(F.col(item).cast("long").alias("item"), "ts", F.unix_micros("ts").alias("us"),
                       F.col(event_id).cast("long").alias("event_id"), F.col(stage).cast("string").alias("stage"))
    return cols.groupBy("item").transformWithStateInPandas(StageMoves(idle_us, round_size), MOVES, "append", "eventTime")


@contextmanager
def _state_provider(spark: SparkSession):
    """Timers and lists in state need this provider; a query keeps that with which it started."""
    old = spark.conf.get(_PROVIDER_KEY)
    spark.conf.set(_PROVIDER_KEY, STATE_PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER_KEY, old)


def run_moves(moves: DataFrame, out_dir: str) -> DataFrame:
    """Run the stream on the input at hand and return all moves so far. ``out_dir`` is a shared folder; run again
    with the same folder, the stream goes on where it stopped. A batch replaces its own output when it is replayed."""
    spark = moves.sparkSession
    path = f"{out_dir.rstrip('/')}/moves"

    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    with _state_provider(spark):
        q = (moves.writeStream.outputMode("append").foreachBatch(sink)
             .option("checkpointLocation", f"{out_dir.rstrip('/')}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(MOVES).parquet(path).select("item", "ts", "event_id", "from_stage", "to_stage")


def open_moves(moves: DataFrame, events: DataFrame, delay_us: int, idle_us: int, item: str, stage: str,
               event_id: str = "event_id", ts: str = "ts") -> DataFrame:
    """Moves up to the latest event that the watermark still holds back when the input ends.

    Only events inside the watermark's delay are read; each item goes on from its last streamed move.
    """
    end = events.agg(F.max(epoch_micros(ts)).alias("end"), F.max(ts).alias("ts")).first()
    if end["end"] is None:
        return moves.limit(0)
    last = (moves.groupBy("item").agg(F.max(F.struct(F.unix_micros("ts").alias("us"), F.col("to_stage").isNull().alias("gone"),
                                                     "event_id", F.col("to_stage").alias("stage"))).alias("m"))
            .select("item", "m.*"))
    late = end["ts"] - pd.Timedelta(microseconds=delay_us + 1000).to_pytimedelta()  # the watermark counts in milliseconds
    tail = (events.where(F.col(ts) >= F.lit(late)).dropDuplicates([event_id])
            .select(F.col(item).cast("long").alias("item"), epoch_micros(ts).alias("us"),
                    F.col(event_id).cast("long").alias("event_id"), F.col(stage).cast("string").alias("stage")))
    seen = last.select(F.col("item").alias("i"), F.col("us").alias("u"), F.col("event_id").alias("e"))
    fresh = (tail.join(seen, tail["item"].eqNullSafe(seen["i"]), "left")
             .where(F.col("u").isNull() | (F.col("us") > F.col("u"))
                    | ((F.col("us") == F.col("u")) & (F.col("event_id") > F.col("e"))))
             .select("item", "us", "event_id", "stage", F.lit(True).alias("new")))
    known = last.where(~F.col("gone")).select("item", "us", "event_id", "stage", F.lit(False).alias("new"))
    w = Window.partitionBy("item").orderBy("us", "event_id")
    chain = fresh.unionByName(known).select(
        "*", F.lag("stage").over(w).alias("before"), F.lag("us").over(w).alias("before_us"), F.lead("us").over(w).alias("next_us"))
    steps = chain.where("new").select(
        "item", "us", "event_id", F.when(F.col("us") <= F.col("before_us") + idle_us, F.col("before")).alias("from_stage"),
        F.col("stage").alias("to_stage"))
    ends = chain.where(F.col("stage").isNotNull() & (F.col("us") + idle_us <= F.lit(end["end"]))
                       & (F.col("next_us").isNull() | (F.col("next_us") > F.col("us") + idle_us))).select(
        "item", (F.col("us") + idle_us).alias("us"), F.lit(None).cast("long").alias("event_id"),
        F.col("stage").alias("from_stage"), F.lit(None).cast("string").alias("to_stage"))
    return steps.unionByName(ends).select("item", F.timestamp_micros("us").alias("ts"), "event_id", "from_stage", "to_stage")


def backlog_windows(moves: DataFrame, hours: int, failed: Column) -> DataFrame:
    """By window and stage: items that came, left, failed (``failed``: a condition on a move out of the stage), and
    the items in the stage at the window's end. The running sum is over one row per window and stage."""
    both = moves.where(~F.col("from_stage").eqNullSafe(F.col("to_stage")))
    change = both.select("ts", F.explode(F.array(
        F.struct(F.col("to_stage").alias("stage"), F.lit(1).alias("came"), F.lit(0).alias("gone"), F.lit(0).alias("bad")),
        F.struct(F.col("from_stage").alias("stage"), F.lit(0).alias("came"), F.lit(1).alias("gone"),
                 failed.cast("int").alias("bad")))).alias("c")).where("c.stage IS NOT NULL")
    per = (change.groupBy(F.window("ts", f"{hours} hours").alias("w"), F.col("c.stage").alias("stage"))
           .agg(F.sum("c.came").alias("came"), F.sum("c.gone").alias("gone"),
                F.sum(F.coalesce("c.bad", F.lit(0))).alias("failed")))
    run = Window.partitionBy("stage").orderBy("w").rowsBetween(Window.unboundedPreceding, 0)
    return per.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "stage", "came", "gone", "failed",
                      F.round(F.col("failed") / F.when(F.col("gone") > 0, F.col("gone")), 6).alias("error_rate"),
                      F.sum(F.col("came") - F.col("gone")).over(run).alias("backlog"))
