"""Stage moves and backlog against a plain loop: late order, repeats, restarts, replays."""

import datetime as dt
import glob
import os
import random

from mediasift.streaming import backlog, monitor
from pyspark.sql import functions as F

HOUR = 3_600_000_000
T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string"


def _loop(rows, idle_us):
    """Moves by a plain pass over the sorted events of each item."""
    out, by = [], {}
    end = max(r[1] for r in rows)
    idle = dt.timedelta(microseconds=idle_us)
    for e, ts, u, s in set(rows):
        by.setdefault(u, []).append((ts, e, s))
    for u, evs in by.items():
        evs.sort(key=lambda r: r[:2])
        stage = last = None
        for ts, e, s in evs:
            if last is not None and ts > last + idle:
                if stage is not None:
                    out.append((u, last + idle, None, stage, None))
                stage = None
            out.append((u, ts, e, stage, s))
            stage, last = s, ts
        if stage is not None and last + idle <= end:
            out.append((u, last + idle, None, stage, None))
    return sorted(out, key=repr)


def _rows(seed=3, n=400):
    """Times run forward with up to 40 minutes of disorder; a third of the rows belong to item 0."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ts = T0 + dt.timedelta(minutes=10 * i + rnd.randint(-40, 0), microseconds=rnd.randint(0, 999_999))
        user = 0 if i % 3 == 0 else rnd.choice([1, 2, 3, 4, None])
        rows.append((i, ts, user, rnd.choice(["load", "scan", "error", None])))
    return rows


def test_moves_equal_a_loop_over_restarts_and_replay(spark, tmp_path):
    rows = _rows()
    src, state = str(tmp_path / "in"), str(tmp_path / "state")
    parts = [rows[:150], rows[149:151] + rows[150:300] + rows[290:300], rows[300:]]  # some rows come twice
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        stream = monitor.event_stream(spark, src, schema, "1 hour")
        return backlog.run_moves(backlog.stage_moves(stream, 3 * HOUR, "user_id", "event_type", round_size=7), state)

    counts = []
    for part in parts:  # the stream stops after each part and goes on from its state
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        closed = run()
        counts.append(closed.count())
    assert counts[0] < counts[1] < counts[2]

    def whole():
        rest = backlog.open_moves(closed, spark.read.parquet(src), HOUR, 3 * HOUR, "user_id", "event_type")
        assert rest.count() < closed.count() / 10  # only what the watermark holds back
        return sorted((tuple(r) for r in closed.unionByName(rest).collect()), key=repr)

    want = _loop(rows, 3 * HOUR)
    assert whole() == want
    commits = [c for c in glob.glob(f"{state}/checkpoint/commits/*") if os.path.basename(c).isdigit()]
    last = max(commits, key=lambda c: int(os.path.basename(c)))
    os.remove(last)  # as if the driver had died before the commit
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    closed = run()
    assert whole() == want


def test_backlog_counts(spark):
    at = lambda h: T0 + dt.timedelta(hours=h)
    moves = spark.createDataFrame(
        [(1, at(0), 1, None, "load"), (2, at(0), 2, None, "load"), (1, at(1), 3, "load", "scan"),
         (2, at(1), 4, "load", "load"), (2, at(2), 5, "load", "error"), (1, at(2), None, "scan", None),
         (3, at(2), 6, None, None)], backlog.MOVES)
    got = {(r["stage"], r["window_start"].hour): (r["came"], r["gone"], r["failed"], r["error_rate"], r["backlog"])
           for r in backlog.backlog_windows(moves, 1, F.col("to_stage") == "error").collect()}
    assert got == {("load", 0): (2, 0, 0, None, 2), ("load", 1): (0, 1, 0, 0.0, 1), ("scan", 1): (1, 0, 0, None, 1),
                   ("load", 2): (0, 1, 1, 1.0, 0), ("scan", 2): (0, 1, 0, 0.0, 0), ("error", 2): (1, 0, 0, None, 1)}


def test_empty_input(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([], SCHEMA).write.parquet(src)
    stream = monitor.event_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, "1 hour")
    closed = backlog.run_moves(backlog.stage_moves(stream, HOUR, "user_id", "event_type"), str(tmp_path / "state"))
    rest = backlog.open_moves(closed, spark.read.parquet(src), HOUR, HOUR, "user_id", "event_type")
    assert backlog.backlog_windows(closed.unionByName(rest), 1, F.col("to_stage") == "error").count() == 0
