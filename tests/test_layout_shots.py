"""Clustered layout (files pruned by ranges) and shots of videos spread over many tasks."""

import random

from mediasift.operators import frames as fr
from mediasift.sources import layout
from pyspark.sql import functions as F


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ranges_on_two_columns_read_under_a_fifth_of_the_files(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(i, 7 if i % 3 == 0 else rnd.randint(0, 5000), None if i % 50 == 1 else rnd.random() ** 3 * 1000, f"s{i}")
            for i in range(20000)]  # a third of the rows share one value of a
    df = spark.createDataFrame(rows, "id long, a int, b double, s string")
    path = str(tmp_path / "t")
    layout.write_clustered(df, path, ["a", "b"], 100)
    ranges = layout.file_ranges(spark, path, ["a", "b"])
    assert ranges.agg(F.sum("rows")).first()[0] == 20000 and spark.read.parquet(path).columns == df.columns
    n_files = ranges.count()
    assert n_files >= 90 and ranges.agg(F.max("rows")).first()[0] < 20000 / 20
    for where in ({"a": (1000, 1400)}, {"b": (400.0, 500.0)}, {"a": (7, 7), "b": (100.0, 130.0)}, {"a": (3000, None), "b": (None, 1.0)}):
        got = _rows(layout.read_where(spark, path, ranges, where))
        inside = lambda v, lo, hi: v is not None and (lo is None or v >= lo) and (hi is None or v <= hi)
        assert got == sorted((r for r in rows if all(inside(r[1 if c == "a" else 2], *w) for c, w in where.items())), key=repr)
        if len(where) == 2:
            assert len(layout.files_for(ranges, where)) < n_files / 5
    assert layout.read_where(spark, path, ranges, {"a": (9000, None)}).count() == 0


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "a int, b double")
    layout.write_clustered(df, str(tmp_path / "e"), ["a", "b"], 4)
    ranges = layout.file_ranges(spark, str(tmp_path / "e"), ["a", "b"])
    assert layout.read_where(spark, str(tmp_path / "e"), ranges, {"a": (0, 1)}).count() == 0


def test_blocks_equal_the_plain_scan(spark):
    rnd = random.Random(2)
    rows = [(v, i, [rnd.gauss(0, 1) for _ in range(4)] if (v, i) not in {(1, 40), (1, 63), (1, 64)} else None)
            for v, n in ((1, 500), (2, 3), (None, 130)) for i in range(n) if not (v == 1 and 100 <= i < 300)]  # empty blocks
    rows += [(3, i, [1.0, 0.0]) for i in range(200)]  # one shot over many blocks
    df = spark.createDataFrame(rows, "video_id long, frame_idx int, embedding array<double>")
    want = _rows(fr.shot_segments(df, 0.1).select("video_id", "segment", "first_frame", "last_frame", "frames"))
    for block in (1, 32, 1000):
        got = fr.shot_segments_in_blocks(df, 0.1, block=block).select("video_id", "segment", "first_frame", "last_frame", "frames")
        assert _rows(got) == want
    assert fr.shot_segments_in_blocks(df.limit(0), 0.1).count() == 0
