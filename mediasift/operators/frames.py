"""Frame-level operators over a frames table (video_id, frame_idx, ...).

F1 evenly spaced sampling with next-frame fallback, F2 fixed-count sampling for
clip models, F3 representative frame, D7 shot segments, D8 key frames per time
bucket, D9 fixed-length chunks, D10 blank/static flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediasift.functions.timecols import epoch_micros
from mediasift.functions.vectors import cosine
from mediasift.session import materialize

SHOT_BLOCK = 4096  # frame numbers that one task compares in a row


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def _idiv(a: Column, b: Column) -> Column:
    """Integer division of non-negative ints (exact: operands are far below 2^52)."""
    return F.floor(a / b).cast("int")


def sample_indices(n: Column | str, k: int, distinct: bool = True) -> Column:
    """floor(linspace(0, n-1, k)) in integer arithmetic.

    distinct=True (F1): k is cut to n, indices unique ascending, n <= 0 -> [0]
    (try the first frame). distinct=False (F2): exactly k indices with repeats,
    n <= 0 -> empty.
    """
    n = _c(n)
    if distinct:
        kk = F.least(F.lit(k), n)
        seq = F.transform(F.sequence(F.lit(0), kk - 1),
                          lambda i: F.when(kk <= 1, F.lit(0)).otherwise(_idiv(i * (n - 1), kk - 1)))
        return F.when(n <= 0, F.array(F.lit(0))).otherwise(F.array_distinct(seq))
    seq = F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                      lambda i: _idiv(i * (n - 1), F.lit(k - 1)) if k > 1 else F.lit(0))
    return F.when(n <= 0, F.array().cast("array<int>")).otherwise(seq)


def sample_frames(videos: DataFrame, frames: DataFrame, k: int = 5,
                  id_col: str = "video_id", n_col: str = "n_frames") -> DataFrame:
    """(video_id, pos, frame_idx) of the frames read for an even k-sample.

    A missing index falls back to the next frame; if that is missing too the
    position is skipped. ``pos`` is the position among the frames read.
    """
    want = videos.select(F.col(id_col).alias("v"),
                         F.posexplode(sample_indices(n_col, k, True)).alias("p", "i"))
    fr = frames.select(F.col(id_col).alias("v"), F.col("frame_idx").alias("f"))
    f0 = fr.select(F.col("v").alias("v0"), F.col("f").alias("f0"))
    f1 = fr.select(F.col("v").alias("v1"), F.col("f").alias("f1"))
    got = (want.join(f0, (F.col("v") == F.col("v0")) & (F.col("i") == F.col("f0")), "left")
           .join(f1, (F.col("v") == F.col("v1")) & (F.col("i") + 1 == F.col("f1")), "left")
           .select("v", "p", F.coalesce("f0", "f1").alias("frame_idx"))
           .where(F.col("frame_idx").isNotNull()))
    w = Window.partitionBy("v").orderBy("p")
    return got.select(F.col("v").alias(id_col), (F.row_number().over(w) - 1).alias("pos"), "frame_idx")


def action_frames(videos: DataFrame, frames: DataFrame, k: int = 16,
                  id_col: str = "video_id", n_col: str = "n_frames") -> DataFrame:
    """k indices with repeats; a video yields rows only if all k are read."""
    want = videos.select(F.col(id_col).alias("v"),
                         F.posexplode(sample_indices(n_col, k, False)).alias("pos", "frame_idx"))
    fr = frames.select(F.col(id_col).alias("v"), "frame_idx").distinct()
    got = want.join(fr, ["v", "frame_idx"])
    full = got.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") == k).select("v")
    return got.join(full, "v").select(F.col("v").alias(id_col), "pos", "frame_idx")


def representative(samples: DataFrame, id_col: str = "video_id") -> DataFrame:
    """the sampled frame at position len // 2 (0-based)."""
    w = Window.partitionBy(id_col)
    return (samples.withColumn("_n", F.count(F.lit(1)).over(w))
            .where(F.col("pos") == F.floor(F.col("_n") / 2))
            .select(id_col, "pos", "frame_idx"))


def shot_segments(frames: DataFrame, threshold: float, id_col: str = "video_id",
                  vec_col: str = "embedding") -> DataFrame:
    """A new shot starts where the cosine to the previous frame drops below
    ``threshold``. Returns (video_id, segment, first_frame, last_frame, frames);
    the child clip id is (video_id, segment)."""
    w = Window.partitionBy(id_col).orderBy("frame_idx")
    v = F.col(vec_col).cast("array<double>")
    prev = F.lag(v).over(w)
    cut = F.when(prev.isNull(), 0).when(cosine(v, prev) < threshold, 1).otherwise(0)
    seg = frames.withColumn("_cut", cut).withColumn(
        "segment", F.sum("_cut").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (seg.groupBy(id_col, "segment")
            .agg(F.min("frame_idx").alias("first_frame"), F.max("frame_idx").alias("last_frame"),
                 F.count(F.lit(1)).alias("frames")))


def shot_segments_in_blocks(frames: DataFrame, threshold: float, id_col: str = "video_id", vec_col: str = "embedding",
                            block: int = SHOT_BLOCK) -> DataFrame:
    """D7 for videos of any length: as ``shot_segments``, a video spread over many tasks.

    Frames are cut into blocks of frame numbers. A block takes the last vector of the video's block before it, numbers
    its own segments from there, and is then summed up by its cuts; the running sum of cuts over a video's blocks (one
    row a block) turns them into numbers of the whole video. A frame without a vector starts no shot, nor does the
    frame after it. Frame numbers must be distinct in a video; those without a number are left out, a null id is one
    video.
    """
    f = frames.where(F.col("frame_idx").isNotNull()).select(
        F.col(id_col).alias("v"), F.floor(F.col("frame_idx") / block).alias("blk"), F.col("frame_idx").alias("i"),
        F.col(vec_col).cast("array<double>").alias("x"))
    by_video = Window.partitionBy("ev").orderBy("eb")
    ends = (f.groupBy(F.col("v").alias("ev"), F.col("blk").alias("eb")).agg(F.max_by("x", "i").alias("end"))
            .select("ev", "eb", F.lag("end").over(by_video).alias("carry")))
    w = Window.partitionBy("v", "blk").orderBy("i")
    prev = F.when(F.row_number().over(w) == 1, F.col("carry")).otherwise(F.lag("x").over(w))
    joined = f.join(ends, F.col("v").eqNullSafe(F.col("ev")) & (F.col("blk") == F.col("eb")))
    cut = joined.select("v", "blk", "i", F.coalesce((cosine(F.col("x"), prev) < threshold).cast("int"), F.lit(0)).alias("cut"))
    parts = materialize(
        cut.select("v", "blk", "i", F.sum("cut").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("part"))
        .groupBy("v", "blk", "part").agg(F.min("i").alias("lo"), F.max("i").alias("hi"), F.count(F.lit(1)).alias("n")), "shots")
    before = Window.partitionBy("ov").orderBy("ob").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (parts.groupBy(F.col("v").alias("ov"), F.col("blk").alias("ob")).agg(F.max("part").alias("cuts"))
               .select("ov", "ob", F.coalesce(F.sum("cuts").over(before), F.lit(0)).alias("offset")))
    return (parts.join(offsets, F.col("v").eqNullSafe(F.col("ov")) & (F.col("blk") == F.col("ob")))
            .groupBy(F.col("v").alias(id_col), (F.col("offset") + F.col("part")).alias("segment"))
            .agg(F.min("lo").alias("first_frame"), F.max("hi").alias("last_frame"), F.sum("n").alias("frames")))


def keyframes(events: DataFrame, group_col: str, ts_col: str, id_col: str, bucket_seconds: int) -> DataFrame:
    """First row (by time, then id) per group and time bucket."""
    bucket = F.floor(epoch_micros(ts_col) / F.lit(bucket_seconds * 1_000_000)).cast("long")
    return (events.select(group_col, bucket.alias("bucket"), ts_col, id_col)
            .groupBy(group_col, "bucket").agg(F.min(F.struct(ts_col, id_col)).alias("m"))
            .select(group_col, "bucket", F.col(f"m.{id_col}").alias(id_col)))


def chunks(items: DataFrame, id_col: str, duration_col: str, length_s: float) -> DataFrame:
    """Fixed-length chunks [start, end) covering the whole duration."""
    n = F.ceil(F.col(duration_col) / F.lit(length_s)).cast("int")
    return (items.select(id_col, duration_col, F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk"))
            .where(F.col(duration_col) > 0)
            .select(id_col, "chunk", (F.col("chunk") * F.lit(length_s)).alias("start_s"),
                    F.least((F.col("chunk") + 1) * F.lit(length_s), F.col(duration_col)).alias("end_s")))


def frame_flags(frames: DataFrame, blank_luma: float, id_col: str = "video_id",
                luma_col: str = "luma", hash_col: str = "hash") -> DataFrame:
    """blank = mean luma below a level; static = every consecutive frame pair
    has the same hash. Returns (video_id, mean_luma, static_ratio, is_blank, is_static)."""
    w = Window.partitionBy(id_col).orderBy("frame_idx")
    same = F.when(F.lag(hash_col).over(w).isNull(), None).otherwise(
        (F.lag(hash_col).over(w) == F.col(hash_col)).cast("int"))
    f = frames.withColumn("_same", same)
    return (f.groupBy(id_col).agg(F.avg(luma_col).alias("mean_luma"), F.avg("_same").alias("static_ratio"))
            .select(id_col, F.round("mean_luma", 6).alias("mean_luma"),
                    F.round("static_ratio", 6).alias("static_ratio"),
                    (F.col("mean_luma") < blank_luma).alias("is_blank"),
                    F.coalesce(F.col("static_ratio") == 1.0, F.lit(False)).alias("is_static")))
