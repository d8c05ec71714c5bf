"""Derived inputs built from the given tables with Spark expressions.

The test data has no media, frame, probe, detection or score tables, so each is
derived deterministically from ids of an existing table; the oracle SQL uses the
same expressions. All work grows with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasift.functions.bits import sign_hash
from mediasift.sources.tables import table

# Fixed values of the clone fixture: id offset, number of leading hash bits
# flipped, and amount added to vector dimension 0, for the near and far copy.
FRAMES_PER_VIDEO = 5
CLONE_EVERY = 10
NEAR_COPY = (1000000, 2, 0.25)
FAR_COPY = (2000000, 6, 0.5)


def original_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of the original videos: 5 consecutive embeddings per video.

    Columns: video_id, frame_idx, hash BIGINT (sign bits of the first 64 dims),
    embedding ARRAY<DOUBLE>.
    """
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return emb.select(
        F.expr(f"vec_id div {FRAMES_PER_VIDEO}").alias("video_id"),
        F.expr(f"cast(vec_id % {FRAMES_PER_VIDEO} as int)").alias("frame_idx"),
        sign_hash("embedding").alias("hash"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


def _copy(frames: DataFrame, offset: int, flip_bits: int, shift: float) -> DataFrame:
    mask = (1 << flip_bits) - 1
    return frames.select(
        (F.col("video_id") + F.lit(offset)).alias("video_id"),
        "frame_idx",
        F.col("hash").bitwiseXOR(F.lit(mask).cast("long")).alias("hash"),
        F.transform("embedding", lambda x, i: F.when(i == 0, x + F.lit(shift)).otherwise(x)).alias("embedding"),
    )


def clone_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Originals plus a near and a far copy of every 10th video (all frames)."""
    orig = original_frames(spark, sf_dir)
    picked = orig.where(F.col("video_id") % CLONE_EVERY == 0)
    return (orig.unionByName(_copy(picked, *NEAR_COPY))
                .unionByName(_copy(picked, *FAR_COPY)))


# Fixed values of the image fixture: side of a frame, frames that are missing, frames that can't be read.
IMAGE_SIDE = 64


def image_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, n_frames) of ``clone_frames``."""
    return clone_frames(spark, sf_dir).select("video_id").distinct().withColumn("n_frames", F.lit(FRAMES_PER_VIDEO))


def image_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, frame_idx, luma): 64 x 64 pixels from products of a frame's first 64 components; some frames are
    missing, some have no pixels."""
    pixels = F.expr(f"""transform(sequence(0, {IMAGE_SIDE * IMAGE_SIDE - 1}), p -> cast(greatest(0, least(255, floor(
        128 + 2000 * embedding[p div {IMAGE_SIDE}] * embedding[(3 * (p % {IMAGE_SIDE}) + 7) % {IMAGE_SIDE}]))) as int))""")
    f = clone_frames(spark, sf_dir).where((F.col("video_id") + F.col("frame_idx")) % 17 != 5)
    broken = (F.col("video_id") % 23 == 4) & (F.col("frame_idx") == 2)
    return f.select("video_id", "frame_idx", F.when(~broken, pixels).alias("luma"))


def phash_signatures(frames: DataFrame) -> DataFrame:
    """One row per video: hashes ordered by frame index.

    The list per video is bounded by the number of sampled frames.
    """
    return (frames.groupBy("video_id")
            .agg(F.array_sort(F.collect_list(F.struct("frame_idx", "hash"))).alias("fs"))
            .select("video_id", F.transform("fs", lambda s: s["hash"]).alias("hashes")))


def embedding_signatures(frames: DataFrame) -> DataFrame:
    """One row per video: frame vectors ordered by frame index (ARRAY<ARRAY<DOUBLE>>)."""
    return (frames.groupBy("video_id")
            .agg(F.array_sort(F.collect_list(F.struct("frame_idx", "embedding"))).alias("fs"))
            .select("video_id", F.transform("fs", lambda s: s["embedding"]).alias("frames")))


# ---------------------------------------------------------------------------
# Model-output and media tables derived from the TPC-H-like and event tables.
# Fixed mapping values (label names, codec list, stream rules) are stated here.
# ---------------------------------------------------------------------------

DETECTION_LABELS = {"A": "person", "N": "car", "R": "dog"}
VIDEO_CODECS = ["h264", "hevc", "vp9"]
FORMAT_NAME = "mov,mp4,m4a,3gp,3g2,mj2"
FRAME_RATES = ["30000/1001", "25/1", "0/0", "24/1"]  # index 4 = missing
LANG_TOKENS = ["<|en|>", "<|fr|>", "de", "<|es|>", "<|de|>"]


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, frame_idx, label, score): one detection per lineitem row."""
    li = table(spark, sf_dir, "lineitem")
    label = F.create_map(*[x for kv in DETECTION_LABELS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return li.select(F.col("l_orderkey").alias("video_id"),
                     F.expr("cast((l_linenumber - 1) div 3 as int)").alias("frame_idx"),
                     label[F.col("l_returnflag")].alias("label"),
                     (F.col("l_discount") * 10).alias("score"))


def audio_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, label, logit): every event is one time step of a class logit."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("video_id"), F.col("event_type").alias("label"),
                     (F.col("value") / 50.0).alias("logit"))


def probe_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, path, probe_json) built from orders; some lack a video or audio
    stream, a frame rate, a stream duration, and some documents are truncated."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    width = (F.lit(160) + (c % 10) * 80).cast("int")
    rate = F.try_element_at(F.array(*[F.lit(r) for r in FRAME_RATES]), (k % 5 + 1).cast("int"))
    dur = ((k % 600) / 8.0).cast("string")
    null_s, null_i = F.lit(None).cast("string"), F.lit(None).cast("int")

    def stream(kind, codec, w, h, fps, duration, bit_rate, channels, sample_rate):
        return F.struct(F.lit(kind).alias("codec_type"), codec.alias("codec_name"), w.alias("width"),
                        h.alias("height"), fps.alias("avg_frame_rate"), duration.alias("duration"),
                        bit_rate.alias("bit_rate"), channels.alias("channels"), sample_rate.alias("sample_rate"))

    video = stream("video",
                   F.element_at(F.array(*[F.lit(x) for x in VIDEO_CODECS]), (c % 3 + 1).cast("int")),
                   width, F.expr("cast((160 + (o_custkey % 10) * 80) * 9 div 16 as int)"), rate,
                   F.when(k % 3 != 0, dur), F.floor(F.col("o_totalprice") * 10).cast("string"), null_i, null_s)
    audio = stream("audio", F.lit("aac"), null_i, null_i, null_s, null_s,
                   F.when(k % 7 != 0, F.lit("128000")), (c % 2 + 1).cast("int"),
                   F.when(k % 2 == 0, "44100").otherwise("48000"))
    streams = F.filter(F.array(F.when(k % 4 != 0, audio), F.when(k % 13 != 0, video)), lambda s: s.isNotNull())
    fmt = F.struct(F.lit(FORMAT_NAME).alias("format_name"), dur.alias("duration"),
                   F.floor(F.col("o_totalprice") * 100).cast("string").alias("size"))
    doc = F.to_json(F.struct(streams.alias("streams"), fmt.alias("format")))
    doc = F.when(k % 101 == 7, F.substring(doc, 1, 20)).otherwise(doc)
    return o.select(k.alias("video_id"), F.format_string("/corpus/%d/clip_%d.mp4", c % 20, k).alias("path"),
                    doc.alias("probe_json"))


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, lang_token, text): one recognised segment per turn."""
    cv = table(spark, sf_dir, "conversations")
    tok = F.element_at(F.array(*[F.lit(t) for t in LANG_TOKENS]), (F.col("conv_id") % 5 + 1).cast("int"))
    return cv.select("conv_id", "turn", tok.alias("lang_token"), "text")


def doc_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, n_frames) with n_frames = n_chars mod 120 (0 to 119)."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("video_id"), (F.col("n_chars") % 120).cast("int").alias("n_frames"))


def doc_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, frame_idx, luma, hash): frames of ``doc_videos`` with some
    indices missing, dark videos (id % 9 = 0) and static ones (id % 5 = 0)."""
    v = doc_videos(spark, sf_dir).where(F.col("n_frames") > 0)
    f = v.select("video_id", F.explode(F.sequence(F.lit(0), F.col("n_frames") - 1)).alias("frame_idx"))
    f = f.where((F.col("video_id") + F.col("frame_idx")) % 17 != 5)
    luma = F.when(F.col("video_id") % 9 == 0, F.col("frame_idx") % 8) \
            .otherwise((F.col("video_id") * 31 + F.col("frame_idx") * 7) % 256)
    hsh = F.when(F.col("video_id") % 5 == 0, F.col("video_id")) \
           .otherwise(F.col("video_id") * 1000 + F.col("frame_idx"))
    return f.select("video_id", "frame_idx", luma.cast("double").alias("luma"), hsh.cast("long").alias("hash"))


def embedding_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, frame_idx, embedding, label) of the original videos."""
    return table(spark, sf_dir, "embeddings").select(
        F.expr(f"vec_id div {FRAMES_PER_VIDEO}").alias("video_id"),
        F.expr(f"cast(vec_id % {FRAMES_PER_VIDEO} as int)").alias("frame_idx"), "embedding", "label")
