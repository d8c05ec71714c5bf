"""Technical metadata from probe documents.

Input: (video_id, path, probe_json) where probe_json has ``streams[]`` and
``format{}``. The document is parsed once with ``from_json`` against a fixed
schema; the first video and first audio stream are picked with ``filter`` and
element 0. Data problems become a ``status`` value, never an exception.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STREAM = T.StructType([
    T.StructField("codec_type", T.StringType()),
    T.StructField("codec_name", T.StringType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("avg_frame_rate", T.StringType()),
    T.StructField("duration", T.StringType()),
    T.StructField("bit_rate", T.StringType()),
    T.StructField("channels", T.IntegerType()),
    T.StructField("sample_rate", T.StringType()),
])
PROBE = T.StructType([
    T.StructField("streams", T.ArrayType(STREAM)),
    T.StructField("format", T.StructType([
        T.StructField("format_name", T.StringType()),
        T.StructField("duration", T.StringType()),
        T.StructField("size", T.StringType()),
    ])),
])

# Fixed thresholds of the quality flags.
SHORT_SECONDS = 1.0
LOW_RES_WIDTH = 320


def fraction(text: Column) -> Column:
    """'30000/1001' -> 29.97...; missing -> 0/1 = 0.0; zero denominator -> NULL."""
    t = F.coalesce(text, F.lit("0/1"))
    parts = F.split(t, "/")
    num = F.element_at(parts, 1).try_cast("double")
    den = F.when(F.size(parts) > 1, F.element_at(parts, 2).try_cast("double")).otherwise(F.lit(1.0))
    return F.try_divide(num, F.when(den != 0, den))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _first(streams: Column, kind: str) -> Column:
    """First stream of a kind. ``streams.codec_type`` is a plain field extraction
    and ``array_position`` a codegen'd function: no per-row lambda."""
    pos = F.array_position(streams["codec_type"], kind)
    return F.when(pos > 0, F.element_at(streams, pos.cast("int")))


def extract_metadata(probes: DataFrame, id_col: str = "video_id", path_col: str = "path",
                     json_col: str = "probe_json") -> DataFrame:
    """All probes with a ``status`` ('ok', 'invalid', 'no_video') and the 16 fields.

    Keep ``status = 'ok'`` for the reference behaviour (records without a video
    stream or with an unreadable document are dropped there).
    """
    p = F.from_json(F.col(json_col), PROBE, {"mode": "PERMISSIVE"})
    # Parse once, pick the streams once: each step is its own projection so the
    # (interpreted) higher-order functions are not repeated per output field.
    # explode of a one-element array is a generator: the optimiser cannot inline
    # the parse into every output column, so each document is parsed once.
    base = probes.select(F.col(id_col), F.col(path_col).alias("filepath"), F.explode(F.array(p)).alias("p"))
    base = base.select(id_col, "filepath", F.col("p.format").alias("fmt"),
                       (F.col("p").isNull() | F.col("p.streams").isNull()).alias("_bad"),
                       _first(F.col("p.streams"), "video").alias("v"),
                       _first(F.col("p.streams"), "audio").alias("a"))
    base = base.withColumn("duration_seconds", F.coalesce(
        F.col("v.duration").try_cast("double"), F.col("fmt.duration").try_cast("double"), F.lit(0.0)))
    v, a, fmt = F.col("v"), F.col("a"), F.col("fmt")
    has_a = a.isNotNull()
    width = v["width"]
    duration = F.col("duration_seconds")
    out = base.select(
        F.col(id_col),
        F.when(F.col("_bad"), "invalid").when(v.isNull(), "no_video").otherwise("ok").alias("status"),
        basename(F.col("filepath")).alias("filename"),
        "filepath",
        fmt["format_name"].alias("format_name"),
        duration.alias("duration_seconds"),
        width.alias("width"),
        v["height"].alias("height"),
        fraction(v["avg_frame_rate"]).alias("avg_frame_rate"),
        v["codec_name"].alias("video_codec"),
        F.coalesce(v["bit_rate"].try_cast("bigint"), F.lit(0).cast("bigint")).alias("video_bit_rate"),
        F.when(has_a, a["codec_name"]).alias("audio_codec"),
        F.when(has_a, a["channels"]).alias("audio_channels"),
        F.when(has_a, a["sample_rate"]).alias("audio_sample_rate"),
        F.when(has_a, F.coalesce(a["bit_rate"].try_cast("bigint"), F.lit(0).cast("bigint")))
         .otherwise(F.lit(0).cast("bigint")).alias("audio_bit_rate"),
        F.coalesce(fmt["size"].try_cast("bigint"), F.lit(0).cast("bigint")).alias("file_size_bytes"),
        (duration < SHORT_SECONDS).alias("quality_flag_short"),
        F.coalesce(width < LOW_RES_WIDTH, F.lit(False)).alias("quality_flag_low_res"),
    )
    return out


def shape_features(meta: DataFrame) -> DataFrame:
    """Aspect ratio, 4K flag and a duration bucket."""
    return meta.withColumns({
        "aspect_ratio": F.round(F.try_divide(F.col("width").cast("double"), F.col("height").cast("double")), 6),
        "is_4k": F.coalesce(F.col("width") >= 3840, F.lit(False)),
        "length_bucket": F.when(F.col("duration_seconds") < 10, "<10s")
                          .when(F.col("duration_seconds") < 60, "10-60s").otherwise(">=60s"),
    })
