"""Label reductions from model-output tables.

Model inference stays outside (see ``infer``); these operators reduce the
score tables it produces:

* A3/D12 objects: detections above a confidence, rounded to 2 places, max per label.
* A7/D13 people: presence estimate and a per-frame head-count bucket.
* A4/D14 sound events: mean logit over time, softmax over classes, top 5 above 0.1.
* R1/R2 top action: top-k classes by logit, ties by class name, first kept.
* J7 zero-shot: argmax cosine against a bounded prompt set (ties: lowest index).
* L5 speech: has_speech, language from a ``<|xx|>`` token, trimmed snippet.
* D14/D15 tags over time chunks and the audio-type rule; D16 motion class;
  D17 tone histogram and shot type; S6 flattening of label maps.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediasift.functions.text import EDGE_SPACE
from mediasift.functions.vectors import cosine

# Fixed values from the label functions: detection threshold (strictly above),
# sound-event floor and count, people buckets.
OBJECT_MIN_CONF = 0.7
SOUND_TOP_K = 5
SOUND_MIN_PROB = 0.1
MAX_PROMPTS = 10_000

# The prompt sets of the zero-shot labels, in order (ties: the first).
PROMPT_GROUPS = {
    "scene_type": ["indoors", "outdoors", "cityscape", "landscape", "beach", "forest", "office", "kitchen",
                   "street view", "aerial view"],
    "environment": ["daytime", "nighttime", "urban setting", "natural setting"],
    "visual_style": ["cinematic style", "amateur footage", "animation style", "vlog style", "documentary style",
                     "black and white film", "monochrome colors", "vibrant colors"],
    "mood_estimation": ["calm mood", "energetic mood", "dramatic mood", "neutral mood", "happy mood", "tense mood",
                        "gloomy mood", "warm mood"],
}


def object_labels(detections: DataFrame, id_col: str = "video_id", min_conf: float = OBJECT_MIN_CONF) -> DataFrame:
    """(video_id, label, conf): max rounded confidence per label over all frames."""
    return (detections.where(F.col("score") > min_conf)
            .groupBy(id_col, "label").agg(F.max(F.round("score", 2)).alias("conf")))


def objects_map(objects: DataFrame, id_col: str = "video_id") -> DataFrame:
    """(video_id, ai_objects MAP<label, conf>) with keys in label order."""
    return (objects.groupBy(id_col)
            .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "conf")))).alias("ai_objects")))


def object_keys(objects: DataFrame) -> list[str]:
    """All labels that occur: the model's classes, not a fixed list."""
    return sorted(r.label for r in objects.select("label").distinct().collect() if r.label is not None)


def people_bucket(detections: DataFrame, person: str = "person", min_conf: float = 0.5,
                  id_col: str = "video_id") -> DataFrame:
    """(video_id, max_people, bucket, people_estimate) over all videos with detections.

    max_people is the largest per-frame count of person detections above
    ``min_conf``; people_estimate is '1' when some person detection passes the
    object threshold, else '0'.
    """
    per_frame = (detections.groupBy(id_col, "frame_idx")
                 .agg(F.sum(((F.col("label") == person) & (F.col("score") > min_conf)).cast("int")).alias("c"),
                      F.max(F.when((F.col("label") == person) & (F.col("score") > OBJECT_MIN_CONF),
                                   F.round("score", 2))).alias("pc")))
    per_video = per_frame.groupBy(id_col).agg(F.max("c").alias("max_people"), F.max("pc").alias("person_conf"))
    m = F.col("max_people")
    bucket = (F.when(m == 0, "0").when(m == 1, "1").when(m <= 5, "2-5").when(m <= 9, "6-9").otherwise("10+"))
    return per_video.select(id_col, m.cast("int").alias("max_people"), bucket.alias("bucket"),
                            F.when(F.coalesce(F.col("person_conf"), F.lit(0.0)) > 0, "1").otherwise("0")
                            .alias("people_estimate"))


def sound_events(logits: DataFrame, id_col: str = "video_id", k: int = SOUND_TOP_K,
                 floor: float = SOUND_MIN_PROB) -> DataFrame:
    """(video_id, rank, label, prob, tag) with tag 'label (0.00)'.

    Per video the mean logit of each class is soft-maxed over the classes
    (numerically stable: subtract the max); the class count per video is the
    model's fixed label set, so the window per video is bounded.
    """
    mean = logits.groupBy(id_col, "label").agg(F.avg("logit").alias("m"))
    w = Window.partitionBy(id_col)
    e = mean.withColumn("e", F.exp(F.col("m") - F.max("m").over(w)))
    p = e.withColumn("prob", F.col("e") / F.sum("e").over(w))
    ranked = p.withColumn("rank", F.row_number().over(
        Window.partitionBy(id_col).orderBy(F.col("prob").desc(), F.col("label"))))
    top = ranked.where((F.col("rank") <= k) & (F.col("prob") > floor))
    return top.select(id_col, "rank", "label", F.round("prob", 6).alias("prob"),
                      F.format_string("%s (%.2f)", F.col("label"), F.col("prob")).alias("tag"))


def top_actions(logits: DataFrame, id_col: str = "video_id", k: int = 5) -> DataFrame:
    """(video_id, rank, label, logit, is_action): top-k classes by mean logit; the
    label output keeps rank 1 only (``is_action``), as the reference does."""
    mean = logits.groupBy(id_col, "label").agg(F.avg("logit").alias("logit"))
    w = Window.partitionBy(id_col).orderBy(F.col("logit").desc(), F.col("label"))
    r = mean.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return r.select(id_col, "rank", "label", F.round("logit", 6).alias("logit"),
                    (F.col("rank") == 1).alias("is_action"))


def prompt_literal(prompts: DataFrame, idx_col: str, label_col: str, vec_col: str) -> Column:
    """Bounded prompt set as a literal array (size checked)."""
    n = prompts.count()
    if n > MAX_PROMPTS:
        raise ValueError(f"{n} prompts exceed the bound of {MAX_PROMPTS}")
    rows = prompts.select(idx_col, label_col, vec_col).orderBy(idx_col).collect()
    return F.array(*[F.struct(F.lit(r[idx_col]).alias("i"), F.lit(str(r[label_col])).alias("l"),
                              F.array(*[F.lit(float(x)) for x in r[vec_col]]).alias("v")) for r in rows])


def zero_shot(items: DataFrame, prompts: Column, id_col: str, vec_col: str) -> DataFrame:
    """(id, prompt_label, sim): argmax cosine over the prompts, ties to the lowest index."""
    v = F.col(vec_col).cast("array<double>")
    scored = F.transform(prompts, lambda p: F.struct(F.round(cosine(v, p["v"]), 12).alias("s"),
                                                      (-p["i"]).alias("ni"), p["l"].alias("l")))
    # the generator keeps the scoring from being inlined once per output field
    best = items.select(id_col, F.explode(F.array(F.array_max(scored))).alias("b"))
    return best.select(id_col, F.col("b.l").alias("prompt_label"), F.round(F.col("b.s"), 6).alias("sim"))


def zero_shot_groups(items: DataFrame, prompts: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, one label column per prompt group): the prompt of each group nearest by
    cosine (J7, L4, L7); ties go to the lowest index, a zero vector to the first
    prompt, a NULL vector gives NULL labels.

    ``prompts``: (group, idx, label, embedding), the model's fixed prompt sets
    (at most ``MAX_PROMPTS`` rows). One matrix product per Arrow batch serves
    all groups.
    """
    rows = prompts.select("group", "idx", "label", "embedding").orderBy("group", "idx").limit(MAX_PROMPTS + 1).collect()
    if len(rows) > MAX_PROMPTS:
        raise ValueError(f"prompts exceed the bound of {MAX_PROMPTS}")
    groups = sorted({r["group"] for r in rows})
    names = {g: np.array([r["label"] for r in rows if r["group"] == g], dtype=object) for g in groups}
    units = {g: _unit_rows(np.array([r["embedding"] for r in rows if r["group"] == g], dtype=np.float64)) for g in groups}

    def run(batches):
        for pdf in batches:
            out = {id_col: pdf[id_col]}
            has = pdf[vec_col].notna().to_numpy()
            x = _unit_rows(np.stack(pdf[vec_col][has].to_numpy()).astype(np.float64)) if has.any() else None
            for g in groups:
                best = np.full(len(pdf), None, dtype=object)
                if x is not None:
                    best[has] = names[g][np.argmax(np.round(x @ units[g].T, 12), axis=1)]
                out[g] = best
            yield pd.DataFrame(out)

    schema = f"{id_col} {items.schema[id_col].dataType.simpleString()}, " + ", ".join(f"`{g}` string" for g in groups)
    return items.select(id_col, vec_col).mapInPandas(run, schema)


def _unit_rows(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def speech_record(transcripts: DataFrame, id_cols: list[str], text_col: str = "text",
                  token_col: str = "lang_token") -> DataFrame:
    """(ids..., has_speech, language, transcription_snippet); without speech the last two are NULL."""
    snippet = F.regexp_replace(F.col(text_col), EDGE_SPACE, "")
    has = F.coalesce(F.length(snippet) > 0, F.lit(False))
    tok = F.col(token_col)
    lang = F.when(has & tok.startswith("<") & tok.endswith(">"),
                  F.expr(f"substring({token_col}, 3, length({token_col}) - 4)"))
    return transcripts.select(*id_cols, has.alias("has_speech"), lang.alias("language"),
                              F.when(has, snippet).alias("transcription_snippet"))


def speech_fields(transcripts: DataFrame, id_cols: list[str], text_col: str = "text",
                  token_col: str = "lang_token") -> DataFrame:
    """(ids..., has_speech, language, snippet_chars)."""
    return speech_record(transcripts, id_cols, text_col, token_col).select(
        *id_cols, "has_speech", "language", F.length("transcription_snippet").alias("snippet_chars"))


def motion_class(frames: DataFrame, id_col: str = "video_id", vec_col: str = "embedding",
                 static_below: float = 0.5, slow_below: float = 1.0) -> DataFrame:
    """Mean (1 - cosine) between consecutive frames -> static / slow / fast."""
    w = Window.partitionBy(id_col).orderBy("frame_idx")
    v = F.col(vec_col).cast("array<double>")
    d = frames.withColumn("_d", 1.0 - cosine(v, F.lag(v).over(w)))
    agg = d.groupBy(id_col).agg(F.avg("_d").alias("motion"))
    cls = F.when(F.col("motion").isNull(), "static").when(F.col("motion") < static_below, "static") \
           .when(F.col("motion") < slow_below, "slow").otherwise("fast")
    return agg.select(id_col, F.round("motion", 6).alias("motion"), cls.alias("class"))


def flatten_objects(objects: DataFrame, keys: list[str], id_col: str = "video_id",
                    prefix: str = "ai_objects_") -> DataFrame:
    """One column per map key of ``keys`` (pivot with known values)."""
    return (objects.groupBy(id_col).pivot("label", keys).agg(F.max("conf"))
            .select(id_col, *[F.col(k).alias(prefix + k) for k in keys]))


def chunk_tags(logits: DataFrame, chunk_col: str, id_col: str = "video_id",
               floor: float = SOUND_MIN_PROB) -> DataFrame:
    """Per chunk, soft-max of mean logits; per video and tag the highest
    chunk probability, kept above ``floor``: (video_id, label, confidence, chunks)."""
    mean = logits.groupBy(id_col, chunk_col, "label").agg(F.avg("logit").alias("m"))
    w = Window.partitionBy(id_col, chunk_col)
    e = mean.withColumn("e", F.exp(F.col("m") - F.max("m").over(w)))
    p = e.withColumn("prob", F.col("e") / F.sum("e").over(w))
    return (p.groupBy(id_col, "label").agg(F.max("prob").alias("confidence"),
                                           F.sum((F.col("prob") > floor).cast("int")).alias("chunks"))
            .where(F.col("confidence") > floor)
            .select(id_col, "label", F.round("confidence", 6).alias("confidence"), "chunks"))


def audio_type(tags: DataFrame, music: str, speech: str, present: float, id_col: str = "video_id") -> DataFrame:
    """D15: 'music-only' (music, no speech), 'narration' (speech), 'silence' (no tag present), else 'ambient'."""
    g = tags.groupBy(id_col).agg(
        F.max(F.when(F.col("label") == music, F.col("confidence"))).alias("mu"),
        F.max(F.when(F.col("label") == speech, F.col("confidence"))).alias("sp"),
        F.max("confidence").alias("top"))
    has_m = F.coalesce(F.col("mu") > present, F.lit(False))
    has_s = F.coalesce(F.col("sp") > present, F.lit(False))
    kind = (F.when(has_m & ~has_s, "music-only").when(has_s, "narration")
            .when(F.col("top") <= present, "silence").otherwise("ambient"))
    return g.select(id_col, kind.alias("audio_type"))


def tone_and_shot(frames: DataFrame, boxes: DataFrame, id_col: str = "video_id",
                  luma_col: str = "luma", area_col: str = "area") -> DataFrame:
    """Colour tone = most frequent of 4 luma bins (ties: darker bin);
    shot type from the largest detection-box area ratio."""
    tones = F.array(*[F.lit(t) for t in TONES])
    hist = (frames.groupBy(id_col, F.least(F.floor(F.col(luma_col) / 64), F.lit(3)).cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("c")))
    tone = hist.groupBy(id_col).agg(F.max(F.struct("c", (-F.col("bin")).alias("nb"))).alias("m")) \
               .select(id_col, F.element_at(tones, (1 - F.col("m.nb")).cast("int")).alias("tone"))
    area = boxes.groupBy(id_col).agg(F.max(area_col).alias("a"))
    shot = area.select(id_col, F.when(F.col("a") >= 0.5, "close-up").when(F.col("a") >= 0.15, "medium")
                       .otherwise("wide").alias("shot_type"))
    return tone.join(shot, id_col, "full_outer")


# Fixed names of the four luma bins used by ``tone_and_shot``.
TONES = ["dark", "dim", "bright", "very bright"]
