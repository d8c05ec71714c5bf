"""End-to-end curation (X1, X2) with a validated configuration.

``curate`` chains: signatures -> greedy dedup -> keep uniques (J5) ->
technical metadata (P5) -> label join (P8/P9/J6). Assignments and metadata are written
once, as every output builds on them; the records stay lazy, and sinks are applied by ``write_outputs``. Media decoding and model inference are
upstream of the tables it takes (frames, probes, score tables).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasift.operators import labels as lb
from mediasift.operators import metadata as md
from mediasift.operators.leaders import greedy_leaders
from mediasift.operators.simjoin import EmbeddingSpec, PhashSpec, written
from mediasift.sources import sinks

LABEL_GROUPS = ("caption", "objects", "people", "actions", "scene", "audio", "additional")


@dataclass(frozen=True)
class CurateConfig:
    dedup_method: str = "phash"
    phash_threshold: float = 5.0
    phash_radius: int = 2
    embedding_threshold: float = 0.95
    embedding_bands: int = 64
    embedding_bits: int = 20
    num_frames: int = 5
    on_missing: str = "keep"          # local pipeline: keep; cluster pipeline: drop
    strict_labels: bool = False       # cluster pipeline: an item whose labelling failed is dropped
    label_groups: tuple = LABEL_GROUPS
    run_ts: str = "2024-01-01T00:00:00Z"
    order_col: str | None = None

    def __post_init__(self):
        if self.dedup_method not in ("phash", "embedding"):
            raise ValueError("dedup_method must be 'phash' or 'embedding'")
        if self.on_missing not in ("keep", "drop"):
            raise ValueError("on_missing must be 'keep' or 'drop'")
        if self.num_frames < 1:
            raise ValueError("num_frames must be >= 1")
        unknown = set(self.label_groups) - set(LABEL_GROUPS)
        if unknown:
            raise ValueError(f"unknown label groups {sorted(unknown)}")

    def spec(self):
        if self.dedup_method == "phash":
            return PhashSpec(self.phash_threshold, self.phash_radius)
        return EmbeddingSpec(self.embedding_threshold, self.embedding_bands, self.embedding_bits)


@dataclass
class CurationResult:
    assignments: DataFrame
    uniques: DataFrame
    metadata: DataFrame
    records: DataFrame
    counts: DataFrame = field(default=None)


def signatures_from_frames(videos: DataFrame, frames: DataFrame, cfg: CurateConfig,
                           value_col: str = "hash") -> DataFrame:
    """F1 + F4 inputs: sample ``cfg.num_frames`` frames per video (with the
    next-frame fallback) and list their per-frame values in sample order.
    Videos with no readable frame get a NULL signature (see ``on_missing``).
    ``videos``: (video_id, n_frames); ``frames``: (video_id, frame_idx, value)."""
    from mediasift.operators.frames import sample_frames

    picked = sample_frames(videos, frames, cfg.num_frames)
    vals = picked.join(frames.select("video_id", "frame_idx", value_col), ["video_id", "frame_idx"])
    sig = (vals.groupBy("video_id")
           .agg(F.array_sort(F.collect_list(F.struct("pos", value_col))).alias("_s"))
           .select("video_id", F.transform("_s", lambda x: x[value_col]).alias(
               "hashes" if cfg.dedup_method == "phash" else "frames")))
    return videos.select("video_id").join(sig, "video_id", "left")


def _label_group(rec: DataFrame, group: str, source: DataFrame | None, values: DataFrame | None,
                 failures: DataFrame | None) -> DataFrame:
    """``rec`` with the group's label columns and ``status_<group>``: 'unavailable'
    (no source given), 'error' (a failure row), 'no_input' (no source row), 'ok'."""
    status = f"status_{group}"
    if source is None:
        return rec.withColumn(status, F.lit("unavailable"))
    # merge: labels and inputs grow with the videos; all are grouped by video_id, so the joins add no shuffle
    rec = rec.join(values.hint("merge"), "video_id", "left")
    rec = rec.join(source.select("video_id").distinct().withColumn("_input", F.lit(True)).hint("merge"), "video_id", "left")
    failed = F.lit(False)
    if failures is not None:
        bad = failures.where(F.col("label_group") == group).select("video_id").distinct()
        rec = rec.join(bad.withColumn("_failed", F.lit(True)).hint("merge"), "video_id", "left")
        failed = F.col("_failed").isNotNull()
    rec = rec.withColumn(status, F.when(failed, "error").when(F.col("_input").isNull(), "no_input").otherwise("ok"))
    kept = [F.when(F.col(status) == "ok", F.col(c)).alias(c) if c in values.columns and c != "video_id" else F.col(c)
            for c in rec.columns if c not in ("_input", "_failed")]
    return rec.select(*kept)


def curate(signatures: DataFrame, probes: DataFrame, cfg: CurateConfig,
           detections: DataFrame | None = None, logits: DataFrame | None = None,
           audio_logits: DataFrame | None = None, failures: DataFrame | None = None,
           captions: DataFrame | None = None, scenes: DataFrame | None = None,
           speech: DataFrame | None = None) -> CurationResult:
    """X1/X2. ``signatures``: (video_id, hashes | frames); ``probes``:
    (video_id, path, probe_json); score tables keyed by video_id; ``captions``:
    (video_id, caption); ``scenes``: ``labels.zero_shot_groups`` of the
    representative frames; ``speech``: ``labels.speech_record`` (video_id, ...).
    ``failures``: (video_id, label_group) rows of label functions that raised.

    Each selected group has a column ``status_<group>`` beside its labels. In
    strict mode an item with status 'error' in a selected group is dropped; an
    item without objects, actions or sounds has not failed. Input tables without
    rows give empty outputs, not an error."""
    assign = written(greedy_leaders(signatures, cfg.spec(), "video_id", cfg.order_col, cfg.on_missing), "assignments")
    uniques = assign.where("is_unique").select("video_id")
    meta_all = md.extract_metadata(probes.join(uniques, "video_id", "left_semi"))
    meta = written(meta_all.where(F.col("status") == "ok").drop("status"), "metadata")
    rec = meta
    for group in LABEL_GROUPS:
        if group not in cfg.label_groups:
            continue
        source = values = None
        if group == "caption" and captions is not None:
            source, values = captions.where("caption IS NOT NULL"), captions.select(
                "video_id", F.col("caption").alias("ai_caption"))
        elif group == "objects" and detections is not None:
            source, values = detections, lb.objects_map(lb.object_labels(detections))
        elif group == "people" and detections is not None:
            source, values = detections, lb.people_bucket(detections).select(
                "video_id", F.col("people_estimate").alias("ai_estimated_people_count"))
        elif group == "actions" and logits is not None:
            source, values = logits, lb.top_actions(logits).where("is_action").select(
                "video_id", F.array("label").alias("ai_actions"))
        elif group == "scene" and scenes is not None:
            source, values = scenes.where("scene_type IS NOT NULL"), scenes.select(
                "video_id", F.col("scene_type").alias("ai_scene_type"), F.col("environment").alias("ai_environment"))
        elif group == "audio" and (audio_logits is not None or speech is not None):
            source, values = _audio(audio_logits, speech)
        elif group == "additional" and scenes is not None:
            source, values = scenes.where("visual_style IS NOT NULL"), scenes.select(
                "video_id", F.col("visual_style").alias("ai_visual_style"),
                F.col("mood_estimation").alias("ai_mood_estimation"))
        rec = _label_group(rec, group, source, values, failures)
    rec = rec.withColumn("ai_camera_motion", F.lit("[Not implemented]")) \
             .withColumn("ai_labeling_timestamp", F.lit(cfg.run_ts))
    if cfg.strict_labels and failures is not None:
        bad = failures.where(F.col("label_group").isin(list(cfg.label_groups))).select("video_id").distinct()
        rec = rec.join(bad.hint("merge"), "video_id", "left_anti")
    counts = (assign.groupBy(F.when(F.col("is_unique"), "unique").otherwise("duplicate").alias("part"))
              .agg(F.count(F.lit(1)).alias("n")))
    return CurationResult(assign, uniques, meta, rec, counts)


def _audio(audio_logits: DataFrame | None, speech: DataFrame | None):
    """(input rows, labels) of the audio group: sound events, speech, or both."""
    parts, values = [], None
    if audio_logits is not None:
        parts.append(audio_logits.select("video_id"))
        values = lb.sound_events(audio_logits).groupBy("video_id").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "tag"))), lambda s: s["tag"]).alias("ai_sound_events"))
    if speech is not None:
        parts.append(speech.select("video_id"))
        spoken = speech.select("video_id", F.col("has_speech").alias("ai_has_speech"),
                               F.col("language").alias("ai_language"),
                               F.col("transcription_snippet").alias("ai_transcription_snippet"))
        values = spoken if values is None else values.join(spoken, "video_id", "full")
    return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])), values


def run_counts(found: DataFrame, valid: DataFrame, res: CurationResult) -> DataFrame:
    """One row (found, valid, unique, duplicate, preprocessed, labeled, failed);
    failed are the items that had metadata and got no record."""
    stages = {"found": found, "valid": valid, "unique": res.uniques,
              "duplicate": res.assignments.where(~F.col("is_unique")), "preprocessed": res.metadata,
              "labeled": res.records}
    tagged = None
    for name, df in stages.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    wide = tagged.agg(*[F.max(F.when(F.col("stage") == name, F.col("n"))).alias(name) for name in stages])
    return wide.withColumn("failed", F.col("preprocessed") - F.col("labeled"))


def write_outputs(res: CurationResult, out_dir: str, cfg: CurateConfig) -> None:
    """S5 JSONL, S6 CSV, S7 duplicate map; the files carry sentinel strings for missing labels."""
    records = render_sentinels(res.records)
    sinks.write_jsonl(records, f"{out_dir}/final_labeled_metadata.jsonl")
    keys = {}
    if "ai_objects" in records.columns:  # all labels that occur, as in the JSON lines
        found = records.select(F.explode(F.map_keys("ai_objects")).alias("label"))
        keys["ai_objects"] = lb.object_keys(found)
    sinks.write_csv(records, f"{out_dir}/final_labeled_metadata.csv", keys)
    sinks.write_duplicate_map(res.assignments, f"{out_dir}/duplicate_map")


# The in-band strings for labels that could not be produced, by
# label column and status (written only on output; inside the engine a missing
# label is NULL). "" is the text for a record without a status column.
SENTINELS = {
    "ai_caption": ("caption", {"": "[Captioning unavailable]", "unavailable": "[Captioning unavailable]",
                               "no_input": "[Captioning failed: No frames]", "error": "[Captioning error]"}),
    "ai_actions": ("actions", {"": "[Action recognition unavailable]", "unavailable": "[Action recognition unavailable]",
                               "no_input": "[Action recognition failed: Not enough frames]",
                               "error": "[Action recognition error]", "ok": "[Action recognition failed]"}),
    "ai_scene_type": ("scene", {"": "[Scene classification unavailable]",
                                "unavailable": "[Scene classification unavailable]",
                                "no_input": "[Scene classification failed: No frames]",
                                "error": "[Scene classification error]"}),
    "ai_sound_events": ("audio", {"": "[No significant audio events detected]", "unavailable": "[Audio analysis unavailable]",
                                  "no_input": "[Audio analysis failed: Cannot load audio]",
                                  "error": "[Audio event detection error]",
                                  "ok": "[No significant audio events detected]"}),
    "ai_visual_style": ("additional", {"": "[Unavailable]", "unavailable": "[Unavailable]", "no_input": "[Unavailable]",
                                       "error": "[Style/Mood Error]"}),
    "ai_mood_estimation": ("additional", {"": "[Unavailable]", "unavailable": "[Unavailable]", "no_input": "[Unavailable]",
                                          "error": "[Style/Mood Error]"}),
    "ai_estimated_people_count": ("people", {"unavailable": "[Unavailable]", "no_input": "0"}),
    "ai_camera_motion": ("additional", {"": "[Not implemented]"}),
}
SENTINEL_ARRAYS = {"ai_actions", "ai_sound_events"}


def render_sentinels(records: DataFrame) -> DataFrame:
    """Replace NULL label values by the sentinel of their group's status (arrays stay
    arrays). A group that is not available has its columns added; the columns of a
    group that was not selected stay absent."""
    out = records
    for col, (group, texts) in SENTINELS.items():
        status = f"status_{group}"
        known = status in records.columns
        if col not in records.columns:
            if not known:
                continue
            out = out.withColumn(col, F.lit(None).cast("array<string>" if col in SENTINEL_ARRAYS else "string"))
        fill = F.lit(texts.get(""))
        if known:
            pick = [x for k, v in texts.items() if k for x in (F.lit(k), F.lit(v))]
            fill = F.coalesce(F.try_element_at(F.create_map(*pick), F.col(status)), fill) if pick else fill
        if col in SENTINEL_ARRAYS:
            fill = F.when(fill.isNotNull(), F.array(fill))
        out = out.withColumn(col, F.coalesce(F.col(col), fill))
    return out
