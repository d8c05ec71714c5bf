"""Registered queries of the label record: zero-shot groups, speech, whole records, run counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasift.operators import labels as lb
from mediasift.plans import dedup_queries as dq
from mediasift.plans import media_queries as mq
from mediasift.plans.pipeline import CurateConfig, curate, render_sentinels
from mediasift.plans.pipeline import run_counts as count_run
from mediasift.sources import fixtures as fx
from mediasift.sources.tables import table

MIDDLE_FRAME = 2      # of FRAMES_PER_VIDEO
FAILED_EVERY = 11     # every 11th clip's scene function is taken as failed
EMPTY_EVERY = 17      # every 17th clip's file is taken as empty


def _prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The fixed prompts; the n-th one's vector is the embedding with id n."""
    rows = [(g, i, p) for g, ps in lb.PROMPT_GROUPS.items() for i, p in enumerate(ps)]
    names = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "vec_id long, group string, idx int, label string")
    return table(spark, sf, "embeddings").select("vec_id", "embedding").join(names, "vec_id").drop("vec_id")


def scene_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The best prompt of each group for every video's middle frame."""
    middle = fx.embedding_frames(spark, sf).where(F.col("frame_idx") == MIDDLE_FRAME)
    return lb.zero_shot_groups(middle, _prompts(spark, sf), "video_id", "embedding")


def speech_record(spark: SparkSession, sf: str) -> DataFrame:
    return lb.speech_record(fx.transcripts(spark, sf), ["conv_id", "turn"])


def _curated(spark: SparkSession, sf: str, strict: bool):
    probes = fx.probe_documents(spark, sf)
    sigs = fx.phash_signatures(fx.clone_frames(spark, sf)).where(F.col("video_id") % EMPTY_EVERY != 0)
    speech = lb.speech_record(fx.transcripts(spark, sf).where("turn = 0"), ["conv_id"])
    failures = probes.where(F.col("video_id") % FAILED_EVERY == 0).select(
        "video_id", F.lit("scene").alias("label_group"))
    return curate(sigs, probes, CurateConfig(strict_labels=strict), detections=fx.detections(spark, sf),
                  logits=fx.audio_logits(spark, sf), audio_logits=fx.audio_logits(spark, sf), failures=failures,
                  scenes=scene_labels(spark, sf), speech=speech.withColumnRenamed("conv_id", "video_id"))


def curate_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records of all unique clips, with the sentinels of every status."""
    rec = render_sentinels(_curated(spark, sf, False).records)
    objects = F.array_join(F.transform(F.map_entries("ai_objects"), lambda e: F.concat(
        e["key"], F.lit(":"), F.format_string("%.2f", e["value"].cast("double")))), ",")
    return rec.select(
        "video_id", "filename", "duration_seconds", "ai_caption", objects.alias("objects"),
        F.array_join("ai_actions", ",").alias("actions"), "ai_scene_type", "ai_environment", "ai_has_speech",
        "ai_language", "ai_transcription_snippet", F.array_join("ai_sound_events", ",").alias("sound_events"),
        "ai_visual_style", "ai_mood_estimation", "ai_camera_motion", "ai_estimated_people_count",
        "status_objects", "status_scene", "status_audio", "ai_labeling_timestamp")


def run_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a strict run."""
    found = fx.phash_signatures(fx.clone_frames(spark, sf)).select("video_id")
    return count_run(found, found.where(F.col("video_id") % EMPTY_EVERY != 0), _curated(spark, sf, True))


QUERIES = {
    "scene_labels": scene_labels,
    "speech_record": speech_record,
    "curate_records": curate_records,
    "run_counts": run_counts,
}

_PROMPT_ROWS = ", ".join(f"({n}, '{g}', {i}, '{p}')" for n, (g, i, p) in enumerate(
    (g, i, p) for g, ps in lb.PROMPT_GROUPS.items() for i, p in enumerate(ps)))
_SCENES = f"""pr AS (SELECT t.grp, t.idx, t.label, CAST(e.embedding AS DOUBLE[]) AS pv
       FROM (VALUES {_PROMPT_ROWS}) t(n, grp, idx, label) JOIN embeddings e ON e.vec_id = t.n),
mid AS (SELECT vec_id // 5 AS video_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 5 = {MIDDLE_FRAME}),
sims AS (SELECT m.video_id, p.grp, p.idx, p.label, round({mq._cos('m.v', 'p.pv')}, 12) AS s FROM mid m, pr p),
bests AS (SELECT video_id, grp, arg_max(label, (s, -idx)) AS label FROM sims GROUP BY video_id, grp),
scenes AS (SELECT video_id, """ + ", ".join(
    f"max(label) FILTER (WHERE grp = '{g}') AS {g}" for g in sorted(lb.PROMPT_GROUPS)) + " FROM bests GROUP BY video_id)"
_SPEECH = r"""st AS (
  SELECT conv_id, turn, ['<|en|>', '<|fr|>', 'de', '<|es|>', '<|de|>'][conv_id % 5 + 1] AS tok,
         regexp_replace(text, '^\s+|\s+$', '', 'g') AS sn FROM conversations),
speech AS (SELECT conv_id, turn, coalesce(length(sn) > 0, false) AS has_speech,
       CASE WHEN length(sn) > 0 AND starts_with(tok, '<') AND ends_with(tok, '>')
            THEN substr(tok, 3, length(tok) - 4) END AS language,
       CASE WHEN length(sn) > 0 THEN sn END AS transcription_snippet FROM st)"""
_SOUNDS = """snd_e AS (SELECT *, exp(m - max(m) OVER (PARTITION BY video_id)) AS e FROM lg),
snd_p AS (SELECT *, e / sum(e) OVER (PARTITION BY video_id) AS prob FROM snd_e),
snd_r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY prob DESC, label) AS rank FROM snd_p),
sounds AS (SELECT video_id, string_agg(printf('%s (%.2f)', label, prob), ',' ORDER BY rank) AS tags
           FROM snd_r WHERE rank <= 5 AND prob > 0.1 GROUP BY video_id)"""
_ALL = ",\n".join([dq.PHASH_PAIRS_CTE, mq._PROBE, mq._DET, mq._OBJ, mq._PEOPLE, mq._LOGITS, mq._ACT, _SCENES, _SPEECH, _SOUNDS])
_VALID = f"video_id % {EMPTY_EVERY} <> 0"
_CLEAN = f"m.video_id % {FAILED_EVERY} <> 0"

ORACLE = {
    "scene_labels": f"WITH {_SCENES} SELECT * FROM scenes",
    "speech_record": f"WITH {_SPEECH} SELECT * FROM speech",
    "curate_records": dq._greedy_sql(_ALL, "", _VALID, f"""SELECT m.video_id, m.filename, m.duration_seconds,
  '[Captioning unavailable]' AS ai_caption,
  (SELECT string_agg(o.label || ':' || printf('%.2f', o.conf), ',' ORDER BY o.label) FROM obj o
   WHERE o.video_id = m.video_id) AS objects,
  coalesce(a.label, '[Action recognition failed: Not enough frames]') AS actions,
  CASE WHEN NOT ({_CLEAN}) THEN '[Scene classification error]'
       ELSE coalesce(s.scene_type, '[Scene classification failed: No frames]') END AS ai_scene_type,
  CASE WHEN {_CLEAN} THEN s.environment END AS ai_environment,
  sp.has_speech AS ai_has_speech, sp.language AS ai_language, sp.transcription_snippet AS ai_transcription_snippet,
  CASE WHEN sn.tags IS NOT NULL THEN sn.tags WHEN sp.conv_id IS NOT NULL OR a.video_id IS NOT NULL
       THEN '[No significant audio events detected]' ELSE '[Audio analysis failed: Cannot load audio]' END AS sound_events,
  coalesce(s.visual_style, '[Unavailable]') AS ai_visual_style,
  coalesce(s.mood_estimation, '[Unavailable]') AS ai_mood_estimation, '[Not implemented]' AS ai_camera_motion,
  coalesce(pe.people_estimate, '0') AS ai_estimated_people_count,
  CASE WHEN pe.video_id IS NULL THEN 'no_input' ELSE 'ok' END AS status_objects,
  CASE WHEN NOT ({_CLEAN}) THEN 'error' WHEN s.video_id IS NULL THEN 'no_input' ELSE 'ok' END AS status_scene,
  CASE WHEN a.video_id IS NULL AND sp.conv_id IS NULL THEN 'no_input' ELSE 'ok' END AS status_audio,
  '2024-01-01T00:00:00Z' AS ai_labeling_timestamp
FROM meta m JOIN lead l ON l.video_id = m.video_id
LEFT JOIN act a ON a.video_id = m.video_id AND a.is_action LEFT JOIN scenes s ON s.video_id = m.video_id
LEFT JOIN speech sp ON sp.conv_id = m.video_id AND sp.turn = 0 LEFT JOIN sounds sn ON sn.video_id = m.video_id
LEFT JOIN people pe ON pe.video_id = m.video_id"""),
    "run_counts": dq._greedy_sql(_ALL, "", _VALID, f"""SELECT *, preprocessed - labeled AS failed FROM (SELECT
  (SELECT count(*) FROM vnf) AS found, (SELECT count(*) FROM items) AS valid, (SELECT count(*) FROM lead) AS "unique",
  (SELECT count(*) FROM items) - (SELECT count(*) FROM lead) AS duplicate,
  (SELECT count(*) FROM meta m JOIN lead l ON l.video_id = m.video_id) AS preprocessed,
  (SELECT count(*) FROM meta m JOIN lead l ON l.video_id = m.video_id WHERE {_CLEAN}) AS labeled)"""),
}
