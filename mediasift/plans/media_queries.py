"""Registered queries over derived media tables: frames, probes, detections,
logits, transcripts, prompts, and batch inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasift.operators import frames as fr
from mediasift.operators import infer as inf
from mediasift.operators import labels as lb
from mediasift.operators import metadata as md
from mediasift.operators.signatures import dct_hash as _dct_hash
from mediasift.sources import fixtures as fx
from mediasift.functions.timecols import epoch_micros
from mediasift.sources.tables import table

# Fixed query parameters.
SAMPLE_K, ACTION_K = 5, 16
BLANK_LUMA = 16.0
SHOT_COS = 0.3
LONG_SHOT_COS, LONG_SHOT_BLOCK = 0.0, 64
KEYFRAME_SECONDS = 3600
CHUNK_SECONDS = 5.0
CHARS_PER_SECOND = 100.0
STATIC_BELOW, SLOW_BELOW = 0.5, 1.0
OBJECT_KEYS = ["car", "dog", "person"]  # the fixture's labels, for the SQL only
RUN_TS = "2024-01-01T00:00:00Z"
CAMERA_MOTION = "[Not implemented]"


def frame_sample(spark: SparkSession, sf: str) -> DataFrame:
    vids, frames = fx.doc_videos(spark, sf), fx.doc_frames(spark, sf)
    sample = fr.sample_frames(vids, frames, SAMPLE_K)
    first = fr.sample_frames(vids, frames, 1)
    rep = fr.representative(sample)
    action = fr.action_frames(vids, frames, ACTION_K)
    parts = [(sample, "sample"), (first, "first"), (rep, "rep"), (action, "action")]
    out = None
    for df, role in parts:
        d = df.select("video_id", F.lit(role).alias("role"), F.col("pos").cast("int").alias("pos"),
                      F.col("frame_idx").cast("int").alias("frame_idx"))
        out = d if out is None else out.unionByName(d)
    return out


def quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    return fr.frame_flags(fx.doc_frames(spark, sf), BLANK_LUMA)


def probe_metadata(spark: SparkSession, sf: str) -> DataFrame:
    meta = md.extract_metadata(fx.probe_documents(spark, sf)).where(F.col("status") == "ok")
    meta = md.shape_features(meta).drop("status", "is_4k", "length_bucket")
    return meta.withColumn("avg_frame_rate", F.round("avg_frame_rate", 6))


def keyframes(spark: SparkSession, sf: str) -> DataFrame:
    return fr.keyframes(table(spark, sf, "events"), "user_id", "ts", "event_id", KEYFRAME_SECONDS)


def clip_chunks(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") / CHARS_PER_SECOND).alias("duration"))
    return fr.chunks(docs, "doc_id", "duration", CHUNK_SECONDS)


def shot_segments(spark: SparkSession, sf: str) -> DataFrame:
    return fr.shot_segments(fx.embedding_frames(spark, sf), SHOT_COS)


def object_labels(spark: SparkSession, sf: str) -> DataFrame:
    return lb.object_labels(fx.detections(spark, sf))


def people_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return lb.people_bucket(fx.detections(spark, sf))


def sound_events(spark: SparkSession, sf: str) -> DataFrame:
    return lb.sound_events(fx.audio_logits(spark, sf))


def top_action(spark: SparkSession, sf: str) -> DataFrame:
    return lb.top_actions(fx.audio_logits(spark, sf))


def zero_shot(spark: SparkSession, sf: str) -> DataFrame:
    emb = table(spark, sf, "embeddings")
    prompts = (emb.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
               .withColumn("idx", F.col("label")))
    return lb.zero_shot(emb, lb.prompt_literal(prompts, "idx", "label", "embedding"), "vec_id", "embedding")


def motion_class(spark: SparkSession, sf: str) -> DataFrame:
    return lb.motion_class(fx.embedding_frames(spark, sf), static_below=STATIC_BELOW, slow_below=SLOW_BELOW)


def speech_fields(spark: SparkSession, sf: str) -> DataFrame:
    return lb.speech_fields(fx.transcripts(spark, sf), ["conv_id", "turn"])


def flatten_record(spark: SparkSession, sf: str) -> DataFrame:
    objects = lb.object_labels(fx.detections(spark, sf))
    return lb.flatten_objects(objects, lb.object_keys(objects))


def label_record(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata of every readable clip left-joined with the
    selected label groups (objects, people, action); absent groups are absent
    columns, missing labels are NULL or the reference defaults."""
    meta = md.extract_metadata(fx.probe_documents(spark, sf)).where(F.col("status") == "ok") \
             .select("video_id", "filename", "filepath", "duration_seconds", "width", "quality_flag_short")
    det = fx.detections(spark, sf)
    objs = lb.object_labels(det)
    obj_summary = objs.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("n_objects"),
        F.min(F.struct((-F.col("conf")).alias("nc"), F.col("label"))).alias("top"))
    people = lb.people_bucket(det).select("video_id", "people_estimate")
    action = (lb.top_actions(fx.audio_logits(spark, sf)).where("is_action")
              .select(F.col("video_id").alias("action_video"), F.col("label").alias("ai_action")))
    rec = (meta.join(obj_summary, "video_id", "left").join(people, "video_id", "left")
           .join(action, F.col("video_id") == F.col("action_video"), "left"))
    return rec.select(
        "video_id", "filename", "filepath", "duration_seconds", "width", "quality_flag_short",
        F.coalesce("n_objects", F.lit(0).cast("bigint")).alias("n_objects"),
        F.col("top.label").alias("top_object"),
        F.coalesce("people_estimate", F.lit("0")).alias("ai_estimated_people_count"),
        "ai_action",
        F.lit(CAMERA_MOTION).alias("ai_camera_motion"),
        # the run time is a UTC wall-clock value: formatting a TIMESTAMP_NTZ does
        # not depend on the session time zone
        F.date_format(F.to_timestamp_ntz(F.lit(RUN_TS[:19].replace("T", " "))),
                      "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ai_labeling_timestamp"))


AUDIO_CHUNK_HOURS = 6
MUSIC_CLASS, SPEECH_CLASS, PRESENT_PROB = "view", "click", 0.3


def audio_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Tags over fixed time chunks, then the audio-type rule
    (event type 'view' stands for music, 'click' for speech)."""
    ev = table(spark, sf, "events")
    logits = ev.select(F.col("user_id").alias("video_id"), F.col("event_type").alias("label"),
                       (F.col("value") / 50.0).alias("logit"),
                       F.floor(epoch_micros("ts") / F.lit(AUDIO_CHUNK_HOURS * 3_600_000_000)).alias("chunk"))
    tags = lb.chunk_tags(logits, "chunk")
    kinds = lb.audio_type(tags, MUSIC_CLASS, SPEECH_CLASS, PRESENT_PROB)
    return tags.join(kinds, "video_id")


def visual_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Tone of documents-derived frames; shot type from box areas (l_quantity / 50)."""
    boxes = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("video_id"),
                                               (F.col("l_quantity") / 50.0).alias("area"))
    return lb.tone_and_shot(fx.doc_frames(spark, sf), boxes)


def batch_infer(spark: SparkSession, sf: str) -> DataFrame:
    emb = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return inf.infer(emb, "linear64", inf.linear_model_loader(64), inf.linear_model_fn,
                     "vec_id long, score double, label string, status string", keep=["vec_id"])


def dct_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _dct_hash(table(spark, sf, "embeddings"), "vec_id", "embedding", 8)


def shot_segments_long(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors of a label as the frames of one long video, numbered by vec_id, in blocks of 64 numbers."""
    frames = table(spark, sf, "embeddings").select(F.col("label").alias("video_id"), F.col("vec_id").alias("frame_idx"), "embedding")
    return fr.shot_segments_in_blocks(frames, LONG_SHOT_COS, block=LONG_SHOT_BLOCK)


QUERIES = {
    "shot_segments_long": shot_segments_long,
    "frame_sample": frame_sample,
    "quality_filter": quality_filter,
    "probe_metadata": probe_metadata,
    "keyframes": keyframes,
    "clip_chunks": clip_chunks,
    "shot_segments": shot_segments,
    "object_labels": object_labels,
    "people_bucket": people_bucket,
    "sound_events": sound_events,
    "top_action": top_action,
    "zero_shot": zero_shot,
    "motion_class": motion_class,
    "speech_fields": speech_fields,
    "flatten_record": flatten_record,
    "label_record": label_record,
    "batch_infer": batch_infer,
    "dct_hash": dct_hash,
    "audio_profile": audio_profile,
    "visual_profile": visual_profile,
}

# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

_FV = "fv AS (SELECT doc_id AS video_id, CAST(n_chars % 120 AS INTEGER) AS n_frames FROM documents)"
_FF = """ff AS (
  SELECT video_id, frame_idx,
         CAST(CASE WHEN video_id % 9 = 0 THEN frame_idx % 8 ELSE (video_id * 31 + frame_idx * 7) % 256 END AS DOUBLE) AS luma,
         CASE WHEN video_id % 5 = 0 THEN video_id ELSE video_id * 1000 + frame_idx END AS hash
  FROM (SELECT video_id, unnest(range(0, n_frames)) AS frame_idx FROM fv)
  WHERE (video_id + frame_idx) % 17 <> 5)"""


def _f1(k: int, name: str) -> str:
    kk = f"least({k}, n_frames)"
    return f"""{name}_want AS (
  SELECT DISTINCT video_id,
         CASE WHEN n_frames <= 0 OR {kk} <= 1 THEN 0 ELSE (i * (n_frames - 1)) // ({kk} - 1) END AS idx
  FROM (SELECT video_id, n_frames, unnest(range(0, CASE WHEN n_frames <= 0 THEN 1 ELSE {kk} END)) AS i FROM fv)),
{name}_got AS (
  SELECT w.video_id, w.idx, coalesce(f0.frame_idx, f1.frame_idx) AS frame_idx
  FROM {name}_want w
  LEFT JOIN ff f0 ON f0.video_id = w.video_id AND f0.frame_idx = w.idx
  LEFT JOIN ff f1 ON f1.video_id = w.video_id AND f1.frame_idx = w.idx + 1
  WHERE coalesce(f0.frame_idx, f1.frame_idx) IS NOT NULL),
{name} AS (
  SELECT video_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY idx) - 1 AS INTEGER) AS pos,
         CAST(frame_idx AS INTEGER) AS frame_idx FROM {name}_got)"""


_FRAME_SAMPLE = f"""WITH {_FV}, {_FF}, {_f1(SAMPLE_K, 's5')}, {_f1(1, 's1')},
aw AS (SELECT video_id, CAST(i AS INTEGER) AS pos, CAST((i * (n_frames - 1)) // {ACTION_K - 1} AS INTEGER) AS frame_idx
       FROM (SELECT video_id, n_frames, unnest(range(0, {ACTION_K})) AS i FROM fv WHERE n_frames > 0)),
ag AS (SELECT aw.* FROM aw JOIN ff ON ff.video_id = aw.video_id AND ff.frame_idx = aw.frame_idx),
act AS (SELECT * FROM ag WHERE video_id IN (SELECT video_id FROM ag GROUP BY video_id HAVING count(*) = {ACTION_K})),
rep AS (SELECT video_id, pos, frame_idx FROM (SELECT *, count(*) OVER (PARTITION BY video_id) AS n FROM s5)
        WHERE pos = n // 2)
SELECT video_id, 'sample' AS role, pos, frame_idx FROM s5
UNION ALL SELECT video_id, 'first', pos, frame_idx FROM s1
UNION ALL SELECT video_id, 'rep', pos, frame_idx FROM rep
UNION ALL SELECT video_id, 'action', pos, frame_idx FROM act"""

_DET = """det AS (
  SELECT l_orderkey AS video_id, CAST((l_linenumber - 1) // 3 AS INTEGER) AS frame_idx,
         CASE l_returnflag WHEN 'A' THEN 'person' WHEN 'N' THEN 'car' WHEN 'R' THEN 'dog' END AS label,
         l_discount * 10 AS score
  FROM lineitem)"""
_OBJ = f"""obj AS (SELECT video_id, label, max(round(score, 2)) AS conf FROM det WHERE score > 0.7 GROUP BY video_id, label)"""
_PEOPLE = """pf AS (SELECT video_id, frame_idx,
              sum(CASE WHEN label = 'person' AND score > 0.5 THEN 1 ELSE 0 END) AS c,
              max(CASE WHEN label = 'person' AND score > 0.7 THEN round(score, 2) END) AS pc
       FROM det GROUP BY video_id, frame_idx),
people AS (SELECT video_id, CAST(max(c) AS INTEGER) AS max_people,
       CASE WHEN max(c) = 0 THEN '0' WHEN max(c) = 1 THEN '1' WHEN max(c) <= 5 THEN '2-5'
            WHEN max(c) <= 9 THEN '6-9' ELSE '10+' END AS bucket,
       CASE WHEN coalesce(max(pc), 0) > 0 THEN '1' ELSE '0' END AS people_estimate
FROM pf GROUP BY video_id)"""
_LOGITS = "lg AS (SELECT user_id AS video_id, event_type AS label, avg(value / 50.0) AS m FROM events GROUP BY user_id, event_type)"
_ACT = """act AS (SELECT video_id, CAST(rank AS INTEGER) AS rank, label, round(m, 6) AS logit, rank = 1 AS is_action
  FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY m DESC, label) AS rank FROM lg) WHERE rank <= 5)"""

_PROBE = """meta AS (
  SELECT o_orderkey AS video_id, 'clip_' || o_orderkey || '.mp4' AS filename,
         printf('/corpus/%d/clip_%d.mp4', o_custkey % 20, o_orderkey) AS filepath,
         'mov,mp4,m4a,3gp,3g2,mj2' AS format_name,
         (o_orderkey % 600) / 8.0 AS duration_seconds,
         CAST(160 + (o_custkey % 10) * 80 AS INTEGER) AS width,
         CAST(((160 + (o_custkey % 10) * 80) * 9) // 16 AS INTEGER) AS height,
         round(CASE o_orderkey % 5 WHEN 0 THEN CAST(30000 AS DOUBLE) / 1001 WHEN 1 THEN 25.0 WHEN 2 THEN NULL
                    WHEN 3 THEN 24.0 ELSE 0.0 END, 6) AS avg_frame_rate,
         ['h264', 'hevc', 'vp9'][o_custkey % 3 + 1] AS video_codec,
         CAST(floor(o_totalprice * 10) AS BIGINT) AS video_bit_rate,
         CASE WHEN o_orderkey % 4 <> 0 THEN 'aac' END AS audio_codec,
         CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey % 2 + 1 AS INTEGER) END AS audio_channels,
         CASE WHEN o_orderkey % 4 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN '44100' ELSE '48000' END END AS audio_sample_rate,
         CAST(CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 7 <> 0 THEN 128000 ELSE 0 END AS BIGINT) AS audio_bit_rate,
         CAST(floor(o_totalprice * 100) AS BIGINT) AS file_size_bytes,
         (o_orderkey % 600) / 8.0 < 1.0 AS quality_flag_short,
         160 + (o_custkey % 10) * 80 < 320 AS quality_flag_low_res,
         round(CAST(160 + (o_custkey % 10) * 80 AS DOUBLE) / (((160 + (o_custkey % 10) * 80) * 9) // 16), 6) AS aspect_ratio
  FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 101 <> 7)"""


def _cos(a: str, b: str) -> str:
    return (f"list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2])) / "
            f"(sqrt(list_sum(list_transform({a}, lambda x: x * x))) * sqrt(list_sum(list_transform({b}, lambda x: x * x))))")


_EF = "ef AS (SELECT vec_id // 5 AS video_id, CAST(vec_id % 5 AS INTEGER) AS frame_idx, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"

ORACLE = {
    "shot_segments_long": f"""WITH f AS (
  SELECT label AS video_id, vec_id AS frame_idx, CAST(embedding AS DOUBLE[]) AS x,
         lag(CAST(embedding AS DOUBLE[])) OVER (PARTITION BY label ORDER BY vec_id) AS y FROM embeddings),
s AS (SELECT video_id, frame_idx, sum(CASE WHEN list_cosine_similarity(x, y) < {LONG_SHOT_COS} THEN 1 ELSE 0 END)
             OVER (PARTITION BY video_id ORDER BY frame_idx) AS segment FROM f)
SELECT video_id, CAST(segment AS BIGINT) AS segment, min(frame_idx) AS first_frame, max(frame_idx) AS last_frame,
       count(*) AS frames FROM s GROUP BY video_id, segment""",
    "frame_sample": _FRAME_SAMPLE,
    "quality_filter": f"""WITH {_FV}, {_FF},
l AS (SELECT *, CASE WHEN lag(hash) OVER w IS NULL THEN NULL ELSE CAST(lag(hash) OVER w = hash AS INTEGER) END AS same
      FROM ff WINDOW w AS (PARTITION BY video_id ORDER BY frame_idx))
SELECT video_id, round(avg(luma), 6) AS mean_luma, round(avg(same), 6) AS static_ratio,
       avg(luma) < {BLANK_LUMA} AS is_blank, coalesce(avg(same) = 1.0, false) AS is_static
FROM l GROUP BY video_id""",
    "probe_metadata": f"WITH {_PROBE} SELECT * FROM meta",
    "keyframes": f"""SELECT user_id, CAST(floor(epoch_us(ts) / {KEYFRAME_SECONDS * 1_000_000}) AS BIGINT) AS bucket,
       arg_min(event_id, (ts, event_id)) AS event_id
FROM events GROUP BY user_id, CAST(floor(epoch_us(ts) / {KEYFRAME_SECONDS * 1_000_000}) AS BIGINT)""",
    "clip_chunks": f"""WITH d AS (SELECT doc_id, n_chars / {CHARS_PER_SECOND} AS duration FROM documents WHERE n_chars > 0)
SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, CAST(chunk * {CHUNK_SECONDS} AS DOUBLE) AS start_s,
       CAST(least((chunk + 1) * {CHUNK_SECONDS}, duration) AS DOUBLE) AS end_s
FROM (SELECT doc_id, duration, unnest(range(0, CAST(ceil(duration / {CHUNK_SECONDS}) AS BIGINT))) AS chunk FROM d)""",
    "shot_segments": f"""WITH {_EF},
l AS (SELECT *, lag(v) OVER (PARTITION BY video_id ORDER BY frame_idx) AS pv FROM ef),
c AS (SELECT *, CASE WHEN pv IS NULL THEN 0 WHEN {_cos('v', 'pv')} < {SHOT_COS} THEN 1 ELSE 0 END AS cut FROM l),
s AS (SELECT *, CAST(sum(cut) OVER (PARTITION BY video_id ORDER BY frame_idx
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS segment FROM c)
SELECT video_id, segment, min(frame_idx) AS first_frame, max(frame_idx) AS last_frame, count(*) AS frames
FROM s GROUP BY video_id, segment""",
    "object_labels": f"WITH {_DET}, {_OBJ} SELECT * FROM obj",
    "people_bucket": f"WITH {_DET}, {_PEOPLE} SELECT * FROM people",
    "sound_events": f"""WITH {_LOGITS},
e AS (SELECT *, exp(m - max(m) OVER (PARTITION BY video_id)) AS e FROM lg),
p AS (SELECT *, e / sum(e) OVER (PARTITION BY video_id) AS prob FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY prob DESC, label) AS rank FROM p)
SELECT video_id, CAST(rank AS INTEGER) AS rank, label, round(prob, 6) AS prob, printf('%s (%.2f)', label, prob) AS tag
FROM r WHERE rank <= 5 AND prob > 0.1""",
    "top_action": f"WITH {_LOGITS}, {_ACT} SELECT * FROM act",
    "zero_shot": f"""WITH p AS (SELECT label AS i, arg_min(CAST(embedding AS DOUBLE[]), vec_id) AS pv FROM embeddings GROUP BY label),
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT e.vec_id, p.i, round(CASE WHEN sqrt(list_sum(list_transform(e.v, lambda x: x * x))) *
                                          sqrt(list_sum(list_transform(p.pv, lambda x: x * x))) > 0
                                     THEN {_cos('e.v', 'p.pv')} ELSE 0 END, 12) AS s FROM e, p)
SELECT vec_id, CAST(arg_max(i, (s, -i)) AS VARCHAR) AS prompt_label, round(max(s), 6) AS sim FROM s GROUP BY vec_id""",
    "motion_class": f"""WITH {_EF},
l AS (SELECT *, 1.0 - {_cos('v', 'lag(v) OVER (PARTITION BY video_id ORDER BY frame_idx)')} AS d FROM ef),
a AS (SELECT video_id, avg(d) AS motion FROM l GROUP BY video_id)
SELECT video_id, round(motion, 6) AS motion,
       CASE WHEN motion IS NULL OR motion < {STATIC_BELOW} THEN 'static' WHEN motion < {SLOW_BELOW} THEN 'slow'
            ELSE 'fast' END AS class
FROM a""",
    "speech_fields": r"""WITH t AS (
  SELECT conv_id, turn, ['<|en|>', '<|fr|>', 'de', '<|es|>', '<|de|>'][conv_id % 5 + 1] AS tok,
         regexp_replace(text, '^\s+|\s+$', '', 'g') AS sn FROM conversations)
SELECT conv_id, turn, coalesce(length(sn) > 0, false) AS has_speech,
       CASE WHEN length(sn) > 0 AND starts_with(tok, '<') AND ends_with(tok, '>')
            THEN substr(tok, 3, length(tok) - 4) END AS language,
       CASE WHEN length(sn) > 0 THEN CAST(length(sn) AS INTEGER) END AS snippet_chars
FROM t""",
    "flatten_record": f"""WITH {_DET}, {_OBJ}
SELECT video_id, """ + ", ".join(f"max(CASE WHEN label = '{k}' THEN conf END) AS ai_objects_{k}" for k in OBJECT_KEYS)
    + " FROM obj GROUP BY video_id",
    "label_record": f"""WITH {_PROBE}, {_DET}, {_OBJ}, {_PEOPLE}, {_LOGITS}, {_ACT},
os AS (SELECT video_id, count(*) AS n_objects, arg_min(label, (-conf, label)) AS top_object FROM obj GROUP BY video_id)
SELECT m.video_id, m.filename, m.filepath, m.duration_seconds, m.width, m.quality_flag_short,
       coalesce(os.n_objects, 0) AS n_objects, os.top_object,
       coalesce(pe.people_estimate, '0') AS ai_estimated_people_count,
       a.label AS ai_action, '{CAMERA_MOTION}' AS ai_camera_motion, '{RUN_TS}' AS ai_labeling_timestamp
FROM meta m LEFT JOIN os ON os.video_id = m.video_id LEFT JOIN people pe ON pe.video_id = m.video_id
LEFT JOIN act a ON a.video_id = m.video_id AND a.is_action""",
    "batch_infer": """WITH s AS (
  SELECT vec_id, list_sum(list_transform(CAST(embedding AS DOUBLE[]),
                 lambda x, i: x * ((((i - 1) * 7) % 11 - 5) / CAST(10 AS DOUBLE)))) AS sc FROM embeddings)
SELECT vec_id, round(sc, 6) AS score, CASE WHEN sc > 0 THEN 'positive' ELSE 'negative' END AS label, 'ok' AS status
FROM s""",
    "audio_profile": f"""WITH lg AS (
  SELECT user_id AS video_id, floor(epoch_us(ts) / {AUDIO_CHUNK_HOURS * 3_600_000_000}) AS chunk, event_type AS label,
         avg(value / 50.0) AS m
  FROM events GROUP BY 1, 2, 3),
e AS (SELECT *, exp(m - max(m) OVER (PARTITION BY video_id, chunk)) AS e FROM lg),
p AS (SELECT *, e / sum(e) OVER (PARTITION BY video_id, chunk) AS prob FROM e),
tags AS (SELECT video_id, label, round(max(prob), 6) AS confidence,
                CAST(sum(CASE WHEN prob > 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS chunks,
                max(prob) AS raw
         FROM p GROUP BY video_id, label HAVING max(prob) > 0.1),
k AS (SELECT video_id,
             CASE WHEN coalesce(max(CASE WHEN label = '{MUSIC_CLASS}' THEN raw END) > {PRESENT_PROB}, false)
                   AND NOT coalesce(max(CASE WHEN label = '{SPEECH_CLASS}' THEN raw END) > {PRESENT_PROB}, false)
                  THEN 'music-only'
                  WHEN coalesce(max(CASE WHEN label = '{SPEECH_CLASS}' THEN raw END) > {PRESENT_PROB}, false)
                  THEN 'narration'
                  WHEN max(raw) <= {PRESENT_PROB} THEN 'silence' ELSE 'ambient' END AS audio_type
      FROM tags GROUP BY video_id)
SELECT t.video_id, t.label, t.confidence, t.chunks, k.audio_type FROM tags t JOIN k ON k.video_id = t.video_id""",
    "visual_profile": f"""WITH {_FV}, {_FF},
h AS (SELECT video_id, CAST(least(floor(luma / 64), 3) AS INTEGER) AS bin, count(*) AS c FROM ff GROUP BY 1, 2),
tone AS (SELECT video_id, ['dark', 'dim', 'bright', 'very bright'][arg_max(bin, (c, -bin)) + 1] AS tone
         FROM h GROUP BY video_id),
shot AS (SELECT l_orderkey AS video_id,
                CASE WHEN max(l_quantity / 50.0) >= 0.5 THEN 'close-up'
                     WHEN max(l_quantity / 50.0) >= 0.15 THEN 'medium' ELSE 'wide' END AS shot_type
         FROM lineitem GROUP BY l_orderkey)
SELECT coalesce(tone.video_id, shot.video_id) AS video_id, tone, shot_type
FROM tone FULL OUTER JOIN shot ON tone.video_id = shot.video_id""",
}
