import json
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from mediasift.plans.pipeline import CurateConfig, curate, write_outputs
from mediasift.sources import fixtures as fx
from mediasift.sources.listing import list_media, read_metadata_docs
from mediasift.sources.sinks import flatten_for_csv, write_jsonl, write_lake


def _touch(path, size):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(b"x" * size)


def test_listing_suffix_nested_zero_and_missing(spark):
    root = tempfile.mkdtemp(prefix="mediasift-list-", dir="/tmp")
    _touch(f"{root}/a.MP4", 10)
    _touch(f"{root}/sub/deeper/b.mkv", 5)
    _touch(f"{root}/notes.txt", 3)
    _touch(f"{root}/empty.mov", 0)
    got = sorted(os.path.basename(r.path) for r in list_media(spark, root).collect())
    assert got == ["a.MP4", "b.mkv"]
    # Spark's file scan already skips zero-byte files, so S3 holds either way
    assert list_media(spark, root, non_empty=False).count() == 2
    assert list_media(spark, f"{root}/does-not-exist").count() == 0


def test_metadata_docs_and_sinks(spark):
    root = tempfile.mkdtemp(prefix="mediasift-docs-", dir="/tmp")
    media = f"{root}/media"
    _touch(f"{media}/v1.mp4", 10)
    _touch(f"{media}/v2.mp4", 0)
    docs = f"{root}/docs"
    os.makedirs(docs)
    for name, body in [("v1.json", {"filepath": f"{media}/v1.mp4", "duration_seconds": 1.0}),
                       ("v2.json", {"filepath": f"{media}/v2.mp4", "duration_seconds": 2.0}),
                       ("nofp.json", {"duration_seconds": 3.0}),
                       ("_all_metadata.json", {"filepath": f"{media}/v1.mp4", "duration_seconds": 9.0})]:
        with open(f"{docs}/{name}", "w") as f:
            json.dump(body, f)
    with open(f"{docs}/bad.json", "w") as f:
        f.write("{not json")
    schema = T.StructType([T.StructField("filepath", T.StringType()), T.StructField("duration_seconds", T.DoubleType())])
    got = read_metadata_docs(spark, docs, schema, list_media(spark, media)).collect()
    assert [(os.path.basename(r.filepath), r.duration_seconds) for r in got] == [("v1.mp4", 1.0)]

    df = spark.createDataFrame([(1, None, {"person": 0.9}, ["a", "b"], (1, "x"))],
                               "id long, note string, ai_objects map<string,double>, tags array<string>, "
                               "s struct<p:int,q:string>")
    out = f"{root}/jsonl"
    write_jsonl(df.select("id", "note"), out)
    line = spark.read.text(out).first()[0]
    assert json.loads(line) == {"id": 1, "note": None}
    flat = flatten_for_csv(df, {"ai_objects": ["person", "car"]})
    assert flat.columns == ["id", "note", "ai_objects_person", "ai_objects_car", "tags", "s_p", "s_q"]
    write_lake(spark.range(10).withColumn("source", F.col("id") % 2), f"{root}/lake", ["source"], "id")
    assert sorted(p for p in os.listdir(f"{root}/lake") if p.startswith("source=")) == ["source=0", "source=1"]


def test_curate_end_to_end(spark):
    frames = fx.clone_frames(spark, SF_SMALL)
    sigs = fx.phash_signatures(frames)
    probes = fx.probe_documents(spark, SF_SMALL).where(F.col("video_id") < 120)
    cfg = CurateConfig(dedup_method="phash")
    res = curate(sigs, probes, cfg, detections=fx.detections(spark, SF_SMALL),
                 logits=fx.audio_logits(spark, SF_SMALL))
    counts = {r.part: r.n for r in res.counts.collect()}
    assert counts == {"unique": 110, "duplicate": 10}
    recs = res.records.collect()
    assert recs and all(r.ai_camera_motion == "[Not implemented]" for r in recs)
    out = tempfile.mkdtemp(prefix="mediasift-out-", dir="/tmp")
    write_outputs(res, out, cfg)
    assert spark.read.parquet(f"{out}/duplicate_map").count() == 10
    try:
        CurateConfig(dedup_method="sift")
        raise AssertionError("invalid method accepted")
    except ValueError:
        pass


def test_render_sentinels(spark):
    from mediasift.plans.pipeline import render_sentinels

    df = spark.createDataFrame([(1, None, None), (2, ["run"], ["music (0.83)"])],
                               "video_id long, ai_actions array<string>, ai_sound_events array<string>")
    got = {r.video_id: (r.ai_actions, r.ai_sound_events) for r in render_sentinels(df).collect()}
    assert got[1] == (["[Action recognition unavailable]"], ["[No significant audio events detected]"])
    assert got[2] == (["run"], ["music (0.83)"])


def test_signatures_honour_num_frames(spark):
    from mediasift.plans.pipeline import signatures_from_frames

    videos = spark.createDataFrame([(1, 10), (2, 0)], "video_id long, n_frames int")
    frames = spark.createDataFrame([(1, i, 100 + i) for i in range(10)], "video_id long, frame_idx int, hash long")
    got = {r.video_id: r.hashes for r in signatures_from_frames(videos, frames, CurateConfig(num_frames=3)).collect()}
    assert got == {1: [100, 104, 109], 2: None}
