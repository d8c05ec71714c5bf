"""Sources and steps of the greedy leaders and the curation that must not be read or run again for each output."""

import json

import pandas as pd
from pyspark.sql import functions as F

from mediasift.operators import leaders
from mediasift.operators.simjoin import PhashSpec
from mediasift.plans.pipeline import CurateConfig, curate, run_counts

HASHES = {i: [(i + 1) * 0x1234567, ~i * 0x7654321, i ** 5] for i in range(20)} | {100: None, 101: []}


def _counted(spark, hashes):
    """(signatures, accumulator): the accumulator counts the rows that the source's function makes."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for pdf in batches:
            made.add(len(pdf))
            yield pdf

    rows = spark.createDataFrame(list(hashes.items()), "video_id long, hashes array<long>").repartition(2)
    return rows.mapInPandas(run, rows.schema), made


def test_leaders_read_their_source_once(spark):
    """the hashing of all frames ran a second time to list the videos without a signature."""
    hashes = HASHES | {200: HASHES[3], 201: [HASHES[4][0] ^ 1, *HASHES[4][1:]], 102: [1, None, 2]}
    sigs, made = _counted(spark, hashes)
    got = {r.video_id: (r.primary_id, r.is_unique) for r in leaders.greedy_leaders(sigs, PhashSpec(threshold=5.0, radius=2)).collect()}
    assert made.value == len(hashes)
    assert got == {i: (i, True) for i in hashes} | {200: (3, False), 201: (4, False)}
    sigs, made = _counted(spark, hashes)
    groups = {r.id: (r.group_id, r.n) for r in leaders.similarity_groups(sigs, PhashSpec(threshold=5.0, radius=2)).collect()}
    assert made.value == len(hashes)
    assert groups == {i: (i, 1) for i in hashes} | {3: (3, 2), 200: (3, 2), 4: (4, 2), 201: (4, 2)}


def test_counts_of_a_run_repeat_no_step(spark):
    """each count took the leaders' last joins and the parsed probes anew, and label tables went through the driver."""
    sigs, made = _counted(spark, HASHES | {200: HASHES[3]})
    doc = json.dumps({"streams": [{"codec_type": "video", "codec_name": "h264", "width": 4, "height": 2}], "format": {"duration": "1.0"}})
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    probes = spark.createDataFrame([(i, f"/a/{i}.mp4", doc) for i in range(20)], "video_id long, path string, probe_json string")
    probes = probes.repartition(2).mapInPandas(run, probes.schema)
    scores = spark.createDataFrame([(i, "person", 0.9, 0) for i in range(0, 20, 2)], "video_id long, label string, score double, frame_idx int")
    logits = spark.createDataFrame([(i, "run", 3.0) for i in range(0, 20, 3)], "video_id long, label string, logit double")
    failures = spark.createDataFrame([(i, "scene") for i in (1, 5)], "video_id long, label_group string")
    scenes = spark.createDataFrame([(i, "a", "b", "c", "d") for i in range(20)],
                                   "video_id long, scene_type string, environment string, visual_style string, mood_estimation string")
    res = curate(sigs, probes, CurateConfig(strict_labels=True), detections=scores, logits=logits, audio_logits=logits,
                 failures=failures, scenes=scenes)
    found = spark.createDataFrame(pd.DataFrame({"video_id": list(HASHES)}))
    counts = run_counts(found, found.where(F.col("video_id") < 100), res)
    assert "BroadcastExchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert counts.first().asDict() == {"found": 22, "valid": 20, "unique": 22, "duplicate": 1, "preprocessed": 20, "labeled": 18, "failed": 2}
    assert res.counts.count() == 2 and res.records.count() == 18
    assert (made.value, read.value) == (23, 20)
