"""Cases that fixed lists, caps or whole-batch handling used to lose."""

import json

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from mediasift.functions.text import canonical_url
from mediasift.operators import content, infer, labels, ops, search
from mediasift.operators.leaders import greedy_leaders
from mediasift.operators.simjoin import PhashSpec
from mediasift.plans.pipeline import CurateConfig, curate, write_outputs


def test_urls_keep_their_query(spark):
    urls = ["http://A.com/watch?v=A", "https://a.com/watch?v=B&utm_source=x", "http://a.com/watch/?utm_a=1&v=A#top",
            "http://a.com/p?b=2&a=1&ref=z", "http://a.com/p/?a=1&b=2", "http://a.com?"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(canonical_url("url")).collect()]
    assert got == ["a.com/watch?v=A", "a.com/watch?v=B", "a.com/watch?v=A", "a.com/p?a=1&b=2", "a.com/p?a=1&b=2", "a.com"]


def test_human_labels_without_prediction(spark):
    preds = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.1)], "id long, p int, c double")
    human = spark.createDataFrame([(1, 0), (3, 1)], "id long, h int")
    got = {r.id: (r.route, r.final_quality) for r in ops.review_routing(preds, human, "id", "p", "c", "h", 0.5).collect()}
    assert got == {1: ("corrected", 0), 2: ("review", None), 3: ("human", 1)}


def test_stable_sample_any_key(spark):
    big = spark.range(20000).select((F.col("id") * 100 + (1 << 62)).alias("id"))
    share = big.where(ops.stable_sample("id", 30)).count() / 20000
    assert 0.28 < share < 0.32


def test_bad_row_alone_fails(spark):
    def fn(_, part):
        if part["x"].isna().any():
            raise ValueError("no value")
        return pd.DataFrame({"y": part["x"].to_numpy() * 2})

    df = spark.createDataFrame([(i, None if i == 13 else float(i)) for i in range(40)], "id long, x double").coalesce(1)
    got = {r.id: r for r in infer.infer(df, "twice", lambda: 1, fn, "id long, y double, status string, error string", ["id"]).collect()}
    assert all(got[i].status == "ok" and got[i].y == 2 * i for i in range(40) if i != 13)
    assert got[13].status == "error" and "no value" in got[13].error


def test_changed_word_splits_span(spark):
    words = [f"w{i}" for i in range(60)]
    changed = [*words[:30], "X", *words[31:]]
    docs = spark.createDataFrame([(1, " ".join(changed))], "doc_id long, text string")
    refs = spark.createDataFrame([(9, " ".join(words))], "item_id long, text string")
    got = sorted((r.start, r.length) for r in content.overlap_spans(docs, refs, 8).collect())
    assert got == [(0, 30), (31, 29)]


def test_copies_with_half_the_rows_on_one_text(spark):
    rows = [(i, "same") for i in range(200)] + [(500 + i, f"t{i}") for i in range(199)] + [(900, None), (901, None)]
    got = dict(content.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert all(got[i] == 0 for i in range(200)) and got[500] == 500 and got[900] == got[901] == 900 and len(got) == 401


def test_query_vectors_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, search.vector_topk(df, df, 3).collect()))
    monkeypatch.setattr(search, "QUERY_BLOCK", 7)
    assert sorted(map(tuple, search.vector_topk(df, df, 3).collect())) == whole


def test_null_frame_is_no_signature(spark):
    df = spark.createDataFrame([(1, [5, None]), (2, [5, None]), (3, [5, 5]), (4, [5, 5])], "video_id long, hashes array<long>")
    got = {r.video_id: r.is_unique for r in greedy_leaders(df, PhashSpec(5.0, 1)).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False}


def test_all_object_labels_and_strict_mode(spark, tmp_path):
    from mediasift.sources import fixtures as fx

    probes = fx.probe_documents(spark, "/root/testdata/sf0.001").where("video_id < 40")
    ids = [r.video_id for r in probes.select("video_id").collect()]
    sigs = spark.createDataFrame([(i, [i * 7919 << 20]) for i in ids], "video_id long, hashes array<long>")
    det = spark.createDataFrame([(i, 0, "bicycle" if k % 2 else "person", 0.9) for k, i in enumerate(ids)],
                                "video_id long, frame_idx int, label string, score double")
    bad = spark.createDataFrame([(ids[0], "objects"), (ids[1], "speech")], "video_id long, label_group string")
    cfg = CurateConfig(strict_labels=True)
    res = curate(sigs, probes, cfg, detections=det, failures=bad)
    base = {r.video_id for r in curate(sigs, probes, CurateConfig(), detections=det).records.collect()}
    assert {r.video_id for r in res.records.collect()} == base - {ids[0]}
    write_outputs(res, str(tmp_path / "out"), cfg)
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out/final_labeled_metadata.jsonl")).collect()]
    assert any("bicycle" in (x["ai_objects"] or {}) for x in lines)
    csv = spark.read.option("header", True).csv(str(tmp_path / "out/final_labeled_metadata.csv"))
    assert {"ai_objects_bicycle", "ai_objects_person"} <= set(csv.columns)
    assert labels.object_keys(labels.object_labels(det)) == ["bicycle", "person"]


def test_pairs_keep_copies(spark):
    from mediasift.operators.leaders import fused_matches, similarity_pairs
    from mediasift.operators.simjoin import EmbeddingSpec

    hashes = spark.createDataFrame([(1, [0]), (2, [0]), (3, [1]), (4, [0]), (9, [-1])], "video_id long, hashes array<long>")
    got = {(r.id_a, r.id_b): r.score for r in similarity_pairs(hashes, PhashSpec(5.0, 1)).collect()}
    assert got == {(1, 2): 0.0, (1, 4): 0.0, (1, 3): 1.0}
    rng = np.random.default_rng(1)
    v = rng.normal(size=16)
    vecs = {1: v, 2: v + 1e-4, 3: -v, 4: v, 9: v}  # 1 and 2: one hash, two vectors; 1 and 4: copies in both
    frames = spark.createDataFrame([(i, [x.tolist()]) for i, x in vecs.items()], "video_id long, frames array<array<double>>")
    pairs = {(r.id_a, r.id_b) for r in fused_matches(hashes, PhashSpec(5.0, 1), frames, EmbeddingSpec(0.95, 64, 8)).collect()}
    assert pairs == {(1, 2), (1, 4)}
