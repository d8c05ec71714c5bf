"""Greedy dedup on verified edges (radius 2, shared frames, hot near copies) and the label record."""

import random

import pytest
from pyspark.sql import functions as F

from brute import phash_score, sequential_greedy
from mediasift.operators import labels as lb
from mediasift.operators import leaders as ld
from mediasift.operators.simjoin import PhashSpec, candidate_pairs, shared_keys
from mediasift.plans.pipeline import CurateConfig, curate, render_sentinels
from test_leaders import SIG, _flip, _same


def _greedy(spark, rows, spec, **kw):
    df = spark.createDataFrame(rows, SIG)
    got = {r.video_id: (r.primary_id, r.score, r.is_unique) for r in ld.greedy_leaders(df, spec, **kw).collect()}
    return got, sequential_greedy(sorted(rows), phash_score, lambda s: s <= spec.threshold, lambda a, b: a < b)


@pytest.mark.parametrize("nf,threshold", [(1, 5.0), (5, 5.0), (3, 0.0), (2, 40.0)])
def test_bands_cover_every_bit_once_and_meet_the_pigeonhole(nf, threshold):
    for radius in (0, 1, 2):
        spec = PhashSpec(threshold, radius)
        nb = spec.bands(nf)
        masks, band, flip = spec._layout(nf, True)
        assert nb * (radius + 1) > int(threshold * nf) and nb >= nf
        for b in range(nb):          # the masked frames of a band do not overlap
            seen = 0
            for f in range(nf):
                m = int(masks[(b + f) % nb])
                assert seen & m == 0
                seen |= m
        assert all(sum(int(masks[(b + f) % nb]) >> i & 1 for b in range(nb)) == 1 for f in range(nf) for i in range(64))
        assert len(band) == nb + 64 * nf and (flip[:nb] == 0).all()


@pytest.mark.parametrize("small_bucket", [1, 64])
def test_radius_two_matches_sequential(spark, small_bucket):
    rnd = random.Random(21)
    rows = []
    for _ in range(30):
        base = [rnd.getrandbits(64) for _ in range(3)]
        for d in (0, 3, 5, 9):
            rows.append([_flip(x, rnd.sample(range(64), rnd.randint(0, d))) if d else _flip(x, []) for x in base])
        rows.append(rows[-2])                     # an exact copy of a near copy
    rnd.shuffle(rows)
    got, want = _greedy(spark, list(enumerate(rows)), PhashSpec(5.0, 2), small_bucket=small_bucket)
    _same(got, want)
    assert any(not u for _, _, u in got.values())


def test_shared_frame_adds_no_rounds_and_no_candidates(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, [0] + [rnd.getrandbits(64) - (1 << 63) for _ in range(4)]) for i in range(500)]
    rows += [(1000 + i, [_flip(h + (1 << 64) if h < 0 else h, [i, i + 9]) for h in rows[i][1]]) for i in range(20)]
    names = []
    write = ld.materialize
    monkeypatch.setattr(ld, "materialize", lambda df, name="t": names.append(name) or write(df, name))
    got, _ = _greedy(spark, rows, PhashSpec(5.0, 2))
    assert all(got[1000 + i][0] == i and got[1000 + i][1] == 2.0 for i in range(20))
    assert sum(u for _, _, u in got.values()) == 500
    assert names.count("state") <= 2 and "near" not in names          # the first state and one round
    items = ld.prepare_items(spark.createDataFrame(rows, SIG), PhashSpec(5.0, 2))
    keys = shared_keys(items, PhashSpec(5.0, 2))
    assert candidate_pairs(keys, keys).where("a < b").count() < 100


def test_hot_near_copies_are_thinned_not_paired(spark, monkeypatch):
    rnd = random.Random(8)
    base = rnd.getrandbits(64)
    rows = [(i, [_flip(base, rnd.sample(range(64), 2)), i % 7]) for i in range(300)]
    sizes = []
    write = ld.materialize
    monkeypatch.setattr(ld, "materialize", lambda df, name="t": sizes.append((name, write(df, name))) or sizes[-1][1])
    got, want = _greedy(spark, rows, PhashSpec(5.0, 2), small_bucket=32)
    _same(got, want)
    near = sum(df.count() for name, df in sizes if name == "near")
    assert 0 < near < 300 * 90 and sum(df.count() for name, df in sizes if name == "edges") < 300 * 300 / 4


def test_status_per_group_and_sentinels(spark):
    rnd = random.Random(2)
    sigs = spark.createDataFrame([(i, [rnd.getrandbits(63)]) for i in range(1, 5)], SIG)
    probe = ('{"streams":[{"codec_type":"video","codec_name":"h264","width":640,"height":360,'
             '"avg_frame_rate":"25/1","duration":"9.0"}],"format":{"format_name":"mp4","duration":"9.0","size":"10"}}')
    probes = spark.createDataFrame([(i, f"/m/{i}.mp4", probe) for i in range(1, 5)],
                                   "video_id long, path string, probe_json string")
    logits = spark.createDataFrame([(1, "run", 3.0), (2, "swim", 2.0)], "video_id long, label string, logit double")
    prompts = spark.createDataFrame([("scene_type", 0, "beach", [1.0, 0.0]), ("scene_type", 1, "forest", [0.0, 1.0]),
                                     ("scene_type", 2, "late tie", [0.0, 2.0]), ("environment", 0, "daytime", [1.0, 1.0]),
                                     ("visual_style", 0, "calm", [1.0, 0.0]), ("mood_estimation", 0, "warm", [1.0, 0.0])],
                                    "`group` string, idx int, label string, embedding array<double>")
    vecs = spark.createDataFrame([(1, [0.1, 3.0]), (2, [0.0, 0.0]), (3, None)], "video_id long, v array<double>")
    scenes = lb.zero_shot_groups(vecs, prompts, "video_id", "v")
    assert {r.video_id: r.scene_type for r in scenes.collect()} == {1: "forest", 2: "beach", 3: None}
    bad = spark.createDataFrame([(2, "actions")], "video_id long, label_group string")
    res = curate(sigs, probes, CurateConfig(), logits=logits, scenes=scenes, failures=bad)
    got = {r.video_id: r for r in render_sentinels(res.records).collect()}
    assert [got[i].status_actions for i in (1, 2, 3)] == ["ok", "error", "no_input"]
    assert [got[i].ai_actions[0] for i in (1, 2, 3)] == ["run", "[Action recognition error]",
                                                         "[Action recognition failed: Not enough frames]"]
    assert [got[i].ai_scene_type for i in (1, 3, 4)] == ["forest", *["[Scene classification failed: No frames]"] * 2]
    assert got[1].ai_caption == "[Captioning unavailable]" and got[1].ai_sound_events == ["[Audio analysis unavailable]"]
    assert got[1].ai_visual_style == "calm" and got[4].ai_mood_estimation == "[Unavailable]"
    strict = curate(sigs, probes, CurateConfig(strict_labels=True), logits=logits, scenes=scenes, failures=bad)
    assert sorted(r.video_id for r in strict.records.select("video_id").collect()) == [1, 3, 4]
    assert curate(sigs.limit(0), probes, CurateConfig(), logits=logits).records.where(F.lit(True)).count() == 0
