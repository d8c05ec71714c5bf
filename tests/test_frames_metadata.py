import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediasift.operators import frames as fr
from mediasift.operators import metadata as md


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 10, 16])
def test_sample_indices_equal_numpy_linspace(spark, k):
    ns = [0, 1, 2, 3, 5, 7, 16, 17, 100, 999, 19999]
    df = spark.createDataFrame([(n,) for n in ns], "n int")
    got = {r.n: r.i for r in df.select("n", fr.sample_indices("n", k, True).alias("i")).collect()}
    rep = {r.n: r.i for r in df.select("n", fr.sample_indices("n", k, False).alias("i")).collect()}
    for n in ns:
        if n <= 0:
            assert got[n] == [0] and rep[n] == []
            continue
        kk = min(k, n)
        want = sorted(set(np.linspace(0, n - 1, num=kk, dtype=int).tolist()))
        assert got[n] == want, (n, k)
        assert rep[n] == np.linspace(0, n - 1, num=k, dtype=int).tolist(), (n, k)


def test_missing_frame_falls_back_to_next(spark):
    vids = spark.createDataFrame([(1, 5), (2, 5), (3, 0)], "video_id long, n_frames int")
    # video 1: index 2 missing, 3 present -> fallback to 3;
    # video 2: 2 and 3 missing -> index 2 skipped, index 3 falls back to 4
    frames = spark.createDataFrame([(1, i) for i in (0, 1, 3, 4)] + [(2, i) for i in (0, 1, 4)],
                                   "video_id long, frame_idx int")
    got = sorted((r.video_id, r.pos, r.frame_idx) for r in fr.sample_frames(vids, frames, 5).collect())
    assert got == [(1, 0, 0), (1, 1, 1), (1, 2, 3), (1, 3, 3), (1, 4, 4),
                   (2, 0, 0), (2, 1, 1), (2, 2, 4), (2, 3, 4)]
    rep = {r.video_id: r.frame_idx for r in fr.representative(fr.sample_frames(vids, frames, 5)).collect()}
    assert rep == {1: 3, 2: 4}
    # 16 of 3 frames: repeats, and only complete videos
    v3 = spark.createDataFrame([(9, 3)], "video_id long, n_frames int")
    f3 = spark.createDataFrame([(9, 0), (9, 1), (9, 2)], "video_id long, frame_idx int")
    act = sorted(r.frame_idx for r in fr.action_frames(v3, f3, 16).collect())
    assert len(act) == 16 and set(act) == {0, 1, 2}
    assert fr.action_frames(v3, f3.where("frame_idx < 2"), 16).count() == 0


def _probe(streams, fmt):
    return json.dumps({"streams": streams, "format": fmt})


def test_probe_edge_rows(spark):
    v = {"codec_type": "video", "codec_name": "h264", "width": 640, "height": 360,
         "avg_frame_rate": "30000/1001", "duration": "12.5", "bit_rate": "800000"}
    a = {"codec_type": "audio", "codec_name": "aac", "channels": 2, "sample_rate": "44100", "bit_rate": "128000"}
    f = {"format_name": "mov,mp4", "duration": "12.5", "size": "1450000"}
    rows = [
        (1, "/a/x.mp4", _probe([v, a], f)),
        (2, "/a/noaudio.mp4", _probe([v], f)),
        (3, "/a/novideo.mp4", _probe([a], f)),
        (4, "/a/zero.mp4", _probe([dict(v, avg_frame_rate="0/0")], f)),
        (5, "/a/missing_rate.mp4", _probe([{k: x for k, x in v.items() if k != "avg_frame_rate"}], f)),
        (6, "/a/fmt_dur.mp4", _probe([{k: x for k, x in v.items() if k != "duration"}], dict(f, duration="0.5"))),
        (7, "/a/w319.mp4", _probe([dict(v, width=319)], f)),
        (8, "/a/w320.mp4", _probe([dict(v, width=320)], f)),
        (9, "/a/wnull.mp4", _probe([{k: x for k, x in v.items() if k != "width"}], f)),
        (10, "/a/bad.mp4", '{"streams": ['),
    ]
    df = spark.createDataFrame(rows, "video_id long, path string, probe_json string")
    got = {r.video_id: r for r in md.extract_metadata(df).collect()}
    assert got[1].status == "ok" and got[1].filename == "x.mp4"
    assert abs(got[1].avg_frame_rate - 30000 / 1001) < 1e-12 and got[1].audio_bit_rate == 128000
    assert got[1].audio_sample_rate == "44100" and got[1].file_size_bytes == 1450000
    assert got[2].audio_codec is None and got[2].audio_bit_rate == 0
    assert got[3].status == "no_video"
    assert got[4].status == "ok" and got[4].avg_frame_rate is None
    assert got[5].avg_frame_rate == 0.0
    assert got[6].duration_seconds == 0.5 and got[6].quality_flag_short
    assert got[7].quality_flag_low_res and not got[8].quality_flag_low_res
    assert got[9].width is None and not got[9].quality_flag_low_res
    assert got[10].status == "invalid"


def test_shot_segments_and_chunks(spark):
    rows = [(1, 0, [1.0, 0.0]), (1, 1, [0.99, 0.1]), (1, 2, [0.0, 1.0]), (1, 3, [0.1, 0.99])]
    df = spark.createDataFrame(rows, "video_id long, frame_idx int, embedding array<double>")
    seg = sorted((r.segment, r.first_frame, r.last_frame) for r in fr.shot_segments(df, 0.5).collect())
    assert seg == [(0, 0, 1), (1, 2, 3)]
    items = spark.createDataFrame([(1, 12.0), (2, 0.0), (3, 5.0)], "id long, d double")
    ch = sorted((r.id, r.chunk, r.start_s, r.end_s) for r in fr.chunks(items, "id", "d", 5.0).collect())
    assert ch == [(1, 0, 0.0, 5.0), (1, 1, 5.0, 10.0), (1, 2, 10.0, 12.0), (3, 0, 0.0, 5.0)]
