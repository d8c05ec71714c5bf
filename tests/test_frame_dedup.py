"""Frames to duplicates: hashes of any size against direct formulas, failed frames, missing frames, greedy loop."""

import numpy as np
import pytest
from mediasift.operators import frame_dedup as fd
from mediasift.operators.metric_join import ExactEmbeddingSpec


def _direct_bits(img, hs):
    """Bits by sums over pixels; the image first averaged pixel by pixel into 4 hs x 4 hs."""
    n, side = len(img), 4 * hs
    big = np.repeat(np.repeat(img, side, 0), side, 1)  # n*side square: both grids divide it
    small = big.reshape(side, n, side, n).mean(axis=(1, 3))
    m = np.arange(side)
    coef = [sum(2 * np.cos(np.pi * k * (2 * m[a] + 1) / (2 * side)) * float((small[a] * 2 * np.cos(np.pi * j * (2 * m + 1) / (2 * side))).sum())
                for a in range(side)) for k in range(hs) for j in range(hs)]
    return [c > np.median(coef) for c in coef]


def _bits(words, n):
    return [bool((int(w) & 0xFFFFFFFFFFFFFFFF) >> (63 - i) & 1) for w in words for i in range(64)][:n]


@pytest.mark.parametrize("hs,n", [(8, 32), (8, 50), (12, 20), (16, 64)])
def test_hash_of_any_size(hs, n):
    img = np.random.default_rng(hs * n).integers(0, 256, (n, n)).astype(float)
    words = fd.wide_hashes(img[None], hs)[0]
    assert len(words) == fd.words_of(hs)
    assert _bits(words, hs * hs) == _direct_bits(img, hs)


def _case():
    """Videos of noise images; 10 is 1 with a weak change, 11 a copy; 4 lacks a frame, 5 has a broken one, 6 none."""
    rng = np.random.default_rng(5)
    base = {v: [rng.integers(0, 256, 32 * 32) for _ in range(5)] for v in (1, 2, 3, 4, 5)}
    base[10] = [np.clip(x + rng.integers(-3, 4, len(x)), 0, 255) for x in base[1]]
    base[11] = base[1]
    rows = [(v, i, [int(p) for p in x]) for v, xs in base.items() for i, x in enumerate(xs)]
    rows = [r for r in rows if (r[0], r[1]) not in {(4, 2), (4, 4)}]
    rows = [(v, i, None if (v, i) == (5, 2) else x) for v, i, x in rows] + [rows[0]]  # one row comes twice
    return sorted({*base, 6}), rows


def _frames(spark):
    ids, rows = _case()
    return (spark.createDataFrame([(v, 5) for v in ids], "video_id long, n_frames int"),
            spark.createDataFrame(rows, "video_id long, frame_idx int, luma array<int>"), rows)


def test_phash_duplicates_equal_the_loop(spark):
    videos, frames, rows = _frames(spark)
    img = {(v, i): x for v, i, x in rows}
    sig = {}
    for v in (1, 2, 3, 4, 10, 11):
        got = [img.get((v, i), img.get((v, i + 1))) for i in (0, 2, 4)]
        sig[v] = [_direct_bits(np.array(x, dtype=float).reshape(32, 32), 12) for x in got if x is not None]
    assert len(sig[4]) == 2  # index 2 falls back to 3, index 4 has no next frame
    leaders, want = [], {5: (5, None), 6: (6, None)}  # failed: kept as unique
    for v in sorted(sig):
        scores = [(np.mean([sum(a != b for a, b in zip(x, y)) for x, y in zip(sig[v], sig[w])]), w)
                  for w in leaders if len(sig[w]) == len(sig[v])]
        best = min([s for s in scores if s[0] <= 14], default=None)
        want[v] = (v, None) if best is None else (best[1], round(best[0], 6))
        leaders += [v] if best is None else []
    out = fd.phash_duplicates(videos, frames, 3, 12, 14.0).collect()
    assert {r["video_id"]: (r["primary_id"], None if r["score"] is None else round(r["score"], 6)) for r in out} == want
    assert want[10][0] == 1 and want[11] == (1, 0.0)
    dropped = fd.phash_duplicates(videos, frames, 3, 12, 14.0, on_missing="drop")
    assert {r["video_id"] for r in dropped.collect()} == set(sig)


def test_embedding_duplicates_and_failing_model(spark):
    videos, frames, rows = _frames(spark)
    bad = np.array(next(x for v, i, x in rows if (v, i) == (2, 0)), dtype=float).reshape(32, 32)
    patch_means = fd.patch_means

    def encode(side, image):
        if (image == bad).all():
            raise RuntimeError("broken")
        return patch_means(side, image)

    out = fd.embedding_duplicates(videos, frames, "patches-test", fd.patch_loader(8), encode, 3,
                                  spec=ExactEmbeddingSpec(threshold=0.95), on_missing="drop")
    got = {r["video_id"]: r["primary_id"] for r in out.collect()}
    assert 2 not in got and 5 not in got and 6 not in got
    assert got[10] == 1 and got[11] == 1 and got[3] == 3 and got[4] == 4


def test_empty_tables(spark):
    videos, frames, _ = _frames(spark)
    assert fd.phash_duplicates(videos.limit(0), frames, 3).count() == 0
    assert fd.phash_duplicates(videos, frames.limit(0), 3).where("is_unique").count() == videos.count()
