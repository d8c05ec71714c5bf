"""Frames to duplicates in one call (F1, F4, F5, J3): sample, hash or embed, signature, greedy leaders.

Frames are (video, frame_idx, luma), luma a square image read row by row. Per video ``k`` evenly spaced frames are
read (a missing index takes the next frame, else its position is left out). A frame that is there but can't be hashed
or embedded (null or empty luma, no square, null or non-finite pixels, a model's error) fails its whole video: the
signature is null, as it is for a video without any frame, and such videos follow ``on_missing``. Repeated frame rows
count once (the smallest result); ``videos`` must be one row per id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasift.operators.frames import sample_indices
from mediasift.operators.infer import infer
from mediasift.operators.leaders import greedy_leaders
from mediasift.operators.signatures import dct_matrix
from mediasift.operators.simjoin import EmbeddingSpec, PhashSpec

FRAMES_AT_ONCE = 256  # images a task stacks; a batch of Arrow rows may hold many more


def sampled(videos: DataFrame, frames: DataFrame, k: int, luma_col: str = "luma", id_col: str = "video_id",
            n_col: str = "n_frames") -> DataFrame:
    """(id, pos, later, luma): per sampled position the frame itself (later 0) and the next one (later 1), if there.

    One pass over ``frames``: a position asks for both indices, the choice follows after the join.
    """
    want = (videos.select(F.col(id_col).alias("id"), F.posexplode(sample_indices(n_col, k, True)).alias("pos", "i"))
            .select("id", "pos", F.posexplode(F.array(F.col("i"), F.col("i") + 1)).alias("later", "i")))
    fr = frames.select(F.col(id_col).alias("v"), F.col("frame_idx").alias("f"), F.col(luma_col).alias("luma"))
    # merge: the wanted positions, several of a video, are estimated as one row of it and would be broadcast
    return want.hint("merge").join(fr, (F.col("id") == F.col("v")) & (F.col("i") == F.col("f"))).select("id", "pos", "later", "luma")


def square(luma) -> np.ndarray | None:
    """The image as an n x n array, None if it is no full square of finite pixels."""
    if luma is None or not len(luma):
        return None
    flat = np.asarray(luma, dtype=np.float64)
    n = int(round(len(flat) ** 0.5))
    return flat.reshape(n, n) if n * n == len(flat) and np.isfinite(flat).all() else None


def area_weights(n: int, m: int) -> np.ndarray:
    """m x n matrix that averages n pixels into m equal stretches (pixels cut by a border count in part)."""
    edges = np.arange(m + 1) * (n / m)
    lo, hi = edges[:-1, None], edges[1:, None]
    cover = np.minimum(hi, np.arange(1, n + 1)) - np.maximum(lo, np.arange(n))
    return np.clip(cover, 0.0, None) * (m / n)


def words_of(hash_size: int) -> int:
    """64-bit words of a hash, rounded up to a power of two so that a threshold by word has no rounding."""
    need = -(-hash_size * hash_size // 64)
    return 1 << (need - 1).bit_length()


def wide_hashes(images: np.ndarray, hash_size: int) -> np.ndarray:
    """(b, n, n) luma -> (b, words) int64: DCT of the image reduced to 4 x hash_size, low corner against its median."""
    n, side = images.shape[-1], 4 * hash_size
    c = dct_matrix(side)[:hash_size]
    c = c if n == side else c @ area_weights(n, side)
    coef = np.einsum("km,bmj,lj->bkl", c, images, c, optimize=True).reshape(len(images), -1)
    bits = coef > np.median(coef, axis=1, keepdims=True)
    words = words_of(hash_size)
    padded = np.zeros((len(images), words * 64), dtype=bool)
    padded[:, :bits.shape[1]] = bits
    return np.packbits(padded, axis=1).view(">u8").astype(np.uint64).view(np.int64).reshape(len(images), words)


def frame_hashes(reads: DataFrame, hash_size: int) -> DataFrame:
    """(id, pos, later, value ARRAY<BIGINT>), null where the frame can't be hashed."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), FRAMES_AT_ONCE):
                part = pdf.iloc[at:at + FRAMES_AT_ONCE]
                images = [square(x) for x in part["luma"]]
                value: list = [None] * len(images)
                for n in {len(im) for im in images if im is not None}:
                    rows = [i for i, im in enumerate(images) if im is not None and len(im) == n]
                    for i, h in zip(rows, wide_hashes(np.stack([images[i] for i in rows]), hash_size)):
                        value[i] = h.tolist()
                yield part[["id", "pos", "later"]].assign(value=value)

    kind = reads.schema["id"].dataType.simpleString()
    return reads.mapInPandas(run, f"id {kind}, pos int, later int, value array<long>")


def frame_vectors(reads: DataFrame, name: str, loader: Callable[[], object],
                  encode: Callable[[object, np.ndarray], np.ndarray]) -> DataFrame:
    """(id, pos, later, value ARRAY<DOUBLE>): ``encode(model, image)`` per frame; null where it fails."""
    def fn(model, part: pd.DataFrame) -> pd.DataFrame:
        images = [square(x) for x in part["luma"]]
        if any(im is None for im in images):
            raise ValueError("no square luma image")
        return pd.DataFrame({"value": [np.asarray(encode(model, im), dtype=np.float64).tolist() for im in images]})

    kind = reads.schema["id"].dataType.simpleString()
    return infer(reads, name, loader, fn, f"id {kind}, pos int, later int, value array<double>, status string",
                 keep=["id", "pos", "later"], batch_size=FRAMES_AT_ONCE).drop("status")


def signatures(videos: DataFrame, values: DataFrame, sig_col: str, id_col: str = "video_id") -> DataFrame:
    """(id, sig): the values of a video's positions in order; null if one failed or none was read."""
    read = values.groupBy("id", "pos").agg(F.min(F.struct("later", "value")).alias("m"))
    sig = read.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("m.value").alias("value")))).alias("s"))
    sig = sig.select("id", F.when(~F.exists("s", lambda x: x["value"].isNull()),
                                  F.transform("s", lambda x: x["value"])).alias(sig_col))
    ids = videos.select(F.col(id_col).alias("id"))
    return ids.join(sig.hint("merge"), "id", "left").select(F.col("id").alias(id_col), sig_col)


def phash_duplicates(videos: DataFrame, frames: DataFrame, k: int = 5, hash_size: int = 8, threshold: float = 5.0,
                     on_missing: str = "keep", luma_col: str = "luma", id_col: str = "video_id") -> DataFrame:
    """Greedy leaders by mean Hamming distance of the frames' hashes, for any ``hash_size``.

    A hash of w words counts as w positions: the mean over words, times w, is the mean over frames.
    """
    words = words_of(hash_size)
    values = frame_hashes(sampled(videos, frames, k, luma_col, id_col), hash_size)
    sigs = signatures(videos, values, "hashes", id_col).withColumn("hashes", F.flatten("hashes"))
    found = greedy_leaders(sigs, PhashSpec(threshold=threshold / words, radius=2), id_col, on_missing=on_missing)
    return found.withColumn("score", F.col("score") * words)


def embedding_duplicates(videos: DataFrame, frames: DataFrame, name: str, loader: Callable[[], object],
                         encode: Callable[[object, np.ndarray], np.ndarray], k: int = 5, threshold: float = 0.95,
                         spec=None, on_missing: str = "keep", luma_col: str = "luma", id_col: str = "video_id") -> DataFrame:
    """Greedy leaders by mean cosine of the frames' vectors. ``spec`` (default: hashing bands) names the join."""
    values = frame_vectors(sampled(videos, frames, k, luma_col, id_col), name, loader, encode)
    sigs = signatures(videos, values, "frames", id_col)
    return greedy_leaders(sigs, spec or EmbeddingSpec(threshold=threshold), id_col, on_missing=on_missing)


# -- a small encoder without weights, for use where no model is at hand --------

def patch_loader(side: int) -> Callable[[], int]:
    return lambda: side


def patch_means(side: int, image: np.ndarray) -> np.ndarray:
    """Means of side x side equal patches, less the image's mean."""
    w = area_weights(len(image), side)
    v = (w @ image @ w.T).reshape(-1)
    return v - v.mean()
