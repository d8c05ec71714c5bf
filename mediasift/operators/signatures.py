"""Perceptual hash of luma frames (F4) as a Spark job.

pHash: unnormalised 2-D DCT-II of an n x n luma image, keep the top-left
``hash_size`` x ``hash_size`` coefficients, bit = coefficient > their median,
bits read row-major with the first as the most significant. The DCT is two
matrix products per image, done with numpy over Arrow batches inside
``mapInPandas``; frames are spread over tasks by Spark, nothing is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dct_matrix(n: int) -> np.ndarray:
    """C[k, m] = 2 cos(pi k (2m + 1) / (2n)) (unnormalised DCT-II)."""
    k = np.arange(n)[:, None]
    m = np.arange(n)[None, :]
    return 2.0 * np.cos(np.pi * k * (2 * m + 1) / (2 * n))


def phash_bits(images: np.ndarray, hash_size: int) -> np.ndarray:
    """(b, n, n) luma -> (b, hash_size*hash_size) booleans."""
    n = images.shape[-1]
    c = dct_matrix(n)
    coef = np.einsum("km,bmj,lj->bkl", c, images, c)[:, :hash_size, :hash_size]
    flat = coef.reshape(len(images), -1)
    med = np.median(flat, axis=1, keepdims=True)
    return flat > med


def pack_bits(bits: np.ndarray) -> np.ndarray:
    """Row of 64 booleans -> signed int64, first bit most significant."""
    weights = np.left_shift(np.uint64(1), np.arange(bits.shape[1] - 1, -1, -1, dtype=np.uint64))
    return (bits.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64).view(np.int64)


def dct_hash(frames: DataFrame, id_col: str, luma_col: str, hash_size: int = 8) -> DataFrame:
    """(id, hash BIGINT, hash_hex) for frames whose luma is a square image (flattened)."""
    if hash_size * hash_size > 64:
        raise ValueError("hash_size up to 8 fits one BIGINT")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            sizes = pdf[luma_col].map(len).to_numpy()
            out = []
            for s in np.unique(sizes):
                sel = sizes == s
                n = int(round(s ** 0.5))
                if n * n != s or n < hash_size:
                    out.append(pd.DataFrame({"id": pdf[id_col][sel].to_numpy(), "hash": None}))
                    continue
                imgs = np.stack(pdf[luma_col][sel].to_numpy()).astype(np.float64).reshape(-1, n, n)
                out.append(pd.DataFrame({"id": pdf[id_col][sel].to_numpy(),
                                         "hash": pack_bits(phash_bits(imgs, hash_size))}))
            yield pd.concat(out, ignore_index=True)

    res = frames.select(id_col, luma_col).mapInPandas(run, "id long, hash long")
    return res.select(F.col("id").alias(id_col), "hash",
                      F.lpad(F.lower(F.hex("hash")), 16, "0").alias("hash_hex"))
