"""Similarity joins over video signatures (pHash lists or frame-embedding lists).

A theta join "score(a, b) within threshold" is turned into an equi-join on band
keys followed by an exact verification of the full score:

* pHash (mean positional Hamming <= t): lossless. A pair within the threshold
  has a total distance <= T = floor(t * n_frames) over n_frames * 64 bits. The
  bits are dealt to B bands, bit i of frame f to band (i - f) mod B, so every
  band mixes all frames: a frame shared by many clips (black, titles) equals no
  band by itself, and as B >= n_frames the masked frames of a band fit one
  64-bit value without overlap. If B * (radius + 1) > T, some band differs in at
  most ``radius`` bits (pigeonhole). ``radius=0`` compares bands as they are,
  ``radius=1`` flips each bit of the probe's bands, ``radius=2`` flips one bit
  on both sides and meets in the middle: 9 bands of about 35 bits for 5 frames
  at t=5, so about ten chance candidates per item among 100 M.
* Embeddings (mean diagonal cosine >= t): the score equals one dot product of
  the concatenated, frame-normalised vectors scaled by 1/sqrt(n_frames).
  Candidates come from random-hyperplane (SimHash) bands computed with numpy
  inside ``mapInPandas``; ``expected_recall`` states the recall at a score.

Each spec exposes the same small interface so the greedy leader operator and
the pair join do not depend on the method.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasift.functions.bits import HASH_BITS, total_hamming
from mediasift.functions.vectors import dot, norm
from mediasift.session import materialize

KEYS_PER_FRAME = 1 << 20      # keys made at once in a task
BLOCK = 2048                  # holders of a key that one task pairs with each other


def written(df: DataFrame, name: str) -> DataFrame:
    """A table of items, keys, edges or states, written and joined by merge.

    Such tables grow with the input, and a written file's compressed size, cut to a few columns,
    says little of what its rows take in memory: unhinted they are sent whole through the driver.
    """
    return materialize(df, name).hint("merge")


def _key_schema(prepared: DataFrame) -> str:
    return f"id {prepared.schema['id'].dataType.simpleString()}, key long"


def _mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64 arrays (wrapping arithmetic)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class PhashSpec:
    """Mean Hamming distance over frame positions, match when <= threshold."""

    threshold: float = 5.0
    radius: int = 0
    sig_col: str = "hashes"
    name: str = "phash"

    def __post_init__(self):
        if self.radius not in (0, 1, 2):
            raise ValueError("radius must be 0, 1 or 2")
        if not 0 <= self.threshold < HASH_BITS:
            raise ValueError("threshold must be in [0, 64)")

    # -- signature preparation -------------------------------------------------
    def prepare(self, items: DataFrame) -> DataFrame:
        """Adds ``sig`` (the compared value), ``nf`` and ``self_match``."""
        return (items.withColumn("sig", F.col(self.sig_col))
                .withColumn("nf", F.size("sig"))
                .withColumn("self_match", F.col("nf") > 0))

    def bands(self, nf: int) -> int:
        """Number of bands of a signature of ``nf`` frames."""
        return max(nf, math.floor(self.threshold * nf) // (self.radius + 1) + 1)

    def _layout(self, nf: int, flips: bool):
        """(mask of each residue, band of each key, bit flipped in each key)."""
        nb = self.bands(nf)
        masks = np.zeros(nb, dtype=np.uint64)
        band, flip = list(range(nb)), [0] * nb
        for i in range(HASH_BITS):
            masks[i % nb] |= np.uint64(1 << i)
            if flips:
                for f in range(nf):
                    band.append((i - f) % nb)
                    flip.append(1 << i)
        return masks, np.array(band), np.array(flip, dtype=np.uint64)

    def _keys(self, prepared: DataFrame, flips: bool) -> DataFrame:
        def keys(batches):
            layouts = {}
            for pdf in batches:
                sizes = pdf["sig"].map(len).to_numpy(dtype=np.int64)
                for nf in np.unique(sizes[sizes > 0]):
                    nf = int(nf)
                    if nf not in layouts:
                        layouts[nf] = self._layout(nf, flips)
                    masks, band, flip = layouts[nf]
                    nb = len(masks)
                    salt = _mix64(np.uint64(nf << 32) + band.astype(np.uint64) + np.uint64(1))
                    group = pdf[sizes == nf]
                    step = max(1, KEYS_PER_FRAME // len(band))
                    for at in range(0, len(group), step):
                        part = group.iloc[at:at + step]
                        sig = np.stack(part["sig"].to_numpy()).astype(np.int64).view(np.uint64)
                        value = np.zeros((len(part), nb), dtype=np.uint64)
                        for f in range(nf):
                            value ^= sig[:, f:f + 1] & masks[(np.arange(nb) + f) % nb]
                        key = _mix64((value[:, band] ^ flip) ^ salt)
                        yield pd.DataFrame({"id": np.repeat(part["id"].to_numpy(), len(band)),
                                            "key": key.reshape(-1).view(np.int64)})

        return prepared.select("id", "sig").mapInPandas(keys, _key_schema(prepared))

    def index_keys(self, prepared: DataFrame) -> DataFrame:
        return self._keys(prepared, self.radius == 2)

    def probe_keys(self, prepared: DataFrame) -> DataFrame:
        return self._keys(prepared, self.radius > 0)

    @property
    def probe_is_index(self) -> bool:
        return self.radius != 1

    # -- scoring ---------------------------------------------------------------
    def comparable(self, a: Column, b: Column) -> Column:
        return (F.size(a) == F.size(b)) & (F.size(a) > 0)

    def score(self, a: Column, b: Column) -> Column:
        return total_hamming(a, b) / F.size(a)

    def is_match(self, score: Column) -> Column:
        return score <= F.lit(float(self.threshold))

    def badness(self, score: Column) -> Column:
        return score


@dataclass(frozen=True)
class EmbeddingSpec:
    """Mean diagonal cosine over frames, match when >= threshold.

    ``bands`` x ``bits_per_band`` random hyperplanes (seeded, regenerated inside
    each Python worker, so nothing is broadcast) give the candidate keys.
    """

    threshold: float = 0.95
    bands: int = 32
    bits_per_band: int = 12
    seed: int = 17
    sig_col: str = "frames"
    name: str = "embedding"

    def expected_recall(self, score: float | None = None) -> float:
        s = self.threshold if score is None else score
        p = 1.0 - math.acos(max(-1.0, min(1.0, s))) / math.pi
        return 1.0 - (1.0 - p ** self.bits_per_band) ** self.bands

    def prepare(self, items: DataFrame) -> DataFrame:
        frames = F.col(self.sig_col)
        nf = F.size(frames)
        # u = concat(frame / |frame|) / sqrt(nf): score(a, b) = u_a . u_b
        normed = F.transform(frames, lambda fr: F.struct(fr.alias("v"), norm(fr).alias("n")))
        scale = F.sqrt(nf.cast("double"))
        unit = F.flatten(F.transform(normed, lambda s: F.transform(
            s["v"], lambda x: F.when(s["n"] > 0, x / s["n"] / scale).otherwise(F.lit(0.0)))))
        nonzero = F.size(F.filter(normed, lambda s: s["n"] > 0))
        return (items.withColumn("nf", nf)
                .withColumn("sig", unit)
                .withColumn("self_match", (F.col("nf") > 0) &
                            (nonzero / F.col("nf") >= F.lit(float(self.threshold)))))

    def index_keys(self, prepared: DataFrame) -> DataFrame:
        bands, width, seed = self.bands, self.bits_per_band, self.seed

        def keys(batches):
            planes_by_dim: dict[int, np.ndarray] = {}
            for pdf in batches:
                out_ids, out_keys = [], []
                if len(pdf):
                    dims = pdf["sig"].map(len).to_numpy()
                    for d in np.unique(dims):
                        sel = dims == d
                        if d == 0:
                            continue
                        if d not in planes_by_dim:
                            rng = np.random.default_rng([seed, int(d)])
                            planes_by_dim[d] = rng.standard_normal((int(d), bands * width))
                        mat = np.stack(pdf["sig"][sel].to_numpy())
                        bits = (mat @ planes_by_dim[d]) > 0
                        weights = np.left_shift(np.uint64(1), np.arange(width, dtype=np.uint64))
                        vals = (bits.reshape(len(mat), bands, width).astype(np.uint64) * weights).sum(axis=2)
                        nf = pdf["nf"][sel].to_numpy().astype(np.uint64)
                        band_idx = np.arange(bands, dtype=np.uint64)
                        k = _mix64(vals ^ _mix64(band_idx[None, :] * np.uint64(1 << 32) + np.uint64(d))
                                   ^ _mix64(nf[:, None] + np.uint64(0x9E3779B97F4A7C15)))
                        out_ids.append(np.repeat(pdf["id"][sel].to_numpy(), bands))
                        out_keys.append(k.reshape(-1).view(np.int64))
                if out_ids:
                    yield pd.DataFrame({"id": np.concatenate(out_ids), "key": np.concatenate(out_keys)})

        return prepared.select("id", "nf", "sig").mapInPandas(keys, _key_schema(prepared))

    def probe_keys(self, prepared: DataFrame) -> DataFrame:
        return self.index_keys(prepared)

    probe_is_index = True

    def comparable(self, a: Column, b: Column) -> Column:
        return (F.size(a) == F.size(b)) & (F.size(a) > 0)

    def score(self, a: Column, b: Column) -> Column:
        return dot(a, b)

    def is_match(self, score: Column) -> Column:
        return score >= F.lit(float(self.threshold))

    def badness(self, score: Column) -> Column:
        return -score


Spec = PhashSpec | EmbeddingSpec


def verify_pairs(cands: DataFrame, sigs: DataFrame, spec: Spec,
                 a: str = "a", b: str = "b") -> DataFrame:
    """Attach the exact score to candidate pairs and keep matches.

    ``cands`` has columns ``a``, ``b`` (ids); ``sigs`` has ``id``, ``sig``.
    Returns the candidate columns plus ``score``.
    """
    sa = sigs.select(F.col("id").alias(a), F.col("sig").alias("_sa")).hint("merge")
    sb = sigs.select(F.col("id").alias(b), F.col("sig").alias("_sb")).hint("merge")
    joined = cands.join(sa, a).join(sb, b)
    # The score is produced by a generator so the match filter cannot be pushed
    # below it and evaluate the (interpreted) score expression a second time.
    keep = [c for c in joined.columns if c not in ("_sa", "_sb")]
    scored = (joined.where(spec.comparable(F.col("_sa"), F.col("_sb")))
              .select(*keep, F.explode(F.array(spec.score(F.col("_sa"), F.col("_sb")))).alias("score")))
    return scored.where(spec.is_match(F.col("score")))


def shared_keys(items: DataFrame, spec: Spec, name: str = "keys") -> DataFrame:
    """Written (id, key, is_index, is_probe, n) of the keys that more than one item of
    ``items`` holds; n is the number of rows of the key. Keys of one holder,
    most of them, end here."""
    yes, no = F.lit(True), F.lit(False)
    if spec.probe_is_index:
        keys = spec.index_keys(items).select("id", "key", yes.alias("is_index"), yes.alias("is_probe"))
    else:
        keys = (spec.index_keys(items).select("id", "key", yes.alias("is_index"), no.alias("is_probe"))
                .unionByName(spec.probe_keys(items).select("id", "key", no.alias("is_index"), yes.alias("is_probe"))))
    return with_holders(keys, name)


def with_holders(keys: DataFrame, name: str) -> DataFrame:
    """``keys`` cut to those with an index row and a second item that probes it, with n."""
    # The sizes are written before the join back, so that AQE sees two plain
    # shuffles and can split a key that a large part of the items hold. Merge: an
    # item's hundreds of keys are estimated as one row, and would be broadcast.
    sizes = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_index").alias("ni"),
                                            F.count_if("is_probe").alias("np"))
                    .where("ni > 0 AND np > 1").select("key", "n"), name + "_sizes")
    return written(keys.select("id", "key", "is_index", "is_probe").join(sizes, "key"), name)


def candidate_pairs(index: DataFrame, probe: DataFrame, distinct_items: bool = True) -> DataFrame:
    """Distinct (a, b) of an index row and a probe row (id, key, n) with one key;
    with ``distinct_items`` (both sides hold the same items) only a != b.

    A key of more than ``BLOCK`` rows is dealt out: its rows fall into blocks,
    and each pair of blocks is a join key of its own, so no task holds the
    whole key. Merge: a broadcast side would grow with the keys of the items.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    every = F.explode(F.sequence(F.lit(0), blocks - 1))
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    left = index.select(F.col("id").alias("a"), "key", own.alias("i"), every.alias("j"))
    right = probe.select(F.col("id").alias("b"), "key", every.alias("i"), own.alias("j"))
    pairs = left.hint("merge").join(right, ["key", "i", "j"]).select("a", "b")
    return (pairs.where(F.col("a") != F.col("b")) if distinct_items else pairs).distinct()
