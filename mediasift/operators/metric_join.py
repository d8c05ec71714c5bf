"""Exact embedding join (J2): metric partitioning with pivots.

The compared vector of an item is the concatenation of its unit frames over the root of their number, so
its length is at most 1 and score(a, b) = a . b >= t implies |a - b| <= e with e = sqrt(2 - 2t). Pivots cut the
space into cells of the nearest pivot. An item is at home in one cell and visits each other cell that a
point within e of it may be at home in:

* it lies within e of the bisector between its own pivot p and the other pivot q, that is
  (|x - q|^2 - |x - p|^2) / (2 |p - q|) <= e, and
* its distance to q is at most the cell's largest home distance plus e.

Of two matching items with different homes the one with the larger cell number visits the other's cell, so
every match meets in exactly one cell; no hashing, no loss. Inside a cell rows are sorted by their distance r
to the pivot: |a - b| <= e implies |r_a - r_b| <= e, so a tile of rows is multiplied only with the rows of its
ring, and matches alone leave the task. Cells of more than ``BLOCK`` rows are dealt out as pairs of blocks.

The number of pivots is the one of ``PIVOTS`` with the least comparisons and sent rows, judged on a bounded sample. On vectors
without any cluster structure e is as wide as the cells and one cell (a blocked comparison of all) is the
best there is: that is the price of an exact answer; ``EmbeddingSpec`` is the approximate way.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasift.operators.ops import least_hashed
from mediasift.operators.simjoin import EmbeddingSpec
from mediasift.session import materialize

PIVOTS = (1, 4, 16, 64, 256)
SAMPLE = 4_000           # rows that choose the pivots
BLOCK = 16_384           # rows of a cell that one task holds per side; a row is sent once for each block of its cell
MOVE = 1_000             # comparisons that sending a row to a block costs as much as
TILE = 256
SLACK = 1e-7             # of distances of order 1; far above rounding


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(d2, 0))


def choose_pivots(x: np.ndarray, k: int) -> np.ndarray:
    """Distinct rows, each as far as possible from those chosen before."""
    chosen = [0]
    far = np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < k and far.max() > 0:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


def visits(x: np.ndarray, pivots: np.ndarray, e: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home, distances, mask of the cells with a smaller number that an item must visit)."""
    dist = _distances(x, pivots)
    home = np.argmin(dist, axis=1)
    own = dist[np.arange(len(x)), home]
    apart = _distances(pivots, pivots)[home]
    with np.errstate(divide="ignore", invalid="ignore"):
        gap = (dist ** 2 - own[:, None] ** 2) / (2 * apart)
    near = np.where(apart > SLACK, gap <= e + SLACK + 1e-6 / np.maximum(apart, SLACK), True)
    near &= np.arange(len(pivots))[None, :] < home[:, None]
    return home, dist, near


def fit_pivots(x: np.ndarray, e: float, n: int | None = None, block: int = BLOCK) -> np.ndarray:
    """Pivots of the number with the least work, judged on the rows ``x`` of ``n`` (a larger one only if clearly
    less): comparisons, and rows sent to each block of each cell they visit."""
    scale = (n or len(x)) / max(len(x), 1)
    best, least = x[:1], math.inf
    pool = choose_pivots(x, max(PIVOTS))
    for k in PIVOTS:
        pivots = pool[:k]
        home, _, near = visits(x, pivots, e)
        at_home = np.bincount(home, minlength=len(pivots)).astype(float)
        held = scale * (at_home + near.sum(axis=0))
        cost = scale ** 2 * (at_home * (at_home / 2 + near.sum(axis=0))).sum() + MOVE * (held * np.ceil(held / block)).sum()
        if cost < 0.9 * least:
            best, least = pivots, cost
        if len(pivots) < k:
            break
    return best


@dataclass(frozen=True)
class ExactEmbeddingSpec(EmbeddingSpec):
    """As ``EmbeddingSpec`` (mean diagonal cosine >= threshold), but the pair join loses nothing."""

    name: str = "embedding-exact"

    def expected_recall(self, score: float | None = None) -> float:
        return 1.0

    def candidates(self, items: DataFrame) -> DataFrame:
        """Distinct (a, b), a < b, of the ``items`` (id, sig) with a score of the threshold or more (and no pair
        whose score is lower than that by more than rounding). With columns ``is_index`` and ``is_probe`` only
        pairs of an index row and a probe row."""
        return pivot_candidates(items, self.threshold)


def pivot_candidates(items: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    spark = items.sparkSession
    if not -1.0 <= threshold <= 1.0:
        raise ValueError("threshold must be a cosine")
    e = math.sqrt(2 - 2 * threshold)
    id_type = items.schema["id"].dataType.simpleString()
    roles = ["is_index", "is_probe"]
    asked = roles if set(roles) <= set(items.columns) else [F.lit(True).alias(c) for c in roles]
    rows = items.select("id", "sig", *asked, F.size("sig").alias("d")).where("d > 0 AND (is_index OR is_probe)")
    pivots = {}
    for d, n in [(r["d"], r["count"]) for r in rows.groupBy("d").count().collect()]:  # lengths of signatures
        sample = least_hashed(rows.where(F.col("d") == d), "id", SAMPLE).select("sig").collect()
        pivots[d] = fit_pivots(np.array([r["sig"] for r in sample], np.float64), e, n, block)
    shared = spark.sparkContext.broadcast(pivots)  # at most 256 vectors per length

    def deal(batches):
        for pdf in batches:
            for d, part in pdf.groupby("d"):
                x = np.stack(part["sig"].to_numpy()).astype(np.float64)
                home, dist, near = visits(x, shared.value[d], e)
                row, cell = np.nonzero(near)
                row, cell = np.concatenate((np.arange(len(x)), row)), np.concatenate((home, cell))
                yield pd.DataFrame({"d": np.int32(d), "cell": cell.astype(np.int32), "home": home[row] == cell,
                                    "r": dist[row, cell], "is_index": part["is_index"].to_numpy()[row],
                                    "is_probe": part["is_probe"].to_numpy()[row], "id": part["id"].to_numpy()[row],
                                    "sig": part["sig"].to_numpy()[row]})

    dealt = rows.mapInPandas(deal, "d int, cell int, home boolean, r double, is_index boolean, is_probe boolean, "
                                   f"id {id_type}, sig array<double>")
    dealt = materialize(dealt, "pivot-cells")
    sizes = dealt.groupBy("d", "cell").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("home"), F.col("r"))).alias("wide"))
    sizes = materialize(sizes, "pivot-sizes")
    # a visitor farther from the pivot than any home row plus e meets nothing there
    held = dealt.join(sizes, ["d", "cell"]).where(F.col("home") | (F.col("r") <= F.col("wide") + F.lit(e + SLACK)))
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    held = held.select("d", "cell", "home", "r", *roles, "id", "sig", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    held = held.select("d", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "home", "r", *roles, "id", "sig")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("r", kind="stable")
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        left, right = (pdf[pdf["own"] == n] for n in (i, j))
        out_a, out_b = [], []
        if len(left) and len(right):
            x, y = (np.stack(s["sig"].to_numpy()) for s in (left, right))
            rx, ry = left["r"].to_numpy(), right["r"].to_numpy()
            hx, hy = left["home"].to_numpy(), right["home"].to_numpy()
            ix, iy = left["id"].to_numpy(), right["id"].to_numpy()
            (nx, px), (ny, py) = ((s["is_index"].to_numpy(bool), s["is_probe"].to_numpy(bool)) for s in (left, right))
            for lo in range(0, len(x), TILE):
                cut = slice(lo, lo + TILE)
                a = lo if i == j else int(np.searchsorted(ry, rx[cut][0] - e - SLACK))
                b = int(np.searchsorted(ry, rx[cut][-1] + e + SLACK, side="right"))
                for at in range(a, b, 8 * TILE):
                    to = slice(at, min(b, at + 8 * TILE))
                    if not (nx[cut].any() and py[to].any() or px[cut].any() and ny[to].any()):
                        continue
                    match = (x[cut] @ y[to].T >= threshold - 1e-9) & (hx[cut][:, None] | hy[to][None, :])
                    match &= nx[cut][:, None] & py[to][None, :] | px[cut][:, None] & ny[to][None, :]
                    p, q = np.nonzero(match)
                    if i == j:
                        keep = p + lo < q + at
                        p, q = p[keep], q[keep]
                    out_a.append(ix[cut][p])
                    out_b.append(iy[to][q])
        if not out_a:
            return pd.DataFrame({"a": pd.Series([], dtype=pdf["id"].dtype), "b": pd.Series([], dtype=pdf["id"].dtype)})
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return held.groupBy("d", "cell", "i", "j").applyInPandas(compare, f"a {id_type}, b {id_type}").where("a <> b")
