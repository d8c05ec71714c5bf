"""Hard-negative mining by inner product, with candidates filtered on summaries of vector segments.

Every vector is stored with a hierarchy of summaries: at level L it is cut into up to 2^L segments, and of
each the mean and the deviation are kept (scaled by the root of the segment's length). For two vectors x, y
Cauchy and Schwarz give for each segment

    mean_x * mean_y - dev_x * dev_y  <=  part of the inner product  <=  mean_x * mean_y + dev_x * dev_y

so the sums over the segments bound the score from both sides, and finer segments bound it more closely. A
pair goes from level to level only while its upper bound reaches what is still asked for (the k-th best
score so far, or the least score allowed) and its lower bound does not pass the largest score allowed. What
is left after the last level is scored exactly, in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediasift.llm.common import arrow_schema
from mediasift.session import materialize
from mediasift.sources.tables import table

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100            # per cent of the positive's score
LEVELS = 4                     # up to 2^4 segments
#: Bytes of anchor vectors that one pass over the rows takes (the anchors of a pass are broadcast).
BLOCK_BYTES = 16_000_000
ROWS, ANCHORS = 2048, 256      # a tile of pairs
#: If more of a tile than this is left, the next step treats the whole tile with one matrix product.
DENSE = 0.1


def segments(dims: int, level: int) -> np.ndarray:
    """Starts of the (at most 2^level) segments of a vector."""
    return np.unique(np.linspace(0, dims, min(2 ** level, dims) + 1).astype(np.int64)[:-1])


def summarise(x: np.ndarray, levels: int = LEVELS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(means, deviations) of the rows of ``x`` for each level, scaled by the root of the segment's length."""
    out = []
    for level in range(levels + 1):
        starts = segments(x.shape[1], level)
        if out and len(starts) == out[-1][0].shape[1]:
            break
        size = np.diff([*starts, x.shape[1]])
        mean = np.add.reduceat(x, starts, axis=1) / size
        rest = x - np.repeat(mean, size, axis=1)
        out.append((mean * np.sqrt(size), np.sqrt(np.add.reduceat(rest * rest, starts, axis=1))))
    return out


def _pack(levels: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return np.concatenate([part for pair in levels for part in pair], axis=1)


def _unpack(flat: np.ndarray, dims: int, levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for level in range(levels + 1):
        n = len(segments(dims, level))
        if at + 2 * n > flat.shape[1]:
            break
        out.append((flat[:, at:at + n], flat[:, at + n:at + 2 * n]))
        at += 2 * n
    return out


class Side:
    """Vectors of one length with their summaries; one side of a tile."""

    def __init__(self, ids, labels, x: np.ndarray, flat: np.ndarray, levels: int):
        self.ids, self.labels, self.x = ids, labels, x
        self.levels = _unpack(flat, x.shape[1], levels) if x.shape[1] else []
        self.norm = np.sqrt((x * x).sum(axis=1))
        self.most = float(np.abs(x).max(initial=0.0))

    def part(self, rows: slice) -> Side:
        side = object.__new__(Side)
        side.ids, side.labels, side.x, side.norm, side.most = (
            self.ids[rows], self.labels[rows], self.x[rows], self.norm[rows], self.most)
        side.levels = [(m[rows], d[rows]) for m, d in self.levels]
        return side


def exact_scores(a: Side, b: Side, i=None, j=None) -> np.ndarray:
    """Integer inner products of all pairs, or of the pairs (i, j). Exact: doubles hold integers below 2^53."""
    most = a.most * b.most * max(1, a.x.shape[1])
    if most >= 2 ** 63:
        raise ValueError("a score may not fit 64 bits")
    x, y = (a.x, b.x) if most < 2 ** 53 else (a.x.astype(np.int64), b.x.astype(np.int64))
    done = x @ y.T if i is None else np.einsum("pd,pd->p", x[i], y[j])
    return done.astype(np.int64)


def candidates(a: Side, b: Side, allowed: np.ndarray, floor: np.ndarray, ceiling: np.ndarray | None, count: list | None = None):
    """(i, j, score) of the allowed pairs of anchors ``a`` and rows ``b`` with floor[i] <= score, and score
    <= ceiling[i] if given. Bounds leave a pair out only if its score surely lies outside."""
    slack = 1e-9  # of the norms' product: far above the rounding of a sum of products
    floor = floor - np.abs(floor) * 1e-12  # limits beyond 2^53 are rounded: the caller compares integers
    ceiling = None if ceiling is None else ceiling + np.abs(ceiling) * 1e-12
    alive, pairs = allowed, None
    if count is not None:
        count[0] += int(alive.sum())
    for level, ((ma, da), (mb, db)) in enumerate(zip(a.levels, b.levels, strict=True)):
        if pairs is None:
            means, devs = ma @ mb.T, da @ db.T + slack * np.outer(a.norm, b.norm) + 0.5
            alive = alive & (means + devs >= floor[:, None])
            if ceiling is not None:
                alive &= means - devs <= ceiling[:, None]
            left = int(alive.sum())
            if left < DENSE * alive.size:
                pairs = np.nonzero(alive)
        else:
            i, j = pairs
            means = np.einsum("ps,ps->p", ma[i], mb[j])
            devs = np.einsum("ps,ps->p", da[i], db[j]) + slack * a.norm[i] * b.norm[j] + 0.5
            keep = means + devs >= floor[i]
            if ceiling is not None:
                keep &= means - devs <= ceiling[i]
            pairs = i[keep], j[keep]
            left = len(pairs[0])
        if count is not None:
            count[level + 1] += left
        if not left:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    if pairs is None:
        scores = exact_scores(a, b)
        i, j = np.nonzero(alive & (scores >= floor[:, None]))
        s = scores[i, j]
    else:
        i, j = pairs
        s = exact_scores(a, b, i, j)
        i, j, s = i[s >= floor[i]], j[s >= floor[i]], s[s >= floor[i]]
    if ceiling is not None:
        ok = s <= ceiling[i]
        i, j, s = i[ok], j[ok], s[ok]
    return i, j, s


class Best:
    """Running first ``k`` (score descending, then id) for each slot; an id counts once, with its best score."""

    def __init__(self, slots: int, k: int):
        self.k, self.slots = k, slots
        self.slot, self.id, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.kth = np.full(slots, np.iinfo(np.int64).min)

    def add(self, slot, ids, scores) -> None:
        keep = scores >= self.kth[slot]
        if not keep.any():
            return
        s, i, v = (np.concatenate((old, new[keep])) for old, new in
                   ((self.slot, slot), (self.id, ids), (self.score, scores)))
        order = np.lexsort((-v, i, s))
        s, i, v = s[order], i[order], v[order]
        once = np.ones(len(s), bool)
        once[1:] = (s[1:] != s[:-1]) | (i[1:] != i[:-1])
        s, i, v = s[once], i[once], v[once]
        order = np.lexsort((i, -v, s))
        s, i, v = s[order], i[order], v[order]
        starts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        rank = np.arange(len(s)) - np.repeat(starts, np.diff([*starts, len(s)]))
        full = rank == self.k - 1
        self.kth[s[full]] = v[full]
        stay = rank < self.k
        self.slot, self.id, self.score = s[stay], i[stay], v[stay]


def _vectors(column) -> np.ndarray:
    """A chunk of binary values of equal length as rows of little-endian doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def _sides(batch, levels):
    """Rows of a stored batch (id, label, dims, vec, summary) by vector length."""
    dims = batch.column(2).to_numpy()
    for d in np.unique(dims):
        part = batch if len(dims) == (n := int((dims == d).sum())) else batch.filter(pa.array(dims == d))
        for at in range(0, n, ROWS):
            rows = part.slice(at, ROWS)
            x = _vectors(rows.column(3)) if d else np.zeros((rows.num_rows, 0))
            flat = _vectors(rows.column(4)) if d else x
            yield int(d), Side(rows.column(0).to_numpy(), rows.column(1).to_numpy(), x, flat, levels)


_STORED = "id long, label int, dims int, vec binary, summary binary"


def store(df: DataFrame, id_col: str, label: Column, vec: Column, levels: int) -> DataFrame:
    """The rows that take part, with scaled integer components (as doubles) and their segments' summaries."""
    schema = arrow_schema(_STORED)

    def run(batches):
        for batch in batches:
            ids, labels, lists = batch.columns
            dims = np.diff(lists.offsets.to_numpy())
            flat = np.floor(SCALE * lists.flatten().to_numpy())
            ends = np.concatenate(([0], np.cumsum(dims)))
            vec, summary = [b""] * len(dims), [b""] * len(dims)
            for d in np.unique(dims[dims > 0]):
                rows = np.flatnonzero(dims == d)
                x = flat[ends[rows][:, None] + np.arange(d)].astype("<f8")
                if np.abs(x).max(initial=0.0) >= 2 ** 52:
                    raise ValueError("a component is too large to be scaled exactly")
                for r, v, s in zip(rows.tolist(), x, _pack(summarise(x, levels)).astype("<f8"), strict=True):
                    vec[r], summary[r] = v.tobytes(), s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids, labels, pa.array(dims.astype(np.int32)), pa.array(vec, pa.binary()), pa.array(summary, pa.binary())],
                schema=schema)

    v = F.transform(vec, lambda x: x.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.cast("int").alias("label"), v.alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).filter(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return materialize(rows.mapInArrow(run, _STORED), "negatives-rows")


def _search(rows: DataFrame, anchors, limits, k: int, levels: int) -> DataFrame:
    """First ``k`` rows per anchor among those of its label (``limits`` None), or per (anchor, positive) among
    those of other labels within the positive's limits; one row set per task, not yet ranked over tasks.

    ``anchors``: broadcast list of (id, label, dims, vec, summary). ``limits``: broadcast list of
    (anchor's place in that list, least, largest score), one per positive, sorted by place.
    """
    def run(batches):
        found: dict[int, tuple[Side, np.ndarray]] = {}
        ids, labels, dims, vecs, flats = anchors.value
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            pick = lambda raw: (np.frombuffer(b"".join(raw[i] for i in at), "<f8").reshape(len(at), -1)
                                if d else np.zeros((len(at), 0)))
            found[int(d)] = Side(ids[at], labels[at], pick(vecs), pick(flats), levels), at
        if limits is None:
            best = Best(len(ids), k)
        else:
            place, least, largest = limits.value
            best = Best(len(place), k)
            first, last = np.searchsorted(place, [np.arange(len(ids)), np.arange(1, len(ids) + 1)])
            some = last > first
        for batch in batches:
            for d, side in _sides(batch, levels):
                if d not in found:
                    continue
                mine, at = found[d]
                for lo in range(0, len(at), ANCHORS):
                    cut, slots = mine.part(slice(lo, lo + ANCHORS)), at[lo:lo + ANCHORS]
                    same = cut.labels[:, None] == side.labels[None, :]
                    if limits is None:
                        i, j, s = candidates(cut, side, same & (cut.ids[:, None] != side.ids[None, :]),
                                             best.kth[slots].astype(float), None)
                        best.add(slots[i], side.ids[j], s)
                        continue
                    allowed = ~same & some[slots][:, None]
                    under, over = np.full(len(slots), 2.0 ** 63), np.full(len(slots), -2.0 ** 63)
                    for p, slot in enumerate(slots.tolist()):
                        f, t = first[slot], last[slot]
                        if t > f:  # a row is of use if it passes the k-th best of any of the positives
                            under[p] = np.maximum(least[f:t], best.kth[f:t]).min()
                            over[p] = largest[f:t].max()
                    i, j, s = candidates(cut, side, allowed, under, over)
                    n = last[slots[i]] - first[slots[i]]
                    which = np.repeat(np.arange(len(i)), n)
                    slot = first[slots[i]][which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                    ok = (s[which] >= least[slot]) & (s[which] <= largest[slot])
                    best.add(slot[ok], side.ids[j][which[ok]], s[which[ok]])
        for lo in range(0, len(best.slot), 65_536):
            cut = slice(lo, lo + 65_536)
            yield pa.RecordBatch.from_arrays([pa.array(best.slot[cut]), pa.array(best.id[cut]), pa.array(best.score[cut])],
                                             names=["slot", "id", "score"])

    return rows.mapInArrow(run, "slot long, id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """(slot, rank, id, score): over all tasks, an id once with its best score."""
    best = found.groupBy("slot", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), "id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(df: DataFrame, anchors: Column | None = None, id_col: str = "vec_id", label: Column | None = None,
         vec_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, levels: int = LEVELS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor.

    A component counts as floor(256 * component), a score is the integer inner product. An anchor's positives
    are its first ``positives`` other ids of the same label (score descending, then id); a positive's
    negatives are the first ``negatives`` ids of another label with ``low`` % <= score <= ``high`` % of the
    positive's score. ``anchors`` picks the anchor rows (None: ids divisible by 100).

    Rows with a null id, label, vector or a null or non-finite component take no part, nor does an id that
    is no integer. Vectors of different length have no score. Repeated rows count once; if rows share an id
    but differ, the id's best score counts, and the anchor is the row with the smallest (label, vector).
    Empty vectors score 0. Other columns are ignored, whatever their names. Components of 2^44 and more, or
    scores that may not fit 64 bits, are an error. Empty table: no rows.

    Anchors are taken in blocks of about ``block_bytes`` (a pass over the stored rows each); a task holds a
    block, its own best rows and a tile of pairs, whatever the size of a label.
    """
    spark = df.sparkSession
    rows = store(df, id_col, F.col("label") if label is None else label, F.col(vec_col), levels)
    pick = F.col("id") % 100 == 0 if anchors is None else anchors
    chosen = rows.filter(pick).groupBy("id").agg(F.min(F.struct("label", "dims", "vec", "summary")).alias("r")).select(
        "id", "r.label", "r.dims", "r.vec", "r.summary")
    chosen = materialize(chosen, "negatives-anchors")
    total = chosen.agg(F.sum(F.octet_length("vec") + F.octet_length("summary") + 16)).head()[0] or 0
    blocks, out = max(1, -(-total // block_bytes)), None
    for block in range(blocks):
        part = chosen.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).orderBy("id")
        got = part.toArrow()  # one block
        ids = got.column("id").to_numpy()
        held = spark.sparkContext.broadcast((ids, got.column("label").to_numpy(), got.column("dims").to_numpy(),
                                             got.column("vec").to_pylist(), got.column("summary").to_pylist()))
        pos = _first(_search(rows, held, None, positives, levels), positives).orderBy("slot", "rank").toArrow()
        place, pid, score = (pos.column(c).to_numpy() for c in ("slot", "id", "score"))
        # bounds in integers: low * s <= 100 * n <= high * s
        ints = [int(s) for s in score]
        least = np.array([-(-low * s // 100) for s in ints], np.int64)
        largest = np.array([high * s // 100 for s in ints], np.int64)
        limits = spark.sparkContext.broadcast((place, least, largest))
        ranked = _first(_search(rows, held, limits, negatives, levels), negatives)
        names = spark.createDataFrame(pa.table({
            "slot": pa.array(np.arange(len(place))), "anchor_id": pa.array(ids[place]),
            "positive_id": pa.array(pid), "positive_score": pa.array(score)}))
        done = ranked.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score").join(
            F.broadcast(names), "slot").select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        done = done if blocks == 1 else materialize(done, "negatives")
        out = done if out is None else out.unionByName(done)
    return out


def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, label=label)


QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLE = {"op13_hard_negatives": """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE id % 100 = 0) a JOIN v b ON a.id <> b.id AND len(a.e) = len(b.e)),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM s WHERE same)
  WHERE r <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""}
