"""Vector index for large corpora (D24): coarse cells, residual codes, exact re-rank, and an exact mode.

Build: k-means centroids and the code books of a product quantiser are fitted on a bounded sample
(``FIT_ROWS`` rows by the least hash of the id). Every row is then indexed: its nearest centroid is its
cell, the rest of the unit vector is coded with one byte for each sub-vector, and its angle to the centroid
is kept. The rows are written sorted and range-partitioned by cell, so a probe reads few row groups.

Search: a query looks into its nearest cells only. In these the codes alone give an approximate
cosine (a table of products per sub-vector); the ``rerank * k`` best of them are scored exactly. How
many cells are needed for a recall is measured on the index itself (``calibrate``).

Exact mode: the angle is a metric on unit vectors, so a row x of the cell with centroid c has
angle(q, x) >= |angle(q, c) - angle(x, c)|. The k-th score of the approximate answer bounds the k-th
exact score from below; rows whose bound lies beyond it are left out, the others are scored. The
result is that of a full scan, whatever the cells and codes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasift.operators.ops import least_hashed
from mediasift.operators.search import TILE, RunningTop, topk
from mediasift.session import checkpoint_dir, materialize

FIT_ROWS = 20_000        # rows that centroids and code books are fitted on
CODES = 256              # values of a code byte
QUERY_BLOCK = 2_000      # queries in one pass over the index
SENT_PAIRS = 400_000     # pairs of a block that are broadcast to the rows; more are shuffled
ANGLE_SLACK = 1e-6       # far above the rounding of a sum of products


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Centroids (at most ``k``) by Lloyd's rounds from distinct rows; an empty cell keeps its centroid."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centre = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        at = nearest(x, centre)
        size = np.bincount(at, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, at, x)
        centre[size > 0] = total[size > 0] / size[size > 0, None]
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Place of the nearest centroid of each row, in tiles."""
    half = (centre * centre).sum(axis=1) / 2
    return np.concatenate([np.empty(0, np.int64)] + [
        np.argmax(x[lo:lo + 8192] @ centre.T - half, axis=1) for lo in range(0, len(x), 8192)])


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


@dataclass(frozen=True)
class Model:
    """Centroids (unit vectors, one per cell) and code books (sub-vectors x values x width)."""

    centres: np.ndarray
    books: list
    cuts: np.ndarray

    def cell(self, unit: np.ndarray) -> np.ndarray:
        return np.concatenate([np.empty(0, np.int64)] + [
            np.argmax(unit[lo:lo + 8192] @ self.centres.T, axis=1) for lo in range(0, len(unit), 8192)])

    def encode(self, unit: np.ndarray, cell: np.ndarray) -> np.ndarray:
        rest = unit - self.centres[cell]
        return np.column_stack([nearest(rest[:, a:b], book) for a, b, book in
                                zip(self.cuts[:-1], self.cuts[1:], self.books, strict=True)]).astype(np.uint8)

    def decode(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        out = self.centres[cell].copy()
        for i, (a, b, book) in enumerate(zip(self.cuts[:-1], self.cuts[1:], self.books, strict=True)):
            out[:, a:b] += book[codes[:, i]]
        return out


def fit(vectors: np.ndarray, cells: int, parts: int) -> Model:
    unit = _unit(vectors)
    unit = unit[np.abs(unit).sum(axis=1) > 0]
    if not len(unit):
        raise ValueError("no non-zero vector to fit on")
    centres = _unit(kmeans(unit, cells))
    centres = centres[np.abs(centres).sum(axis=1) > 0]
    model = Model(centres, [], np.linspace(0, unit.shape[1], min(parts, unit.shape[1]) + 1).astype(int))
    rest = unit - centres[model.cell(unit)]
    books = [kmeans(rest[:, a:b], CODES, seed=11 + i) for i, (a, b) in enumerate(zip(model.cuts[:-1], model.cuts[1:]))]
    return Model(centres, books, model.cuts)


@dataclass(frozen=True)
class VectorIndex:
    """A written index (``path``) with its model. By default a query searches ``probes`` cells and scores
    ``rerank`` * k rows exactly."""

    spark: SparkSession
    path: str
    model: Model
    probes: int
    rerank: int = 4

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def build_index(items: DataFrame, cells: int = 64, parts: int = 16, id_col: str = "vec_id", vec_col: str = "embedding",
                filter_col: str | None = None, path: str | None = None, fit_rows: int = FIT_ROWS,
                probes: int | None = None) -> VectorIndex:
    """Index every row with an id and a vector: (cell, id, tag, angle, codes, vec), sorted by cell.

    ``cells`` centroids and ``parts`` code bytes are fitted on at most ``fit_rows`` rows. A cell of any size
    is written over as many files as its share of the rows asks for (range partitioning on cell and id).
    """
    spark = items.sparkSession
    src = items.select(F.col(id_col).cast("long").alias("id"),
                       (F.col(filter_col).cast("string") if filter_col else F.lit(None).cast("string")).alias("tag"),
                       F.col(vec_col).cast("array<double>").alias("vec")).where("id IS NOT NULL AND size(vec) > 0")
    sample = least_hashed(src, "id", fit_rows).select("vec").collect()
    if not sample:
        raise ValueError("nothing to index")
    model = fit(np.array([r["vec"] for r in sample], dtype=np.float64), cells, parts)
    shared = spark.sparkContext.broadcast(model)  # cells x dims + 256 x dims numbers

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            unit = _unit(np.stack(pdf["vec"].to_numpy()).astype(np.float64))
            m = shared.value
            cell = m.cell(unit)
            angle = _angle((unit * m.centres[cell]).sum(axis=1))
            yield pd.DataFrame({"cell": cell.astype(np.int32), "id": pdf["id"], "tag": pdf["tag"], "angle": angle,
                                "codes": [c.tobytes() for c in m.encode(unit, cell)], "vec": pdf["vec"]})

    schema = "cell int, id long, tag string, angle double, codes binary, vec array<double>"
    target = path or f"{checkpoint_dir(spark).rstrip('/')}/vector-index-{uuid.uuid4().hex}"
    (src.mapInPandas(run, schema).repartitionByRange("cell", "id").sortWithinPartitions("cell", "id")
     .write.mode("overwrite").parquet(target))
    return VectorIndex(spark, target, model, probes or len(model.centres))


def _blocks(queries: DataFrame, id_col: str, vec_col: str, filter_col: str | None):
    """Blocks of about ``QUERY_BLOCK`` queries: (ids, unit vectors, tags)."""
    q = queries.select(F.col(id_col).cast("long").alias("q"), F.col(vec_col).cast("array<double>").alias("v"),
                       (F.col(filter_col).cast("string") if filter_col else F.lit(None).cast("string")).alias("t"))
    q = q.where("q IS NOT NULL AND size(v) > 0")
    blocks = max(1, -(-q.count() // QUERY_BLOCK))
    for b in range(blocks):
        rows = q.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).orderBy("q").collect()  # one block
        if rows:
            yield (np.array([r["q"] for r in rows], np.int64), _unit(np.array([r["v"] for r in rows], np.float64)),
                   np.array([r["t"] for r in rows], object))


def _by_cell(pdf: pd.DataFrame):
    cell = pdf["cell"].to_numpy()
    bounds = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        for at in range(lo, hi, TILE):
            yield int(cell[lo]), pdf.iloc[at:min(hi, at + TILE)]


def _probe_lists(model: Model, unit: np.ndarray, probes: int) -> list[np.ndarray]:
    """Queries that look into each cell."""
    order = np.argsort(-(unit @ model.centres.T), axis=1, kind="stable")[:, :probes]
    lists: list[list[int]] = [[] for _ in model.centres]
    for j, cells in enumerate(order):
        for c in cells:
            lists[c].append(j)
    return [np.array(x, np.int64) for x in lists]


def _approximate(index: VectorIndex, block, k: int, probes: int, rerank: int, tagged: bool) -> DataFrame:
    """(q, id, cell) of the ``rerank * k`` best by codes per query."""
    qids, unit, tags = block
    model, lists = index.model, _probe_lists(index.model, unit, probes)
    want = rerank * k
    cells = [int(c) for c, x in enumerate(lists) if len(x)]

    def run(batches):
        top = RunningTop(len(qids), want)
        for pdf in batches:
            for cell, part in _by_cell(pdf):
                js = lists[cell]
                codes = np.frombuffer(b"".join(part["codes"]), np.uint8).reshape(len(part), -1)
                # the approximate cosine: query times centroid plus a table look-up per sub-vector
                sims = np.repeat((unit[js] @ model.centres[cell])[:, None], len(part), axis=1)
                for i, (a, b, book) in enumerate(zip(model.cuts[:-1], model.cuts[1:], model.books)):
                    sims += (unit[js, a:b] @ book.T)[:, codes[:, i]]
                ids, tag = part["id"].to_numpy(), part["tag"].to_numpy(object)
                for n, j in enumerate(js):
                    ok = tag == tags[j] if tagged else slice(None)
                    top.add(j, ids[ok], sims[n][ok])
        yield top.frame(qids)

    cols = ["cell", "id", "tag", "codes"] if tagged else ["cell", "id", "codes", F.lit(None).cast("string").alias("tag")]
    found = index.rows().where(F.col("cell").isin(cells)).select(*cols).mapInPandas(run, "q long, id long, sim double")
    return topk(found, ["q"], [F.col("sim").desc(), F.col("id")], want).select("q", "id")


def _rescore(index: VectorIndex, pairs: DataFrame, block, want: int) -> DataFrame:
    """Exact cosine of (q, id) pairs: the rows of the ids are read once, joined on the id. The vectors never go
    through the driver (the size of an array column is estimated far too low, so the side is named here)."""
    qids, unit, _ = block
    pairs = pairs.hint("broadcast" if len(qids) * want <= SENT_PAIRS else "merge")
    place = {int(q): j for j, q in enumerate(qids)}

    def run(batches):
        for pdf in batches:
            if len(pdf):
                x = _unit(np.stack(pdf["vec"].to_numpy()))
                sim = np.einsum("nd,nd->n", x, unit[[place[q] for q in pdf["q"]]])
                yield pd.DataFrame({"q": pdf["q"], "id": pdf["id"], "sim": sim})

    rows = index.rows().select("id", "vec").join(pairs, "id")
    return rows.select("q", "id", "vec").mapInPandas(run, "q long, id long, sim double")


def _exact(index: VectorIndex, block, k: int, floor: np.ndarray, tagged: bool) -> DataFrame:
    """Rows that may be among the first ``k`` of a query, scored exactly. ``floor``: a lower bound of each
    query's k-th score (-2: none)."""
    qids, unit, tags = block
    model = index.model
    to_centre = _angle(unit @ model.centres.T)
    reach = np.where(floor > -1, _angle(floor - 1e-6), np.pi) + ANGLE_SLACK

    def run(batches):
        top = RunningTop(len(qids), k)
        for pdf in batches:
            for cell, part in _by_cell(pdf):
                angle = part["angle"].to_numpy()
                near = np.abs(to_centre[:, cell, None] - angle[None, :]) <= reach[:, None]
                js = np.flatnonzero(near.any(axis=1))
                if not len(js):
                    continue
                x = _unit(np.stack(part["vec"].to_numpy()))
                ids, tag = part["id"].to_numpy(), part["tag"].to_numpy(object)
                for lo in range(0, len(js), TILE):
                    some = js[lo:lo + TILE]
                    sims = unit[some] @ x.T
                    for n, j in enumerate(some):
                        ok = near[j] & (sims[n] >= floor[j] - 2e-6)
                        if tagged:
                            ok &= tag == tags[j]
                        if ok.any():
                            top.add(j, ids[ok], sims[n][ok])
        yield top.frame(qids)

    cols = ["cell", "id", "tag", "angle", "vec"] if tagged else ["cell", "id", "angle", "vec", F.lit(None).cast("string").alias("tag")]
    return index.rows().select(*cols).mapInPandas(run, "q long, id long, sim double")


def _ranked(scored: DataFrame, k: int, id_col: str) -> DataFrame:
    done = topk(scored.withColumn("sim", F.round("sim", 6)), ["q"], [F.col("sim").desc(), F.col("id")], k)
    return done.select("q", "rank", F.col("id").alias(id_col), "sim")


def search_index(index: VectorIndex, queries: DataFrame, k: int = 5, exact: bool = False, probes: int | None = None,
                 rerank: int | None = None, id_col: str = "vec_id", vec_col: str = "embedding",
                 filter_col: str | None = None) -> DataFrame:
    """(q, rank, id, sim): the ``k`` best rows by cosine for each query, ties to the smaller id.

    ``exact``: the same rows as ``search.vector_topk``, through triangle bounds; else the best of ``probes``
    cells. With ``filter_col`` (the index must carry it) only rows with the query's value take part. A zero
    vector has cosine 0 with everything. Queries go in blocks; each block's result is written.
    """
    out = None
    for block in _blocks(queries, id_col, vec_col, filter_col):
        again = rerank or index.rerank
        close = _rescore(index, _approximate(index, block, k, probes or index.probes, again, bool(filter_col)), block, again * k)
        close = materialize(_ranked(close, k, "id"), "ann")
        if exact:
            floor = np.full(len(block[0]), -2.0)
            place = {int(q): j for j, q in enumerate(block[0])}
            for r in close.where(F.col("rank") == k).select("q", "sim").collect():  # one row per query of the block
                floor[place[r["q"]]] = r["sim"] - 1e-6
            close = materialize(_ranked(_exact(index, block, k, floor, bool(filter_col)), k, "id"), "exact")
        out = close if out is None else out.unionByName(close)
    if out is None:
        return index.spark.createDataFrame([], f"q long, rank int, {id_col} long, sim double")
    return out.withColumnRenamed("id", id_col)


RERANK = (4, 8, 16, 32, 64, 128)


def calibrate(index: VectorIndex, queries: DataFrame, k: int = 5, target: float = 0.95, id_col: str = "vec_id",
              vec_col: str = "embedding", most: int = 200) -> VectorIndex:
    """The index with probes and re-rank set for a recall of ``target``, measured against exact answers for at
    most ``most`` of the queries (by the least hash of the id).

    The probes cover the cells of all but half of the allowed misses; the re-rank is the first of ``RERANK``
    whose measured recall reaches the target (else the last).
    """
    some = materialize(least_hashed(queries, id_col, most).select(id_col, vec_col), "calibrate")
    truth = search_index(index, some, k, exact=True, id_col=id_col, vec_col=vec_col)
    held = index.rows().select("id", "cell").join(F.broadcast(truth.select("q", F.col(id_col).alias("id"))), "id").select("q", "cell").collect()
    vecs = {r[id_col]: r[vec_col] for r in some.collect()}  # at most ``most`` rows
    ranks = []
    for r in held:
        order = np.argsort(-(_unit(np.array([vecs[r["q"]]], np.float64)) @ index.model.centres.T)[0], kind="stable")
        ranks.append(int(np.flatnonzero(order == r["cell"])[0]) + 1)
    if not ranks:
        return index
    probes = int(np.quantile(ranks, (1 + target) / 2, method="higher"))
    for rerank in RERANK:
        tuned = VectorIndex(index.spark, index.path, index.model, probes, rerank)
        if recall(search_index(tuned, some, k, id_col=id_col, vec_col=vec_col), truth, id_col).first()["recall"] >= target:
            break
    return tuned


def recall(found: DataFrame, truth: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """(queries, neighbours, found, recall) of an approximate answer against the true one. A row that ties with
    the true k-th score counts as found."""
    worst = truth.groupBy("q").agg(F.min("sim").alias("least"), F.count(F.lit(1)).alias("n"))
    hit = found.join(worst, "q").where(F.col("sim") >= F.col("least")).groupBy("q").agg(F.count(F.lit(1)).alias("hit"))
    per = worst.join(hit, "q", "left").select("n", F.least("n", F.coalesce("hit", F.lit(0))).alias("hit"))
    return per.agg(F.count(F.lit(1)).alias("queries"), F.sum("n").alias("neighbours"), F.sum("hit").alias("found")).withColumn(
        "recall", F.col("found") / F.col("neighbours"))
