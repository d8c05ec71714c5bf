"""Batch search: boolean term filter (D22), BM25 top-k (D23), vector top-k (D24),
hybrid filter + vector rank (D25).

Top-k uses ``row_number() <= k`` over a window; Spark plans a partial
``WindowGroupLimit`` before the shuffle, so each task forwards at most k rows
per group and a hot group never lands whole in one task.
"""

from __future__ import annotations


import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from mediasift.functions.text import tokens
from mediasift.session import materialize

# Queries scored in one pass over the items; a larger query set takes several passes.
QUERY_BLOCK = 10_000
BM25_BLOCK = 500       # text queries (with their terms) in one pass
SCORE_ROWS = 512       # documents scored at once in a task
TILE = 512             # items and queries of one matrix product


def topk(df: DataFrame, group_cols: list[str], order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def boolean_search(docs: DataFrame, all_terms: list[str], any_terms: list[str], none_terms: list[str],
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of documents containing every ``all`` term, one ``any`` term (if given) and no ``none`` term.

    Tokens are exploded and cut to the query terms before the group-by, so only
    matching (doc, term) rows are shuffled.
    """
    terms = sorted(set(all_terms) | set(any_terms) | set(none_terms))
    hits = (docs.select(F.col(id_col).alias("id"), F.explode(tokens(text_col)).alias("t"))
            .where(F.col("t").isin(terms))
            .groupBy("id").agg(F.collect_set("t").alias("ts")))
    cond = F.lit(True)
    for t in all_terms:
        cond = cond & F.array_contains("ts", t)
    if any_terms:
        cond = cond & F.arrays_overlap("ts", F.array(*[F.lit(t) for t in any_terms]))
    for t in none_terms:
        cond = cond & ~F.array_contains("ts", t)
    if all_terms or any_terms:
        return hits.where(cond).select(F.col("id").alias(id_col))
    # only exclusions: every document without a banned term
    banned = hits.where(~cond).select("id")
    return docs.select(F.col(id_col).alias("id")).join(banned, "id", "left_anti").select(F.col("id").alias(id_col))


def bm25_topk(docs: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.2, b: float = 0.75,
              doc_id: str = "doc_id", query_id: str = "item_id", text_col: str = "text") -> DataFrame:
    """Okapi BM25 with idf = ln(1 + (N - df + 0.5) / (df + 0.5)).

    Returns (item_id, rank, doc_id, score) for the k best documents per query,
    ties broken by the smaller doc id. Each document is scored where it lies: no
    shuffle by term and no row per (query, document), so a word that nearly every
    document holds costs no more than a rare one. Queries go in blocks of about
    ``BM25_BLOCK``; a block's terms and the k best documents a task has seen per
    query are all that a task holds beside its documents.
    """
    blocks = max(1, -(-queries.count() // BM25_BLOCK))
    out = None
    for n in range(blocks):
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == n)
        done = _bm25_block(docs, part, k, k1, b, doc_id, query_id, text_col)
        done = done if blocks == 1 else materialize(done, "bm25")
        out = done if out is None else out.unionByName(done)
    return out


def _bm25_block(docs: DataFrame, queries: DataFrame, k: int, k1: float, b: float,
                doc_id: str, query_id: str, text_col: str) -> DataFrame:
    asked = [(r["q"], r["t"]) for r in queries.select(
        F.col(query_id).alias("q"), F.array_distinct(tokens(text_col)).alias("t")).collect() if r["t"]]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, ts in asked for t in ts}))}
    terms = [np.array([vocabulary[t] for t in ts]) for _, ts in asked]
    dtype = docs.schema[doc_id].dataType.simpleString()
    qtype = queries.schema[query_id].dataType.simpleString()

    def count_terms(batches):
        for pdf in batches:
            ts, fs = [], []
            for words in pdf["tk"]:
                seen: dict[int, int] = {}
                for w in words if words is not None else ():
                    i = vocabulary.get(w)
                    if i is not None:
                        seen[i] = seen.get(i, 0) + 1
                ts.append(list(seen))
                fs.append(list(seen.values()))
            yield pd.DataFrame({"d": pdf["d"], "dl": pdf["dl"], "ts": ts, "fs": fs})

    # The first pass writes the query terms of each document; the document count
    # and mean length are observed metrics of the same job.
    obs = Observation("bm25_stats")
    toks = (docs.select(F.col(doc_id).alias("d"), tokens(text_col).alias("tk"))
            .select("d", "tk", F.size("tk").cast("bigint").alias("dl"))
            .observe(obs, F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")))
    postings = materialize(toks.mapInPandas(count_terms, f"d {dtype}, dl bigint, ts array<int>, fs array<int>")
                           .where(F.size("ts") > 0), "bm25_postings")
    n_docs, avgdl = int(obs.get["n"]), float(obs.get["avgdl"] or 0.0) or 1.0
    idf = np.zeros(len(vocabulary))
    for r in postings.select(F.explode("ts").alias("t")).groupBy("t").count().collect():  # at most the block's terms
        idf[r["t"]] = np.log(1.0 + (n_docs - r["count"] + 0.5) / (r["count"] + 0.5))

    def score(batches):
        best_s = [np.zeros(0)] * len(asked)
        best_d = [np.zeros(0, dtype=object)] * len(asked)
        for pdf in batches:
            for at in range(0, len(pdf), SCORE_ROWS):
                part = pdf.iloc[at:at + SCORE_ROWS]
                row = np.repeat(np.arange(len(part)), part["ts"].map(len).to_numpy())
                term = np.concatenate(part["ts"].to_numpy()).astype(np.int64)
                tf = np.concatenate(part["fs"].to_numpy()).astype(np.float64)
                norm = k1 * ((1.0 - b) + b * part["dl"].to_numpy(dtype=np.float64) / avgdl)
                weight = np.zeros((len(vocabulary), len(part)))
                weight[term, row] = idf[term] * tf * (k1 + 1) / (tf + norm[row])
                ids = part["d"].to_numpy(dtype=object)
                for j, mine in enumerate(terms):
                    col = weight[mine].sum(axis=0)
                    hit = np.nonzero(col)[0]
                    if not len(hit):
                        continue
                    s, d = np.concatenate([best_s[j], col[hit]]), np.concatenate([best_d[j], ids[hit]])
                    if len(s) > k:
                        # rank on the rounded score, as the final window does: equal documents tie
                        r = np.floor(s * 1e6 + 0.5)
                        near = np.nonzero(r >= -np.partition(-r, k - 1)[k - 1])[0]
                        near = sorted(near, key=lambda i: (-r[i], d[i]))[:k]
                        s, d = s[near], d[near]
                    best_s[j], best_d[j] = s, d
        for j, (q, _) in enumerate(asked):
            if len(best_s[j]):
                yield pd.DataFrame({"q": [q] * len(best_s[j]), "d": list(best_d[j]), "score": best_s[j]})

    # Rank on the rounded score: equal documents then tie exactly and the
    # smaller id wins, whatever order the partial sums were added in.
    scores = postings.mapInPandas(score, f"q {qtype}, d {dtype}, score double").withColumn("score", F.round("score", 6))
    ranked = topk(scores, ["q"], [F.col("score").desc(), F.col("d")], k)
    return ranked.select(F.col("q").alias(query_id), "rank", F.col("d").alias(doc_id), "score")


def _block_of_queries(queries: DataFrame, qid: str, vec: str, extra: str | None):
    """One block of queries (about ``QUERY_BLOCK``), shipped to the tasks inside the closure."""
    rows = queries.select(qid, vec, *([extra] if extra else [])).collect()
    ids = np.array([r[qid] for r in rows], dtype=np.int64)
    mat = np.array([np.asarray(r[vec], dtype=np.float64) for r in rows]).reshape(len(rows), -1)
    tags = [r[extra] for r in rows] if extra else None
    return ids, mat, tags


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def vector_topk(items: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
                vec_col: str = "embedding", filter_col: str | None = None) -> DataFrame:
    """Exact cosine top-k of every query over all items (ties: smaller id).

    Items are scored in tiles of ``TILE`` rows and queries (numpy inside
    ``mapInPandas``) beside a running top list per query; a task forwards only that
    (the k best plus any within rounding distance of the k-th), so the shuffle
    carries O(k) rows per task and query, not one row per item and query. The final rank is a ``row_number() <= k`` window on the
    rounded similarity. With ``filter_col`` an item is only ranked for queries
    with the same value in that column (hybrid search, filter before rank).
    A query set of any size is taken in blocks of about ``QUERY_BLOCK``; with
    several blocks each one's result is written before the next is read.
    """
    blocks = -(-queries.count() // QUERY_BLOCK)
    if blocks > 1:
        out = None
        for b in range(blocks):
            part = queries.where(F.pmod(F.xxhash64(id_col), F.lit(blocks)) == b)
            done = materialize(_topk_of_block(items, part, k, id_col, vec_col, filter_col), "topk")
            out = done if out is None else out.unionByName(done)
        return out
    return _topk_of_block(items, queries, k, id_col, vec_col, filter_col)


class RunningTop:
    """Running best ``k`` (score descending on 6 digits, then id) per query; what ties in 6 digits stays."""

    def __init__(self, n: int, k: int):
        self.k, self.ids, self.scores = k, [np.empty(0, np.int64)] * n, [np.empty(0)] * n

    def add(self, j: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate((self.ids[j], ids)), np.concatenate((self.scores[j], scores))
        if len(scores) > self.k:
            keep = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k] - 2e-6
            if keep.sum() > 4 * self.k:  # many ties: rank them as the result does
                at = np.flatnonzero(keep)
                keep = at[np.lexsort((ids[at], -np.round(scores[at], 6)))[:2 * self.k]]
            ids, scores = ids[keep], scores[keep]
        self.ids[j], self.scores[j] = ids, scores

    def frame(self, qids: np.ndarray) -> pd.DataFrame:
        sizes = [len(x) for x in self.ids]
        return pd.DataFrame({"q": np.repeat(qids, sizes), "id": np.concatenate([np.empty(0, np.int64), *self.ids]),
                             "sim": np.concatenate([np.empty(0), *self.scores])})


def _topk_of_block(items: DataFrame, queries: DataFrame, k: int, id_col: str, vec_col: str,
                   filter_col: str | None) -> DataFrame:
    qids, qmat, qtags = _block_of_queries(queries, id_col, vec_col, filter_col)
    qunit = _unit(qmat)
    cols = [id_col, vec_col] + ([filter_col] if filter_col else [])

    def run(batches):
        top = RunningTop(len(qids), k)
        tags = np.array(qtags, dtype=object) if filter_col else None
        for pdf in batches:
            for at in range(0, len(pdf), TILE):
                part = pdf.iloc[at:at + TILE]
                x = _unit(np.stack(part[vec_col].to_numpy()).astype(np.float64))
                ids = part[id_col].to_numpy()
                mine = part[filter_col].to_numpy() if filter_col else None
                for lo in range(0, len(qids), TILE):
                    sims = qunit[lo:lo + TILE] @ x.T
                    for j in range(lo, min(lo + TILE, len(qids))):
                        ok = np.isfinite(sims[j - lo]) if mine is None else np.isfinite(sims[j - lo]) & (mine == tags[j])
                        top.add(j, ids[ok], sims[j - lo][ok])
        yield top.frame(qids)

    scored = items.select(*cols).mapInPandas(run, "q long, id long, sim double")
    scored = scored.withColumn("sim", F.round("sim", 6))
    ranked = topk(scored, ["q"], [F.col("sim").desc(), F.col("id")], k)
    return ranked.select("q", "rank", F.col("id").alias(id_col), "sim")
