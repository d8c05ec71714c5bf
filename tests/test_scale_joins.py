"""Joins and samples whose driver or shuffle share must not grow with the table."""

import numpy as np
from pyspark.sql import functions as F

from brute import cos_score, sequential_greedy
from mediasift.operators import frame_dedup, leaders, metric_join, ops, search, simjoin, vector_index
from mediasift.operators.simjoin import PhashSpec


def _plans(monkeypatch, module):
    seen, write = [], module.materialize

    def kept(df, name="t"):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(module, "materialize", kept)
    return seen


def test_band_keys_are_never_broadcast(spark, monkeypatch):
    """An item's hundreds of keys are estimated as one row; joined with the sizes they are merged."""
    rows = [(i, [int(x) for x in np.random.default_rng(i).integers(-2**62, 2**62, 5)]) for i in range(40)]
    rows += [(100 + i, [h ^ 3 for h in hs]) for i, hs in rows[:10]]
    sigs = spark.createDataFrame(rows, "video_id long, hashes array<long>")
    spec = PhashSpec(threshold=5.0, radius=2)
    seen = _plans(monkeypatch, simjoin)
    items = spec.prepare(sigs.withColumnRenamed("video_id", "id"))
    keys = simjoin.shared_keys(items, spec)
    joined = [p for name, p in seen if name == "keys"]
    assert joined and all("SortMergeJoin" in p and "Broadcast" not in p for p in joined)
    pairs = simjoin.candidate_pairs(keys.where("is_index"), keys.where("is_probe")).where("a < b")
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert {(r.a, r.b) for r in pairs.collect()} >= {(i, 100 + i) for i in range(10)}
    found = leaders.greedy_leaders(sigs, spec).where(~F.col("is_unique")).collect()
    assert {(r.video_id, r.primary_id) for r in found} == {(100 + i, i) for i in range(10)}


def test_items_keys_and_edges_are_never_broadcast(spark, monkeypatch):
    """No step of the leaders, the groups or the sampled frames sends a table that grows with the items whole
    through the driver, however small it is estimated."""
    hashes = {i: [int(x) for x in np.random.default_rng(i).integers(-2**62, 2**62, 5)] for i in range(40)}
    hashes |= {100 + i: [h ^ 3 for h in hashes[i]] for i in range(10)} | {200 + i: hashes[i] for i in range(5)}
    hashes |= {300 + i: [hashes[39][0] ^ (1 << i), *hashes[39][1:]] for i in range(12)}
    sigs = spark.createDataFrame(list(hashes.items()), "video_id long, hashes array<long>")
    spec = PhashSpec(threshold=5.0, radius=2)
    seen = _plans(monkeypatch, simjoin)
    found = leaders.greedy_leaders(sigs, spec, small_bucket=4)
    groups = leaders.similarity_groups(sigs, spec)
    plans = seen + [(n, df._jdf.queryExecution().executedPlan().toString()) for n, df in (("leaders", found), ("groups", groups))]
    assert {"thinned", "edges", "state", "stars", "labels", "cc_edges"} <= {n for n, _ in plans}
    assert not [n for n, p in plans if "BroadcastExchange" in p]
    want = {100 + i: i for i in range(10)} | {200 + i: i for i in range(5)} | {300 + i: 39 for i in range(12)}
    assert {r.video_id: r.primary_id for r in found.where(~F.col("is_unique")).collect()} == want
    assert {r.id: r.group_id for r in groups.collect() if r.id >= 100} == want
    videos = spark.createDataFrame([(i, 5) for i in range(9)], "video_id long, n_frames int")
    frames = spark.createDataFrame([(i, f, [1, 2, 3, 4]) for i in range(9) for f in range(5)],
                                   "video_id long, frame_idx int, luma array<int>")
    reads = frame_dedup.sampled(videos, frames, 3)
    assert "BroadcastExchange" not in reads._jdf.queryExecution().executedPlan().toString()
    assert reads.where("later = 0").count() == 27


def test_index_sends_pairs_not_vectors(spark, monkeypatch):
    """the index's vectors are never the broadcast side, however small their estimate."""
    rng = np.random.default_rng(3)
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 8)))],
                                  "vec_id long, embedding array<double>")
    index = vector_index.build_index(items, 4, 4)
    seen = []
    rescore = vector_index._rescore
    monkeypatch.setattr(vector_index, "_rescore", lambda *a: seen.append(rescore(*a)) or seen[-1])
    few = items.where("vec_id % 50 = 0")
    want = {(r.q, r.rank, r.vec_id) for r in search.vector_topk(items, few, 5).collect()}
    for sent, kind in ((vector_index.SENT_PAIRS, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(vector_index, "SENT_PAIRS", sent)
        got = vector_index.search_index(index, few, 5, exact=True)
        assert {(r.q, r.rank, r.vec_id) for r in got.collect()} == want
        plan = seen[-1]._jdf.queryExecution().executedPlan().toString()
        assert kind in plan
        assert kind == "SortMergeJoin" or "vec" not in plan.split("BroadcastExchange")[1].split("Scan parquet")[0]


def test_sample_is_cut_before_the_sort(spark):
    """the rows with the least hashes, and only a few more pass to the sort; repeated ids are no loss."""
    df = spark.range(0, 20_000, numPartitions=16)
    want = [r.id for r in df.orderBy(F.xxhash64("id"), "id").limit(500).collect()]
    some = ops.least_hashed(df, "id", 500)
    assert [r.id for r in some.collect()] == want
    assert "xxhash64(id" in some._jdf.queryExecution().optimizedPlan().toString().split("Filter")[-1]
    same = df.withColumn("id", F.lit(7).cast("long"))
    assert ops.least_hashed(same, "id", 500).count() == 500
    assert ops.least_hashed(df.limit(3), "id", 500).count() == 3


def test_exact_leaders_thin_groups_of_near_copies(spark, monkeypatch):
    """the exact join makes the candidates of greedy leaders, also when a large group is thinned out first."""
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(12)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((60, 12)))]
    rows += [(1000 + i, centre + 0.12 * rng.standard_normal(12)) for i in range(160)]
    rows = [(int(i), [v.tolist()]) for i, v in rows]
    spec = metric_join.ExactEmbeddingSpec(threshold=0.95)
    asked = []
    monkeypatch.setattr(metric_join.ExactEmbeddingSpec, "candidates",
                        lambda self, items: asked.append(1) or metric_join.pivot_candidates(items, self.threshold))
    df = spark.createDataFrame(rows, "video_id long, frames array<array<double>>")
    want = sequential_greedy(rows, cos_score, lambda s: s >= 0.95, lambda a, b: a > b)
    for small, calls in ((10 ** 6, 1), (20, 3)):
        asked.clear()
        got = {r.video_id: (r.primary_id, r.is_unique) for r in leaders.greedy_leaders(df, spec, small_bucket=small).collect()}
        assert got == {k: (v[0], v[2]) for k, v in want.items()}
        assert len(asked) >= calls


def test_pivots_weigh_the_rows_they_send():
    """rows without clusters would visit most cells; one cell sends each row once for each block."""
    x = np.random.default_rng(5).standard_normal((1500, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sent = {}
    for n in (1_500, 140_000):
        pivots = metric_join.fit_pivots(x, 0.32, n)
        home, _, near = metric_join.visits(x, pivots, 0.32)
        held = (np.bincount(home, minlength=len(pivots)) + near.sum(axis=0)) * n / len(x)
        sent[n] = (held * np.ceil(held / metric_join.BLOCK)).sum() / n
    assert max(sent.values()) <= np.ceil(140_000 / metric_join.BLOCK)
    groups = np.repeat(np.eye(64), 20, axis=0)
    assert len(metric_join.fit_pivots(groups, 0.32, 1_000_000)) >= 16
