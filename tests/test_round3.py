"""Vector index, exact metric join and overlaps between documents against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediasift.operators import metric_join, overlap, search, vector_index
from mediasift.operators import leaders
from mediasift.operators.leaders import similarity_groups, similarity_pairs
from mediasift.operators.simjoin import PhashSpec, shared_keys


def _vectors(spark, n=600, dims=24, seed=3, spread=0.5):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, dims))
    rows = [(i, [float(np.float32(x)) for x in centre[i % 12] + spread * rng.normal(size=dims)], str(i % 3)) for i in range(n)]
    rows += [(n + i, rows[6][1], "0") for i in range(40)] + [(n + 100, [0.0] * dims, "1")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize("cells,parts", [(16, 8), (1, 2), (500, 24)])
def test_index_exact_equals_scan(spark, cells, parts):
    items = _vectors(spark).repartition(5)
    queries = items.where("vec_id % 20 = 0 OR vec_id = 700")
    index = vector_index.build_index(items, cells, parts, filter_col="label")
    assert index.rows().count() == items.count()
    want = search.vector_topk(items, queries, 5)
    assert _same(vector_index.search_index(index, queries, 5, exact=True, probes=1), want)
    want = search.vector_topk(items, queries, 4, filter_col="label")
    assert _same(vector_index.search_index(index, queries, 4, exact=True, probes=2, filter_col="label"), want)


def test_index_recall_and_calibration(spark, monkeypatch):
    items = _vectors(spark, 1500)
    queries = items.where("vec_id % 25 = 0")
    index = vector_index.calibrate(vector_index.build_index(items, 24, 12), queries, 5, 0.97)
    assert 1 <= index.probes < 24
    truth = search.vector_topk(items, queries, 5)
    monkeypatch.setattr(vector_index, "QUERY_BLOCK", 20)
    found = vector_index.search_index(index, queries, 5)
    row = vector_index.recall(found, truth).first()
    assert row.queries == queries.count() and row.neighbours == 5 * row.queries
    assert row.recall >= 0.9
    assert vector_index.recall(truth, truth).first().recall == 1.0
    assert vector_index.search_index(index, queries.limit(0), 5).count() == 0


def test_index_of_awkward_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, None, 1), (None, [0.5, 0.5], 1), (3, [0.0, 2.0], None), (4, [], 2)]
    items = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("cell", F.lit("x"))
    index = vector_index.build_index(items, 4, 2, filter_col="label")
    got = vector_index.search_index(index, items, 2, exact=True).collect()
    assert sorted((r.q, r["rank"], r.vec_id) for r in got if r.q == 3) == [(3, 1, 3), (3, 2, 1)]
    with pytest.raises(ValueError, match="nothing"):
        vector_index.build_index(items.limit(0))


# --- exact metric join ---

def _clouds(rng, n, dims, clusters, spread):
    centre = rng.normal(size=(clusters, dims))
    x = centre[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, dims))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("clusters,spread,t", [(1, 1.0, 0.95), (30, 0.12, 0.95), (30, 0.05, 0.99), (200, 0.2, 0.8), (3, 0.01, 0.95)])
def test_every_match_meets_in_one_cell(clusters, spread, t):
    x = _clouds(np.random.default_rng(clusters), 500, 16, clusters, spread)
    x[7] *= 0.98  # a vector with a zero frame is shorter
    e = float(np.sqrt(2 - 2 * t))
    for pivots in (metric_join.fit_pivots(x, e), metric_join.choose_pivots(x, 64)):
        home, dist, near = metric_join.visits(x, pivots, e)
        wide = np.array([dist[home == c, c].max(initial=-1) for c in range(len(pivots))])
        member = near & (dist <= wide[None, :] + e + 1e-7)
        member[np.arange(len(x)), home] = True
        a, b = np.nonzero(np.triu(x @ x.T >= t, 1))
        at_home = np.zeros_like(member)
        at_home[np.arange(len(x)), home] = True
        meet = (member[a] & member[b] & (at_home[a] | at_home[b])).sum(axis=1)
        assert (meet == 1).all()


@pytest.mark.parametrize("block", [metric_join.BLOCK, 16])
def test_exact_join_equals_all_pairs(spark, block, monkeypatch):
    rng = np.random.default_rng(9)
    x = _clouds(rng, 240, 12, 25, 0.12)
    x = np.concatenate((x, x[:20], x[3] + 0.01 * rng.normal(size=(90, 12))))  # copies, and a third in one cluster
    rows = [(i, [[float(v) for v in f] for f in y.reshape(3, 4)]) for i, y in enumerate(x)]
    rows += [(1000, [[0.0] * 4, [1.0, 0.0, 0.0, 0.0], [0.0] * 4]), (1001, []), (1002, None), (1003, [[1.0, 0.0, 0.0, 0.0]]), (1004, [[2.0, 0.0, 0.0, 0.0]]),
             (1005, [[0.0] * 4] * 3)]
    df = spark.createDataFrame(rows, "video_id long, frames array<array<double>>")
    spec = metric_join.ExactEmbeddingSpec(threshold=0.95)
    if block < metric_join.BLOCK:
        monkeypatch.setattr(metric_join.ExactEmbeddingSpec, "candidates",
                            lambda self, items: metric_join.pivot_candidates(items, self.threshold, block))
    got = {(r.id_a, r.id_b): r.score for r in similarity_pairs(df, spec).collect()}
    unit = {}
    for i, frames in rows:
        if frames:
            f = np.array(frames)
            n = np.linalg.norm(f, axis=1, keepdims=True)
            unit[i] = (np.divide(f, n, out=np.zeros_like(f), where=n > 0) / np.sqrt(len(f))).ravel()
    first = {}
    for i, frames in rows:
        if frames and (np.abs(np.array(frames)).sum(axis=1) > 0).mean() >= 0.95:
            first.setdefault(unit[i].tobytes(), []).append(i)
    reps = [v[0] for v in first.values()]
    want = {(a, b) for a in reps for b in reps if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95}
    want |= {(v[0], c) for v in first.values() for c in v[1:]}
    assert set(got) == want and len(want) > 4000
    assert all(abs(got[a, b] - unit[a] @ unit[b]) < 1e-9 for a, b in want)
    assert similarity_pairs(df.limit(0), spec).count() == 0


# --- overlaps between documents ---

def test_winnow_leaves_no_window_without_a_seed():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 16, 17, 300):
        h = rng.integers(0, 50, n)
        chosen = overlap.winnow(h, 16)
        for i in range(max(0, n - 15)):
            inside = chosen[(chosen >= i) & (chosen < i + 16)]
            assert h[inside].min() == h[i:i + 16].min()
        assert n == 0 or len(chosen) > 0


def _long_common(a, b, least):
    """Maximal equal runs (start in a, start in b, length) of at least ``least`` words."""
    out = []
    for d in range(-len(b) + 1, len(a)):
        i, run = max(d, 0), 0
        while i < len(a) and i - d < len(b):
            run = run + 1 if a[i] == b[i - d] else 0
            i += 1
            if run >= least and (i == len(a) or i - d == len(b) or a[i] != b[i - d]):
                out.append((i - run, i - run - d, run))
    return out


@pytest.mark.parametrize("max_df", [20, 3])
def test_document_overlaps(spark, max_df):
    rng = np.random.default_rng(8)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 4000, n)]
    passage, frequent, other = word(40), word(30), word(23)
    texts = {i: word(60) for i in range(30)}
    for i in (3, 9, 12):
        texts[i] = texts[i][:17] + passage + texts[i][17:]
    texts[5] = texts[5][:4] + other + texts[5][4:] + other
    texts[6] = other + texts[6]
    for i in range(10, 30):
        texts[i] = texts[i] + frequent
    texts[30] = list(texts[9])                    # an exact copy, and a group of near copies
    for i in range(40, 70):
        texts[i] = texts[9][:50] + [f"own{i}"] + texts[9][50:]
    rows = [(i, "  " + " ".join(t), "x") for i, t in texts.items()]
    rows += [rows[4], (None, " ".join(passage), "x"), (80, None, None), (81, "", "x"), (82, "few words", "x"), (83, " ".join(["a"] * 500), "x"),
             (84, "b " + " ".join(["a"] * 400), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, H string").withColumn("source", F.lit(1))
    got = {(r.doc_id, r.source_id, r.start, r.source_start, r.length)
           for r in overlap.document_overlaps(df.repartition(4), max_df=max_df).collect()}
    assert all(texts[a][s:s + n] == texts[b][q:q + n] and n >= 23 and b < a for a, b, s, q, n in got if a < 80)
    pairs = {(a, b) for a, b, *_ in got}
    rare = {(9, 3), (12, 3), (12, 9), (6, 5)}
    assert rare - pairs == set() if max_df == 20 else {(9, 3), (12, 3), (6, 5)} <= pairs
    assert 30 not in {a for a, *_ in got} | {b for _, b, *_ in got}
    assert {a for a, b in pairs if b == 10} >= set(range(11, 30)) - {30}           # each linked with the first holder
    assert len([p for p in pairs if p[0] >= 40 and p[0] < 70]) <= 30 * max_df      # near copies: no square of links
    for a, b in rare & pairs:
        want = set(_long_common(texts[a], texts[b], 23)) if (a, b) != (6, 5) else {(0, 4, 23)}  # a source's first place
        assert {x[2:] for x in got if x[:2] == (a, b)} == want
    assert {(s, q, n) for a, b, s, q, n in got if (a, b) == (84, 83)} and max(n for a, b, s, q, n in got if (a, b) == (84, 83)) == 400
    assert overlap.document_overlaps(df.limit(0)).count() == 0


# --- groups without pairs ---

def _hashes(rng, n, cluster):
    """Random signatures of two frames; ``cluster`` of them within a few bits of one, and chains of close steps."""
    sig = rng.integers(-2 ** 62, 2 ** 62, (n, 2))
    for i in range(cluster):
        sig[i] = sig[0]
        for bit in rng.integers(0, 62, 3):
            sig[i, i % 2] ^= 1 << int(bit)
    for i in range(cluster + 1, cluster + 12):  # a chain: only neighbours match
        sig[i] = sig[i - 1]
        for bit in range((i - cluster) * 4, (i - cluster) * 4 + 4):
            sig[i, 0] ^= 1 << bit
    return sig


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_groups_equal_components_of_all_pairs(spark, radius):
    rng = np.random.default_rng(radius)
    sig = _hashes(rng, 160, 60)
    rows = [(1000 - i, [int(x) for x in s]) for i, s in enumerate(sig)] + [(5, [int(x) for x in sig[100]]), (1, None), (2, [])]
    df = spark.createDataFrame(rows, "video_id long, hashes array<long>")
    spec = PhashSpec(threshold=2.0, radius=radius)
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, s in rows:
        for b, t in rows:
            if a < b and s and t and sum(bin((x ^ y) & (2 ** 64 - 1)).count("1") for x, y in zip(s, t)) <= 4:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = {r.id: (r.group_id, r.n) for r in similarity_groups(df, spec).collect()}
    size = {}
    for i, _ in rows:
        size[root(i)] = size.get(root(i), 0) + 1
    assert got == {i: (root(i), size[root(i)]) for i, _ in rows} and max(size.values()) >= 60
    assert similarity_groups(df.limit(0), spec).count() == 0


def test_near_copies_give_linear_links(spark):
    counts = []
    for n in (90, 180):
        sig = _hashes(np.random.default_rng(3), n, n // 3)
        df = spark.createDataFrame([(i, [int(x) for x in s], 2) for i, s in enumerate(sig)], "id long, sig array<long>, nf int")
        spec = PhashSpec(threshold=3.0, radius=0)
        keys = shared_keys(df, spec)
        stars = leaders._star_links(keys, df.select("id", "sig"), spec)
        labels = leaders.connected_groups(df.select("id"), stars)
        counts.append(stars.count() + leaders._open_links(keys, labels, df.select("id", "sig"), spec).count())
    assert counts[1] < 3 * counts[0] and counts[1] < 180 * 8 < 60 * 59 / 2


def test_cube_tells_subtotals_from_null_keys(spark):
    from mediasift.operators import ops

    docs = spark.createDataFrame([(1, "en", None, 5), (2, None, "a", 100), (3, None, None, None), (4, "en", "a", 20000)],
                                 "doc_id long, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    got = {(r.lang, r.source, r.level): r for r in ops.label_cube(docs, labels).collect()}
    assert len(got) == 4 + 2 + 2 + 1
    assert [got[None, None, level].n for level in (0, 1, 2, 3)] == [1, 2, 2, 4]
    whole = got[None, None, 3]
    assert (whole.labeled, whole.quality_rate, whole.min_chars, whole.max_chars) == (2, 0.5, 5, 20000)
    assert (whole.below_100, whole.below_1000, whole.below_10000, whole.from_10000) == (1, 1, 0, 1)
    assert ops.label_cube(docs.limit(0), labels).filter("level < 3").count() == 0
