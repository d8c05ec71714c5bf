import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brute import components, cos_score, phash_score, sequential_greedy
from mediasift.operators.leaders import connected_groups, greedy_leaders, lookup_index, similarity_pairs
from mediasift.operators.simjoin import EmbeddingSpec, PhashSpec

SIG = T.StructType([T.StructField("video_id", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType()))])
EMB = T.StructType([T.StructField("video_id", T.LongType()),
                    T.StructField("frames", T.ArrayType(T.ArrayType(T.DoubleType())))])


def _flip(h, bits):
    for b in bits:
        h ^= 1 << b
    return h - (1 << 64) if h >= 1 << 63 else h


def _run_phash(spark, rows, spec, on_missing="keep"):
    df = spark.createDataFrame(rows, SIG)
    got = {r.video_id: (r.primary_id, r.score, r.is_unique)
           for r in greedy_leaders(df, spec, on_missing=on_missing).collect()}
    want = sequential_greedy(sorted(rows), phash_score, lambda s: s <= spec.threshold, lambda a, b: a < b)
    if on_missing == "drop":
        want = {k: v for k, v in want.items() if dict(rows)[k] is not None}
    return got, want


def _same(got, want):
    assert set(got) == set(want)
    for k in want:
        gp, gs, gu = got[k]
        wp, ws, wu = want[k]
        assert (gp, gu) == (wp, wu), k
        assert (gs is None and ws is None) or abs(gs - ws) < 1e-9, k


@pytest.mark.parametrize("radius", [0, 1])
def test_chain_is_not_transitive(spark, radius):
    a = 0x0F0F_0F0F_0F0F_0F0F
    rows = [(1, [a, a]), (2, [_flip(a, range(4)), _flip(a, range(4))]),
            (3, [_flip(a, range(8)), _flip(a, range(8))])]
    got, want = _run_phash(spark, rows, PhashSpec(5.0, radius))
    _same(got, want)
    assert got[1][2] and not got[2][2] and got[3][2]      # A leader, B dup, C leader


def test_tie_goes_to_earliest_leader(spark):
    a = 0
    b = _flip(0, range(10))            # distance 10 from a: both leaders
    c = _flip(0, [0, 1, 2, 3, 4])      # distance 5 to a and to b
    c = _flip(0, list(range(5)))
    rows = [(1, [a]), (2, [b]), (3, [_flip(0, [0, 1, 2, 3, 4])])]
    got, want = _run_phash(spark, rows, PhashSpec(5.0, 1))
    _same(got, want)
    assert got[3][0] == 1


def test_unequal_frames_null_and_empty(spark):
    h = 12345
    rows = [(1, [h, h, h]), (2, [h, h]), (3, None), (4, []), (5, [h, h, h])]
    got, want = _run_phash(spark, rows, PhashSpec(5.0, 1))
    _same(got, want)
    assert got[5] == (1, 0.0, False) and got[2][2] and got[3][2] and got[4][2]
    dropped, want_d = _run_phash(spark, rows, PhashSpec(5.0, 1), on_missing="drop")
    assert 3 not in dropped and set(dropped) == set(want_d)


def test_hot_key_identical_signatures(spark):
    h = [7, 7, 7]
    rows = [(i, h) for i in range(300)] + [(1000 + i, [_flip(7, [i % 60]), 7, 7]) for i in range(50)]
    got, want = _run_phash(spark, rows, PhashSpec(5.0, 1))
    _same(got, want)
    assert sum(1 for v in got.values() if v[2]) == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_planted_copies_match_sequential(spark, seed):
    rnd = random.Random(seed)
    rows, vid = [], 0
    for _ in range(40):
        base = [rnd.getrandbits(64) - (1 << 63) for _ in range(3)]
        rows.append((vid, base))
        vid += 1
        for _ in range(rnd.randint(0, 3)):
            rows.append((vid, [_flip(x + (1 << 63), rnd.sample(range(64), rnd.randint(0, 7))) for x in base]))
            vid += 1
    rnd.shuffle(rows)
    rows = [(i, sig) for i, (_, sig) in enumerate(rows)]
    for radius in (0, 1):
        got, want = _run_phash(spark, rows, PhashSpec(4.0, radius))
        _same(got, want)


def test_embedding_greedy_and_zero_vector(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(30):
        v = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(2)]
        rows.append((i * 3, v))
        rows.append((i * 3 + 1, [[x + rnd.gauss(0, 0.05) for x in f] for f in v]))
    rows.append((1000, [[0.0] * 8, [0.0] * 8]))
    rows.append((1001, [[0.0] * 8, [0.0] * 8]))
    df = spark.createDataFrame(rows, EMB)
    spec = EmbeddingSpec(0.95, bands=48, bits_per_band=8)
    got = {r.video_id: (r.primary_id, r.score, r.is_unique) for r in greedy_leaders(df, spec).collect()}
    want = sequential_greedy(sorted(rows), cos_score, lambda s: s >= 0.95, lambda a, b: a > b)
    _same(got, want)
    assert got[1001][2]                     # zero vectors never match, not even each other


def test_pairs_equal_brute_force(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(60):
        base = rnd.getrandbits(64)
        rows.append((2 * i, [base - (1 << 63)]))
        rows.append((2 * i + 1, [_flip(base, rnd.sample(range(64), rnd.randint(0, 8)))]))
    df = spark.createDataFrame(rows, SIG)
    spec = PhashSpec(5.0, 0)
    got = {(r.id_a, r.id_b) for r in similarity_pairs(df, spec).collect()}
    want = {(a, b) for a, sa in rows for b, sb in rows if a < b and phash_score(sa, sb) <= 5}
    assert got == want


def test_components_and_lookup(spark):
    edges = [(1, 2), (2, 3), (5, 6), (7, 7)]
    nodes = list(range(1, 9))
    got = {r.id: r.group_id for r in connected_groups(
        spark.createDataFrame([(n,) for n in nodes], "id long"),
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == components(nodes, edges)
    idx = spark.createDataFrame([(1, [0]), (2, [_flip(0, range(20))])], SIG)
    probes = spark.createDataFrame([(10, [_flip(0, [1])]), (11, [_flip(0, range(40))])], SIG)
    res = {r.probe_id: (r.match_id, r.score) for r in lookup_index(probes, idx, PhashSpec(5.0, 1)).collect()}
    assert res == {10: (1, 1.0), 11: (None, None)}


def test_partition_invariant(spark):
    rows = [(i, [i % 3]) for i in range(20)] + [(100, None)]
    df = spark.createDataFrame(rows, SIG)
    res = greedy_leaders(df, PhashSpec(5.0, 1))
    u = res.where("is_unique").select("video_id")
    d = res.where(~F.col("is_unique")).select("video_id")
    assert u.intersect(d).count() == 0
    assert sorted(r[0] for r in u.unionByName(d).collect()) == sorted(r[0] for r in rows)


def test_lsh_pairs_subset_of_exact(spark):
    from conftest import SF_MID
    from mediasift.plans import dedup_queries as dq
    from mediasift.sources.fixtures import clone_frames, embedding_signatures

    lsh = dq.embedding_lsh_pairs(spark, SF_MID).collect()
    sigs = embedding_signatures(clone_frames(spark, SF_MID)).collect()
    by_id = {r.video_id: r.frames for r in sigs}
    exact = {(a, b) for a in by_id for b in by_id
             if a < b and len(by_id[a]) == len(by_id[b]) and cos_score(by_id[a], by_id[b]) >= 0.95}
    got = {(r.id_a, r.id_b) for r in lsh}
    assert got <= exact
    assert 0.9 < lsh[0].expected_recall <= 1.0
    assert len(got) / len(exact) >= 0.8


@pytest.mark.parametrize("small_bucket", [1, 2])
def test_hot_bucket_fallback_matches_sequential(spark, small_bucket):
    rnd = random.Random(11)
    rows, vid = [], 0
    hub = rnd.getrandbits(64)
    for _ in range(12):          # a cluster of near copies: buckets bigger than small_bucket
        rows.append((vid, [_flip(hub, rnd.sample(range(64), rnd.randint(0, 6)))]))
        vid += 1
    for _ in range(15):
        base = rnd.getrandbits(64)
        rows.append((vid, [base - (1 << 63)]))
        rows.append((vid + 1, [_flip(base, rnd.sample(range(64), 3))]))
        vid += 2
    rnd.shuffle(rows)
    rows = [(i, sig) for i, (_, sig) in enumerate(rows)]
    df = spark.createDataFrame(rows, SIG)
    spec = PhashSpec(5.0, 1)
    got = {r.video_id: (r.primary_id, r.score, r.is_unique)
           for r in greedy_leaders(df, spec, small_bucket=small_bucket).collect()}
    want = sequential_greedy(sorted(rows), phash_score, lambda s: s <= 5.0, lambda a, b: a < b)
    _same(got, want)


def test_deterministic_across_partitioning(spark):
    from conftest import SF_SMALL
    from mediasift.plans.dedup_queries import PHASH
    from mediasift.sources.fixtures import clone_frames, phash_signatures

    sigs = phash_signatures(clone_frames(spark, SF_SMALL)).cache()
    one = {tuple(r) for r in greedy_leaders(sigs.coalesce(1), PHASH).collect()}
    many = {tuple(r) for r in greedy_leaders(sigs.repartition(64).orderBy(F.rand(7)), PHASH).collect()}
    assert one == many and len(one) == sigs.count()


def test_pairs_list_copies_linearly_and_components_keep_them(spark):
    rows = [(1, [5]), (2, [5]), (3, [5]), (4, [_flip(5, [0, 1])]), (9, [_flip(5, range(30))])]
    df = spark.createDataFrame(rows, SIG)
    spec = PhashSpec(5.0, 1)
    pairs = {(r.id_a, r.id_b) for r in similarity_pairs(df, spec).collect()}
    assert pairs == {(1, 4), (1, 2), (1, 3)}      # each copy once, with the smallest id of its signature
    edges = similarity_pairs(df, spec).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    groups = {r.id: r.group_id for r in connected_groups(df.select(F.col("video_id").alias("id")), edges).collect()}
    assert groups == {1: 1, 2: 1, 3: 1, 4: 1, 9: 9}
