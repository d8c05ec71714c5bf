"""Sketches merged over a cube against exact counts; labels never made; preview."""

import numpy as np
from mediasift.operators import ops


def test_merged_sketches_stay_within_the_stated_error(spark):
    rng = np.random.default_rng(4)
    n = 60_000
    value = np.floor(np.exp(rng.normal(6, 1.5, n))).astype(int)
    group = np.where(rng.random(n) < 0.4, "hot", rng.choice(["a", "b", "c"], n))
    df = spark.createDataFrame([(g, int(i % 2), int(v) if i % 100 else None) for i, (g, v) in enumerate(zip(group, value))],
                               "lang string, source int, chars int")
    parts = ops.value_sketches(df, ["lang", "source"], "chars")
    out = ops.sketch_cube(parts, ["lang", "source"], {"p10": 0.1, "p50": 0.5, "p99": 0.99}).collect()
    assert len(out) == 4 * 2 + 4 + 2 + 1
    known = np.arange(n) % 100 != 0
    for r in out:
        sel = np.ones(n, dtype=bool)
        if r["level"] in (0, 1):
            sel &= group == r["lang"]
        if r["level"] in (0, 2):
            sel &= np.arange(n) % 2 == r["source"]
        vals = value[sel & known]
        assert r["n"] == sel.sum()
        assert abs(r["distinct_values"] / len(np.unique(vals)) - 1) < 0.03
        for c, share in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)):
            slack = 2 / ops.QUANTILE_K + 1 / len(vals)
            assert (vals < r[c]).mean() - slack <= share <= (vals <= r[c]).mean() + slack


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([("x", None)], "lang string, chars int")
    row = [r for r in ops.sketch_cube(ops.value_sketches(df, ["lang"], "chars"), ["lang"], {"p50": 0.5}).collect() if r["level"] == 0][0]
    assert (row["n"], row["distinct_values"], row["p50"]) == (1, 0, None)
    assert ops.value_sketches(df.limit(0), ["lang"], "chars").count() == 0


def test_stale_labels_and_preview(spark):
    labels = spark.createDataFrame([(1, 1), (2, 3), (3, None)], "doc_id long, version int")
    items = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "doc_id long")
    assert sorted(r[0] for r in ops.stale_labels(labels, "version", 2, items=items).collect()) == [1, 3, 4]
    assert [r[0] for r in ops.preview(items, ["doc_id"], 2).collect()] == [1, 2]
