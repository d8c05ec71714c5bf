"""Joins of the document overlaps, whose sides grow with the texts."""

import numpy as np

from mediasift.operators import overlap


def test_overlaps_broadcast_nothing(spark, monkeypatch):
    """words, seeds and spans were sent whole through the driver by the size of their compressed files."""
    rng = np.random.default_rng(6)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 4000, n)]
    common = word(300)
    texts = [" ".join(word(5) + common[:100 + 8 * i] + word(40)) for i in range(24)]  # seeds of over 20 texts: open ends
    df = spark.createDataFrame([*enumerate(texts), (24, texts[3])], "doc_id long, text string")
    seen, write = [], overlap.materialize

    def kept(df, name="t"):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(overlap, "materialize", kept)
    found = overlap.document_overlaps(df)
    seen.append(("overlaps", found._jdf.queryExecution().executedPlan().toString()))
    assert {"seeds", "seed-words", "spans", "asked-words", "moved-ends"} <= {n for n, _ in seen}
    assert not [n for n, p in seen if "BroadcastExchange" in p]
    got = {(r.doc_id, r.source_id): (r.start, r.source_start, r.length) for r in found.collect()}
    assert all(got[i, 0] == (5, 5, 100) for i in range(1, 24)) and not [k for k in got if 24 in k]
    assert got[23, 22] == (5, 5, 276)
