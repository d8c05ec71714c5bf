"""Overlaps whose ends lie at frequent seeds: compared on in rounds of some words, not with whole texts at hand."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediasift.operators import overlap


@pytest.mark.parametrize("ahead", [2, 64])
def test_open_ends_send_the_words_they_need(spark, monkeypatch, ahead):
    """each open span took both whole texts along; now a round sends at most its size of words for a place."""
    rng = np.random.default_rng(4)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 4000, n)]
    common = word(300)
    texts = {i: word(5 + i) + common + word(400) for i in range(6)} | {6: word(3) + common[:130] + word(60), 7: list(common[100:])}
    sent = []
    write = overlap.materialize

    def kept(df, name="t"):
        out = write(df, name)
        if name == "asked-words":
            sent.append(out.agg(F.max(F.size("words"))).first()[0])
        return out

    monkeypatch.setattr(overlap, "materialize", kept)
    monkeypatch.setattr(overlap, "AHEAD", ahead)
    monkeypatch.setattr(overlap, "FASTER", 4)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "id long, text string")
    spans, want = [], set()
    for a in range(1, 8):
        for b in range(a):
            first = {6: 0, 7: 100}
            at = {i: (5 + i if i < 6 else 3 if i == 6 else 0) - first.get(i, 0) * (i == 7) for i in (a, b)}  # place of common[0]
            lo = max(100 if 7 in (a, b) else 0, 0)
            hi = 130 if 6 in (a, b) else 300
            x, y, n = at[a] + lo, at[b] + lo, hi - lo
            while x > 0 and y > 0 and texts[a][x - 1] == texts[b][y - 1]:
                x, y, n = x - 1, y - 1, n + 1
            while x + n < len(texts[a]) and y + n < len(texts[b]) and texts[a][x + n] == texts[b][y + n]:
                n += 1
            spans.append((a, b, x - y, x + 5, x + 20, True, True))
            want.add((a, b, x - y, x, x + n))
    rows = spark.createDataFrame(spans, "id long, source long, diag int, start int, end int, more_back boolean, more_on boolean")
    got = [tuple(r) for r in overlap._extended(rows, df).select("id", "source", "diag", "start", "end").collect()]
    assert set(got) == want and len(got) == len(want)
    assert sent and all(n <= ahead * 4 ** i for i, n in enumerate(sent))
    assert [r.asDict() for r in overlap._extended(rows.limit(0), df).collect()] == []


def test_seeds_hash_the_words_of_any_white_space(spark):
    texts = ["a b\tc\x0b d\u00a0e\x0cf g\r\nh  i \u2003 j k\u0085 l ", "", " \t", "one two", None, "x " * 40, "\u00e4 \U0001f600 " * 9]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("w", overlap.words("text"))
    want = set()
    for r in df.where("size(w) >= 8").collect():
        h = np.array([int(hashlib.md5(" ".join(r.w[i:i + 8]).encode()).hexdigest()[:15], 16) for i in range(len(r.w) - 7)])
        pos = overlap.winnow(h, 16)
        want |= {(int(h[p]), r.id, int(p), bool(p == min(q for q in pos if h[q] == h[p]))) for p in pos}
    got = [tuple(r) for r in overlap.seeds(df.select("id", "text"), "id", "text").select("h", "id", "pos", "first").collect()]
    assert set(got) == want and len(got) == len(want) > 3
