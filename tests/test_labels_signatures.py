import numpy as np
from pyspark.sql import functions as F

from mediasift.operators import labels as lb
from mediasift.operators.infer import infer, linear_model_fn, linear_weights
from mediasift.operators.signatures import dct_hash, pack_bits, phash_bits


def test_object_threshold_and_max_per_label(spark):
    det = spark.createDataFrame(
        [(1, 0, "person", 0.70), (1, 0, "person", 0.71), (1, 1, "person", 0.93), (1, 0, "car", 0.65),
         (2, 0, "dog", 0.5)], "video_id long, frame_idx int, label string, score double")
    got = {(r.video_id, r.label): r.conf for r in lb.object_labels(det).collect()}
    assert got == {(1, "person"): 0.93}
    ppl = {r.video_id: (r.max_people, r.bucket, r.people_estimate) for r in lb.people_bucket(det).collect()}
    assert ppl == {1: (2, "2-5", "1"), 2: (0, "0", "0")}
    flat = lb.flatten_objects(lb.object_labels(det), ["car", "person"]).collect()
    assert [(r.video_id, r.ai_objects_car, r.ai_objects_person) for r in flat] == [(1, None, 0.93)]


def test_sound_events_softmax_top5_floor(spark):
    classes = ["a", "b", "c", "d", "e", "f"]
    twelve = [f"c{i:02d}" for i in range(12)]
    rows = ([(1, c, float(i)) for i, c in enumerate(classes)] + [(2, c, 0.0) for c in twelve * 3]
            + [(3, "solo", 1.0)] + [(4, c, 0.0) for c in classes])
    df = spark.createDataFrame(rows, "video_id long, label string, logit double")
    res = lb.sound_events(df).collect()
    v1 = sorted((r.rank, r.label) for r in res if r.video_id == 1)
    logits = np.arange(6.0)
    p = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
    want = [c for c, q in sorted(zip(classes, p), key=lambda t: -t[1]) if q > 0.1][:5]
    assert [lab for _, lab in v1] == want
    assert not [r for r in res if r.video_id == 2]          # 12 equal classes: 1/12 < 0.1 each
    assert [r.label for r in sorted(res, key=lambda r: r.rank) if r.video_id == 4] == classes[:5]  # ties by name
    assert [r.tag for r in res if r.video_id == 3] == ["solo (1.00)"]


def test_speech_fields(spark):
    df = spark.createDataFrame([(1, "<|en|>", "  hello \n"), (2, "<|fr|>", ""), (3, "de", "hallo"),
                                (4, "<|es|>", "   ")], "id long, lang_token string, text string")
    got = {r.id: (r.has_speech, r.language, r.snippet_chars) for r in lb.speech_fields(df, ["id"]).collect()}
    assert got == {1: (True, "en", 5), 2: (False, None, None), 3: (True, None, 5), 4: (False, None, None)}


def _naive_phash(img, hs):
    n = img.shape[0]
    coef = np.zeros((n, n))
    for k in range(n):
        for m in range(n):
            coef[k, m] = sum(img[x, y] * 4 * np.cos(np.pi * k * (2 * x + 1) / (2 * n)) *
                             np.cos(np.pi * m * (2 * y + 1) / (2 * n)) for x in range(n) for y in range(n))
    low = coef[:hs, :hs].flatten()
    return low > np.median(low)


def test_dct_hash_matches_direct_formula(spark):
    rnd = np.random.default_rng(3)
    imgs = rnd.random((6, 8, 8))
    for img in imgs:
        assert (phash_bits(img[None], 8)[0] == _naive_phash(img, 8)).all()
    df = spark.createDataFrame([(i, img.flatten().tolist()) for i, img in enumerate(imgs)], "id long, luma array<double>")
    got = {r.id: r.hash for r in dct_hash(df, "id", "luma").collect()}
    for i, img in enumerate(imgs):
        assert got[i] == int(pack_bits(phash_bits(img[None], 8))[0])


def test_infer_unavailable_model_and_batches(spark):
    df = spark.createDataFrame([(i, [float(i)] * 64) for i in range(10)], "vec_id long, embedding array<double>")

    def broken():
        raise RuntimeError("no weights")

    out = infer(df, "broken-model", broken, linear_model_fn, "vec_id long, score double, label string, status string",
                keep=["vec_id"], batch_size=3).collect()
    assert len(out) == 10 and {r.status for r in out} == {"unavailable"}
    ok = infer(df, "lin", lambda: linear_weights(64), linear_model_fn,
               "vec_id long, score double, label string, status string", keep=["vec_id"], batch_size=3).collect()
    w = linear_weights(64)
    assert all(abs(r.score - round(float(np.full(64, r.vec_id) @ w), 6)) < 1e-9 for r in ok)


def test_registered_dct_hash_equals_brute_force(spark):
    import duckdb

    import __spark_entry__ as entry
    from conftest import SF_SMALL

    got = {r.vec_id: r.hash_hex for r in entry.queries()["dct_hash"](spark, SF_SMALL).collect()}
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_SMALL}/embeddings.parquet'").fetchall()
    assert len(got) == len(rows)
    for vid, emb in rows:
        bits = _naive_phash(np.asarray(emb, dtype=np.float64).reshape(8, 8), 8)
        want = format(int("".join("1" if b else "0" for b in bits), 2), "016x")
        assert got[vid] == want, vid
