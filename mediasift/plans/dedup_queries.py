"""Registered dedup queries over the clone fixture (FIXTURES.md section 3.1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasift.operators import frame_dedup
from mediasift.operators.leaders import (greedy_leaders, lookup_index,
                                        fused_matches, similarity_groups, similarity_pairs)
from mediasift.operators.metric_join import ExactEmbeddingSpec
from mediasift.operators.simjoin import EmbeddingSpec, PhashSpec
from mediasift.session import materialize
from mediasift.sources.fixtures import (FAR_COPY, NEAR_COPY, clone_frames, embedding_signatures,
                                        image_frames, image_videos, phash_signatures)

PHASH = PhashSpec(threshold=5.0, radius=2)
EMBED = EmbeddingSpec(threshold=0.95, bands=64, bits_per_band=20)
# A cheaper, more selective configuration for very large corpora: fewer, wider
# bands; its expected recall at the threshold is reported with the result.
EMBED_EXACT = ExactEmbeddingSpec(threshold=0.95)
EMBED_LSH = EmbeddingSpec(threshold=0.95, bands=24, bits_per_band=16)


def _round(df: DataFrame, col: str = "score") -> DataFrame:
    return df.withColumn(col, F.round(F.col(col).cast("double"), 6))


def phash_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sigs = phash_signatures(clone_frames(spark, sf_dir))
    return _round(similarity_pairs(sigs, PHASH, every_copy=True))


def phash_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    sigs = phash_signatures(clone_frames(spark, sf_dir))
    return _round(greedy_leaders(sigs, PHASH))


def embedding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sigs = embedding_signatures(clone_frames(spark, sf_dir))
    return _round(similarity_pairs(sigs, EMBED))


def embedding_exact_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2, exact: pivot cells with replication inside the threshold's distance; no hashing."""
    sigs = embedding_signatures(clone_frames(spark, sf_dir))
    return _round(similarity_pairs(sigs, EMBED_EXACT))


def embedding_lsh_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 at scale: a subset of ``embedding_pairs`` with the configuration's
    expected recall at the threshold (rows-only check; tests compare it with
    brute force)."""
    sigs = embedding_signatures(clone_frames(spark, sf_dir))
    return _round(similarity_pairs(sigs, EMBED_LSH)).withColumn(
        "expected_recall", F.lit(round(EMBED_LSH.expected_recall(), 6)))


def embedding_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    sigs = embedding_signatures(clone_frames(spark, sf_dir))
    return _round(greedy_leaders(sigs, EMBED))


def phash_index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Originals form the index; every copy probes it."""
    sigs = phash_signatures(clone_frames(spark, sf_dir))
    index = sigs.where(F.col("video_id") < NEAR_COPY[0])
    probes = sigs.where(F.col("video_id") >= NEAR_COPY[0])
    return _round(lookup_index(probes, index, PHASH))


MISSING_EVERY, MISSING_AT = 7, 3


def duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    """D5 (components mode): every video with its group (smallest id) and group size."""
    groups = similarity_groups(phash_signatures(clone_frames(spark, sf)), PHASH)
    return groups.select(F.col("id").alias("video_id"), "group_id", "n")


def fused_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs that match on both the visual hash and the embedding."""
    frames = clone_frames(spark, sf)
    both = fused_matches(phash_signatures(frames), PHASH, embedding_signatures(frames), EMBED)
    return both.select("id_a", "id_b", F.round("first_score", 6).alias("phash_score"),
                       F.round("second_score", 6).alias("embedding_score"))


def assignment_parts(spark: SparkSession, sf: str) -> DataFrame:
    """P2/J5/2.7: part sizes under both missing-signature policies."""
    sigs = phash_signatures(clone_frames(spark, sf))
    sigs = sigs.withColumn("hashes", F.when(F.col("video_id") % MISSING_EVERY == MISSING_AT, None)
                           .otherwise(F.col("hashes")))
    # Items without a signature never take part in a comparison, so one greedy
    # run serves both policies: "drop" only removes them from the output.
    keep = materialize(greedy_leaders(sigs, PHASH, on_missing="keep"), "assignments")
    missing = sigs.where(F.col("hashes").isNull()).select("video_id")
    drop = keep.join(missing, "video_id", "left_anti")
    out = None
    for policy, res in (("keep", keep), ("drop", drop)):
        part = res.groupBy(F.when(F.col("is_unique"), "unique").otherwise("duplicate").alias("part")) \
                  .agg(F.count(F.lit(1)).alias("n")).withColumn("policy", F.lit(policy))
        out = part if out is None else out.unionByName(part)
    return out.select("policy", "part", "n")


FRAME_K, WIDE_HASH, WIDE_THRESHOLD, PATCHES = 3, 16, 32.0, 8


def frames_phash_leaders(spark: SparkSession, sf: str) -> DataFrame:
    """Images of sampled frames, 256-bit hashes, duplicates."""
    return _round(frame_dedup.phash_duplicates(image_videos(spark, sf), image_frames(spark, sf), FRAME_K, WIDE_HASH,
                                               WIDE_THRESHOLD))


def frames_embedding_leaders(spark: SparkSession, sf: str) -> DataFrame:
    """Images of sampled frames, a vector per frame, duplicates by the exact join."""
    return _round(frame_dedup.embedding_duplicates(
        image_videos(spark, sf), image_frames(spark, sf), f"patches-{PATCHES}", frame_dedup.patch_loader(PATCHES),
        frame_dedup.patch_means, FRAME_K, spec=EMBED_EXACT))


QUERIES = {
    "frames_phash_leaders": frames_phash_leaders,
    "frames_embedding_leaders": frames_embedding_leaders,
    "duplicate_groups": duplicate_groups,
    "fused_pairs": fused_pairs,
    "assignment_parts": assignment_parts,
    "phash_pairs": phash_pairs,
    "phash_leaders": phash_leaders,
    "embedding_pairs": embedding_pairs,
    "embedding_exact_pairs": embedding_exact_pairs,
    "embedding_lsh_pairs": embedding_lsh_pairs,
    "embedding_leaders": embedding_leaders,
    "phash_index_lookup": phash_index_lookup,
}

# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB). Frame bits are compared as boolean lists, not packed.
# ---------------------------------------------------------------------------

V_FRAMES = f"""
orig AS (
  SELECT vec_id // 5 AS video_id, CAST(vec_id % 5 AS INTEGER) AS frame_idx,
         list_transform(list_slice(embedding, 1, 64), lambda x: x > 0) AS bits,
         CAST(embedding AS DOUBLE[]) AS vec
  FROM embeddings
),
vframes AS (
  SELECT video_id, frame_idx, bits, vec FROM orig
  UNION ALL
  SELECT video_id + {NEAR_COPY[0]}, frame_idx,
         list_transform(bits, lambda b, i: CASE WHEN i <= {NEAR_COPY[1]} THEN NOT b ELSE b END),
         list_transform(vec, lambda x, i: CASE WHEN i = 1 THEN x + {NEAR_COPY[2]} ELSE x END)
  FROM orig WHERE video_id % 10 = 0
  UNION ALL
  SELECT video_id + {FAR_COPY[0]}, frame_idx,
         list_transform(bits, lambda b, i: CASE WHEN i <= {FAR_COPY[1]} THEN NOT b ELSE b END),
         list_transform(vec, lambda x, i: CASE WHEN i = 1 THEN x + {FAR_COPY[2]} ELSE x END)
  FROM orig WHERE video_id % 10 = 0
),
vnf AS (SELECT video_id, count(*) AS nf FROM vframes GROUP BY video_id)"""

_REPS = """,
vsig AS (SELECT video_id, list(bits ORDER BY frame_idx) AS s FROM vframes GROUP BY video_id),
reps AS (SELECT video_id, min(video_id) OVER (PARTITION BY s) AS rep FROM vsig)"""

# Pairs of representatives, and each copy with its representative.
_LISTED = """JOIN reps ra ON ra.video_id = id_a JOIN reps rb ON rb.video_id = id_b
WHERE ra.rep = id_a AND (rb.rep = id_b OR rb.rep = id_a)"""

PHASH_PAIRS_CTE = V_FRAMES + """,
fpairs AS (
  SELECT a.video_id AS id_a, b.video_id AS id_b,
         len(list_filter(range(1, 65), lambda i: a.bits[i] <> b.bits[i])) AS d
  FROM vframes a JOIN vframes b ON a.frame_idx = b.frame_idx AND a.video_id < b.video_id
),
pairs AS (
  SELECT p.id_a, p.id_b, sum(p.d) / max(na.nf) AS score
  FROM fpairs p JOIN vnf na ON na.video_id = p.id_a JOIN vnf nb ON nb.video_id = p.id_b
  WHERE na.nf = nb.nf
  GROUP BY p.id_a, p.id_b
  HAVING count(*) = max(na.nf) AND sum(p.d) / max(na.nf) <= 5
)"""

EMBED_PAIRS_CTE = V_FRAMES + """,
fcos AS (
  SELECT a.video_id AS id_a, b.video_id AS id_b,
         CASE WHEN sqrt(list_sum(list_transform(a.vec, lambda x: x * x))) *
                   sqrt(list_sum(list_transform(b.vec, lambda x: x * x))) > 0
              THEN list_sum(list_transform(list_zip(a.vec, b.vec), lambda p: p[1] * p[2])) /
                   (sqrt(list_sum(list_transform(a.vec, lambda x: x * x))) *
                    sqrt(list_sum(list_transform(b.vec, lambda x: x * x))))
              ELSE 0 END AS c
  FROM vframes a JOIN vframes b ON a.frame_idx = b.frame_idx AND a.video_id < b.video_id
),
pairs AS (
  SELECT p.id_a, p.id_b, avg(p.c) AS score
  FROM fcos p JOIN vnf na ON na.video_id = p.id_a JOIN vnf nb ON nb.video_id = p.id_b
  WHERE na.nf = nb.nf
  GROUP BY p.id_a, p.id_b
  HAVING count(*) = max(na.nf) AND avg(p.c) >= 0.95
)"""


def _greedy_sql(pairs_cte: str, best: str, keep: str = "true", tail: str | None = None) -> str:
    """Sequential greedy loop as a recursive CTE over the visiting order.

    ``keep`` filters the items that have a signature; ``tail`` replaces the
    final SELECT (it can use the CTEs ``lead`` and ``gp``).
    """
    body = f"""SELECT video_id, video_id AS primary_id, CAST(NULL AS DOUBLE) AS score, true AS is_unique FROM lead
UNION ALL
SELECT p.id_b AS video_id, {best} AS primary_id,
       round(CAST({'min' if best.startswith('arg_min(p.id_a, (p.score') else 'max'}(p.score) AS DOUBLE), 6) AS score,
       false AS is_unique
FROM gp p
WHERE p.id_a IN (SELECT video_id FROM lead) AND p.id_b NOT IN (SELECT video_id FROM lead)
GROUP BY p.id_b"""
    return f"""WITH RECURSIVE {pairs_cte},
gp AS (SELECT * FROM pairs WHERE {keep.replace('video_id', 'id_a')} AND {keep.replace('video_id', 'id_b')}),
items AS (SELECT video_id, row_number() OVER (ORDER BY video_id) AS rn FROM vnf WHERE {keep}),
nb AS (
  SELECT i.video_id, i.rn, coalesce(list(p.id_a) FILTER (WHERE p.id_a IS NOT NULL), []) AS earlier
  FROM items i LEFT JOIN gp p ON p.id_b = i.video_id
  GROUP BY i.video_id, i.rn
),
walk(rn, leaders) AS (
  SELECT 0, CAST([] AS BIGINT[])
  UNION ALL
  SELECT w.rn + 1,
         CASE WHEN list_has_any(w.leaders, n.earlier) THEN w.leaders
              ELSE list_append(w.leaders, n.video_id) END
  FROM walk w JOIN nb n ON n.rn = w.rn + 1
),
lead AS (SELECT unnest(leaders) AS video_id FROM (SELECT leaders FROM walk ORDER BY rn DESC LIMIT 1))
{tail or body}"""


# Images of the sampled frames: index 0, 2, 4 of five, the next index if one is missing.
_IMAGES = f"""{V_FRAMES.replace("vnf AS (SELECT", "vnf0 AS (SELECT")},
vnf AS (SELECT DISTINCT video_id FROM vframes),
there AS (SELECT video_id, frame_idx, vec FROM vframes WHERE (video_id + frame_idx) % 17 <> 5),
reads AS (
  SELECT v.video_id, i AS pos, coalesce(a.vec, b.vec) AS vec,
         coalesce(a.frame_idx, b.frame_idx) AS frame_idx
  FROM vnf v CROSS JOIN range(0, 5, 2) t(i)
  LEFT JOIN there a ON a.video_id = v.video_id AND a.frame_idx = i
  LEFT JOIN there b ON b.video_id = v.video_id AND b.frame_idx = i + 1
  WHERE coalesce(a.frame_idx, b.frame_idx) IS NOT NULL),
good AS (SELECT video_id, count(*) AS nf FROM reads GROUP BY video_id
         HAVING NOT bool_or(video_id % 23 = 4 AND frame_idx = 2)),
imrows AS (
  SELECT video_id, pos, r, [CAST(greatest(0, least(255, floor(128 + 2000 * vec[r + 1] * vec[(3 * c + 7) % 64 + 1]))) AS DOUBLE)
                            FOR c IN range(0, 64)] AS px
  FROM reads SEMI JOIN good USING (video_id) CROSS JOIN range(0, 64) t(r))"""

_IMAGE_HASHES = _IMAGES + f""",
basis AS (SELECT k, [2 * cos(pi() * k * (2 * m + 1) / 128) FOR m IN range(0, 64)] AS c FROM range(0, {WIDE_HASH}) t(k)),
half AS (SELECT video_id, pos, k AS l, list(list_dot_product(px, c) ORDER BY r) AS t
         FROM imrows CROSS JOIN basis GROUP BY video_id, pos, k),
coef AS (SELECT video_id, pos, k, l, list_dot_product(t, c) AS v FROM half CROSS JOIN basis),
mid AS (SELECT video_id, pos, median(v) AS m FROM coef GROUP BY video_id, pos),
bits AS (SELECT video_id, pos, string_agg(CASE WHEN v > m THEN '1' ELSE '0' END, '' ORDER BY k, l)::BIT AS h
         FROM coef JOIN mid USING (video_id, pos) GROUP BY video_id, pos),
ranked AS (SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY pos) AS p, h, nf FROM bits JOIN good USING (video_id)),
pairs AS (SELECT a.video_id AS id_a, b.video_id AS id_b, sum(bit_count(xor(a.h, b.h))) / max(a.nf) AS score
          FROM ranked a JOIN ranked b ON a.p = b.p AND a.nf = b.nf AND a.video_id < b.video_id
          GROUP BY 1, 2 HAVING sum(bit_count(xor(a.h, b.h))) / max(a.nf) <= {WIDE_THRESHOLD})"""

_IMAGE_VECTORS = _IMAGES + f""",
cells AS (SELECT video_id, pos, r // 8 AS pr, pc, avg(list_sum(px[pc * 8 + 1:pc * 8 + 8]) / 8) AS v
          FROM imrows CROSS JOIN range(0, {PATCHES}) t(pc) GROUP BY 1, 2, 3, 4),
vecs AS (SELECT video_id, pos, list(v - m ORDER BY pr, pc) AS x
         FROM (SELECT *, avg(v) OVER (PARTITION BY video_id, pos) AS m FROM cells) GROUP BY 1, 2),
ranked AS (SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY pos) AS p, x, nf FROM vecs JOIN good USING (video_id)),
pairs AS (SELECT a.video_id AS id_a, b.video_id AS id_b, avg(list_cosine_similarity(a.x, b.x)) AS score
          FROM ranked a JOIN ranked b ON a.p = b.p AND a.nf = b.nf AND a.video_id < b.video_id
          GROUP BY 1, 2 HAVING avg(list_cosine_similarity(a.x, b.x)) >= 0.95)"""

_FUSED = (PHASH_PAIRS_CTE.replace("\npairs AS (", "\nppairs AS (") + ",\n"
          + EMBED_PAIRS_CTE[len(V_FRAMES) + 2:].replace("\npairs AS (", "\nepairs AS ("))

_MISSING = f"video_id % {MISSING_EVERY} <> {MISSING_AT}"
_PARTS_TAIL = f"""SELECT 'keep' AS policy, 'unique' AS part,
       (SELECT count(*) FROM lead) + (SELECT count(*) FROM vnf WHERE NOT ({_MISSING})) AS n
UNION ALL SELECT 'drop', 'unique', (SELECT count(*) FROM lead)
UNION ALL SELECT 'keep', 'duplicate', (SELECT count(*) FROM items) - (SELECT count(*) FROM lead)
UNION ALL SELECT 'drop', 'duplicate', (SELECT count(*) FROM items) - (SELECT count(*) FROM lead)"""

ORACLE = {
    "frames_phash_leaders": _greedy_sql(_IMAGE_HASHES, "arg_min(p.id_a, (p.score, p.id_a))"),
    "frames_embedding_leaders": _greedy_sql(_IMAGE_VECTORS, "arg_min(p.id_a, (-p.score, p.id_a))"),
    "duplicate_groups": f"""WITH RECURSIVE {PHASH_PAIRS_CTE},
e AS (SELECT id_a AS a, id_b AS b FROM pairs UNION ALL SELECT id_b, id_a FROM pairs),
lab(video_id, g) AS (SELECT video_id, video_id FROM vnf
                     UNION SELECT e.b, l.g FROM lab l JOIN e ON e.a = l.video_id),
grp AS (SELECT video_id, min(g) AS group_id FROM lab GROUP BY video_id)
SELECT video_id, group_id, count(*) OVER (PARTITION BY group_id) AS n FROM grp""",
    "fused_pairs": f"""WITH {_FUSED}{_REPS.replace("list(bits ORDER", "list((bits, vec) ORDER")}
SELECT p.id_a, p.id_b, round(CAST(p.score AS DOUBLE), 6) AS phash_score,
       round(CAST(e.score AS DOUBLE), 6) AS embedding_score
FROM ppairs p JOIN epairs e ON e.id_a = p.id_a AND e.id_b = p.id_b
""" + _LISTED.replace("= id_", "= p.id_"),
    "assignment_parts": _greedy_sql(PHASH_PAIRS_CTE, "arg_min(p.id_a, (p.score, p.id_a))", _MISSING, _PARTS_TAIL),
    "phash_pairs": f"""WITH {PHASH_PAIRS_CTE}
SELECT id_a, id_b, round(CAST(score AS DOUBLE), 6) AS score FROM pairs""",
    "phash_leaders": _greedy_sql(PHASH_PAIRS_CTE, "arg_min(p.id_a, (p.score, p.id_a))"),
    "embedding_pairs": f"""WITH {EMBED_PAIRS_CTE}{_REPS.replace("list(bits", "list(vec")}
SELECT id_a, id_b, round(CAST(score AS DOUBLE), 6) AS score FROM pairs
""" + _LISTED,
    "embedding_exact_pairs": f"""WITH {EMBED_PAIRS_CTE}{_REPS.replace("list(bits", "list(vec")}
SELECT id_a, id_b, round(CAST(score AS DOUBLE), 6) AS score FROM pairs
""" + _LISTED,
    "embedding_leaders": _greedy_sql(EMBED_PAIRS_CTE, "arg_min(p.id_a, (-p.score, p.id_a))"),
    "phash_index_lookup": f"""WITH {PHASH_PAIRS_CTE.replace('a.video_id < b.video_id', 'a.video_id <> b.video_id')},
probes AS (SELECT video_id FROM vnf WHERE video_id >= {NEAR_COPY[0]})
SELECT pr.video_id AS probe_id, arg_min(p.id_a, (p.score, p.id_a)) AS match_id,
       round(CAST(min(p.score) AS DOUBLE), 6) AS score
FROM probes pr LEFT JOIN pairs p ON p.id_b = pr.video_id AND p.id_a < {NEAR_COPY[0]}
GROUP BY pr.video_id""",
}
