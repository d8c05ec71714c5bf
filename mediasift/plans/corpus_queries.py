"""Registered queries over documents, pages, benchmark, labels and events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasift.operators import content, ops, overlap, search, vector_index
from mediasift.session import checkpoint_dir, materialize
from mediasift.sources import layout
from mediasift.sources.manifest import StageRuns, input_version
from mediasift.sources.tables import table

# Fixed query parameters of the registered queries.
BOOL_ALL = ["the", "and"]
BOOL_ANY = ["of", "in"]
BOOL_NONE = ["ci"]
BM25_K, BM25_K1, BM25_B = 10, 1.2, 0.75
VEC_K, VEC_QUERY_EVERY = 5, 50
SHINGLE_WORDS = 8
PRED_CUTOFF_CHARS, MIN_CONF, SAMPLE_PERCENT = 300, 0.2, 30
LABEL_VERSIONS, TARGET_VERSION = 3, 2
WAVES, FIRST_WAVES = 4, 2
LENGTH_SHARES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
PREVIEW_ROWS = 5
LAYOUT_COLUMNS, LAYOUT_FILES = ["o_custkey", "o_totalprice"], 64
LAYOUT_RANGES = {"o_custkey": (100, 400), "o_totalprice": (None, 60000.0)}


def url_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return content.url_dedup(table(spark, sf, "pages"))


def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return content.exact_dedup(table(spark, sf, "documents"))


def overlap_spans(spark: SparkSession, sf: str) -> DataFrame:
    return content.overlap_spans(table(spark, sf, "documents"), table(spark, sf, "benchmark"), SHINGLE_WORDS)


def document_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    """D3 among all documents: common passages of a document and an earlier one."""
    return overlap.document_overlaps(table(spark, sf, "documents"))


def boolean_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.boolean_search(table(spark, sf, "documents"), BOOL_ALL, BOOL_ANY, BOOL_NONE)


def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    return search.bm25_topk(table(spark, sf, "documents"), table(spark, sf, "benchmark"),
                            BM25_K, BM25_K1, BM25_B)


def _vectors(spark, sf):
    emb = table(spark, sf, "embeddings")
    return emb, emb.where(F.col("vec_id") % VEC_QUERY_EVERY == 0)


def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    emb, q = _vectors(spark, sf)
    return search.vector_topk(emb, q, VEC_K)


def hybrid_topk(spark: SparkSession, sf: str) -> DataFrame:
    emb, q = _vectors(spark, sf)
    return search.vector_topk(emb, q, VEC_K, filter_col="label")


INDEX_CELLS, INDEX_CODES, INDEX_RECALL = 32, 16, 0.95


def vector_index_topk(spark: SparkSession, sf: str) -> DataFrame:
    """D24 over the written index, exact mode: equal to the full scan."""
    emb, q = _vectors(spark, sf)
    return vector_index.search_index(vector_index.build_index(emb, INDEX_CELLS, INDEX_CODES), q, VEC_K, exact=True)


def vector_index_recall(spark: SparkSession, sf: str) -> DataFrame:
    """D24, approximate mode: recall of the calibrated index against the full scan, over all queries. Rows that
    are no queries calibrate it."""
    emb, q = _vectors(spark, sf)
    other = emb.where(F.col("vec_id") % VEC_QUERY_EVERY == 1)
    index = vector_index.calibrate(vector_index.build_index(emb, INDEX_CELLS, INDEX_CODES), other, VEC_K, INDEX_RECALL)
    done = vector_index.recall(vector_index.search_index(index, q, VEC_K), search.vector_topk(emb, q, VEC_K))
    return done.select("queries", "neighbours", (F.col("recall") >= 0.9).alias("recall_reached"))


def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ops.stage_counts(table(spark, sf, "events"))


def resume_pending(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select(F.expr("event_id div 10").alias("doc_id"),
                                           F.col("event_type").alias("status"), "ts")
    return ops.resume_pending(table(spark, sf, "documents"), log, "doc_id")


def stale_labels(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").withColumn("version", F.col("doc_id") % LABEL_VERSIONS)
    return ops.stale_labels(labels, "version", TARGET_VERSION, items=table(spark, sf, "documents"))


def length_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches of document lengths by language and source, written, then merged over every subset."""
    parts = materialize(ops.value_sketches(table(spark, sf, "documents"), ["lang", "source"], "n_chars"), "sketches")
    return ops.sketch_cube(parts, ["lang", "source"], LENGTH_SHARES)


def document_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first documents by id."""
    return ops.preview(table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars"), ["doc_id"], PREVIEW_ROWS)


def review_queue(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    preds = docs.select(
        "doc_id",
        (F.col("n_chars") >= PRED_CUTOFF_CHARS).cast("int").alias("pred"),
        (F.abs(F.col("n_chars") - PRED_CUTOFF_CHARS) / (F.col("n_chars") + F.lit(float(PRED_CUTOFF_CHARS))))
        .alias("conf"))
    routed = ops.review_routing(preds, table(spark, sf, "labels"), "doc_id", "pred", "conf", "quality", MIN_CONF)
    return routed.withColumn("in_training", F.col("route").isin("human", "corrected") |
                             ops.stable_sample("doc_id", SAMPLE_PERCENT))


def label_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return ops.label_rollup(table(spark, sf, "documents"), table(spark, sf, "labels"))


def label_cube(spark: SparkSession, sf: str) -> DataFrame:
    return ops.label_cube(table(spark, sf, "documents"), table(spark, sf, "labels"))


def clustered_layout(spark: SparkSession, sf: str) -> DataFrame:
    """All orders written along a Z-order curve of customer and price, then read by ranges of both, from the files
    that the ranges leave."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/mediasift-layout/{uuid.uuid4().hex}"
    layout.write_clustered(table(spark, sf, "orders"), path, LAYOUT_COLUMNS, LAYOUT_FILES)
    ranges = layout.file_ranges(spark, path, LAYOUT_COLUMNS)
    return layout.read_where(spark, path, ranges, LAYOUT_RANGES).select("o_orderkey", *LAYOUT_COLUMNS)


def stage_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """Word counts of all documents by a stage that stops after two waves and is run again; every row with the
    wave and run that made it."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/mediasift-stages/{uuid.uuid4().hex}"
    stage = StageRuns(spark, base, "word_counts", code_version="1", waves=WAVES)
    docs, source = table(spark, sf, "documents"), input_version(spark, f"{sf}/documents.parquet")
    words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^ \t-\r]+"), F.lit(0)))
    count = lambda part: part.select("doc_id", words.cast("long").alias("n_words"))
    stage.run(docs, source, "doc_id", count, run="first", stop_after=FIRST_WAVES)
    version = stage.run(docs, source, "doc_id", count, run="second")
    return stage.read(version, provenance=True).select("doc_id", "n_words", "made_by.stage", "made_by.wave", "made_by.run")


QUERIES = {
    "length_profile": length_profile,
    "document_preview": document_preview,
    "clustered_layout": clustered_layout,
    "stage_provenance": stage_provenance,
    "url_dedup": url_dedup,
    "exact_dedup": exact_dedup,
    "overlap_spans": overlap_spans,
    "document_overlaps": document_overlaps,
    "boolean_search": boolean_search,
    "bm25_topk": bm25_topk,
    "vector_topk": vector_topk,
    "hybrid_topk": hybrid_topk,
    "vector_index_topk": vector_index_topk,
    "vector_index_recall": vector_index_recall,
    "stage_counts": stage_counts,
    "resume_pending": resume_pending,
    "stale_labels": stale_labels,
    "review_queue": review_queue,
    "label_rollup": label_rollup,
    "label_cube": label_cube,
}

# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

_TOK = r"list_filter(regexp_split_to_array(lower({t}), '[^\p{{L}}\p{{N}}]+'), lambda x: length(x) > 0)"
_WORDS = r"list_filter(regexp_split_to_array(regexp_replace({t}, '^\s+|\s+$', '', 'g'), '\s+'), lambda x: length(x) > 0)"


def _tok(t: str) -> str:
    return _TOK.format(t=t)


def _shingles(src: str, idc: str, k: int) -> str:
    return f"""(SELECT id, pos - 1 AS pos, array_to_string(list_slice(w, pos, pos + {k - 1}), ' ') AS sh
   FROM (SELECT id, w, generate_subscripts(w, 1) AS pos
         FROM (SELECT {idc} AS id, {_WORDS.format(t='text')} AS w FROM {src}))
   WHERE pos <= len(w) - {k - 1})"""


def _cos(a: str, b: str) -> str:
    return (f"list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2])) / "
            f"(sqrt(list_sum(list_transform({a}, lambda x: x * x))) * sqrt(list_sum(list_transform({b}, lambda x: x * x))))")


def _vec_sql(extra: str) -> str:
    return f"""WITH q AS (SELECT vec_id AS q, CAST(embedding AS DOUBLE[]) AS qv, label AS ql FROM embeddings
           WHERE vec_id % {VEC_QUERY_EVERY} = 0),
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
s AS (SELECT q.q, e.vec_id, {_cos('e.v', 'q.qv')} AS sim FROM q JOIN e ON true {extra})
SELECT q, CAST(rank AS INTEGER) AS rank, vec_id, sim
FROM (SELECT q, vec_id, round(sim, 6) AS sim,
             row_number() OVER (PARTITION BY q ORDER BY round(sim, 6) DESC, vec_id) AS rank FROM s)
WHERE rank <= {VEC_K}"""


def _overlap_sql(k: int = overlap.SHINGLE, w: int = overlap.WINDOW, max_df: int = overlap.MAX_DF) -> str:
    before = ("coalesce(list_min(list_filter(range(0, least(p.pos, p.q)), lambda j: x.w[p.pos - j] <> y.w[p.q - j])), "
              "least(p.pos, p.q))")
    left = f"least(len(x.w) - p.pos, len(y.w) - p.q) - {k}"
    after = (f"coalesce(list_min(list_filter(range(0, {left}), lambda j: x.w[p.pos + {k + 1} + j] <> y.w[p.q + {k + 1} + j])), "
             f"{left})")
    return f"""WITH keep AS (SELECT min(doc_id) AS id, text FROM documents WHERE text IS NOT NULL GROUP BY text),
d AS (SELECT id, {_WORDS.format(t='text')} AS w FROM keep WHERE id IS NOT NULL),
sh AS (SELECT id, pos - 1 AS pos, n, CAST('0x' || substr(md5(array_to_string(list_slice(w, pos, pos + {k - 1}), ' ')), 1, 15) AS BIGINT) AS h
       FROM (SELECT id, w, len(w) - {k - 1} AS n, unnest(range(1, len(w) - {k - 2})) AS pos FROM d WHERE len(w) >= {k})),
sel AS (SELECT id, pos, n, arg_min(pos, (h, -pos)) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {w - 1} FOLLOWING) AS s FROM sh),
seed AS (SELECT sh.id, sh.pos, sh.h, sh.pos = min(sh.pos) OVER (PARTITION BY sh.id, sh.h) AS first
         FROM sh SEMI JOIN (SELECT id, s FROM sel WHERE pos <= greatest(n - {w}, 0)) c ON c.id = sh.id AND c.s = sh.pos),
df AS (SELECT h, count(*) AS df, min(id) AS origin FROM seed WHERE first GROUP BY h HAVING count(*) > 1),
p AS (SELECT a.id, b.id AS source, a.pos, b.pos AS q FROM seed a JOIN df ON df.h = a.h JOIN seed b ON b.h = a.h
      WHERE b.first AND a.id > b.id AND (df.df <= {max_df} OR b.id = df.origin)),
e AS (SELECT p.id, p.source, p.pos - p.q AS diag, p.pos - {before} AS lo, p.pos + {k} + {after} AS hi
      FROM p JOIN d x ON x.id = p.id JOIN d y ON y.id = p.source)
SELECT DISTINCT id AS doc_id, source AS source_id, CAST(lo AS INTEGER) AS start, CAST(lo - diag AS INTEGER) AS source_start,
       CAST(hi - lo AS INTEGER) AS length
FROM e WHERE hi - lo >= {k + w - 1}"""


_BOOL_HAVING = " AND ".join(
    [f"bool_or(t = '{t}')" for t in BOOL_ALL]
    + ["(" + " OR ".join(f"bool_or(t = '{t}')" for t in BOOL_ANY) + ")"]
    + [f"NOT bool_or(t = '{t}')" for t in BOOL_NONE])
_BOOL_TERMS = ", ".join(f"'{t}'" for t in BOOL_ALL + BOOL_ANY + BOOL_NONE)

ORACLE = {
    "clustered_layout": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey BETWEEN 100 AND 400 AND o_totalprice <= 60000""",
    "stage_provenance": f"""SELECT *, CASE WHEN wave < {FIRST_WAVES} THEN 'first' ELSE 'second' END AS run FROM (
  SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS n_words, 'word_counts' AS stage,
         CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % {WAVES} AS INTEGER) AS wave
  FROM documents)""",
    "url_dedup": r"""WITH c AS (
  SELECT page_id, split_part(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#', 1) AS u FROM pages),
p AS (SELECT page_id, rtrim(split_part(u, '?', 1), '/') AS u,
             CASE WHEN strpos(u, '?') > 0 THEN substr(u, strpos(u, '?') + 1) ELSE '' END AS query FROM c),
h AS (SELECT page_id, u, split_part(u, '/', 1) AS host,
             list_sort(list_filter(string_split(query, '&'), lambda x: x <> ''
               AND NOT starts_with(split_part(x, '=', 1), 'utm_')
               AND split_part(x, '=', 1) NOT IN ('ref', 'fbclid', 'gclid'))) AS params FROM p)
SELECT lower(host) || substr(u, length(host) + 1)
       || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical,
       min(page_id) AS keep_id, count(*) AS n
FROM h GROUP BY 1""",
    "exact_dedup": "SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keep_id FROM documents",
    "overlap_spans": f"""WITH ds AS {_shingles('documents', 'doc_id', SHINGLE_WORDS)},
rs AS {_shingles('benchmark', 'item_id', SHINGLE_WORDS)},
tot AS (SELECT id, count(*) AS total FROM rs GROUP BY id),
m AS (SELECT d.id AS did, r.id AS rid, d.pos - r.pos AS diag, d.pos AS pos FROM ds d JOIN rs r ON d.sh = r.sh),
i AS (SELECT *, pos - row_number() OVER (PARTITION BY did, rid, diag ORDER BY pos) AS island FROM m),
g AS (SELECT did, rid, diag, min(pos) AS start, count(*) AS n FROM i GROUP BY did, rid, diag, island)
SELECT did AS doc_id, rid AS item_id, CAST(start AS INTEGER) AS start, n + {SHINGLE_WORDS - 1} AS length,
       round(n / total, 6) AS containment
FROM g JOIN tot ON tot.id = g.rid""",
    "document_overlaps": _overlap_sql(),
    "boolean_search": f"""SELECT doc_id FROM (
  SELECT doc_id, unnest({_tok('text')}) AS t FROM documents) WHERE t IN ({_BOOL_TERMS})
GROUP BY doc_id HAVING {_BOOL_HAVING}""",
    "bm25_topk": f"""WITH dt AS (SELECT doc_id AS d, {_tok('text')} AS tk FROM documents),
ln_ AS (SELECT d, len(tk) AS dl FROM dt),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM ln_),
tf AS (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(tk) AS t FROM dt) GROUP BY d, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
idf AS (SELECT t, ln(1 + (st.n - df + 0.5) / (df + 0.5)) AS idf FROM df, st),
qt AS (SELECT DISTINCT q, t FROM (SELECT item_id AS q, unnest({_tok('text')}) AS t FROM benchmark)),
sc AS (SELECT qt.q, tf.d, sum(idf.idf * tf.tf * {BM25_K1 + 1} /
              (tf.tf + {BM25_K1} * ({1 - BM25_B} + {BM25_B} * ln_.dl / st.avgdl))) AS score
       FROM qt JOIN idf ON idf.t = qt.t JOIN tf ON tf.t = qt.t JOIN ln_ ON ln_.d = tf.d, st
       GROUP BY qt.q, tf.d)
SELECT q AS item_id, CAST(rank AS INTEGER) AS rank, d AS doc_id, score
FROM (SELECT q, d, round(score, 6) AS score,
             row_number() OVER (PARTITION BY q ORDER BY round(score, 6) DESC, d) AS rank FROM sc)
WHERE rank <= {BM25_K}""",
    "vector_topk": _vec_sql(""),
    "hybrid_topk": _vec_sql("AND e.label = q.ql"),
    "vector_index_topk": _vec_sql(""),
    "vector_index_recall": f"""SELECT count(*) AS queries, CAST(sum(least(n, {VEC_K})) AS BIGINT) AS neighbours, true AS recall_reached
FROM (SELECT q.vec_id, count(*) AS n FROM embeddings q, embeddings e WHERE q.vec_id % {VEC_QUERY_EVERY} = 0 GROUP BY q.vec_id)""",
    "stage_counts": """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS workers,
       round(avg(value), 6) AS mean_latency,
       round(count(*) / sum(count(*)) OVER (), 6) AS share,
       round(CASE WHEN epoch_us(max(ts)) - epoch_us(min(ts)) > 0
                  THEN count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9) END, 6) AS rate_per_hour
FROM events GROUP BY event_type""",
    "resume_pending": """WITH lg AS (SELECT event_id // 10 AS doc_id, event_type AS status, ts FROM events),
latest AS (SELECT doc_id, arg_max(status, (ts, status)) AS status FROM lg GROUP BY doc_id)
SELECT doc_id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM latest WHERE status = 'purchase')""",
    "stale_labels": f"""SELECT doc_id FROM labels WHERE coalesce(doc_id % {LABEL_VERSIONS} < {TARGET_VERSION}, true)
UNION ALL SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "length_profile": """SELECT lang, source, CAST(grouping(lang, source) AS INTEGER) AS level, count(*) AS n,
       count(DISTINCT n_chars) AS distinct_values, quantile_disc(n_chars, 0.5) AS p50, quantile_disc(n_chars, 0.9) AS p90,
       quantile_disc(n_chars, 0.99) AS p99
FROM documents GROUP BY CUBE (lang, source)""",
    "document_preview": f"SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT {PREVIEW_ROWS}",
    "review_queue": f"""WITH p AS (
  SELECT doc_id, CASE WHEN n_chars >= {PRED_CUTOFF_CHARS} THEN 1 ELSE 0 END AS pred,
         abs(n_chars - {PRED_CUTOFF_CHARS}) / (n_chars + CAST({PRED_CUTOFF_CHARS} AS DOUBLE)) AS conf
  FROM documents),
j AS (SELECT doc_id, pred, conf, l.quality AS h FROM p FULL JOIN labels l USING (doc_id))
SELECT doc_id,
       CASE WHEN h IS NOT NULL AND h <> pred THEN 'corrected' WHEN h IS NOT NULL THEN 'human'
            WHEN conf < {MIN_CONF} THEN 'review' ELSE 'auto' END AS route,
       CASE WHEN h IS NOT NULL THEN h WHEN conf >= {MIN_CONF} THEN pred END AS final_quality,
       (h IS NOT NULL AND h <> pred) OR (h IS NOT NULL) OR (CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < {SAMPLE_PERCENT}) AS in_training
FROM j""",
    "label_rollup": """SELECT lang, source, count(*) AS n, count(quality) AS labeled,
       round(avg(quality), 6) AS quality_rate, round(avg(toxic), 6) AS toxic_rate
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
GROUP BY ROLLUP (lang, source)""",
    "label_cube": """SELECT lang, source, CAST(grouping_id(lang, source) AS INTEGER) AS level, count(*) AS n, count(quality) AS labeled,
       round(avg(quality), 6) AS quality_rate, round(avg(toxic), 6) AS toxic_rate,
       CAST(min(n_chars) AS BIGINT) AS min_chars, CAST(max(n_chars) AS BIGINT) AS max_chars,
       count(*) FILTER (n_chars < 100) AS below_100, count(*) FILTER (n_chars >= 100 AND n_chars < 1000) AS below_1000,
       count(*) FILTER (n_chars >= 1000 AND n_chars < 10000) AS below_10000, count(*) FILTER (n_chars >= 10000) AS from_10000
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
GROUP BY CUBE (lang, source)""",
}
