"""The corpus pipeline on the small tables, each stage against its operator's own rule."""

from pyspark.sql import functions as F

import corpus_pipeline
from mediasift.llm import simhash


def test_stages(spark, sf="/root/testdata/sf0.001"):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns, name
        rows = out.collect()
        assert 0 < len(rows) <= left
        docs, left = spark.createDataFrame(rows, out.schema), len(rows)
    assert simhash.keep_one(docs).count() == left  # nothing left to link
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == left and last.filter("n_tokens * 4 <> octet_length(ids)").count() == 0


CLASHES = ("n_words counted log_ppl kept perplexity base_failed word_chars n_hit items spans fp _fp _n n first stays root "
           "component_id score _toxic _k _l _mid _half _in _0 _1 id b ids decoded _key _ids").split()


def test_columns_of_any_name_come_back(spark, sf="/root/testdata/sf0.001"):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(120)
    wide = docs.select("*", *[F.concat_ws("/", F.lit(c), "doc_id").alias(c) for c in CLASHES])
    long = "word other third more " * 60_000
    odd = [(None, None, None, None, None), (900_001, "", "en", None, 0), (900_002, long, None, "s", 1), (900_003, long, "xx", None, None),
           (-1, "Some text that is said twice, but no more than that it is.", "en", "s", 3)] + [
           (-1, "Some text that is said twice, but no more than that it is.", "en", "s", 3)]
    odd = spark.createDataFrame(odd, docs.schema).select("*", *[F.concat_ws("/", F.lit(c), "doc_id").alias(c) for c in CLASHES])
    given = wide.unionByName(odd).cache()
    settings = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, given, sf)
        assert out.columns == given.columns, name
        rows = out.collect()
        assert 0 < len(rows) < given.count() or name == "toxicity"
        for r in rows:
            for c in CLASHES:
                assert r[c] == (c if r.doc_id is None else f"{c}/{r.doc_id}"), (name, c)
    assert sum(r.doc_id == -1 for r in corpus_pipeline.STAGES[2][1](spark, given, sf).collect()) == 1
    assert corpus_pipeline.STAGES[-1][1](spark, given, sf).count() == given.count()
    assert settings == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))


def test_empty_and_repeated_rows(spark, sf="/root/testdata/sf0.001"):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for docs_now in (docs.limit(0), docs.unionByName(docs)):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs_now, sf).count() <= docs_now.count(), name
    assert corpus_pipeline.run(spark, sf).count() > 0
