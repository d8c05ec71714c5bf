"""Training-corpus pipeline: toxicity, quality, near duplicates, benchmark passages, tokens.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``.

Nulls in any column: a null or empty text scores 0 in toxicity (kept) and fails the quality rules; a null
language is one of its own; of documents without an id one may stay in each group of near copies. Very long
texts are handled whole. Ties and repeated rows: of a group of copies one row stays, that with the smallest
id. Empty tables give empty results. Columns beside those of ``documents`` pass through the first four stages
unchanged, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasift.llm import bpe, decontam, quality, simhash, toxicity
from mediasift.session import checkpoint_dir
from mediasift.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose worst window scores under 0.5."""
    net = toxicity.train(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.drop_toxic(docs, net)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their language's perplexity bands."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, with their digest and that of the decoded text."""
    done = bpe.decode(bpe.encode(docs))
    return done.select(
        "doc_id", "lang", "source", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("tokens", encode),
]

#: Networks, smoothed models and hashes are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
