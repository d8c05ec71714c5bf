"""Media listing (S1-S3) and per-item metadata documents.

Listing uses the ``binaryFile`` source with recursive lookup and selects only
``path``, ``length`` and ``modificationTime``, so file contents are never read.
Any Hadoop-supported scheme works (local, HDFS, object stores).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: media suffixes accepted by the listing (case-insensitive).
VIDEO_SUFFIXES = (".mp4", ".avi", ".mov", ".mkv", ".wmv")

ASSET_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_media(spark: SparkSession, root: str, suffixes=VIDEO_SUFFIXES, non_empty: bool = True) -> DataFrame:
    """(path, length, modificationTime) of media files under ``root``.

    A missing root gives an empty DataFrame (the reference logs a warning and
    returns an empty list). ``non_empty`` drops zero-byte files (S3); Spark's
    file scan never emits zero-length files anyway, the filter states intent.
    """
    if not _exists(spark, root):
        return spark.createDataFrame([], ASSET_SCHEMA)
    pattern = r"\.(" + "|".join(s.lstrip(".") for s in suffixes) + r")$"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select("path", "length", "modificationTime"))
    files = files.where(F.lower("path").rlike(pattern))
    if non_empty:
        files = files.where(F.col("length") > 0)
    return files


def read_metadata_docs(spark: SparkSession, folder: str, schema: T.StructType,
                       assets: DataFrame | None = None) -> DataFrame:
    """Per-item JSON documents in ``folder`` (``*.json``, names starting with
    ``_all`` skipped, malformed documents dropped, ``filepath`` required). With
    ``assets`` given, only documents whose ``filepath`` is a listed, non-empty
    media file are kept (left-semi join)."""
    if not _exists(spark, folder):
        return spark.createDataFrame([], schema)
    docs = (spark.read.schema(schema).option("multiLine", "true").option("mode", "DROPMALFORMED")
            .option("pathGlobFilter", "*.json").json(folder)
            .withColumn("_file", F.col("_metadata.file_name"))
            .where(~F.col("_file").startswith("_all"))
            .where(F.col("filepath").isNotNull())
            .drop("_file"))
    if assets is not None:
        local = assets.select(F.regexp_replace("path", "^file:", "").alias("filepath"))
        docs = docs.join(local, "filepath", "left_semi")
    return docs
