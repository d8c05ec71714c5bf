"""Incremental near-duplicate detection over a stream of signature files.

Each micro-batch is deduplicated against the index of leaders from earlier
batches and against itself, in ``foreachBatch``:

* only index leaders that share a band key with the batch take part (a semi-join
  on the stored index keys; the key columns of the whole index are read, its
  signatures only for the leaders touched);
* greedy runs over (those index leaders, then the batch in id order): index
  leaders never match each other, so they stay leaders; a batch item matching
  one of them is a duplicate, and the assignment takes the best score over the
  index leaders and earlier leaders of the same batch (the sequential loop over
  the concatenated batches gives the same answer);
* outputs and index rows are written under ``batch_id=<n>`` with overwrite, and
  an index read ignores rows of its own batch, so replaying a batch after a
  failure changes nothing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediasift.operators.leaders import greedy_leaders, prepare_items
from mediasift.operators.simjoin import Spec


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


class IncrementalDedup:
    """State lives in ``state_dir`` (a shared folder): index/, index_keys/, out/."""

    def __init__(self, spec: Spec, state_dir: str, id_col: str = "video_id"):
        self.spec = spec
        self.state = state_dir.rstrip("/")
        self.id_col = id_col

    def _path(self, name: str, batch_id: int | None = None) -> str:
        base = f"{self.state}/{name}"
        return base if batch_id is None else f"{base}/batch_id={batch_id}"

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spec, idc = self.spec, self.id_col
        sig = spec.sig_col
        items = batch.select(idc, sig)
        parts = [items.select(idc, sig, F.struct(F.lit(1).alias("s"), F.col(idc).alias("i")).alias("ordk"))]
        if _exists(spark, self._path("index_keys")):
            idx_keys = spark.read.parquet(self._path("index_keys")).where(F.col("batch_id") < batch_id)
            probes = spec.probe_keys(prepare_items(items, spec, idc).where("self_match")).select("key")
            touched = idx_keys.join(probes.distinct(), "key", "left_semi").select(F.col("id").alias(idc)).distinct()
            index = (spark.read.parquet(self._path("index")).where(F.col("batch_id") < batch_id)
                     .join(touched, idc, "left_semi"))
            parts.insert(0, index.select(idc, sig, F.struct(F.lit(0).alias("s"), F.col(idc).alias("i")).alias("ordk")))
        combined = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        res = greedy_leaders(combined, spec, idc, order_col="ordk")
        res = res.join(items.select(idc), idc, "left_semi")
        res.write.mode("overwrite").parquet(self._path("out", batch_id))
        done = spark.read.parquet(self._path("out", batch_id))
        leaders = items.join(done.where("is_unique").select(idc), idc, "left_semi").where(F.col(sig).isNotNull())
        leaders.write.mode("overwrite").parquet(self._path("index", batch_id))
        prepared = prepare_items(spark.read.parquet(self._path("index", batch_id)), spec, idc).where("self_match")
        spec.index_keys(prepared).write.mode("overwrite").parquet(self._path("index_keys", batch_id))

    def results(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self._path("out")).drop("batch_id")


def run_incremental(spark: SparkSession, source_dir: str, schema: T.StructType, spec: Spec,
                    state_dir: str, files_per_batch: int = 1) -> DataFrame:
    """Process every file in ``source_dir`` (oldest first) and return all assignments."""
    job = IncrementalDedup(spec, state_dir)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(source_dir))
    q = (stream.writeStream.foreachBatch(job.process)
         .option("checkpointLocation", os.path.join(state_dir, "_checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return job.results(spark)
