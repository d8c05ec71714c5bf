"""Stage outputs with provenance: manifests, atomic commit, resume, latest complete version.

A stage is a function of rows or of whole keys. Its input is cut into ``waves`` by a hash of a key; each wave is one
Spark job that writes a folder of its own, and then one small manifest file that names input version, code version and
output files. The manifest appears by a rename, so a wave is either committed as a whole or not at all, and folders of
attempts that died have no manifest and are never read. A later run of the same version does only the waves without a
manifest. A version is complete when all its waves are committed.

Layout under ``base/stage``: ``data/<version>/wave=<w>/attempt=<id>/part files`` and
``manifest/<version>/wave-<w>.json``. Paths may be of any file system that Spark writes to. Rows whose key is null go
to the wave of the empty key. An empty input gives empty, committed waves.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = ("stage string, version string, input_version string, code_version string, run string, wave int, waves int, "
          "attempt string, files array<string>, rows long, schema string, finished string")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def input_version(spark: SparkSession, path: str, pattern: str = "*.parquet") -> str:
    """Digest of the names, lengths and times of the files at ``path``; changes when a file does."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
             .load(path).select("path", "length", F.unix_micros("modificationTime").alias("at")))
    r = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                  F.bit_xor(F.xxhash64("path", "length", "at")).alias("x")).first()
    return hashlib.sha256(json.dumps([r["n"], r["bytes"], r["x"]]).encode()).hexdigest()[:16]


def wave_of(key: str, waves: int) -> Column:
    """Wave by the first 32 bits of the key's MD5. With ``_metadata.file_name`` as key (for functions of rows) a wave
    lists only its own files, so each file is read once; any other key reads the source once a wave."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % waves).cast("int")


class StageRuns:
    """Runs of one stage under ``base``."""

    def __init__(self, spark: SparkSession, base: str, stage: str, code_version: str, waves: int = 8):
        if waves < 1:
            raise ValueError("waves must be at least 1")
        self.spark, self.stage, self.code_version, self.waves = spark, stage, code_version, waves
        self.root = f"{base.rstrip('/')}/{stage}"

    def version(self, source: str) -> str:
        text = json.dumps([self.stage, source, self.code_version, self.waves])
        return hashlib.sha256(text.encode()).hexdigest()[:16]

    def history(self) -> DataFrame:
        """One row per committed wave of any version."""
        fs, p = _fs(self.spark, f"{self.root}/manifest")
        if not fs.exists(p):
            return self.spark.createDataFrame([], RECORD)
        return (self.spark.read.schema(RECORD).option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "wave-*.json").json(f"{self.root}/manifest"))

    def committed(self, version: str) -> set[int]:
        """Waves done (at most ``waves`` numbers)."""
        rows = self.history().where(F.col("version") == version).select("wave").distinct().collect()
        return {r["wave"] for r in rows}

    def _commit(self, record: dict) -> bool:
        fs, folder = _fs(self.spark, f"{self.root}/manifest/{record['version']}")
        fs.mkdirs(folder)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        draft, final = path(folder, f".draft-{uuid.uuid4().hex}"), path(folder, f"wave-{record['wave']}.json")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(record).encode()))
        finally:
            out.close()
        done = not fs.exists(final) and fs.rename(draft, final)
        if not done:
            fs.delete(draft, False)  # another run was first; its attempt counts
        return done

    def run(self, source: DataFrame, source_version: str, key: str, fn: Callable[[DataFrame], DataFrame],
            run: str = "", stop_after: int | None = None) -> str:
        """Do the waves of this version that have no manifest; returns the version. ``fn`` gets a wave's rows with the
        columns of ``source``. ``stop_after`` ends after so many waves (for bounded runs, and to test a restart)."""
        version = self.version(source_version)
        done = self.committed(version)
        todo = [w for w in range(self.waves) if w not in done][:stop_after]
        for w in todo:
            attempt = f"{self.root}/data/{version}/wave={w}/attempt={uuid.uuid4().hex}"
            part = fn(source.where(wave_of(key, self.waves) == w))
            part.write.mode("error").parquet(attempt)
            out = self.spark.read.schema(part.schema).parquet(attempt)
            fs, p = _fs(self.spark, attempt)
            names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))
            self._commit({"stage": self.stage, "version": version, "input_version": source_version,
                          "code_version": self.code_version, "run": run, "wave": w, "waves": self.waves,
                          "attempt": attempt, "files": names, "rows": out.count(), "schema": part.schema.json(),
                          "finished": dt.datetime.now(dt.timezone.utc).isoformat()})
        return version

    def latest(self) -> str | None:
        """The complete version that was finished last, None if there is none."""
        got = (self.history().groupBy("version").agg(F.countDistinct("wave").alias("n"), F.max("waves").alias("waves"),
                                                     F.max("finished").alias("at"))
               .where(F.col("n") == F.col("waves")).agg(F.max(F.struct("at", "version")).alias("m")).first())
        return None if got["m"] is None else got["m"]["version"]

    def read(self, version: str | None = None, provenance: bool = False) -> DataFrame:
        """Rows of a complete version (default: the latest). With ``provenance`` also a struct column ``made_by``:
        stage, versions, run, wave and file of each row."""
        version = version or self.latest()
        waves = [] if version is None else self.history().where(F.col("version") == version).collect()
        if not waves or len({r["wave"] for r in waves}) < waves[0]["waves"]:
            raise ValueError(f"stage {self.stage!r} has no complete version {version or ''}")
        schema = T.StructType.fromJson(json.loads(waves[0]["schema"]))
        paths = [f"{r['attempt']}/{f}" for r in waves for f in r["files"]]  # as many as files, for the reader only
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*paths)
        if not provenance:
            return rows
        wave = F.regexp_extract(F.col("_metadata.file_path"), r"/wave=(\d+)/", 1).cast("int")
        facts = F.broadcast(self.history().where(F.col("version") == version)  # one row per wave
                            .select(F.col("wave").alias("_w"), F.struct(
                                "stage", "version", "input_version", "code_version", "run", "wave").alias("_facts")))
        cols = rows.columns
        return (rows.select(*[F.col(f"`{c}`") for c in cols], wave.alias("_wave"),
                            F.col("_metadata.file_name").alias("_file"))
                .join(facts, F.col("_wave") == F.col("_w"), "left")
                .select(*[F.col(f"`{c}`") for c in cols],
                        F.col("_facts").withField("file", F.col("_file")).alias("made_by")))
