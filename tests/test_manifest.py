"""Stage runs: resume after a crash, atomic commit, latest complete version, provenance."""

import glob

import pytest
from mediasift.sources.manifest import StageRuns, input_version
from pyspark.sql import functions as F


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_killed_run_resumes_and_skips_finished_waves(spark, tmp_path):
    docs = spark.createDataFrame([(i if i != 7 else None, f"t{i}") for i in range(60)], "id long, text string")
    calls = []

    def fn(part):
        calls.append(1)
        if len(calls) == 3:  # the third wave's job dies after some output was written
            fail = F.udf(lambda t: 1 / 0, "long")
            return part.select("id", fail("text").alias("n"))
        return part.select("id", F.length("text").cast("long").alias("n"))

    stage = StageRuns(spark, str(tmp_path), "len", "code1", waves=4)
    with pytest.raises(Exception):
        stage.run(docs, "in1", "id", fn, run="a")
    assert len(stage.committed(stage.version("in1"))) == 2 and stage.latest() is None
    with pytest.raises(ValueError):
        stage.read()
    again = StageRuns(spark, str(tmp_path), "len", "code1", waves=4)  # a new process knows only the folder
    version = again.run(docs, "in1", "id", fn, run="b")
    assert len(calls) == 5  # two done, one failed, two more
    out = again.read(version)
    assert out.columns == ["id", "n"]
    assert _rows(out) == _rows(docs.select("id", F.length("text").cast("long")))
    made = again.read(provenance=True).groupBy("made_by.wave", "made_by.run", "made_by.input_version").count().collect()
    assert {(r["wave"], r["run"]) for r in made} == {(0, "a"), (1, "a"), (2, "b"), (3, "b")}
    assert again.run(docs, "in1", "id", fn) == version and len(calls) == 5  # nothing left to do
    stray = docs.select("id", F.lit(0).cast("long").alias("n"))  # an attempt without a manifest is never read
    stray.write.parquet(f"{tmp_path}/len/data/{version}/wave=0/attempt=dead")
    assert again.read().count() == 60


def test_latest_is_the_last_complete_version(spark, tmp_path):
    old = spark.range(20).select(F.col("id"), F.lit("old").alias("v"))
    new = spark.range(30).select(F.col("id"), F.lit("new").alias("v"))
    stage = StageRuns(spark, str(tmp_path), "copy", "1", waves=3)
    first = stage.run(old, "in1", "id", lambda d: d)
    second = stage.run(new, "in2", "id", lambda d: d, stop_after=2)
    assert first != second and stage.latest() == first and stage.read().count() == 20
    with pytest.raises(ValueError):
        stage.read(second)
    stage.run(new, "in2", "id", lambda d: d)
    assert stage.latest() == second and {r["v"] for r in stage.read().collect()} == {"new"}
    assert stage.version("in2") != StageRuns(spark, str(tmp_path), "copy", "2", waves=3).version("in2")
    record = stage.history().where(F.col("version") == second).first()
    assert not stage._commit({**record.asDict(), "run": "late"})  # the first commit of a wave stands
    assert stage.history().where("run = 'late'").count() == 0 and not glob.glob(f"{tmp_path}/copy/manifest/*/.draft-*[0-9a-f]")


def test_waves_by_file_read_only_their_files(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(400).repartition(16).write.parquet(src)
    before = input_version(spark, src)
    stage = StageRuns(spark, str(tmp_path / "out"), "copy", "1", waves=4)
    seen = []

    def fn(part):
        seen.append(set(part.select("_metadata.file_name").distinct().toPandas()["file_name"]))
        return part.select("id")

    stage.run(spark.read.parquet(src), before, "_metadata.file_name", fn)
    assert _rows(stage.read()) == [(i,) for i in sorted(range(400), key=lambda i: repr((i,)))]
    assert sum(map(len, seen)) == 16 and len(set().union(*seen)) == 16
    spark.range(5).write.mode("append").parquet(src)
    assert input_version(spark, src) != before


def test_empty_input(spark, tmp_path):
    stage = StageRuns(spark, str(tmp_path), "none", "1", waves=2)
    stage.run(spark.createDataFrame([], "id long, text string"), "in", "id", lambda d: d)
    assert stage.read().count() == 0 and stage.read().columns == ["id", "text"]
