"""Clustered layout: files cut along a Z-order curve, with ranges per file that prune reads.

``write_clustered`` gives each row a bucket per column (by approximate quantiles, so skewed columns get even buckets),
interleaves the bucket bits to one key and writes ranges of that key. ``file_ranges`` is one row per file with the
smallest and largest value, null count and rows of each column. ``read_where`` reads only the files whose ranges meet
all conditions, and then filters their rows.

Nulls sort before all values and match no range. Ties share a bucket; a value that fills many buckets (a hot value)
is still cut by the other columns, and rows equal in all columns are spread over files by a hash. An empty table
gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 8            # 256 buckets a column
ERROR = 1.0 / 2048  # rank error of the cuts


def cuts(df: DataFrame, columns: list[str]) -> dict[str, list]:
    """At most 255 ascending cut values per column."""
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    row = df.agg(*[F.percentile_approx(c, shares, int(1 / ERROR)).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def bucket(column: str, at: list, kind: str) -> Column:
    """Number of cuts at or below the value (binary search in the plan's constants), 0 for null."""
    if not at:
        return F.lit(0)
    c = F.col(column)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c >= F.lit(at[mid]).cast(kind), search(mid + 1, hi)).otherwise(search(lo, mid))

    return F.when(c.isNull(), 0).otherwise(search(0, len(at)))


def z_key(buckets: list[Column]) -> Column:
    """Bits of the buckets interleaved, the highest of each first."""
    n = len(buckets)
    key = F.lit(0).cast("long")
    for bit in range(BITS):
        for i, b in enumerate(buckets):
            one = F.shiftright(b, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * n + (n - 1 - i)))
    return key


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int) -> None:
    """Rows of ``df`` in about ``files`` files, clustered on up to seven ``columns``."""
    if not 1 <= len(columns) <= 7:
        raise ValueError("one to seven columns")
    kinds, at, cols = dict(df.dtypes), cuts(df, columns), df.columns
    names = [f"{i}_{'_'.join(cols)}" for i in range(2)]  # no column of the table has these names
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in cols if not kinds[c].startswith("map")])
    keyed = df.select("*", z_key([bucket(c, at[c], kinds[c]) for c in columns]).alias(names[0]), tie.alias(names[1]))
    (keyed.repartitionByRange(files, *[F.col(f"`{n}`") for n in names]).select(*[F.col(f"`{c}`") for c in cols])
     .write.mode("error").parquet(path))


def file_ranges(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """(file, rows, and per column c: c_min, c_max, c_nulls), from the files as they are."""
    df = spark.read.parquet(path)
    per = [e for c in columns for e in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"),
                                        F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))]
    return (df.select(F.col("_metadata.file_path").alias("file"), *columns)
            .groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *per))


def files_for(ranges: DataFrame, where: dict[str, tuple]) -> list[str]:
    """Files that may hold a row with every column c of ``where`` inside its closed range (None: open end)."""
    kept = ranges
    for c, (lo, hi) in where.items():
        kept = kept.where(F.col(f"{c}_min").isNotNull())
        if lo is not None:
            kept = kept.where(F.col(f"{c}_max") >= F.lit(lo))
        if hi is not None:
            kept = kept.where(F.col(f"{c}_min") <= F.lit(hi))
    return sorted(r["file"] for r in kept.select("file").collect())  # names of files to read, no rows


def read_where(spark: SparkSession, path: str, ranges: DataFrame, where: dict[str, tuple]) -> DataFrame:
    """Rows inside all ranges, read from the files that ``ranges`` (of this ``path``) leaves."""
    schema = spark.read.parquet(path).schema
    files = files_for(ranges, where)
    if not files:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(*files)
    for c, (lo, hi) in where.items():
        df = df.where(F.col(c).isNotNull() if lo is None else F.col(c) >= F.lit(lo))
        df = df if hi is None else df.where(F.col(c) <= F.lit(hi))
    return df
