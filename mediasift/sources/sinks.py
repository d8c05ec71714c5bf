"""Sinks: JSON lines with nulls kept (S5), flattened CSV (S6), duplicate map
(S7), records keyed by full id instead of file stem (S8), partitioned metadata
lake (S9, D29). All are distributed writes (a directory of part files)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON record per line; NULL fields are written, not skipped."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def flatten_for_csv(df: DataFrame, map_keys: dict[str, list[str]] | None = None, sep: str = "_") -> DataFrame:
    """Structs become prefixed columns (``a_b``); maps become one column per
    key of the given key list (``ai_objects_person``); arrays become JSON text.
    Repeats until no nested column is left."""
    map_keys = map_keys or {}
    while True:
        cols, nested = [], False
        for f in df.schema.fields:
            c = F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.StructType):
                nested = True
                cols += [c[s.name].alias(f"{f.name}{sep}{s.name}") for s in f.dataType.fields]
            elif isinstance(f.dataType, T.MapType):
                nested = True
                keys = map_keys.get(f.name)
                if keys is None:
                    raise ValueError(f"map column {f.name!r} needs a fixed key list")
                cols += [c[F.lit(k)].alias(f"{f.name}{sep}{k}") for k in keys]
            elif isinstance(f.dataType, T.ArrayType):
                cols.append(F.to_json(c).alias(f.name))
            else:
                cols.append(c)
        df = df.select(*cols)
        if not nested:
            return df


def write_csv(df: DataFrame, path: str, map_keys: dict[str, list[str]] | None = None) -> None:
    flatten_for_csv(df, map_keys).write.mode("overwrite").option("header", "true").csv(path)


def write_duplicate_map(duplicates: DataFrame, path: str) -> None:
    """One row per duplicate (video_id, primary_id, score), never one giant object."""
    (duplicates.where(~F.col("is_unique")).select("video_id", "primary_id", "score")
     .write.mode("overwrite").parquet(path))


def write_lake(df: DataFrame, path: str, partition_cols: list[str], sort_col: str | None = None) -> None:
    """Parquet partitioned by e.g. source/date; rows clustered by
    ``sort_col`` within each partition so readers can skip row groups."""
    order = [*partition_cols, *([sort_col] if sort_col else [])]
    w = df.repartitionByRange(*order).sortWithinPartitions(*order)  # a large partition takes several tasks
    w.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)
