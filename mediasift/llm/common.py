"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of text that one call of an operator's batch function gets (a single longer text goes alone).
CHUNK_BYTES = 2_000_000


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns that would clash with result columns (names compare without case)."""
    taken = {n.lower() for n in names}
    return df.select(*[col(c) for c in df.columns if c.lower() not in taken])


def keep_rows(df: DataFrame, cols: list[str], keep: Callable[..., DataFrame]) -> DataFrame:
    """Rows of ``df`` that ``keep`` leaves, with all columns as they were.

    ``keep`` gets the rows under plain names (``_0``, ``_1``, ...) and the plain names of ``cols``; it may add
    columns of any other name. So no column of the input can clash with a result or an inner column.
    """
    plain = [f"_{i}" for i in range(len(df.columns))]
    done = keep(df.toDF(*plain), *(plain[df.columns.index(c)] for c in cols))
    return done.select(*plain).toDF(*df.columns)


def chunks(batches: Iterator[pa.RecordBatch], text_col: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of the batches with about ``limit`` bytes of text each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if batch.num_rows > start:
            yield batch.slice(start)


def map_text(df: DataFrame, text_col: str, schema: str,
             make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """Append columns that depend on one text column of a row only.

    ``make()`` runs once per task and returns a function from a list of texts (None for null) to the
    lists of the columns in ``schema``. All other columns pass through; an input column that has the
    name of a result column (any case) is replaced, unless it is the text itself (then: an error).
    """
    out = T.StructType.fromDDL(schema)
    if text_col.lower() in {n.lower() for n in out.names}:
        raise ValueError(f"result column would replace the text column {text_col!r}")
    base = without(df, out.names)
    full = T.StructType([*base.schema.fields, *out.fields])
    index = base.columns.index(text_col)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        f, target = make(), to_arrow_schema(out)
        for part in chunks(batches, text_col):
            texts = part.column(index).to_pylist()
            new = [pa.array(v, type=field.type) for v, field in zip(f(texts), target, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=full.names)

    return base.mapInArrow(run, full)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string (on the driver: tasks get it in the closure)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))


def lower_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 with A-Z lower-cased (bytes methods touch ASCII only)."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def fold(doc_id: str = "doc_id", parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts
