"""Batch inference with a user-supplied model.

``infer`` runs a model function over Arrow batches with ``mapInPandas``. The
model is loaded lazily once per Python worker process (a module-level cache
keyed by name), so it is neither pickled per row nor broadcast whole. A load
failure does not crash the job: rows come back with ``status = 'unavailable'``
and null outputs, like the reference's "labels unavailable" sentinel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

_MODELS: dict[str, object] = {}
LOAD_TRIES = 2  # per task: a later task on the same worker tries again


def _get_model(name: str, loader: Callable[[], object]):
    for _ in range(LOAD_TRIES):
        if name in _MODELS:
            break
        try:
            _MODELS[name] = loader()
        except Exception:  # noqa: BLE001 - a broken model means "unavailable", not a failed job
            pass
    return _MODELS.get(name)


def _apply(fn, model, part: pd.DataFrame, outputs: list[str]) -> Iterator[tuple[pd.DataFrame, pd.DataFrame, str, str | None]]:
    """(rows, outputs, status, error) of a batch; a failing batch is halved down to the rows at fault."""
    try:
        yield part, fn(model, part).reset_index(drop=True), "ok", None
    except Exception as e:  # noqa: BLE001 - isolation of bad rows
        if len(part) > 1:
            half = len(part) // 2
            yield from _apply(fn, model, part.iloc[:half], outputs)
            yield from _apply(fn, model, part.iloc[half:], outputs)
        else:
            yield part, pd.DataFrame({c: [None] for c in outputs}), "error", f"{type(e).__name__}: {e}"


def infer(df: DataFrame, name: str, loader: Callable[[], object],
          fn: Callable[[object, pd.DataFrame], pd.DataFrame], out_schema: str,
          keep: list[str], batch_size: int = 4096) -> DataFrame:
    """Apply ``fn(model, batch) -> outputs`` batch by batch.

    ``out_schema`` lists the kept columns, the model outputs and a trailing
    ``status string``; ``keep`` are input columns copied to the output. A column
    ``error string`` in the schema takes the message of a row that failed; rows
    beside it keep their outputs.
    """
    from pyspark.sql.types import _parse_datatype_string

    outputs = [f.name for f in _parse_datatype_string(out_schema).fields if f.name not in keep and f.name not in ("status", "error")]
    order = [f.name for f in _parse_datatype_string(out_schema).fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _get_model(name, loader)
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start:start + batch_size]
                if model is None:
                    none = pd.DataFrame({c: [None] * len(part) for c in outputs})
                    done = [(part, none, "unavailable", None)]
                else:
                    done = _apply(fn, model, part, outputs)
                for rows, res, status, error in done:
                    yield pd.concat([rows[keep].reset_index(drop=True), res], axis=1).assign(
                        status=status, error=error)[order]

    return df.mapInPandas(run, out_schema)


# -- a small deterministic model used by the registered query and the tests ----

def linear_weights(dim: int) -> np.ndarray:
    """Fixed stub weights: w_j = ((7 j) mod 11 - 5) / 10."""
    j = np.arange(dim)
    return ((j * 7) % 11 - 5) / 10.0


def linear_model_loader(dim: int = 64):
    return lambda: linear_weights(dim)


def linear_model_fn(w: np.ndarray, batch: pd.DataFrame) -> pd.DataFrame:
    mat = np.stack(batch["embedding"].to_numpy()).astype(np.float64)
    score = mat @ w
    return pd.DataFrame({"score": np.round(score, 6),
                         "label": np.where(score > 0, "positive", "negative")})
