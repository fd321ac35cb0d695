"""Batch inference with a linear model file, loaded once by each worker."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import png
from ..functions.pictures import evaluation_tensor
from ..functions.vectors import softmax
from ..settings import DEFAULTS
from .evaluation import prediction_response


def save_linear(path: str, weights: np.ndarray, bias: np.ndarray, names: list[str]) -> None:
    """One ``.npz`` file with ``weights`` (classes x dimensions), ``bias`` and class names in index order."""
    with open(path, "wb") as f:
        np.savez(f, weights=weights, bias=bias, names=np.array(names, dtype=np.str_))


@lru_cache(4)
def load_linear(path: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    with np.load(path, allow_pickle=False) as f:
        return f["weights"], f["bias"], f["names"].tolist()


def linear_logits(df: DataFrame, vector: str, path: str) -> DataFrame:
    """Adds ``logits`` and ``class_names``; a null vector or one of another length gives null logits.

    ``path`` must be readable by every worker (a shared folder, or ``SparkContext.addFile``).
    """
    schema = df.schema.simpleString()[len("struct<") : -1]
    at = df.columns.index(vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, names = load_linear(path)
        for batch in batches:
            rows = [np.asarray(v, np.float64) if v is not None and len(v) == weights.shape[1] and None not in v else None for v in batch.column(at).to_pylist()]
            fine = [r for r in rows if r is not None]
            found = iter((np.stack(fine) @ weights.T + bias).tolist() if fine else [])
            logits = pa.array([None if r is None else next(found) for r in rows], pa.list_(pa.float64()))
            labels = pa.array([names] * len(rows), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, logits, labels], [*batch.schema.names, "logits", "class_names"])

    return df.mapInArrow(run, f"{schema}, logits: array<double>, class_names: array<string>")


def respond(df: DataFrame, content: str, weights: np.ndarray, bias: np.ndarray, names: list[str], size: int = DEFAULTS.image_size, resize_to: int = 256) -> DataFrame:
    """Adds ``response``, the JSON answer to the picture bytes in ``content``; null where they can't be read.

    Bytes are decoded, set to the evaluation transform and put through a linear model in one Arrow pass.
    """
    model = df.sparkSession.sparkContext.broadcast((weights, bias))

    @F.pandas_udf("array<double>")
    def logits(contents: pd.Series) -> pd.Series:
        w, b = model.value
        out = []
        for data in contents:
            try:
                out.append(w @ evaluation_tensor(png.decode(bytes(data)), size, resize_to).ravel() + b if data is not None else None)
            except (ValueError, struct.error, IndexError):
                out.append(None)
        return pd.Series(out, dtype=object)

    scored = df.withColumn("_logits", logits(content)).withColumn("probabilities", softmax(F.col("_logits"))).withColumn("class_names", F.array(*map(F.lit, names)))
    answered = prediction_response(scored)
    return answered.select(*df.columns, F.when(F.col("_logits").isNotNull(), F.col("response")).alias("response"))
