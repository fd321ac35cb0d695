"""Classification metrics from labelled predictions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V


def class_grid(classes: DataFrame, name: str = "cls") -> DataFrame:
    """All pairs ``(y_true, y_pred)`` of the classes, which are few, without a cross join."""
    every = classes.agg(F.array_sort(F.collect_set(name)).alias("every"))
    return every.select("every", F.explode("every").alias("y_true")).select("y_true", F.explode("every").alias("y_pred"))


def confusion_matrix(predictions: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """``(y_true, y_pred, n)``, zero-filled over all classes; rows with a null in either column don't count."""
    rows = predictions.select("y_true", "y_pred").dropna()
    if classes is None:
        classes = rows.select(F.col("y_true").alias("cls")).unionByName(rows.select(F.col("y_pred").alias("cls"))).distinct()
    return class_grid(classes).join(rows.groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("n")), ["y_true", "y_pred"], "left").select("y_true", "y_pred", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def _safe(a, b):
    return F.when(b > 0, a / b).otherwise(0.0)


def class_report(matrix: DataFrame) -> DataFrame:
    """``(cls, precision, recall, f1, support)``; an undefined ratio is 0."""
    sides = F.explode(F.array(F.struct(F.col("y_true").alias("cls"), F.lit(0).alias("side")), F.struct(F.col("y_pred").alias("cls"), F.lit(1).alias("side"))))
    per = matrix.select("n", (F.col("y_true") == F.col("y_pred")).alias("hit"), sides.alias("s")).groupBy("s.cls").agg(
        F.sum(F.when(F.col("hit") & (F.col("s.side") == 0), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("s.side") == 0, F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("s.side") == 1, F.col("n")).otherwise(0)).alias("predicted"),
    )
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return per.select("cls", _safe(tp, predicted).alias("precision"), _safe(tp, support).alias("recall"), _safe(2.0 * tp, support + predicted).alias("f1"), "support")


def report_averages(report: DataFrame, matrix: DataFrame) -> DataFrame:
    """Rows accuracy, macro avg and weighted avg in the shape of :func:`class_report`."""
    total = F.sum("support")
    weighted = lambda c: _safe(F.sum(F.col(c) * F.col("support")), total)
    names = ("precision", "recall", "f1")
    macro = report.agg(*(F.avg(c).alias(c) for c in names), total.alias("support")).select(F.lit("macro avg").alias("cls"), *names, "support")
    weight = report.agg(*(weighted(c).alias(c) for c in names), total.alias("support")).select(F.lit("weighted avg").alias("cls"), *names, "support")
    hits = F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0))
    accuracy = matrix.agg(_safe(hits, F.sum("n")).alias("a"), F.sum("n").alias("support")).select(F.lit("accuracy").alias("cls"), *(F.col("a").alias(c) for c in names), "support")
    return accuracy.unionByName(macro).unionByName(weight)


def epoch_metrics(batches: DataFrame, run: str = "run") -> DataFrame:
    """Sample-weighted loss and accuracy of each run from ``(run, loss, batch_size, correct)``."""
    n = F.greatest(F.lit(1), F.sum("batch_size"))
    return batches.groupBy(run).agg((F.sum(F.col("loss") * F.col("batch_size")) / n).alias("loss"), (F.sum("correct") / n).alias("accuracy"))


PROTOTYPES_AT_ONCE = 50_000  # that one product takes; they are some 25 MB at 64 dimensions


def _products(prototypes: Broadcast) -> Callable[[pd.Series], pd.Series]:
    @F.pandas_udf("array<double>")
    def products(vectors: pd.Series) -> pd.Series:
        has = vectors.notna().to_numpy()
        out: list = [None] * len(vectors)
        if has.any():
            rows = np.stack(vectors[has].to_list()).astype(np.float64)
            rows /= np.sqrt((rows * rows).sum(axis=1, keepdims=True))
            for i, found in zip(np.flatnonzero(has), rows @ prototypes.value.T, strict=True):
                out[i] = found
        return pd.Series(out, dtype=object)

    return products


def nearest_prototype(items: DataFrame, prototypes: DataFrame, vector: str = "embedding", at_once: int = PROTOTYPES_AT_ONCE) -> DataFrame:
    """Adds ``logits`` (cosines to every prototype, in order of class), ``class_names``, ``y_pred`` and ``probabilities``.

    There is one prototype for each class, and a row's result names all of them.
    They are fetched and multiplied in Arrow batches, ``at_once`` of them at a time.
    """
    spark = items.sparkSession
    kept = prototypes.select("label", "ref").orderBy("label")
    names, blocks, rows = [], [], []

    def flush() -> None:
        if rows:
            block = np.array(rows, np.float64)
            blocks.append(_products(spark.sparkContext.broadcast(block / np.sqrt((block * block).sum(axis=1, keepdims=True))))(F.col(vector)))
            rows.clear()

    for row in kept.toLocalIterator(prefetchPartitions=True):
        names.append(row["label"])
        rows.append(row["ref"])
        if len(rows) >= at_once:
            flush()
    flush()
    logits = F.concat(*blocks) if blocks else F.array().cast("array<double>")
    class_names = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    met = items.withColumn("logits", logits).withColumn("class_names", class_names)
    return met.withColumns({"y_pred": F.get("class_names", V.argmax(F.col("logits"))), "probabilities": V.softmax(F.col("logits"))})


def prediction_response(df: DataFrame, k: int = 3, digits: int = 4) -> DataFrame:
    """Adds ``response`` (JSON with prediction, confidence, all_results) and ``confidences`` (map label -> confidence)."""
    top = V.top_k(F.col("probabilities"), F.col("class_names"), k, digits)
    rows = df.withColumn("all_results", top)
    first = F.element_at("all_results", 1)
    body = F.struct(first["label"].alias("prediction"), first["confidence"].alias("confidence"), F.col("all_results"))
    return rows.withColumns({"response": F.to_json(body), "confidences": F.map_from_entries("all_results")})


def parameter_counts(layers: DataFrame, model: str = "model") -> DataFrame:
    """Trainable and total parameters of each model from ``(model, layer, parameters, trainable)``."""
    return layers.groupBy(model).agg(F.sum(F.when(F.col("trainable"), F.col("parameters")).otherwise(0)).alias("trainable"), F.sum("parameters").alias("total"))
