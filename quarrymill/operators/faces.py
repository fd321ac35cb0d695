"""Reference vectors, the three ways to pick a face, similarity gates, reasons."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.quality import box_area
from ..settings import DEFAULTS, Settings

FACE_RULES = ("largest", "first", "best_match")


def _sums(epsilon: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(0).dictionary_encode()
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            rows /= np.sqrt((rows * rows).sum(axis=1, keepdims=True)) + epsilon
            own = names.indices.to_numpy()
            total = np.zeros((len(names.dictionary), rows.shape[1]))
            np.add.at(total, own, rows)
            ends = np.arange(0, total.size + 1, rows.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([names.dictionary, pa.array(np.bincount(own, minlength=len(total))), pa.ListArray.from_arrays(pa.array(ends), pa.array(total.ravel()))], ["label", "n", "total"])

    return run


def mean_vectors(df: DataFrame, label: str, vector: str, epsilon: float = 0.0) -> DataFrame:
    """``(label, n_vectors, ref)``: normalised vectors' mean, normalised again; a label without vectors has no row.

    Vectors, all of one length, are added up by label in Arrow batches first; only those sums are exploded.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(vector).isNotNull()).select(F.col(label).alias("label"), vector)
    sums = rows.mapInArrow(_sums(epsilon), f"label {df.schema[label].dataType.simpleString()}, n long, total array<double>")
    counts = sums.groupBy("label").agg(F.sum("n").alias("n_vectors"))
    parts = sums.select("label", F.posexplode("total").alias("pos", "x")).groupBy("label", "pos").agg(F.sum("x").alias("x"))
    whole = parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("m"))
    means = whole.join(counts, "label").withColumn("m", F.transform("m", lambda x: x / F.col("n_vectors")))
    return means.select(F.col("label").alias(label), "n_vectors", V.normalise(F.col("m"), epsilon).alias("ref"))


def with_similarity(faces: DataFrame, references: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """Adds ``similarity`` to the label's reference, null without one; the planner broadcasts the references if they are small."""
    refs = references.select(F.col(label).alias("_label"), "ref")
    return faces.join(refs, F.col(label) == F.col("_label"), "left").withColumn("similarity", V.cosine(F.col(vector), F.col("ref"))).drop("_label")


def pick_face(faces: DataFrame, picture: str, order: str, rule: str = "largest") -> DataFrame:
    """One face of each picture by ``rule``; ``order`` is the detection order and breaks ties.

    ``best_match`` needs ``similarity``; faces without one come last.
    """
    by: dict[str, list[Column]] = {
        "largest": [box_area(F.col("bbox")).desc_nulls_last(), F.col(order)],
        "first": [F.col(order)],
        "best_match": [F.col("similarity").desc_nulls_last(), F.col(order)] if "similarity" in faces.columns else [],
    }
    if rule not in FACE_RULES or not by[rule]:
        raise ValueError(f"unknown face rule or missing similarity: {rule}")
    return faces.withColumn("_place", F.row_number().over(Window.partitionBy(picture).orderBy(*by[rule]))).where("_place = 1").drop("_place")


def face_gate(faces: DataFrame, picture: str, s: Settings = DEFAULTS, pictures: DataFrame | None = None) -> DataFrame:
    """``(picture, faces, gate)``: no_face without a face, too_many_faces beyond the limit, else ok.

    ``pictures(picture)`` names all of them; without it, only those with a face have a row.
    """
    n = faces.groupBy(picture).agg(F.count(F.lit(1)).alias("faces"))
    if pictures is not None:
        n = pictures.select(picture).distinct().join(n, picture, "left").withColumn("faces", F.coalesce("faces", F.lit(0)))
    return n.withColumn("gate", F.when(F.col("faces") == 0, "no_face").when(F.col("faces") > s.most_faces, "too_many_faces").otherwise("ok"))


def exactly_one(faces: DataFrame, picture: str) -> DataFrame:
    """The face of pictures that show exactly one, as hashing stored files again wants it."""
    alone = faces.groupBy(picture).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select(picture)
    return faces.join(alone, picture, "left_semi")


def verdict_reason(corrupt: Column, faces: Column, has_reference: Column, similarity: Column, duplicate: Column | None = None, s: Settings = DEFAULTS) -> Column:
    """First failing rule of the verification; ``duplicate`` is md5, phash, emb or null."""
    reason = (
        F.when(corrupt, "corrupt").when(faces == 0, "no_face").when(faces > s.most_faces, F.concat(F.lit("too_many_faces="), faces.cast("string")))
        .when(~has_reference, "no_ref").when(similarity < s.similarity_gate, "low_sim")
    )
    if duplicate is not None:
        reason = reason.when(duplicate.isNotNull(), F.concat(F.lit("dup:"), duplicate))
    return reason.otherwise("ok")


def fetch_accepted(df: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Responses worth decoding: status 200, picture-like content type, enough bytes."""
    kind = F.lower("content_type")
    return df.where((F.col("status") == 200) & (kind.contains("image/") | kind.contains("application/octet")) & (F.octet_length("content") >= s.least_bytes))
