"""Folders of labelled pictures, reference vector files, and the sinks of each stage."""

from __future__ import annotations

import io
import json

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import file_name, label_of
from ..settings import IMAGE_EXTENSIONS

# the picture extensions in any letter case, so that other files are never opened
PICTURE_GLOB = "*.{" + ",".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in e[1:]) for e in IMAGE_EXTENSIONS) + "}"


def scan_files(spark: SparkSession, folder: str, pictures_only: bool = True, content: bool = True) -> DataFrame:
    """``(label, name, path, length, content)`` of ``folder/<label>/<file>``; without ``content`` no bytes are read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    rows = (reader.option("pathGlobFilter", PICTURE_GLOB) if pictures_only else reader).load(folder)
    kept = ["path", "length", *(["content"] if content else [])]
    return rows.select(label_of(F.col("path")).alias("label"), file_name(F.col("path")).alias("name"), *kept)


def scan_pictures(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded pictures ``(label, name, image)``; one that can't be decoded has ``readable`` false, so it can be counted."""
    rows = spark.read.format("image").option("recursiveFileLookup", True).option("pathGlobFilter", PICTURE_GLOB).load(folder)
    return rows.select(label_of(F.col("image.origin")).alias("label"), file_name(F.col("image.origin")).alias("name"), "image", (F.col("image.height") > 0).alias("readable"))


def read_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``(label, ref)`` from ``<label>.npy`` files, in single precision, normalised; an unreadable file gives no row."""

    def parse(batches):
        for pdf in batches:
            out = []
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    v = np.load(io.BytesIO(data), allow_pickle=False).astype(np.float32).ravel()
                except (ValueError, OSError, EOFError):
                    continue
                out.append((path.rsplit("/", 1)[-1].removesuffix(".npy"), v / (np.linalg.norm(v) + np.float32(1e-9))))
            yield pd.DataFrame(out, columns=["label", "ref"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "content").mapInPandas(parse, "label string, ref array<float>")


def write_files(df: DataFrame, folder: str, content: str = "content") -> DataFrame:
    """Bytes of ``df(path, content)`` as files below ``folder``, as they are: ``(path, length)`` of what was written.

    ``path`` is relative (``split/label/name``), unique, and made by the caller;
    a task that is repeated writes the same files again.  Nulls are left out.
    ``folder`` is a URI that every executor reaches (``file:``, ``hdfs:``, ``s3:``).
    """

    def run(batches):
        system, base = pa_fs.FileSystem.from_uri(folder)
        made = set()
        for batch in batches:
            sizes = []
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parent = f"{base}/{path}".rsplit("/", 1)[0]
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(f"{base}/{path}.part") as out:
                    out.write(data)
                system.move(f"{base}/{path}.part", f"{base}/{path}")
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["path", "length"])

    return df.select("path", content).dropna().mapInArrow(run, "path string, length long")


@F.pandas_udf(T.BinaryType())
def vector_file(vectors: pd.Series) -> pd.Series:
    """The bytes of a ``.npy`` file for each vector."""
    out = []
    for v in vectors:
        buf = io.BytesIO()
        if v is not None:
            np.save(buf, np.asarray(v, np.float32), allow_pickle=False)
        out.append(buf.getvalue() if v is not None else None)
    return pd.Series(out, dtype=object)


def write_labelled(df: DataFrame, path: str, *by: str) -> None:
    """Rows below a folder for each label (and split); overwritten as a whole, so no stale members stay."""
    df.write.mode("overwrite").partitionBy(*(by or ("label",))).parquet(path)


def write_report(df: DataFrame, path: str, rows_a_file: int = 1_000_000) -> None:
    """CSV files with a header, of up to ``rows_a_file`` rows each: a report has a row for every picture."""
    df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_a_file).csv(path)


def model_metadata(spark: SparkSession, model: str, size: int, classes: list[str], mean: tuple[float, ...], std: tuple[float, ...]) -> DataFrame:
    """One row ``(json)`` with name, picture size, class names and normalisation."""
    body = {"model_name": model, "img_size": size, "class_names": list(classes), "normalization": {"mean": list(mean), "std": list(std)}}
    return spark.createDataFrame([(json.dumps(body),)], "json string")
