"""Queries that write named files to the shared folder and read them again with the folder sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pictures, png
from ..functions.urls import numbered
from ..sources import pictures as sources
from ..sources.tables import new_path, table, written
from .pixels import planted


def _written(spark: SparkSession, rows: DataFrame, tag: str) -> str:
    folder = new_path(spark, tag)
    written(sources.write_files(rows, folder), "files")
    return folder


def _labels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "reference_vector").where("label is not null")
    return rows.groupBy("label").agg(F.max("n_images").cast("long").alias("n"), F.max("ref").alias("ref"))


def picture_files(spark: SparkSession, d: str) -> DataFrame:
    """One numbered picture file of each label, decoded by the folder source; those cut short count as unreadable."""
    rows = _labels(spark, d).select(F.concat_ws("/", "label", F.regexp_replace(numbered(F.col("label"), F.lit(1)), "jpg$", "png")).alias("path"), planted("n").alias("content"))
    found = sources.scan_pictures(spark, _written(spark, rows, "pictures"))
    return found.select("label", "name", "readable", F.when(F.col("readable"), F.col("image.height")).alias("height"), F.when(F.col("readable"), F.col("image.width")).alias("width"))


def cropped_files(spark: SparkSession, d: str) -> DataFrame:
    """Crops written under split and label, scanned as bytes, decoded: their sizes."""
    box = F.struct(F.lit(2).alias("x1"), F.lit(1).alias("y1"), F.lit(9).alias("x2"), F.lit(6).alias("y2"))
    image = png.decode_udf()(planted("n"))
    rows = _labels(spark, d).withColumn("cut", pictures.crop_udf()(image, box)).where("cut.height is not null")
    rows = rows.select(F.concat(F.lit("train/"), "label", F.lit("/crop.PNG")).alias("path"), png.encode_udf()("cut").alias("content"))
    found = sources.scan_files(spark, _written(spark, rows, "crops")).withColumn("image", png.decode_udf()("content"))
    return found.select("label", "name", "image.height", "image.width")


def vector_files(spark: SparkSession, d: str) -> DataFrame:
    """Reference vectors as one file each, read again and normalised."""
    rows = _labels(spark, d).where("ref is not null").select(F.concat("label", F.lit(".npy")).alias("path"), sources.vector_file("ref").alias("content"))
    found = sources.read_vectors(spark, _written(spark, rows, "vectors"))
    return found.select("label", F.posexplode("ref").alias("pos", "x")).select("label", "pos", F.round(F.col("x").cast("double"), 4).alias("x"))


QUERIES = {f.__name__: f for f in (picture_files, cropped_files, vector_files)}

_L = "l AS (SELECT label, CAST(max(n_images) AS BIGINT) AS n, max(ref) AS ref FROM reference_vector WHERE label IS NOT NULL GROUP BY label)"
ORACLES = {
    "picture_files": f"""WITH {_L} SELECT label, label || '_0001.png' AS name, n % 13 <> 0 AS readable, CASE WHEN n % 13 <> 0 THEN CAST(12 + n % 7 AS INTEGER) END AS height,
        CASE WHEN n % 13 <> 0 THEN CAST(16 + n % 9 AS INTEGER) END AS width FROM l""",
    "cropped_files": f"WITH {_L} SELECT label, 'crop.PNG' AS name, 5 AS height, 7 AS width FROM l WHERE n % 13 <> 0",
    "vector_files": f"""WITH {_L} SELECT label, CAST(pos - 1 AS INTEGER) AS pos, round(CAST(ref[pos] AS DOUBLE) / (sqrt(list_dot_product(CAST(ref AS DOUBLE[]), CAST(ref AS DOUBLE[]))) + 1e-9), 4) AS x
        FROM (SELECT label, ref, unnest(range(1, len(ref) + 1)) AS pos FROM l WHERE ref IS NOT NULL)""",
}
