"""Queries of the picture steps over planted picture bytes: two flat halves whose sizes and levels follow from the row.

A row's picture is a file of ``16 + report_id % 9`` by ``12 + report_id % 7``
pixels; its left 8 columns have the level ``report_id % 200``, the others 50
more.  Every thirteenth is cut short and can't be read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import pictures, png
from ..operators import evaluation, inference
from ..settings import CHANNEL_MEAN, CHANNEL_STD
from ..sources.tables import table

LEFT, STEP, SIDE = 8, 50, 16


@F.pandas_udf(T.BinaryType())
def planted(ids: pd.Series) -> pd.Series:
    """The picture file of each number."""
    out = []
    for i in ids:
        a = np.full((12 + i % 7, 16 + i % 9, 3), i % 200 + STEP, np.uint8)
        a[:, :LEFT] = i % 200
        data = png.encode(a)
        out.append(data[:40] if i % 13 == 0 else data)
    return pd.Series(out, dtype=object)


def _decoded(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "cleaning_report").where("report_id is not null").select("report_id").distinct()
    return rows.select("report_id", png.decode_udf()(planted("report_id")).alias("image"))


def picture_measures(spark: SparkSession, d: str) -> DataFrame:
    """Readable pictures' size, blur and brightness, and how many bits of the perceptual hash are set."""
    rows = _decoded(spark, d).where("image.height is not null").withColumn("m", pictures.measures_udf()("image"))
    return rows.select("report_id", "image.height", "image.width", F.round("m.blur", 4).alias("blur"), F.round("m.brightness", 4).alias("brightness"), F.length("m.phash").alias("hash_bits"))


def unreadable_pictures(spark: SparkSession, d: str) -> DataFrame:
    return _decoded(spark, d).where("image.height is null").select("report_id")


def picture_crops(spark: SparkSession, d: str) -> DataFrame:
    """The four columns on either side of the halves' border, six rows high, resized to 3 by 3: the corners' levels."""
    box = F.struct(F.lit(LEFT - 4).alias("x1"), F.lit(2).alias("y1"), F.lit(LEFT + 4).alias("x2"), F.lit(8).alias("y2"))
    cut = _decoded(spark, d).where("image.height is not null").withColumn("cut", pictures.crop_udf()("image", box))
    small = cut.withColumn("small", pictures.resize_udf(4)("cut"))
    byte = lambda n: F.conv(F.hex(F.substring("small.data", n, 1)), 16, 10).cast("int")
    return small.select("report_id", "cut.height", "cut.width", byte(1).alias("first"), byte(10).alias("last"))


def picture_tensors(spark: SparkSession, d: str) -> DataFrame:
    """First and last value of the first channel of the evaluation tensor: the levels of the two halves, normalised."""
    rows = _decoded(spark, d).where("image.height is not null").withColumn("t", pictures.tensor_udf(SIDE, SIDE)("image"))
    return rows.select("report_id", F.size("t").alias("values"), F.round(F.element_at("t", 1).cast("double"), 4).alias("first"), F.round(F.element_at("t", SIDE).cast("double"), 4).alias("last"))


def picture_copies(spark: SparkSession, d: str) -> DataFrame:
    """Pictures written as files again and read once more: the same pixels."""
    rows = _decoded(spark, d).where("image.height is not null").withColumn("again", png.decode_udf()(png.encode_udf()("image")))
    return rows.where(F.col("again") == F.col("image")).select("report_id")


def picture_responses(spark: SparkSession, d: str) -> DataFrame:
    """Request bytes to response: decoded, transformed, put through a linear model of two classes, and named; null where unreadable."""
    served = inference.respond(table(spark, d, "cleaning_report").where("report_id is not null").select("report_id").distinct().withColumn("content", planted("report_id")), "content", _WEIGHTS, _BIAS, ["dark", "light"], SIDE, SIDE)
    return served.select("report_id", F.get_json_object("response", "$.prediction").alias("prediction"))


# the first channel at the end of the first row, against the level 125.5
_AT = np.eye(1, 3 * SIDE * SIDE, SIDE - 1)[0]
_WEIGHTS = np.stack([-_AT, _AT])
_BIAS = np.array([1.0, -1.0]) * (125.5 / 255 - CHANNEL_MEAN[0]) / CHANNEL_STD[0]

QUERIES = {f.__name__: f for f in (picture_measures, unreadable_pictures, picture_crops, picture_tensors, picture_copies, picture_responses)}

_P = f"""p AS (SELECT DISTINCT report_id, CAST(12 + report_id % 7 AS INTEGER) AS height, CAST(16 + report_id % 9 AS INTEGER) AS width, report_id % 200 AS dark, report_id % 200 + {STEP} AS light
        FROM cleaning_report WHERE report_id IS NOT NULL)"""
_LEVEL = f"round(({{}} / 255.0 - {CHANNEL_MEAN[0]}) / {CHANNEL_STD[0]}, 4)"
ORACLES = {
    # the Laplacian is the step beside the border, once up and once down, and 0 elsewhere
    "picture_measures": f"""WITH {_P} SELECT report_id, height, width, round(2.0 * {STEP} * {STEP} / width, 4) AS blur, round(({LEFT} * dark + (width - {LEFT}) * light) / CAST(width AS DOUBLE), 4) AS brightness,
        64 AS hash_bits FROM p WHERE report_id % 13 <> 0""",
    "unreadable_pictures": f"WITH {_P} SELECT report_id FROM p WHERE report_id % 13 = 0",
    "picture_crops": f"WITH {_P} SELECT report_id, 6 AS height, 8 AS width, CAST(dark AS INTEGER) AS first, CAST(light AS INTEGER) AS last FROM p WHERE report_id % 13 <> 0",
    "picture_tensors": f"WITH {_P} SELECT report_id, 3 * {SIDE} * {SIDE} AS values, {_LEVEL.format('dark')} AS first, {_LEVEL.format('light')} AS last FROM p WHERE report_id % 13 <> 0",
    "picture_responses": f"WITH {_P} SELECT report_id, CASE WHEN report_id % 13 <> 0 THEN CASE WHEN light > 125 THEN 'light' ELSE 'dark' END END AS prediction FROM p",
    "picture_copies": f"WITH {_P} SELECT report_id FROM p WHERE report_id % 13 <> 0",
}
