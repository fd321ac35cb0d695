"""Quality scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import DEFAULTS, Settings


def penalty(blur: Column, brightness: Column, width: Column, height: Column, s: Settings = DEFAULTS) -> Column:
    """How far a picture falls short of sharpness, light and size; 0 is good."""
    short = lambda x: F.greatest(F.lit(0.0), x)
    small = F.when((width < s.least_side) | (height < s.least_side), s.small_penalty).otherwise(0.0)
    return short(s.blur_floor - blur) + short(s.dark_floor - brightness) + short(brightness - s.bright_ceiling) + small


def padded_box(box: Column, width: Column, height: Column, share: float = DEFAULTS.crop_padding) -> Column:
    """The box grown on each side, whole numbers cut toward zero, inside the picture."""
    at = {k: box[k].cast("int") for k in ("x1", "y1", "x2", "y2")}
    pad_x, pad_y = (((at[b] - at[a]) * share).cast("int") for a, b in (("x1", "x2"), ("y1", "y2")))
    return F.struct(
        F.greatest(F.lit(0), at["x1"] - pad_x).alias("x1"), F.greatest(F.lit(0), at["y1"] - pad_y).alias("y1"),
        F.least(width, at["x2"] + pad_x).alias("x2"), F.least(height, at["y2"] + pad_y).alias("y2"),
    )


def box_area(box: Column) -> Column:
    return (box["x2"].cast("double") - box["x1"]) * (box["y2"].cast("double") - box["y1"])
