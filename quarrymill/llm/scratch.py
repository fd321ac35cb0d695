"""Written intermediates (``sources.tables``), and how wide to shuffle."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

from ..sources.tables import drop_path, dropped, new_path, released, written

__all__ = ["drop_path", "dropped", "new_path", "partitions_for", "released", "written"]


def partitions_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Shuffle width that keeps a task's share of ``rows`` near ``rows_per_task``."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(rows / rows_per_task))
