"""Problem 4: the first N of every group, by exact positions of one global range-partitioned sort (``operators.positions``)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.positions import positions


def top_n(df: DataFrame, group: str, order_by: list[str], n: int) -> DataFrame:
    """Problem 4: the first ``n`` rows of every group, ties broken by the last column of ``order_by``."""
    return positions(df, group, order_by, [order_by[-1]], keep=n)
