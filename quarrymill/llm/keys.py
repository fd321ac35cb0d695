"""Fingerprint expressions of the training-data queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint(phash: Column) -> Column:
    """64 characters ``0``/``1`` as one long; null where the text is malformed."""
    half = lambda at: F.conv(F.substring(phash, at, 32), 2, 10).cast("long")
    return F.when(F.coalesce(phash.rlike("^[01]{64}\\z"), F.lit(False)), F.shiftleft(half(1), 32).bitwiseOR(half(33)))
