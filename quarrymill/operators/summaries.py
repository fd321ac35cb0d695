"""Counters of stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import DEFAULTS


def class_summary(df: DataFrame, label: str, accepted: Column, target: int = DEFAULTS.accepted_cap) -> DataFrame:
    """Accepted, rejected and completeness of each label."""
    rows = df.groupBy(label).agg(F.count_if(accepted).alias("accepted"), F.count_if(~accepted).alias("rejected"))
    return rows.withColumn("complete", F.col("accepted") >= target)


def incomplete(summary: DataFrame, label: str) -> DataFrame:
    return summary.where(~F.col("complete")).select(label)


def with_total(counts: DataFrame, label: str) -> DataFrame:
    """A row of ``level`` total below the counts of each label: ``(level, label, counts)``."""
    names = [c for c in counts.columns if c != label]
    whole = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names))
    by = counts.select(F.lit("label").alias("level"), label, *names)
    return by.unionByName(whole.select(F.lit("total").alias("level"), F.lit(None).cast(counts.schema[label].dataType).alias(label), *names))


def totals(df: DataFrame, label: str, **counts: Column) -> DataFrame:
    """Counts of each label and, with ``level`` total, of all of them."""
    return with_total(df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(n) for n, c in counts.items())), label)


def round_counters(df: DataFrame, label: str, round_: str, **counts: Column) -> DataFrame:
    """Conditional counts by label and round."""
    return df.groupBy(label, round_).agg(F.count(F.lit(1)).alias("found"), *(F.count_if(c).alias(n) for n, c in counts.items()))


def queue_counters(df: DataFrame, label: str, round_: str, key: str, order: str, room: int) -> DataFrame:
    """Found, pushed, seen and queue_full of each label and round.

    A key (URL) is seen if its label has met it at a smaller ``order``; of a
    round's new ones the first ``room`` are pushed, the others find the queue full.
    """
    rows = df.where(f"{label} is not null and {key} is not null")
    first = rows.groupBy(label, key).agg(F.min(order).alias("_first"))
    new = rows.join(first, [label, key]).withColumn("_new", F.col(order) == F.col("_first"))
    counts = new.groupBy(label, round_).agg(F.count(F.lit(1)).alias("found"), F.count_if("_new").alias("_fresh"))
    pushed = F.least("_fresh", F.lit(room))
    return counts.select(label, round_, "found", pushed.alias("pushed"), (F.col("found") - F.col("_fresh")).alias("seen"), (F.col("_fresh") - pushed).alias("queue_full"))
