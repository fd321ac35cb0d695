"""Ranking, caps, splits and numbering of labelled collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import numbered, number_of
from ..settings import DEFAULTS
from ..sources.tables import written
from .positions import positions


def ranked(df: DataFrame, label: str, *order: str | Column, name: str = "rank") -> DataFrame:
    """Position from 1 in the label; end ``order`` in a unique column."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(label).orderBy(*order)))


def best_per_class(df: DataFrame, label: str, *order: str | Column, keep: int = DEFAULTS.best_per_class) -> DataFrame:
    """The first ``keep`` of each label, or all of fewer; the rank filter bounds the sort map-side."""
    return ranked(df, label, *order).where(F.col("rank") <= keep)


def with_status(df: DataFrame, label: str, *order: str | Column, keep: int = DEFAULTS.best_per_class) -> DataFrame:
    """Every row with ``status`` saved or removed, and the ``rank`` of saved ones; ``order`` ends in a unique column's name.

    Only the first ``keep`` of each label are ranked, map-side first; the others get no place in any one task.
    """
    id_ = order[-1]
    saved = best_per_class(df, label, *order, keep=keep).select(F.col(id_).alias("_saved"), "rank")
    return df.join(saved, F.col(id_) == F.col("_saved"), "left").withColumn("status", F.when(F.col("rank").isNotNull(), "saved").otherwise("removed")).drop("_saved")


def status_counts(df: DataFrame, label: str, keep: int = DEFAULTS.best_per_class) -> DataFrame:
    """``(label, rows, saved, removed)``: how many the first ``keep`` of each label are follows from its number of rows."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    return n.select(label, "rows", F.least("rows", F.lit(keep)).alias("saved"), F.greatest(F.col("rows") - keep, F.lit(0)).alias("removed"))


def cleaning_report(df: DataFrame, label: str, name: str, *order: str | Column, keep: int = DEFAULTS.best_per_class) -> DataFrame:
    """The seven columns of the cleaning report: saved rows get a new name, removed ones none."""
    new = F.when(F.col("status") == "saved", numbered(F.col(label), F.col("rank"))).otherwise("")
    return with_status(df, label, *order, keep=keep).withColumn("new_name", new).withColumnRenamed(name, "original_name")


def capped(df: DataFrame, key: str, *order: str | Column, cap: int, existing: DataFrame | None = None) -> DataFrame:
    """The first ``cap`` rows of each key in order of arrival; ``existing(key, accepted)`` already counts."""
    if existing is None:
        return ranked(df, key, *order).where(F.col("rank") <= cap).drop("rank")
    # nobody accepts more than the cap anew, whatever already counts
    rows = ranked(df, key, *order).where(F.col("rank") <= cap).join(existing.select(key, "accepted"), key, "left")
    return rows.where(F.col("rank") <= cap - F.coalesce("accepted", F.lit(0))).drop("rank", "accepted")


def seeded_order(id_: str, seed: int = DEFAULTS.seed) -> Column:
    """A pseudo-random order that depends on the id and the seed only, not on the partitioning."""
    return F.md5(F.concat(F.col(id_).cast("string"), F.lit(f"/{seed}")))


def stratified_split(df: DataFrame, label: str, id_: str, train: int = DEFAULTS.train_percent, val: int = DEFAULTS.val_percent, seed: int = DEFAULTS.seed) -> DataFrame:
    """``df`` with ``split``: floors of the shares go to train and val, the rest to test, in seeded order within each label.

    ``id_`` is unique.  Places come from one range-partitioned sort, so that a label of any size spreads over tasks.
    """
    # names of the sort's own columns can't clash
    inner = {c: f"c{i}" for i, c in enumerate(df.columns)}
    rows = positions(df.withColumn("_order", seeded_order(id_, seed)).withColumnsRenamed(inner), inner[label], ["_order", inner[id_]], [c for c in inner.values() if c != inner[label]])
    rows = rows.withColumnsRenamed({v: k for k, v in inner.items()} | {"position": "_place"})
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed(label, "_label")
    rows = rows.join(counts, F.col(label).eqNullSafe(F.col("_label")))
    first = F.floor(F.col("_n") * train / 100)
    second = first + F.floor(F.col("_n") * val / 100)
    split = F.when(F.col("_place") <= first, "train").when(F.col("_place") <= second, "val").otherwise("test")
    return rows.select(*df.columns, split.alias("split"))


def require_splits(df: DataFrame, split: str = "split", names: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """``df`` itself, or an error that names the missing splits."""
    there = {r[0] for r in df.select(split).distinct().limit(1000).collect()}
    if missing := [n for n in names if n not in there]:
        raise FileNotFoundError(f"missing splits: {', '.join(missing)}")
    return df


def split_leaks(df: DataFrame, id_: str, split: str = "split") -> DataFrame:
    """Ids that lie in more than one split."""
    return df.groupBy(id_).agg(F.count_distinct(split).alias("splits")).where("splits > 1")


def next_numbers(df: DataFrame, label: str, name: str) -> DataFrame:
    """Next free number of each label: one more than the greatest in its names, or 1."""
    return df.groupBy(label).agg((F.coalesce(F.max(number_of(F.col(name))), F.lit(0)) + 1).alias("next_number"))


def first_seen(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The first row of each key, combined map-side; rows with a null key are dropped."""
    place = F.struct(*order) if len(order) > 1 else order[0]
    first = df.dropna(subset=keys).groupBy(*(F.col(k).alias(f"_{i}") for i, k in enumerate(keys))).agg(F.min_by(F.struct(*df.columns), place).alias("_row"))
    return first.select("_row.*")


def unseen(df: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't in ``history``."""
    return df.join(history.select(*keys).distinct(), keys, "left_anti")


def label_index(df: DataFrame, label: str) -> DataFrame:
    """``(label, class_index)`` from 0 in sorted order; the labels of a collection are few."""
    names = df.where(F.col(label).isNotNull()).select(label).distinct()
    return names.withColumn("class_index", F.row_number().over(Window.orderBy(label)) - 1)


def mini_batches(df: DataFrame, id_: str, size: int = 32, seed: int | None = DEFAULTS.seed, partitions: int | None = None) -> DataFrame:
    """Adds ``batch``: rows in seeded order (or by id) cut into batches of ``size`` without one global sort task.

    The order is a range partitioning; a partition's rows before it come from one count per partition.
    """
    order = seeded_order(id_, seed) if seed is not None else F.col(id_)
    rows = df.withColumn("_order", order)
    spread = rows.repartitionByRange(partitions, "_order", id_) if partitions else rows.repartitionByRange("_order", id_)
    own = written(spread.withColumn("_part", F.spark_partition_id()), "mini-batches")
    counts = own.groupBy("_part").count()
    before = counts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_order", id_)) - 1
    return own.join(F.broadcast(before), "_part").withColumn("batch", F.floor((place + F.col("_before")) / size)).drop("_order", "_part", "_before")


def preview(df: DataFrame, label: str, id_: str, seed: int = DEFAULTS.seed) -> DataFrame:
    """One row: uniform over labels first, then over the label's rows, by the seed."""
    one = df.where(F.col(label).isNotNull()).select(label).distinct().orderBy(seeded_order(label, seed), label).limit(1)
    return df.join(F.broadcast(one), label).orderBy(seeded_order(id_, seed), id_).limit(1)
