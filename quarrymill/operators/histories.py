"""Ordered replays: early stopping, best epoch, plateau schedule, progress and streaks.

Each run or label is one short ordered sequence (epochs, rounds), so windows
are partitioned by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..settings import DEFAULTS, Settings


def early_stopping(history: DataFrame, run: str = "run", epoch: str = "epoch", value: str = "val_acc", patience: int = DEFAULTS.patience) -> DataFrame:
    """Adds ``best_before``, ``improved``, ``streak``; drops epochs after the one at which training stops.

    Improved means strictly greater than the best so far, which begins at 0.
    """
    upto = Window.partitionBy(run).orderBy(epoch)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    rows = history.withColumn("best_before", F.coalesce(F.greatest(F.max(value).over(before), F.lit(0.0)), F.lit(0.0)))
    rows = rows.withColumn("improved", F.col(value) > F.col("best_before")).withColumn("_at", F.row_number().over(upto))
    last = F.coalesce(F.max(F.when(F.col("improved"), F.col("_at"))).over(upto.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    rows = rows.withColumn("streak", (F.col("_at") - last).cast("int"))
    stopped = F.max(F.when(F.col("streak") >= patience, 1).otherwise(0)).over(before)
    return rows.withColumn("_stopped", F.coalesce(stopped, F.lit(0))).where("_stopped = 0").drop("_at", "_stopped")


def best_epoch(history: DataFrame, run: str = "run", epoch: str = "epoch", value: str = "val_acc") -> DataFrame:
    """The epoch with the greatest value of each run, the first one on ties."""
    w = Window.partitionBy(run).orderBy(F.desc_nulls_last(value), epoch)
    return history.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def plateau_rates(history: DataFrame, run: str, epoch: str, value: str, rate: float, s: Settings = DEFAULTS) -> DataFrame:
    """``(run, epoch, lr)``: the rate in force after each epoch under reduce-on-plateau, mode max, relative threshold.

    A fold over the run's epochs in order: the state is (best, bad epochs, rate, rates so far).
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(epoch).alias("e"), F.col(value).cast("double").alias("v"))))
    start = F.struct(F.lit(float("-inf")).alias("best"), F.lit(0).alias("bad"), F.lit(float(rate)).alias("lr"), F.array().cast("array<struct<epoch:int,lr:double>>").alias("out"))

    def step(state, x):
        first = state["best"] == float("-inf")
        better = first | (x["v"] > state["best"] + F.abs(state["best"]) * s.plateau_threshold)
        bad = F.when(better, 0).otherwise(state["bad"] + 1)
        cut = bad > s.plateau_patience
        lr = F.when(cut, state["lr"] * s.plateau_factor).otherwise(state["lr"])
        row = F.struct(x["e"].cast("int").alias("epoch"), lr.alias("lr"))
        return F.struct(F.when(better, x["v"]).otherwise(state["best"]).alias("best"), F.when(cut, 0).otherwise(bad).alias("bad"), lr.alias("lr"), F.array_append(state["out"], row).alias("out"))

    folded = history.groupBy(run).agg(ordered.alias("h")).select(run, F.aggregate("h", start, step)["out"].alias("out"))
    return folded.select(run, F.inline("out"))


def progress(rounds: DataFrame, label: str = "label", round_: str = "round", accepted: str = "accepted") -> DataFrame:
    """Adds ``gained``: accepted since the round before."""
    w = Window.partitionBy(label).orderBy(round_)
    return rounds.withColumn("gained", F.col(accepted) - F.coalesce(F.lag(accepted).over(w), F.lit(0)))


def idle_streaks(rounds: DataFrame, label: str = "label", round_: str = "round", gained: str = "gained") -> DataFrame:
    """Adds ``idle``: rounds without progress since the last one with it (gaps and islands)."""
    w = Window.partitionBy(label).orderBy(round_)
    rows = rounds.withColumn("_island", F.sum(F.when(F.col(gained) > 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    idle = F.sum(F.when(F.col(gained) > 0, 0).otherwise(1)).over(Window.partitionBy(label, "_island").orderBy(round_).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("idle", idle.cast("int")).drop("_island")


def round_robin(rounds: DataFrame, queries: DataFrame, label: str = "label", round_: str = "round") -> DataFrame:
    """Adds the ``query`` of each round, taking the label's queries in turn; rounds count from 0."""
    every = queries.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "query"))), lambda s: s["query"]).alias("_q"))
    at = (F.pmod(F.col(round_), F.size("_q")) + 1).cast("int")
    return rounds.join(every, label).withColumn("query", F.element_at("_q", at)).drop("_q")


def metric_log(history: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Wide history to the long log ``(keys..., metric, value)``."""
    return history.select(*keys, *(F.col(m).cast("double") for m in metrics)).unpivot(keys, metrics, "metric", "value")
