"""Layered duplicate removal: match graphs of each layer, then greedy order-aware resolution.

Items with an equal value of a layer are one class; a layer's match graph lies
between classes.  The layers are joined into one graph before resolving, since
an item that one layer drops must not suppress others through another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..settings import DEFAULTS
from ..sources.tables import dropped, written

REPLAY_ROWS = 1 << 20  # undecided rows and links that one task replays in order; the result is the same for any number
LAYERS = ("md5", "phash", "emb")  # also the order in which a reason is given


def exact_edges(df: DataFrame, label: str, order: str, key: str) -> DataFrame:
    """Each later copy of an equal key with the first one, so that n copies give n - 1 edges."""
    base = df.where(f"{label} is not null and {key} is not null")
    first = base.groupBy(label, key).agg(F.min(order).alias("a"))
    return base.join(first, [label, key]).where(F.col(order) > F.col("a")).select(label, "a", F.col(order).alias("b"))


def hamming_edges(df: DataFrame, label: str, order: str, bits: str, most: int = DEFAULTS.duplicate_distance) -> DataFrame:
    """Pairs of 64-bit fingerprints (long) within ``most``: an exact band join.

    The bits are cut into ``most + 2`` bands; two fingerprints within the distance agree in at least two of them.
    A key is a pair of bands (18 bits at distance 5), so that few other fingerprints of a label share it.
    """
    bands, at, cuts = most + 2, 0, []
    for i in range(bands):
        width = 64 // bands + (i < 64 % bands)
        cuts.append(F.shiftrightunsigned(bits, at).bitwiseAND(F.lit((1 << width) - 1)))
        at += width
    keys = [F.struct(F.lit(n).alias("no"), F.shiftleft(x, 32).bitwiseOR(y).alias("band")) for n, (x, y) in enumerate(combinations(cuts, 2))]
    base = df.where(f"{label} is not null and {bits} is not null")
    banded = base.select(label, F.col(order).alias("a"), F.col(bits).alias("x"), F.explode(F.array(*keys)).alias("c")).select(label, "c.no", "c.band", "a", "x")
    other = banded.withColumnsRenamed({"a": "b", "x": "y"})
    met = banded.join(other, [label, "no", "band"]).where((F.col("a") < F.col("b")) & (V.hamming(F.col("x"), F.col("y")) <= most))
    return met.select(label, "a", "b").distinct()


def _block_pairs(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=None) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        task, part, ids = (table.column(c).to_numpy() for c in ("task", "part", "id"))
        labels = table.column("label").combine_chunks()
        rows = table.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(ids), -1)
        rows /= np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        by = np.argsort(task, kind="stable")
        for own in np.split(by, np.flatnonzero(np.diff(task[by])) + 1):
            left, right = own[part[own] == 0], own[part[own] == 1]
            for at in range(0, len(left), 1024):
                x = left[at : at + 1024]
                y = right if len(right) else left[at:]
                i, j = np.nonzero(rows[x] @ rows[y].T >= least)
                a, b = ids[x[i]], ids[y[j]]
                low, high = np.minimum(a, b), np.maximum(a, b)
                keep = low < high
                if keep.any():
                    pairs = np.unique(np.stack([low[keep], high[keep]], 1), axis=0)
                    own_label = labels.take(pa.array(np.repeat(own[:1], len(pairs))))  # a task has one label
                    yield pa.RecordBatch.from_arrays([own_label, pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["label", "a", "b"])

    return run


def cosine_edges(df: DataFrame, label: str, order: str, vector: str, least: float = DEFAULTS.duplicate_cosine, block: int = 2048) -> DataFrame:
    """Pairs of one label with a cosine of at least ``least``: exact, by products of blocks.

    A label of up to ``block`` rows is one task; a larger one is every pair of its blocks, so no label gathers in one task.
    """
    base = df.where(f"{label} is not null and {vector} is not null").select(label, F.col(order).alias("id"), F.col(vector).alias("vector"))
    sizes = base.groupBy(label).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 1")
    met = base.join(sizes, label, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    met = met.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j")))
    rows = met.select(label, "id", "vector", "own", F.explode(pair).alias("p"))
    part = F.when(F.col("p.i") == F.col("own"), 0).otherwise(1).cast("byte")
    tasks = rows.select(F.xxhash64(label, "p.i", "p.j").alias("task"), part.alias("part"), F.col(label).alias("label"), "id", "vector").repartition("task")
    found = tasks.mapInArrow(_block_pairs(least), f"label {df.schema[label].dataType.simpleString()}, a long, b long")
    return found.withColumnRenamed("label", label)


def class_members(df: DataFrame, label: str, order: str, **layers: str) -> DataFrame:
    """``(id, layer, cls)``: the class of equal values an item belongs to in each layer; a null value belongs to none."""
    parts = [
        df.where(f"{label} is not null and {column} is not null").select(F.col(order).alias("id"), F.lit(layer).alias("layer"), F.xxhash64(F.lit(layer), label, column).alias("cls"))
        for layer, column in layers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def near_classes(df: DataFrame, label: str, layer: str, column: str, pairs: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(cls, other)``: classes of a layer that match each other; ``pairs`` finds ``(a, b)`` among one row for each class."""
    base = df.where(f"{label} is not null and {column} is not null").withColumn("cls", F.xxhash64(F.lit(layer), label, column)).dropDuplicates(["cls"])
    found = written(pairs(base).select("a", "b"), "near-classes")
    return found.select(F.col("a").alias("cls"), F.col("b").alias("other")).unionByName(found.select(F.col("b").alias("cls"), F.col("a").alias("other")))


def _rivals(members: DataFrame, near: DataFrame, status: DataFrame) -> DataFrame:
    """``(id, layer, k, u)``: the least kept and the least undecided item an item matches in a layer, itself included."""
    seen = members.join(status, "id")
    own = seen.groupBy("cls").agg(F.min(F.when(F.col("kept"), F.col("id"))).alias("k"), F.min(F.when(F.col("kept").isNull(), F.col("id"))).alias("u"))
    around = near.join(own.withColumnRenamed("cls", "other"), "other").select("cls", "k", "u")
    least = own.unionByName(around).groupBy("cls").agg(F.min("k").alias("k"), F.min("u").alias("u"))
    return members.join(least, "cls").groupBy("id", "layer").agg(F.min("k").alias("k"), F.min("u").alias("u"))


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dropped ones of items (id, classes, near classes) in order: one is kept unless a kept one has its class or a near one."""
    taken: set[int] = set()
    for batch in batches:
        out = []
        for id_, own, near in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not taken.isdisjoint(own):
                out.append(id_)
            else:
                taken.update(own)
                taken.update(near or ())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["id"])


def _replayed(members: DataFrame, near: DataFrame) -> DataFrame:
    """``(id)`` of the dropped ones, in one task; for few rows."""
    around = near.groupBy("cls").agg(F.collect_list("other").alias("near"))
    rows = members.join(around, "cls", "left").groupBy("id").agg(F.collect_list("cls").alias("own"), F.flatten(F.collect_list(F.coalesce("near", F.array().cast("array<long>")))).alias("near"))
    return rows.repartition(1).sortWithinPartitions("id").select("id", "own", "near").mapInArrow(_in_order, "id long")


def greedy_by_class(items: DataFrame, members: DataFrame, near: DataFrame, order: str, replay_rows: int = REPLAY_ROWS) -> DataFrame:
    """``items`` with ``kept``: an item is kept unless an earlier kept one matches it.

    Two items match when they share a class or belong to matching ones; classes
    stand for their members, so that many copies make no pairs.  While there are
    more undecided rows than ``replay_rows``, a round over all of them keeps the
    items without an earlier undecided match and drops what matches those; only
    what is still undecided goes on.  What is few is replayed in order, one
    after another.  ``order`` is a unique long.
    """
    linked = near.select("cls").unionByName(members.groupBy("cls").count().where("count > 1").select("cls")).distinct()
    members = written(members.join(linked, "cls", "left_semi").select("id", "cls"), "greedy-members")
    near = written(near.select("cls", "other").distinct(), "greedy-near")
    lost = []
    while rows := members.count():
        if rows + near.count() <= replay_rows:
            lost.append(_replayed(members, near))
            break
        first = members.groupBy("cls").agg(F.min("id").alias("u"))
        around = near.join(first.withColumnRenamed("cls", "other"), "other").select("cls", "u")
        least = first.unionByName(around).groupBy("cls").agg(F.min("u").alias("u"))
        free = members.join(least, "cls").groupBy("id").agg(F.min("u").alias("u")).where("u >= id").select("id")
        won = written(members.join(free, "id", "left_semi"), "greedy-won")
        hit = won.select("cls").distinct()
        hit = hit.unionByName(near.join(hit.withColumnRenamed("cls", "other"), "other", "left_semi").select("cls")).distinct()
        settled = won.select("id").distinct()
        out = written(members.join(hit, "cls", "left_semi").select("id").distinct().join(settled, "id", "left_anti"), "greedy-lost")
        lost.append(out)
        rest = written(members.join(settled.unionByName(out), "id", "left_anti"), "greedy-members")
        open_ = rest.select("cls").distinct()
        fewer = written(near.join(open_, "cls", "left_semi").join(open_.withColumnRenamed("cls", "other"), "other", "left_semi").select("cls", "other"), "greedy-near")
        dropped(members, near, won)
        members, near = rest, fewer
    gone = reduce(DataFrame.unionByName, lost) if lost else items.select(F.col(order).alias("id")).limit(0)
    return items.join(gone.select(F.col("id").alias(order), F.lit(False).alias("kept")), order, "left").withColumn("kept", F.coalesce("kept", F.lit(True)))


def greedy_keep(items: DataFrame, edges: DataFrame, order: str, replay_rows: int = REPLAY_ROWS) -> DataFrame:
    """The same from plain edges ``(a, b)``: every item is a class of its own."""
    both = edges.select(F.col("a").alias("cls"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("cls"), F.col("a").alias("other"))).distinct()
    members = items.select(F.col(order).alias("id"), F.lit("any").alias("layer"), F.col(order).alias("cls"))
    return greedy_by_class(items, members, both, order, replay_rows)


def drop_reasons(kept: DataFrame, members: DataFrame, near: DataFrame, order: str) -> DataFrame:
    """``(order, reason)`` of dropped items: the first layer, in the order of LAYERS, in which a kept earlier item matches."""
    rank = F.array_position(F.array(*map(F.lit, LAYERS)), F.col("layer"))
    rival = _rivals(members, near, kept.select(F.col(order).alias("id"), "kept")).where(F.col("k") < F.col("id"))
    best = rival.groupBy("id").agg(F.min(rank).cast("int").alias("r"))
    dropped = kept.where("not kept").select(F.col(order).alias("id"))
    return dropped.join(best, "id").select(F.col("id").alias(order), F.concat(F.lit("dup:"), F.element_at(F.array(*map(F.lit, LAYERS)), F.col("r"))).alias("reason"))


def store_sizes(df: DataFrame, label: str, md5: str, phash: str, vector: str) -> DataFrame:
    """What a label's duplicate store holds: distinct md5, fingerprints, vectors."""
    return df.groupBy(label).agg(F.count_distinct(md5).alias("md5s"), F.count(phash).alias("phashes"), F.count(vector).alias("embeddings"))
