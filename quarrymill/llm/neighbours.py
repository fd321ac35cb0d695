"""Problem 6: the k most similar vectors of every vector, by a block matrix join.

Equal vectors are one class.  Class vectors are coded in 16 bits and assigned
to one cell of each of several independent coarse partitions; cells (blocks of
them, where a cell is large) are multiplied with themselves.  A tile product of
8-bit codes with its error bound drops nearly all pairs; survivors are
recomputed in floating point from the 16-bit codes, and each vector keeps what
may still be among its k + 1 nearest, given the error bounds.  The lists of all
cells are merged; where the order around rank k or the least cosine is closer
than the remaining error, the original vectors decide.  A vector with more
candidates within the error than its heap holds (near-copies) meets its cells a
second time, in double precision on the original vectors.  What the coarse
partitions miss is the accuracy loss (see README).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .balls import gather
from .ranking import positions
from .scratch import partitions_for, written
from .vectors import SLACK, blocked_cells, by_task, coded, encode, exact_cosine, from_binary, join_counted, present, stacked, tile_survivors, unit

_DIRECTED = "a long, b long, cosine float, bound float"
_PAIRS = 1 << 17  # pairs whose vectors are taken out at a time
_STRIP = 256  # rows of an exact product
_ROUNDING = 1e-13  # of cosines in double precision, summed in any order, twice


@dataclass(frozen=True)
class NeighbourConfig:
    k: int = 5
    least: float = 0.85
    tables: int = 6  # independent coarse partitions
    rows_per_cell: int = 1024  # on average; the number of cells grows with the vectors
    sample: int = 12_000  # vectors, on average, that the cells' centres are fitted on; every vector is indexed
    most_centres: int = 2048  # of a level; where more cells are needed, each is divided by the centres of a second level
    heap: int = 16  # candidates of a vector that the codes may leave; with more, the original vectors decide
    dims: int = 64


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(axis=1) / 2
    return np.concatenate([np.zeros(0, np.int64), *((rows[i : i + 4096] @ centres.T - half).argmax(axis=1) for i in range(0, len(rows), 4096))])


def fit_centres(rows: np.ndarray, cells: int, seed: int, rounds: int = 4) -> np.ndarray:
    """k-means from a random start."""
    centres = rows[np.random.default_rng(seed).choice(len(rows), min(cells, len(rows)), replace=False)]
    for _ in range(rounds):
        own = _nearest(rows, centres)
        total = np.zeros_like(centres)
        np.add.at(total, own, rows)
        many = np.bincount(own, minlength=len(centres))[:, None]
        centres = np.where(many > 0, total / np.maximum(many, 1), centres).astype(np.float32)
    return centres


def fit_tables(rows: np.ndarray, cells: int, config: NeighbourConfig) -> list[tuple[np.ndarray, np.ndarray]]:
    """Centres of each table, and those of the differences to them: a cell is a pair of both."""
    first = min(cells, config.most_centres)
    second = min(math.ceil(cells / first), config.most_centres)
    out = []
    for table in range(config.tables):
        coarse = fit_centres(rows, first, table)
        out.append((coarse, fit_centres(rows - coarse[_nearest(rows, coarse)], second, table) if second > 1 else np.zeros((1, rows.shape[1]), np.float32)))
    return out


def cells_of(rows: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A cell of each table for every row."""
    found = []
    for t, (coarse, fine) in enumerate(tables):
        own = _nearest(rows, coarse)
        inner = _nearest(rows - coarse[own], fine) if len(fine) > 1 else 0
        found.append((t << 48) + (own << 24) + inner)
    return np.stack(found, axis=1)


def _heaps(q: np.ndarray, o: np.ndarray, cosine: np.ndarray, bound: np.ndarray, need: int, heap: int):
    """What may be among the ``need`` nearest of each q, and the q's that have more than ``heap`` of it, which keep nothing.

    Behind ``need`` others for certain is whose cosine with its bound lies below
    the ``need``-th best cosine without it.
    """
    by = np.lexsort((bound - cosine, q))
    q, o, cosine, bound = q[by], o[by], cosine[by], bound[by]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    many = np.diff(np.r_[first, len(q)])
    last = (cosine - bound)[np.minimum(first + need - 1, len(q) - 1)]
    kept = cosine + bound >= np.repeat(np.where(many >= need, last, -np.inf), many)
    over = np.add.reduceat(kept.astype(np.int64), first) > heap
    kept &= ~np.repeat(over, many)
    return (q[kept], o[kept], cosine[kept], bound[kept]), q[first[over]]


def _once(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """One row of each id: a record delivered twice counts once."""
    return rows[np.unique(ids[rows], return_index=True)[1]]


def _tiles(config: NeighbourConfig):
    """Lists of candidates; a row without b, cosine and bound is a vector that the codes can't settle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        task, part, ids, scale, err = (table[c].to_numpy() for c in ("task", "part", "id", "scale", "err"))
        code = from_binary(table["code"].chunk(0), np.int16)
        del table, got
        fine = code.astype(np.float32) * scale[:, None]
        short, short_scale, short_err = encode(fine.astype(np.float64), np.int8)
        short_err = short_err + err
        names = ["a", "b", "cosine", "bound"]
        for rows in by_task(task):
            left, right = _once(rows[part[rows] == 0], ids), _once(rows[part[rows] == 1], ids)
            lists = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, np.float32)]
            full = np.zeros(len(ids), bool)
            fresh: list[list[np.ndarray]] = []

            def settle(lists, fresh, full):
                joined = [np.concatenate(x) for x in zip(lists, *fresh, strict=True)]
                open_ = ~full[joined[0]]
                if not open_.any():
                    return [x[:0] for x in joined]
                kept, over = _heaps(*(x[open_] for x in joined), config.k + 1, config.heap)
                full[over] = True
                return list(kept)

            for r_all, c_all, _, _ in tile_survivors(short, short_scale, short_err, left, right if len(right) else None, config.least):
                for at in range(0, len(r_all), _PAIRS):
                    r, c = r_all[at : at + _PAIRS], c_all[at : at + _PAIRS]
                    some = ~(full[r] & full[c])
                    r, c = r[some], c[some]
                    value = np.einsum("ij,ij->i", fine[r].astype(np.float64), fine[c].astype(np.float64))
                    error = err[r] * (1 + err[c]) + err[c] + np.float32(SLACK)
                    some = value + error >= config.least
                    r, c, value, error = r[some], c[some], value[some], error[some]
                    fresh += [[r, c, value, error], [c, r, value, error]]
                    if sum(len(x[0]) for x in fresh) > 1 << 19:
                        lists, fresh = settle(lists, fresh, full), []
            lists = settle(lists, fresh, full)
            if len(lists[0]):
                q, o, cosine, bound = lists
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(ids[o]), pa.array(cosine.astype(np.float32)), pa.array(bound.astype(np.float32))], names)
            over = np.flatnonzero(full)
            if len(over):
                yield pa.RecordBatch.from_arrays([pa.array(ids[over]), pa.nulls(len(over), pa.int64()), pa.nulls(len(over), pa.float32()), pa.nulls(len(over), pa.float32())], names)

    return run


def _summed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Scalar products of rows, added up in the order of ``exact_cosine``, so that both give the same bits."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * y[:, d]
    return total


def _exact_tiles(config: NeighbourConfig):
    """The k + 1 nearest in its task of every row marked ``hard``, by the original vectors, the smaller id first among equals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        task, part, ids = (table[c].to_numpy() for c in ("task", "part", "id"))
        hard = table["hard"].to_numpy(zero_copy_only=False)
        raw = stacked(table["vector"].chunk(0)).astype(np.float64)
        del table, got
        near, length, need = unit(raw), np.sqrt(_summed(raw, raw)), config.k + 1
        for rows in by_task(task):
            left, right = rows[part[rows] == 0], rows[part[rows] == 1]
            for own, others in [(left, right), (right, left)] if len(right) else [(left, left)]:
                own = own[hard[own]]
                for at in range(0, len(own), _STRIP):
                    q = own[at : at + _STRIP]
                    product = near[q] @ near[others].T
                    product[ids[q][:, None] == ids[others]] = -np.inf
                    least = np.full((len(q), 1), config.least)
                    if len(others) > need:
                        least = np.maximum(least, np.partition(product, -need, axis=1)[:, [-need]])
                    i, j = np.nonzero(product >= least - _ROUNDING)
                    if not len(i):
                        continue
                    a, b = q[i], others[j]
                    cosine = np.concatenate([_summed(raw[a[s : s + _PAIRS]], raw[b[s : s + _PAIRS]]) for s in range(0, len(a), _PAIRS)]) / (length[a] * length[b])
                    by = np.lexsort((ids[b], -cosine, a))
                    a, b, cosine = a[by], b[by], cosine[by]
                    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
                    top = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)])) < need
                    yield pa.RecordBatch.from_arrays([pa.array(ids[a[top]]), pa.array(ids[b[top]]), pa.array(cosine[top])], ["a", "b", "cosine"])

    return run


def _settled(spots: DataFrame, hard: DataFrame, base: DataFrame, config: NeighbourConfig) -> DataFrame:
    """``spots(task, part, id)``, ``hard(id)`` -> ``(a, b, cosine)``: the k + 1 nearest of the hard ones in all their cells."""
    spark = spots.sparkSession
    tasks = written(join_counted(spots, hard, "id").select("task").distinct(), "hard-tasks")
    again = written(join_counted(spots, tasks, "task").distinct(), "hard-spots")
    some = written(again.select("id").distinct(), "hard-ids")
    vectors = join_counted(base, some, "id").dropDuplicates(["id"])
    marked = vectors.join(hard.withColumn("hard", F.lit(True)), "id", "left").withColumn("hard", F.coalesce("hard", F.lit(False)))
    rows = again.join(marked, "id").select("task", "part", "id", "hard", "vector")
    spread = rows.repartition(partitions_for(spark, again.count(), 1 << 15), "task")
    met = spread.mapInArrow(_exact_tiles(config), "a long, b long, cosine double").groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    best = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return met.withColumn("place", F.row_number().over(best)).where(F.col("place") <= config.k + 1).drop("place")


def nearest(df: DataFrame, id_: str, vector: str, config: NeighbourConfig = NeighbourConfig()) -> DataFrame:
    """Rows ``(a, b, cosine)``: b is among the k most similar others of a, with at least the least cosine.

    Of equally similar ones the smaller id goes first.  Vectors that are null,
    of another length, with null or NaN, or all zeros take no part; nor do
    records without an id.  A record delivered twice counts once.
    """
    spark = df.sparkSession
    base = df.select(F.col(id_).cast("long").alias("id"), F.col(vector).alias("vector")).where(F.col("id").isNotNull() & present(F.col("vector"), config.dims))
    named = base.select("id", F.xxhash64("vector").alias("x"), F.xxhash64(F.lit(1), F.reverse("vector")).alias("y"))
    classes = named.groupBy("x", "y").agg(F.min("id").alias("rep"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # every delivered record of a vector that occurs more than once; few, unless there are many copies
    members = written(named.join(classes, ["x", "y"]).select("id", "rep", "n"), "class-members")
    again = written(members.where("id <> rep").select("id").distinct(), "class-copies")
    reps = join_counted(base, again, "id", "left_anti")

    n = base.count()
    cells = math.ceil(n / config.rows_per_cell)
    tables = config.tables if cells > 1 else 1  # all would be the same
    if cells > 1:
        # by the ids' hashes, so the same rows each time; their number is the sample's, give or take its root
        share = min(1 << 30, math.ceil((1 << 30) * config.sample / n))
        sample = base.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share).select("id", "vector").orderBy("id").select("vector").toArrow()
        # at most 2 x most_centres vectors a table, whatever the number of vectors
        shared = spark.sparkContext.broadcast(fit_tables(unit(stacked(sample["vector"].combine_chunks())).astype(np.float32), cells, config))

        def home(rows: np.ndarray, _: pa.RecordBatch) -> dict[str, pa.Array]:
            own = cells_of(rows.astype(np.float32), shared.value)
            ends = np.arange(0, own.size + 1, own.shape[1], dtype=np.int32)
            return {"cells": pa.ListArray.from_arrays(pa.array(ends), pa.array(own.ravel()))}

        codes = coded(reps, "int16", home, "cells array<long>")
    else:
        codes = coded(reps, "int16").withColumn("cells", F.array(F.lit(0).cast("long")))
    codes = written(codes.select("id", "code", "scale", "err", "cells"), "vector-codes")  # a record delivered twice is met twice and kept once
    rows = codes.select(F.explode("cells").alias("cell"), "id", "code", "scale", "err")
    met = blocked_cells(rows).select("task", "part", "id", "code", "scale", "err")
    spread = met.repartition(partitions_for(spark, n * tables, 1 << 17), "task")
    pairs = spread.mapInArrow(_tiles(config), _DIRECTED).groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.max("bound").alias("bound"))
    # the same rule over all cells: whatever may be among the k + 1 nearest stays, or the vector is hard
    of = Window.partitionBy("a")
    low, high = F.col("cosine") - F.col("bound"), F.col("cosine") + F.col("bound")
    placed = pairs.withColumn("place", F.row_number().over(of.orderBy(F.desc_nulls_last(low))))
    placed = placed.withColumn("last", F.max(F.when(F.col("place") == config.k + 1, low)).over(of))
    placed = placed.withColumn("may", F.coalesce(high >= F.col("last"), F.col("b").isNotNull()))
    placed = placed.withColumn("hard", F.max(F.col("b").isNull()).over(of) | (F.sum(F.col("may").cast("int")).over(of) > config.heap))
    listed = written(placed.where("if(hard, place = 1, may)").select("a", "b", "cosine", "bound", "hard"), "neighbour-pairs")
    pairs = listed.where("not hard").select("a", "b", F.col("cosine").cast("double").alias("cosine"), "bound")
    hard = written(listed.where("hard").select(F.col("a").alias("id")), "neighbour-hard")
    if not hard.isEmpty():
        settled = _settled(met.select("task", "part", "id"), hard, base, config)
        pairs = pairs.unionByName(settled.withColumn("bound", F.lit(0.0).cast("float")))

    # of a class only its first k + 1 members can be among anyone's k nearest
    few = written(positions(members, "rep", ["id"], ["id"], keep=config.k + 1), "class-firsts")
    own = few.select(F.col("rep").alias("a"), F.col("rep").alias("b")).distinct().withColumns({"cosine": F.lit(1.0), "bound": F.lit(0.0).cast("float")})
    later = few.where("position > 1").select(F.col("rep").alias("b"), F.col("id").alias("other"))
    met = pairs.unionByName(own)
    met = met.select("*", F.col("b").alias("other")).unionByName(join_counted(met, written(later, "class-later"), "b").select("a", "b", "cosine", "bound", "other"))

    each = Window.partitionBy("a")
    ranked = met.withColumn("place", F.row_number().over(each.orderBy(F.desc("cosine"), "other")))
    # list place k + 1 matters too: a member drops itself from its class's list
    at = lambda p: F.max(F.when(F.col("place") == p, F.col("cosine"))).over(each)
    close = lambda hi, lo: F.coalesce(at(hi) - at(lo) <= 4 * F.max("bound").over(each), F.lit(False))
    unsure = (F.min(F.abs(F.col("cosine") - config.least) - F.col("bound")).over(each) <= 0) | close(config.k, config.k + 1) | close(config.k + 1, config.k + 2)
    unsure &= F.max("bound").over(each) > 0
    ranked = written(ranked.withColumn("unsure", unsure).drop("place"), "neighbour-lists")
    open_ = written(ranked.where("unsure and a <> b").select("a", "b").distinct(), "neighbour-open")
    ends = written(open_.select(F.col("a").alias("id")).unionByName(open_.select(F.col("b").alias("id"))).distinct(), "neighbour-ends")
    vectors = written(join_counted(base, ends, "id").dropDuplicates(["id"]), "neighbour-vectors")
    exact = open_.join(vectors.select(F.col("id").alias("a"), F.col("vector").alias("u")), "a").join(vectors.select(F.col("id").alias("b"), F.col("vector").alias("v")), "b")
    exact = exact.select("a", "b", exact_cosine(F.col("u"), F.col("v")).alias("exact"))
    value = F.when(F.col("a") == F.col("b"), 1.0).otherwise(F.coalesce("exact", "cosine"))
    final = ranked.join(exact, ["a", "b"], "left").select("a", "other", value.alias("cosine")).where(F.col("cosine") >= config.least)
    final = final.withColumn("place", F.row_number().over(each.orderBy(F.desc("cosine"), "other"))).where(F.col("place") <= config.k + 1)
    alone = final.select("a", F.col("a").alias("id"), "other", "cosine", "place")
    copies = final.join(members.where("id <> rep").select(F.col("rep").alias("a"), "id").distinct(), "a").select("a", "id", "other", "cosine", "place")
    lists = alone.unionByName(copies)
    # a member's own place, where it stands in its class's list, doesn't count
    itself = final.where("other <> a").select(F.col("a").alias("c"), F.col("other").alias("id"), F.col("place").alias("own"))
    itself = join_counted(members.where("id <> rep").select(F.col("rep").alias("c"), "id").distinct(), written(itself, "own-places"), ["c", "id"])
    self_rep = final.where("other = a").select(F.col("a").alias("c"), F.col("a").alias("id"), F.col("place").alias("own"))
    lists = lists.join(itself.unionByName(self_rep).withColumnRenamed("c", "a"), ["a", "id"], "left")
    kept = lists.where("other <> id").where(F.col("place") - F.when(F.col("own") < F.col("place"), 1).otherwise(0) <= config.k)
    return kept.select(F.col("id").alias("a"), F.col("other").alias("b"), "cosine")
