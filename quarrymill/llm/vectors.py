"""Vectors as fixed-point codes with error bounds, and tile products over cells.

A unit vector is stored as whole numbers and a scale; ``err`` is the length of
what rounding took away.  For two unit vectors the product of the codes lies
within ``err_a * (1 + err_b) + err_b`` of the true cosine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

TILE = 1024
BLOCK = 8192  # rows of a cell that meet in one task; larger cells are products of blocks
SLACK = 2e-6  # more than two roundings of a cosine in single precision, and those of sums in double precision


def present(vector: Column, dims: int = 64) -> Column:
    """A vector of ``dims`` elements without null or NaN that isn't all zeros."""
    good = ~F.array_contains(vector, F.lit(float("nan")).cast("float")) & ((F.array_max(vector) != 0) | (F.array_min(vector) != 0))  # null where an element is
    return F.coalesce((F.size(vector) == dims) & good, F.lit(False))


def stacked(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def encode(rows: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of unit rows, their scales and errors (rounded up)."""
    scale = np.abs(rows).max(axis=1) / np.iinfo(kind).max
    code = np.rint(rows / scale[:, None]).astype(kind)
    scale = scale.astype(np.float32)
    err = np.sqrt(((code * scale[:, None].astype(np.float64) - rows) ** 2).sum(axis=1))
    return code, scale, np.nextafter(err.astype(np.float32), np.float32(1)) + np.float32(1e-9)


def binary(code: np.ndarray) -> pa.Array:
    """Rows of codes as a binary column."""
    size = code.shape[1] * code.itemsize
    ends = np.arange(0, len(code) * size + 1, size, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(code), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(code))])


def from_binary(column: pa.Array, kind: type) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1), kind)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind).reshape(len(column), -1)


def blocked_cells(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows(cell long, id long, ...)`` -> the same with ``task long`` and ``part byte``.

    A cell of up to ``block`` rows is one task.  A larger one becomes blocks,
    and every pair of blocks a task: part 0 holds the rows of its first block,
    part 1 of its second.  Tasks of one cell cover each pair of rows once.
    """
    sizes = written(rows.groupBy("cell").count().where(F.col("count") > block).select("cell", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "cells-large")
    if sizes.isEmpty():
        return rows.withColumns({"task": F.xxhash64("cell"), "part": F.lit(0).cast("byte")})
    met = rows.join(sizes, "cell", "left").withColumn("own", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int"))
    other = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    pair = F.explode(F.transform(other, lambda b: F.struct(F.least(b, F.col("own")).alias("i"), F.greatest(b, F.col("own")).alias("j"))))
    met = met.select(*rows.columns, "own", pair.alias("pair"))
    part = F.when(F.col("pair.i") == F.col("own"), 0).otherwise(1).cast("byte")
    return met.select(*rows.columns, F.xxhash64("cell", "pair.i", "pair.j").alias("task"), part.alias("part"))


def tile_survivors(
    code: np.ndarray, scale: np.ndarray, err: np.ndarray, left: np.ndarray, right: np.ndarray | None, least: float, tile: int = TILE
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (i, j, estimate, bound) whose cosine may reach ``least``.

    ``left`` and ``right`` are row numbers; without ``right``, each pair inside
    ``left`` once.  Products of 8-bit codes are whole numbers: below 2**24 they
    are exact in single precision, else double precision is used.  The scales
    are multiplied in afterwards, two roundings that ``SLACK`` exceeds.
    """
    exact = np.float32 if code.shape[1] * 127**2 < 1 << 24 else np.float64
    worst = max(float(err[left].max(initial=0)), float(err[left if right is None else right].max(initial=0)))
    margin = worst * (2 + worst) + SLACK
    wide = lambda rows: code[rows].astype(exact)
    x_all = wide(left)
    y_all = x_all if right is None else wide(right)
    for a in range(0, len(left), tile):
        rows = left[a : a + tile]
        x = x_all[a : a + tile]
        others = left[a:] if right is None else right
        skip = a if right is None else 0
        for b in range(0, len(others), tile):
            cols = others[b : b + tile]
            product = x @ y_all[skip + b : skip + b + tile].T
            product *= scale[rows, None]
            product *= scale[cols]
            i, j = np.nonzero(product >= least - margin)
            if right is None and b == 0:
                i, j = i[i < j], j[i < j]
            if len(i):
                r, c = rows[i], cols[j]
                bound = err[r] * (1 + err[c]) + err[c] + np.float32(SLACK)
                est = product[i, j]
                some = est + bound >= least
                yield r[some], c[some], est[some], bound[some]


def by_task(keys: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of each task."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]]) if len(keys) else np.zeros(0, np.int64)
    for a, b in zip(cuts, np.r_[cuts[1:], len(keys)], strict=True):
        yield order[a:b]


def exact_cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision; lambdas are interpreted, so each vector is gone through as seldom as can be."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    square = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return dot / (F.sqrt(square(a)) * F.sqrt(square(b)))


def coded(df: DataFrame, kind: str, extra: Callable[[np.ndarray, pa.RecordBatch], dict[str, pa.Array]] | None = None, extra_schema: str = "", carry: list[str] | None = None) -> DataFrame:
    """``df(id, vector, ...)`` -> ``(id, code, scale, err, carried and extra columns)``."""
    carry = carry or []
    kept = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = unit(stacked(batch.column(batch.schema.get_field_index("vector"))))
            code, scale, err = encode(rows, np.dtype(kind).type)
            more = extra(rows, batch) if extra else {}
            columns = {"id": batch.column(batch.schema.get_field_index("id")), "code": binary(code), "scale": pa.array(scale), "err": pa.array(err)}
            columns |= {c: batch.column(batch.schema.get_field_index(c)) for c in carry} | more
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "id long, code binary, scale float, err float" + (", " + kept if kept else "") + (", " + extra_schema if extra_schema else "")
    return df.select("id", "vector", *(c for c in carry)).mapInArrow(run, schema)


SMALL_ROWS = 50_000  # rows of a few numbers that may be broadcast, after counting


def join_counted(large: DataFrame, few: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """``few`` is a written table: broadcast if it has few rows, shuffled like any other beyond that."""
    return large.join(F.broadcast(few) if few.count() <= SMALL_ROWS else few, on, how)
