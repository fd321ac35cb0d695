"""Exact positions inside groups by one global range-partitioned sort.

Rows are range-partitioned on (group, sort keys, id), so that a group of any
size spreads over as many tasks as it needs.  Each task counts along its sorted
rows; only a partition's first group can have begun in an earlier partition, so
the prefix sums involve at most two counts for each partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import written


def _changes(column: pa.Array) -> np.ndarray:
    """True where a value differs from the one before it; nulls equal each other."""
    if len(column) < 2:
        return np.zeros(max(0, len(column) - 1), bool)
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    equal = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    return ~equal.to_numpy(zero_copy_only=False)


def _count_along(group: str, same: list[str], keep: int | None, out: list[str], weight: str | None = None):
    """Adds each row's place in its group within the partition; summaries of the first and the last group follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        group_now, row_now, place, first = None, None, 0, None
        names = ["part", "grp", "place", "total", *out]
        schema = None

        def summary(name, total):
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name], schema.field(group).type), pa.array([None], pa.int64()), pa.array([total], pa.int64()), *(pa.nulls(1, schema.field(c).type) for c in out)], names
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            g = batch.column(schema.get_field_index(group))
            new_group = np.r_[group_now is None or g[0] != group_now, _changes(g)]
            other = new_group.copy()
            for c in same:
                other[1:] |= _changes(batch.column(schema.get_field_index(c)))
            here = [batch.column(schema.get_field_index(c)) for c in same]
            other[0] = new_group[0] or row_now is None or any(a[0] != b for a, b in zip(here, row_now, strict=True))
            step = other.astype(np.int64) if weight is None else other * batch.column(schema.get_field_index(weight)).to_numpy()
            running = np.cumsum(step)
            base = np.maximum.accumulate(np.where(new_group, running - step, -1))
            places = np.where(base < 0, running + place, running - base)
            ends = np.flatnonzero(new_group)
            if first is None and group_now is not None and len(ends):
                first = (group_now, place if ends[0] == 0 else int(places[ends[0] - 1]))
            elif first is None and len(ends) > 1:
                first = (g[0], int(places[ends[1] - 1]))
            group_now, row_now, place = g[-1], [c[-1] for c in here], int(places[-1])
            take = other if keep is None else other & (places <= keep)
            if take.any():
                rows = batch.filter(pa.array(take))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows.num_rows, part, np.int32)), rows.column(schema.get_field_index(group)), pa.array(places[take]), pa.nulls(rows.num_rows, pa.int64()), *(rows.column(schema.get_field_index(c)) for c in out)], names
                )
        if group_now is not None:
            if first is not None:
                yield summary(first[0].as_py(), first[1])
            yield summary(group_now.as_py(), place)

    return run


def _ranged(rows: DataFrame, columns: list[str], bytes_a_task: int = 128 << 20) -> DataFrame:
    """``rows`` range-partitioned; more widely than the session's setting where the plan's estimated size asks for it."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wide = min(size // bytes_a_task, 1 << 17)
    names = [F.col(c) for c in columns]
    return rows.repartitionByRange(wide, *names) if wide > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows.repartitionByRange(*names)


def positions(df: DataFrame, group: str, order_by: list[str], carry: list[str], keep: int | None = None, weight: str | None = None) -> DataFrame:
    """``group``, ``carry`` and the exact ``position`` (from 1) of each row in its group.

    ``order_by`` must end in a unique identifier: rows equal in all of it are
    redeliveries of one record and count once.  With ``keep``, only positions
    up to it are returned; a task drops what lies beyond it at once.  Nulls sort
    first and null is a group of its own; filter them where they are not wanted.
    With ``weight``, a row counts that often: ``position`` is the running sum.
    """
    names = list(dict.fromkeys([group, *order_by, *carry, *([weight] if weight else [])]))
    rows = df.select(*names)
    ordered = _ranged(rows, [group, *order_by]).sortWithinPartitions(group, *order_by)
    fields = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("grp", fields[group]), T.StructField("place", T.LongType()), T.StructField("total", T.LongType()), *(T.StructField(c, fields[c]) for c in carry)]
    )
    counted = written(ordered.mapInArrow(_count_along(group, order_by, keep, carry, weight), schema), "positions")
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counted.where("total is not null").select("part", "grp", "total")
        .select("part", F.col("grp").alias("of"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before")).where("before > 0")
    )
    # at most two summaries for each partition: bounded by the number of tasks
    found = counted.where("total is null").join(F.broadcast(offsets.withColumnRenamed("part", "at")), (F.col("part") == F.col("at")) & F.col("grp").eqNullSafe(F.col("of")), "left")
    position = F.col("place") + F.coalesce("before", F.lit(0))
    done = found.select(F.col("grp").alias(group), *carry, position.alias("position"))
    return done if keep is None else done.where(F.col("position") <= keep)
