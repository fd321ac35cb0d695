"""Problem 8: filling containers of fixed capacity with texts measured in tokens.

Bulk-synchronous best fit in rounds.  A round range-sorts the texts not placed
yet (largest first) and the gaps of the containers (smallest first), which
gives every text and every gap its exact rank.  Both are dealt to tasks by
rank, so that each task holds texts and gaps of all sizes and no gap is wanted
by two tasks.  A task sweeps its texts in order of rank over its gaps: each
takes its successor, the smallest gap it fits in; of several that want one
gap the first by rank gets it, and what remains of the gap is a gap again.  A
task opens no more containers than its texts fill or need for themselves.  What
fits nowhere is left for the next round, in which the updated gaps and the
texts left are ranked and dealt anew.  When a round places little, its tasks
may open containers freely, and all is placed.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import positions
from .scratch import dropped, partitions_for, written

ITEMS_A_TASK = 1 << 15  # texts, and gaps, that one sweep holds; more texts only where they fill fewer than two containers for each sweep
_LOCAL_BITS, _SHARD_BITS = 24, 24  # a container's key: round, task of the round, number within the task
PLACED, LEFT, GAP = 0, 1, 2
_SWEPT = "kind byte, capacity_id int, capacity long, doc_id long, piece int, size long, bin long, offset long"


def sweep(sizes: list[int], gaps: list[tuple[int, int]], capacity: int, first_bin: int, free: bool) -> tuple[list[tuple[int, int] | None], list[tuple[int, int]]]:
    """Best fit of ``sizes``, largest first, into ``gaps(gap, bin)``, sorted, and new containers from ``first_bin`` on.

    (bin, offset) of each size, None for what is left, and the gaps after all.
    Not ``free``, it opens as many containers as the sizes fill beyond the gaps,
    or as there are sizes above half the capacity.
    """
    room = sum(g for g, _ in gaps)
    most = len(sizes) if free else max((sum(sizes) - room) // capacity, sum(s * 2 > capacity for s in sizes))
    found: list[tuple[int, int] | None] = []
    opened = 0
    for size in sizes:
        at = bisect_left(gaps, (size, -1))
        if at < len(gaps):
            gap, own = gaps.pop(at)
        elif opened < most:
            gap, own = capacity, first_bin + opened
            opened += 1
        else:
            found.append(None)
            continue
        found.append((own, capacity - gap))
        if gap > size:
            insort(gaps, (gap - size, own))
    return found, gaps


def _sweeps(round_: int, free: bool):
    """Rows of (capacity_id, shard), gaps before texts and each in order of rank, to placed and left texts and gaps."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        capacity_id, capacity, shard = rows[0][0], rows[0][1], rows[0][2]
        gaps = sorted((r[6], r[7]) for r in rows if r[3] == 0)
        items = [r for r in rows if r[3] == 1]
        found, gaps = sweep([r[6] for r in items], gaps, capacity, (round_ << _SHARD_BITS | shard) << _LOCAL_BITS, free)
        out = [(LEFT if f is None else PLACED, r[4], r[5], r[6], *(f or (None, None))) for r, f in zip(items, found, strict=True)]
        out += [(GAP, None, None, gap, own, None) for gap, own in gaps]
        kind, doc, piece, size, own, offset = map(list, zip(*out, strict=True))
        n = len(out)
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int8()), pa.array([capacity_id] * n, pa.int32()), pa.array([capacity] * n, pa.int64()), pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(size, pa.int64()), pa.array(own, pa.int64()), pa.array(offset, pa.int64())],
            ["kind", "capacity_id", "capacity", "doc_id", "piece", "size", "bin", "offset"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (row[0], row[2]) != (rows[0][0], rows[0][2]):
                    yield settle(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield settle(rows)

    return run


def _round(items: DataFrame, gaps: DataFrame | None, round_: int, free: bool, items_a_task: int) -> DataFrame:
    """One round over ``items(capacity_id, capacity, doc_id, piece, size)`` and ``gaps(capacity_id, capacity, size, bin)``."""
    spark = items.sparkSession
    ranked = positions(items.withColumn("down", -F.col("size")), "capacity_id", ["down", "doc_id", "piece"], ["capacity", "doc_id", "piece", "size"])
    rows = ranked.select("capacity_id", "capacity", F.lit(1).alias("kind"), "doc_id", "piece", "size", F.lit(None).cast("long").alias("bin"), "position")
    if gaps is not None:
        placed = positions(gaps, "capacity_id", ["size", "bin"], ["capacity", "size", "bin"])
        rows = rows.unionByName(placed.select("capacity_id", "capacity", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("int").alias("piece"), "size", "bin", "position"))
    rows = written(rows, "pack-ranks")
    # one row for each capacity; texts that fill few containers stay in few tasks, however many they are
    count = lambda kind: F.ceil(F.sum((F.col("kind") == kind).cast("int")) / items_a_task)
    filled = F.floor(F.sum(F.when(F.col("kind") == 1, F.col("size"))) / (2 * F.first("capacity")))
    shards = rows.groupBy("capacity_id").agg(F.greatest(F.lit(1), count(0), F.least(count(1), filled)).alias("shards"))
    dealt = rows.join(shards, "capacity_id").withColumn("shard", F.pmod(F.col("position"), F.col("shards")).cast("int"))
    dealt = dealt.select("capacity_id", "capacity", "shard", "kind", "doc_id", "piece", "size", "bin", "position")
    spread = dealt.repartition(partitions_for(spark, rows.count(), 8 * items_a_task), "capacity_id", "shard").sortWithinPartitions("capacity_id", "shard", "kind", "position")
    swept = written(spread.drop("position").mapInArrow(_sweeps(round_, free), _SWEPT), "pack-swept")
    dropped(rows)
    return swept


def pack(sizes: DataFrame, capacities: DataFrame, items_a_task: int = ITEMS_A_TASK) -> DataFrame:
    """``sizes(id, tokens)``, ``capacities(capacity_id, capacity)`` -> ``(capacity_id, doc_id, piece, size, bin, offset)``.

    A text larger than the capacity fills whole containers with its first
    pieces; its rest is an item like any other.  Texts without tokens take no
    space and go to container 0.  Null ids, null or negative sizes and null or
    non-positive capacities are left out; an id that occurs twice is placed
    twice unless its rows are equal.  Containers count from 0 for each capacity.
    There is no limit on the number of capacities or on their size.
    """
    spark = sizes.sparkSession
    named = capacities.where("capacity_id is not null and capacity > 0").select(F.col("capacity_id").cast("int"), F.col("capacity").cast("long")).distinct()
    # the configured capacities, one element each: every text meets every capacity by definition of the problem
    wanted = F.array(*(F.struct(F.lit(c).alias("capacity_id"), F.lit(n).cast("long").alias("capacity")) for c, n in sorted(map(tuple, named.collect())))).cast("array<struct<capacity_id:int,capacity:bigint>>")
    items = sizes.where("id is not null and tokens >= 0").select(F.col("id").cast("long").alias("doc_id"), F.col("tokens").cast("long").alias("tokens")).distinct()
    met = items.select("doc_id", "tokens", F.explode(wanted).alias("c")).select("c.capacity_id", "c.capacity", "doc_id", "tokens")
    pieces = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("tokens") / F.col("capacity")) - 1).cast("int"))
    piece_size = F.transform(pieces, lambda i: F.least("capacity", F.col("tokens") - i * F.col("capacity")))
    cut = written(met.select("capacity_id", "capacity", "doc_id", F.posexplode(piece_size).alias("piece", "size")), "pack-items")
    empty = cut.where("size = 0").select("capacity_id", "doc_id", "piece", "size", F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"))

    left, gaps, swept = cut.where("size > 0"), None, []
    many = left.count()
    free = many <= items_a_task  # one sweep for each capacity
    while many:
        done = _round(left, gaps, len(swept) + 1, free, items_a_task)
        swept.append(done)
        left = done.where(F.col("kind") == LEFT).select("capacity_id", "capacity", "doc_id", "piece", "size")
        sizes_left = left.groupBy("capacity_id").agg(F.min("size").alias("least"), F.count(F.lit(1)).alias("many")).collect()  # one row for each capacity
        now = sum(r.many for r in sizes_left)
        free, many = now > 0.5 * many or now <= items_a_task // 8, now
        if many:
            least = spark.createDataFrame([(r.capacity_id, r.least) for r in sizes_left], "capacity_id int, least long")
            # a gap smaller than all that is left can't change any more
            gaps = done.where(F.col("kind") == GAP).select("capacity_id", "capacity", "size", "bin").join(F.broadcast(least), "capacity_id").where("size >= least").drop("least")
    if not swept:
        return empty
    every = swept[0]
    for more in swept[1:]:
        every = every.unionByName(more)
    every = every.where(F.col("kind") == PLACED).select("capacity_id", "doc_id", "piece", "size", "bin", "offset")
    # containers are numbered by round, task and number within the task; a row for each sweep
    local = (1 << _LOCAL_BITS) - 1
    opened = every.groupBy("capacity_id", F.shiftright("bin", _LOCAL_BITS).alias("sweep")).agg((F.max(F.col("bin").bitwiseAND(F.lit(local))) + 1).alias("many"))
    before = Window.partitionBy("capacity_id").orderBy("sweep").rowsBetween(Window.unboundedPreceding, -1)
    first = written(opened.select("capacity_id", "sweep", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("first")), "pack-sweeps")
    numbered = every.withColumn("sweep", F.shiftright("bin", _LOCAL_BITS)).join(F.broadcast(first) if first.count() <= 50_000 else first, ["capacity_id", "sweep"])
    numbered = numbered.select("capacity_id", "doc_id", "piece", "size", (F.col("first") + F.col("bin").bitwiseAND(F.lit(local))).alias("bin"), "offset")
    return numbered.unionByName(empty)


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """Containers, tokens and filled share for each capacity."""
    used = packed.groupBy("capacity_id").agg((F.max("bin") + 1).alias("containers"), F.sum("size").alias("tokens"), F.count(F.lit(1)).alias("pieces"))
    return used.join(capacities.select("capacity_id", "capacity").distinct(), "capacity_id").select(
        "capacity_id", "capacity", "containers", "pieces", "tokens", (F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("filled")
    )
