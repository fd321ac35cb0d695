"""Problem 2: near-duplicate fingerprints by ball hashing that meets in the middle.

Two 64-bit fingerprints within distance 5 agree in one of their halves up to
distance 2 (were both at 3 or more, the sum would be 6).  Each half emits all
its variants within half that radius, 1: itself and its 32 neighbours.  Halves
within distance 2 always share a variant, so equal (label, half, variant) keys
hold every pair; what meets is verified on the whole fingerprint.  Emitting the
ball of the whole fingerprint (radius 3: 43,745 variants) finds the same pairs.

A half value that very many fingerprints of a label share would make its keys
hot.  There, the other half is split again: within distance 5 one of its
quarters is within distance 2, and so shares a variant of radius 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import partitions_for, written

RADIUS = 5
HOT_HALF = 4096  # fingerprints of one label with one half value, beyond which the second split applies
_PAIRS = "a long, b long"
_BLOCK = 1 << 21


def runs_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of at least two equal values in a sorted array."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    lengths = np.diff(np.r_[starts, len(keys)])
    return starts[lengths > 1], lengths[lengths > 1]


def gather(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """The partition's columns; the caller has set the number of partitions by the number of rows."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return []
    table = pa.Table.from_batches(got)
    return [c.to_numpy() for c in table.columns]


def blocked_pairs(starts: np.ndarray, lengths: np.ndarray, block: int = _BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs inside each run, at most about ``block`` of them at a time."""
    row = np.concatenate([np.arange(s, s + n - 1) for s, n in zip(starts, lengths, strict=True)]) if len(starts) else np.zeros(0, np.int64)
    left = np.concatenate([np.arange(n - 1, 0, -1) for n in lengths]) if len(starts) else np.zeros(0, np.int64)
    cut = np.searchsorted(np.cumsum(left), np.arange(block, left.sum() + block, block)) + 1
    at = 0
    for end in cut:
        r, m = row[at:end], left[at:end]
        at = end
        if len(r):
            first = np.repeat(r, m)
            step = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + 1
            yield first, first + step


def _colliding(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = gather(batches)
        if not columns:
            return
        keys, prints = columns
        by = np.argsort(keys, kind="stable")
        keys, prints = keys[by], prints[by].view(np.uint64)
        for i, j in blocked_pairs(*runs_of(keys)):
            x, y = prints[i], prints[j]
            near = np.bitwise_count(x ^ y) <= radius
            x, y = x[near].view(np.int64), y[near].view(np.int64)
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def _variants(value: Column, bits: int) -> Column:
    """The value and its neighbours at distance 1, as an array."""
    flips = F.array(*(F.lit(m).cast("long") for m in [0, *(1 << i for i in range(bits))]))
    return F.transform(flips, lambda m: value.bitwiseXOR(m))


def near_prints(prints: DataFrame, hot_half: int = HOT_HALF) -> DataFrame:
    """Distinct pairs ``a < b`` of fingerprints within distance 5 that share a group.

    ``prints(grp long, fp long)`` must be distinct and without nulls.
    """
    spark = prints.sparkSession
    low = (1 << 32) - 1
    half = F.array(F.struct(F.lit(0).alias("no"), F.shiftrightunsigned("fp", 32).alias("own"), F.col("fp").bitwiseAND(F.lit(low)).alias("other")),
                   F.struct(F.lit(1).alias("no"), F.col("fp").bitwiseAND(F.lit(low)).alias("own"), F.shiftrightunsigned("fp", 32).alias("other")))
    halves = prints.select("grp", "fp", F.explode(half).alias("h")).select("grp", "fp", "h.no", "h.own", "h.other")
    key = F.xxhash64("grp", "no", "variant")
    plain = halves.select("grp", "fp", "no", "other", F.explode(_variants(F.col("own"), 32)).alias("variant")).select(key.alias("key"), "fp", "no", "other")
    sizes = written(halves.groupBy("grp", "no", "own").count().where(F.col("count") > hot_half), "balls-hot")
    # each row of a hot half, and of the halves next to it, may emit 34 more keys
    rows = prints.count() * 66 + 34 * 33 * (sizes.agg(F.sum("count")).first()[0] or 0)
    if sizes.isEmpty():
        emitted = plain.select("key", "fp")
    else:
        hot = sizes.select("grp", "no", F.explode(_variants(F.col("own"), 32)).alias("variant")).select(key.alias("key")).distinct().withColumn("hot", F.lit(True))
        marked = plain.join(hot, "key", "left")
        quarter = F.array(F.struct(F.lit(0).alias("side"), F.shiftrightunsigned("other", 16).alias("bits")), F.struct(F.lit(1).alias("side"), F.col("other").bitwiseAND(F.lit(65535)).alias("bits")))
        deep = marked.where("hot").select("key", "fp", F.explode(quarter).alias("q")).select("key", "fp", "q.side", F.explode(_variants(F.col("q.bits"), 16)).alias("near"))
        emitted = marked.where("hot is null").select("key", "fp").unionByName(deep.select(F.xxhash64("key", "side", "near").alias("key"), "fp"))
    spread = emitted.repartition(partitions_for(spark, rows, 3 << 20), "key")
    return written(spread.mapInArrow(_colliding(RADIUS), _PAIRS).distinct(), "balls-pairs")


def near_duplicates(df: DataFrame, record: str, group: str, exact: str, print_: str, hot_half: int = HOT_HALF) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of records of one group with an equal ``exact`` value or prints within distance 5.

    All pairs, also those of copies: the expansion of :func:`alike_links`, for who asks for it.

    ``print_`` is a long (see :func:`keys.fingerprint`).  A null ``exact`` or
    ``print_`` equals nothing; records without a group or an identifier are left
    out; a record delivered twice counts once; further columns are ignored.
    """
    items = df.select(F.col(record).alias("id"), F.col(group).alias("grp"), F.col(exact).alias("exact"), F.col(print_).alias("fp"))
    items = written(items.where("id is not null and grp is not null").dropDuplicates(["id"]), "near-items")
    printed = items.where("fp is not null").select("id", "grp", "fp")
    near = near_prints(printed.select(F.xxhash64("grp").alias("grp"), "fp").distinct(), hot_half)
    equal = lambda column: (
        items.where(f"{column} is not null").select("grp", column, F.col("id").alias("a"))
        .join(items.where(f"{column} is not null").select("grp", column, F.col("id").alias("b")), ["grp", column]).where("a < b").select("a", "b")
    )
    x = printed.select(F.col("id").alias("x"), F.col("grp"), F.col("fp").alias("a"))
    y = printed.select(F.col("id").alias("y"), F.col("grp"), F.col("fp").alias("b"))
    met = near.join(x, "a").join(y, ["grp", "b"]).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return equal("exact").unionByName(equal("fp")).unionByName(met).distinct()


def alike_links(items: DataFrame, hot_half: int = HOT_HALF) -> DataFrame:
    """The compact form: ``(u, v)``, ``u > v``, over ``items(id, grp, exact, fp)``, a written table.

    Every copy is linked to the first of its class of equal ``exact`` or equal
    print, and classes of alike prints by their firsts: chains of these links
    are the chains of alike pairs, but n copies give n - 1 links.
    """
    near = near_prints(items.where("fp is not null").select(F.xxhash64("grp").alias("grp"), "fp").distinct(), hot_half)

    def firsts(column: str) -> DataFrame:
        return items.where(f"{column} is not null").groupBy("grp", column).agg(F.min("id").alias("first"))

    def star(column: str) -> DataFrame:
        return items.where(f"{column} is not null").join(firsts(column), ["grp", column]).select(F.col("id").alias("u"), F.col("first").alias("v")).where("u > v")

    x = firsts("fp").select("grp", F.col("fp").alias("a"), F.col("first").alias("x"))
    y = firsts("fp").select("grp", F.col("fp").alias("b"), F.col("first").alias("y"))
    met = near.join(x, "a").join(y, ["grp", "b"]).select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
    return star("exact").unionByName(star("fp")).unionByName(met)


def alike_groups(df: DataFrame, record: str, group: str, exact: str, print_: str) -> DataFrame:
    """``(id, group)`` for every record with an identifier and a group: the least id it is linked to by chains of alike pairs."""
    items = df.select(F.col(record).alias("id"), F.col(group).alias("grp"), F.col(exact).alias("exact"), F.col(print_).alias("fp"))
    items = written(items.where("id is not null and grp is not null").dropDuplicates(["id"]), "group-items")
    found = components(alike_links(items))
    return items.select("id").join(found, "id", "left").select("id", F.coalesce("group", "id").alias("group"))
