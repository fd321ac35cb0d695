"""Problem 1: has this key been seen before?  Filter, then verify.

1. Records travel as ``(hash, order)`` only.  A bounded map-side table first
   marks repeats of a key inside one input split, so that a key holding a
   third of all rows never gathers in one task.
2. The others meet, in order, a Bloom filter for their slice of the hash
   space.  Negatives leave at once: they are new.
3. Positives are verified against full keys.  The full keys of records that
   cannot matter are dropped before their shuffle by a bitmap of bounded size
   over the positives' hashes.
4. A positive without an earlier equal key is a disproved one; they are logged,
   and their number is the filter's measured error.  What is reported after verification is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import dropped, new_path, partitions_for, written

LOCAL_SLOTS = 1 << 16
STEP = 256  # records a filter tests before it takes them in
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 30  # of the bitmap, eight a positive between them: 128 KB to 128 MB; a full one only prunes less
BITMAP_CHUNK = 32768  # bits of one bitmap_construct_agg value
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class SeenConfig:
    keys_per_filter: int = 1 << 20
    false_positive_rate: float = 0.01


@dataclass(frozen=True)
class SeenResult:
    """``positives(hash, order)`` of the filter and the ``found`` ones with an earlier equal key."""

    positives: DataFrame
    found: DataFrame
    records: DataFrame

    def disproved(self) -> DataFrame:
        """``(order, hash)`` of the positives that verification disproved: the log of the filter's errors."""
        return self.positives.join(self.found, "order", "left_anti").select("order", "hash").distinct()

    def report(self) -> DataFrame:
        """One row: records, filter positives, disproved ones, filter's error rate, rate after verification.

        The verdict after verification compares whole keys, so its rate of wrong answers is 0.
        """
        n = self.records.agg(F.count_distinct("order").alias("records"))
        p = self.positives.agg(F.count_distinct("order").alias("filter_positives"))
        f = self.found.agg(F.count_distinct("order").alias("seen_before"))
        wrong = F.col("filter_positives") - F.col("seen_before")
        fresh = F.col("records") - F.col("seen_before")
        return (
            n.join(p, F.lit(True)).join(f, F.lit(True))
            .select("records", "filter_positives", "seen_before", wrong.alias("disproved"),
                    F.when(fresh > 0, wrong / fresh).otherwise(0.0).alias("filter_error_rate"), F.lit(0.0).alias("final_error_rate"))
        )


def _mark_local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``sure``: an earlier record of the same hash was met in this split."""
    keys = np.zeros(LOCAL_SLOTS, np.int64)
    first = np.full(LOCAL_SLOTS, np.iinfo(np.int64).max)
    for batch in batches:
        if not batch.num_rows:
            continue
        h, at = (batch.column(i).to_numpy() for i in (0, 1))
        slot = (h & (LOCAL_SLOTS - 1)).astype(np.int64)
        sure = (keys[slot] == h) & (first[slot] < at)
        by = np.lexsort((at, h))
        hs, ats = h[by], at[by]
        start = np.r_[True, hs[1:] != hs[:-1]]
        least = ats[np.flatnonzero(start)][np.cumsum(start) - 1]
        sure[by] |= ats > least
        hs, ats = hs[start], ats[start]
        slot = (hs & (LOCAL_SLOTS - 1)).astype(np.int64)
        same = keys[slot] == hs
        ats = np.where(same, np.minimum(first[slot], ats), ats)
        keys[slot], first[slot] = hs, ats
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sure)], ["hash", "order", "sure"])


class _Bloom:
    def __init__(self, keys: int, rate: float):
        bits = max(64, int(-keys * math.log(rate) / math.log(2) ** 2))
        self.size = np.uint64(bits)
        self.probes = max(1, round(bits / keys * math.log(2)))
        self.words = np.zeros(bits // 64 + 1, np.uint64)

    def places(self, h: np.ndarray) -> np.ndarray:
        h = h.view(np.uint64)
        with np.errstate(over="ignore"):
            a = h * np.uint64(_MIX[0])
            a ^= a >> np.uint64(29)
            b = (h ^ (h >> np.uint64(32))) * np.uint64(_MIX[1]) | np.uint64(1)
            return (a[:, None] + b[:, None] * np.arange(self.probes, dtype=np.uint64)) % self.size

    def test_and_set(self, h: np.ndarray) -> np.ndarray:
        at = self.places(h)
        word, bit = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
        hit = ((self.words[word] & bit) != 0).all(axis=1)
        np.bitwise_or.at(self.words, word.ravel(), bit.ravel())
        return hit


def _filter_pass(config: SeenConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_now, bloom, last = None, None, (None, None)
        for batch in batches:
            if not batch.num_rows:
                continue
            part, h, at, sure = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            fresh = np.r_[(h[0], at[0]) != last, (h[1:] != h[:-1]) | (at[1:] != at[:-1])]  # not a redelivery
            last = (h[-1], at[-1])
            part, h, at, sure = part[fresh], h[fresh], at[fresh], sure[fresh]
            positive = sure.copy()
            for k in np.unique(part):
                if k != slice_now:
                    slice_now, bloom = k, _Bloom(config.keys_per_filter, config.false_positive_rate)
                every = np.flatnonzero((part == k) & ~sure)
                for own in np.split(every, range(STEP, len(every), STEP)) if len(every) else ():
                    _, once = np.unique(h[own], return_index=True)
                    repeat = np.ones(len(own), bool)
                    repeat[once] = False
                    positive[own] = bloom.test_and_set(h[own]) | repeat
            yield pa.RecordBatch.from_arrays([pa.array(h[positive]), pa.array(at[positive])], ["hash", "order"])

    return run


def _positive_bitmap(positives: DataFrame, size: int) -> bytes:
    """Bitmap over hash slots of the positives; at most ``size`` / 8 bytes reach the driver."""
    slot = F.pmod("hash", F.lit(size))
    chunks = (
        positives.select((slot / BITMAP_CHUNK).cast("int").alias("chunk"), (slot % BITMAP_CHUNK).alias("bit"))
        .groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    )
    bits = bytearray(size // 8)
    for row in chunks:
        bits[row.chunk * BITMAP_CHUNK // 8 : (row.chunk + 1) * BITMAP_CHUNK // 8] = row.bits
    return bytes(bits)


def seen_before(df: DataFrame, keys: list[str], order: str, config: SeenConfig = SeenConfig()) -> SeenResult:
    """Records of ``df`` whose whole key also occurs at a smaller ``order``.

    Keys are compared character by character.  Records with a null in a key
    column or in ``order`` are never cases; a redelivered record (equal key and
    order) counts once; an empty key text is an ordinary key; an empty table
    gives empty results.  Columns of ``df`` beyond ``keys`` and ``order`` are
    ignored, whatever their names.
    """
    spark = df.sparkSession
    whole = df.select(*(F.col(k).alias(f"key{i}") for i, k in enumerate(keys)), F.col(order).cast("long").alias("order")).dropna()
    whole = whole.withColumn("hash", F.xxhash64(*(f"key{i}" for i in range(len(keys)))))
    narrow = whole.select("hash", "order")
    n = df.count()  # reads no column; an upper bound is enough
    slices = max(1, math.ceil(n / config.keys_per_filter))
    marked = narrow.mapInArrow(_mark_local, "hash long, order long, sure boolean")
    own = F.pmod(F.shiftrightunsigned("hash", 20), F.lit(slices))
    spread = F.pmod(F.xxhash64("order"), F.lit(slices * 8))
    routed = marked.select(F.when(F.col("sure"), spread).otherwise(own).cast("int").alias("slice"), "hash", "order", "sure")
    ordered = routed.repartition(partitions_for(spark, n, 2 << 20), "slice").sortWithinPartitions("slice", "order", "hash")
    positives = written(ordered.mapInArrow(_filter_pass(config), "hash long, order long"), "seen-positives")

    size = min(MOST_BITS, max(LEAST_BITS, 1 << (8 * positives.count()).bit_length()))
    bits = spark.sparkContext.broadcast(np.frombuffer(_positive_bitmap(positives, size), np.uint8))

    @F.pandas_udf("boolean")
    def may_matter(h):
        import pandas as pd

        slot = np.mod(h.to_numpy(), size)
        return pd.Series((bits.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1)

    full = [f"key{i}" for i in range(len(keys))]
    firsts = whole.where(may_matter("hash")).groupBy("hash", *full).agg(F.min("order").alias("first"))
    by_hash = written(firsts.groupBy("hash").agg(F.count(F.lit(1)).alias("keys"), F.min("first").alias("first")), "seen-firsts")
    found = positives.join(by_hash.where("keys = 1"), "hash").where("order > first").select("order")
    shared = by_hash.where("keys > 1").select("hash")
    if not shared.isEmpty():  # different keys with one 64-bit hash: those records' whole keys are compared
        same = whole.join(shared, "hash")
        least = same.groupBy("hash", *full).agg(F.min("order").alias("first"))
        found = found.unionByName(same.join(least, ["hash", *full]).where("order > first").select("order"))
    return SeenResult(positives, found.distinct(), narrow)


def _probe_filters(config: SeenConfig):
    """Hashes of one slice against the filters of all parts: those that none rules out."""

    def run(hashes: pa.Table, filters: pa.Table) -> pa.Table:
        h = hashes["hash"].to_numpy()
        hit = np.zeros(len(h), bool)
        for size, bits in zip(filters["keys"].to_pylist(), filters["bits"].to_pylist(), strict=True):
            own = _Bloom(size, config.false_positive_rate)
            own.words = np.frombuffer(bits, np.uint64)
            at = own.places(h)
            hit |= ((own.words[at >> np.uint64(6)] & np.uint64(1) << (at & np.uint64(63))) != 0).all(axis=1) if len(h) else hit
        return pa.table({"hash": pa.array(h[hit])})

    return run


def _build_filter(config: SeenConfig):
    def run(hashes: pa.Table) -> pa.Table:
        h = np.unique(hashes["hash"].to_numpy())
        own = _Bloom(len(h), config.false_positive_rate)
        for at in range(0, len(h), 1 << 16):
            own.test_and_set(h[at : at + (1 << 16)])
        return pa.table({"slice": pa.array([hashes["slice"][0].as_py()], pa.int32()), "keys": pa.array([len(h)], pa.int64()), "bits": pa.array([own.words.tobytes()], pa.binary())})

    return run


class KeyStore:
    """Keys of all earlier batches on disk: whole keys in folders by their hash, and a Bloom filter of each part and slice.

    A batch's distinct keys meet the filters of their slice; what they rule out
    is new.  The others are looked up among the whole keys of their folders.
    Only distinct new keys are appended, so no key is stored twice.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, slices: int = 16, config: SeenConfig = SeenConfig()):
        self.spark, self.config, self.slices = spark, config, slices
        self.path = path or new_path(spark, "keys")
        self.parts = 0
        self.schema = ""

    def _stored(self, table: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{table}/part={i}" for i in range(self.parts)]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}").parquet(*paths)

    def ingest(self, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
        """``(order, seen, disproved)`` for every record of ``batch`` with a key and an order; its new keys are appended.

        ``seen``: the key is stored already, or an earlier record of the batch
        has it.  ``disproved``: a filter took the key for a stored one, and the
        lookup did not find it; their share is the filters' measured error.
        """
        names = [f"key{i}" for i in range(len(keys))]
        rows = batch.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.col(order).cast("long").alias("order")).dropna()
        rows = written(rows.withColumn("hash", F.xxhash64(*names)), "store-batch")
        slice_ = F.pmod(F.shiftrightunsigned("hash", 20), F.lit(self.slices)).cast("int")
        firsts = written(rows.groupBy("hash", *names).agg(F.min("order").alias("first")).withColumn("slice", slice_), "store-firsts")
        if self.parts:
            filters = self._stored("filters", "slice int, keys long, bits binary")
            ask = firsts.select("slice", "hash").distinct().groupBy("slice").cogroup(filters.groupBy("slice"))
            positive = ask.applyInArrow(_probe_filters(self.config), "hash long").withColumn("positive", F.lit(True))
            known = self._stored("keys", f"{self.schema}, slice int").join(positive, ["hash"], "left_semi").select("hash", *names).withColumn("known", F.lit(True))
            marked = firsts.join(positive, "hash", "left").join(known, ["hash", *names], "left")
        else:
            marked = firsts.withColumns({"positive": F.lit(None).cast("boolean"), "known": F.lit(None).cast("boolean")})
        marked = written(marked.withColumns({"positive": F.coalesce("positive", F.lit(False)), "known": F.coalesce("known", F.lit(False))}), "store-marked")
        fresh = marked.where("not known").select("slice", "hash", *names)
        self.schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fresh.schema.fields if f.name != "slice")
        fresh.repartition("slice", F.pmod(F.xxhash64(*names), F.lit(4))).write.option("compression", "zstd").partitionBy("slice").parquet(f"{self.path}/keys/part={self.parts}")
        fresh.select("slice", "hash").groupBy("slice").applyInArrow(_build_filter(self.config), "slice int, keys long, bits binary").write.parquet(f"{self.path}/filters/part={self.parts}")
        self.parts += 1
        out = rows.join(marked.select("hash", *names, "first", "positive", "known"), ["hash", *names])
        dropped(firsts)
        return out.select("order", (F.col("known") | (F.col("order") > F.col("first"))).alias("seen"), (F.col("positive") & ~F.col("known")).alias("disproved")).distinct()
