"""Problem 5: records of evaluation splits that also lie in training.

A fingerprint is the set of its eight (position, byte) shingles.  Within
distance 5 at most five bytes differ, so two prints share at least three
shingles.  With the shingles of each print in one global order, rarest first,
the prefix filter for an overlap of three with two prefix matches holds: the
first two shared shingles lie among the first seven of either print.  Pairs of
prefix shingles are the index keys; where both shingles of a key are very
frequent, the third shared one joins the key, and where all three are, the
training prints of the key are divided.  Evaluation prefixes are indexed
first; training keys that no evaluation print has don't travel.  What meets
passes the length filter (numbers of set bits differ by at most 5) and is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .balls import gather
from .scratch import partitions_for, written

RADIUS, SHINGLES, SHARED = 5, 8, 3
HOT_KEY = 16384  # prints expected under a key, beyond which another shingle joins it, or its training prints are divided
MOST_PARTS = 1 << 14
PREFIX = SHINGLES - SHARED + 2
_KEYS = "key int, salt short, fp long, side byte"
_BLOCK = 1 << 21
_CHUNK = 32768  # bits of one value of bitmap_or_agg
_PAIR_SLOTS, _TRIPLE_SLOTS = 28 << 16, 1 << 25  # of the evaluation keys' bitmap: one for each pair key, hashed for the others


def _numbered(size: int) -> np.ndarray:
    """A number for each set of ``size`` of the eight positions, at its ascending members."""
    table = np.zeros((8,) * size, np.int64)
    for n, places in enumerate(combinations(range(8), size)):
        table[places] = n
    return table


_PAIR, _TRIPLE = _numbered(2), _numbered(3)


def _key(tokens: np.ndarray) -> np.ndarray:
    """Rows of two or three shingles as one number each, the same for the same set of shingles only."""
    tokens = np.sort(tokens, axis=1)  # by position
    place, value = tokens >> 8, tokens & 255
    if tokens.shape[1] == 2:
        return _PAIR[place[:, 0], place[:, 1]] << 16 | value[:, 0] << 8 | value[:, 1]
    return 1 << 30 | _TRIPLE[place[:, 0], place[:, 1], place[:, 2]] << 24 | value[:, 0] << 16 | value[:, 1] << 8 | value[:, 2]


def _slot(key: np.ndarray) -> np.ndarray:
    mixed = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(39)  # 25 bits
    return np.where(key >> 30 == 1, mixed.astype(np.int64) + _PAIR_SLOTS, key)


@dataclass(frozen=True)
class _Shingles:
    """Of the 2,048 shingles: their rarity order, which are very frequent, and the share of prints that have them."""

    rank: np.ndarray
    hot: np.ndarray
    share: np.ndarray
    prints: int
    hot_key: int


def _keys_of(fp: np.ndarray, s: _Shingles) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix keys, the row each belongs to, and into how many parts the training prints of a key are divided."""
    rank, hot = s.rank, s.hot
    token = fp.view(np.uint8).reshape(-1, 8).astype(np.int64) + np.arange(8) * 256
    token = np.take_along_axis(token, np.argsort(rank[token], axis=1), axis=1)
    keys, rows, parts = [], [], []
    for i, j in combinations(range(PREFIX), 2):
        deep = hot[token[:, i]] & hot[token[:, j]]
        at = np.flatnonzero(~deep)
        keys.append(_key(token[at][:, [i, j]]))
        rows.append(at)
        parts.append(np.ones(len(at), np.int64))
        at = np.flatnonzero(deep)
        for k in range(j + 1, SHINGLES) if len(at) else ():
            three = token[at][:, [i, j, k]]
            keys.append(_key(three))
            rows.append(at)
            parts.append(np.clip(np.ceil(s.share[three].prod(axis=1) * s.prints / s.hot_key), 1, MOST_PARTS).astype(np.int64))
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(parts)


def _bitmaps(s: _Shingles):
    """Of evaluation prints, the chunks of their keys' bitmap that aren't empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.zeros(_PAIR_SLOTS + _TRIPLE_SLOTS, bool)
        for batch in batches:
            if batch.num_rows:
                there[_slot(_keys_of(batch.column(0).to_numpy(), s)[0])] = True
        chunks = there.reshape(-1, _CHUNK)
        some = np.flatnonzero(chunks.any(axis=1))
        bits = [np.packbits(chunks[c], bitorder="little").tobytes() for c in some]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(bits, pa.binary())], ["chunk", "bits"])

    return run


def _index_keys(s: _Shingles, evaluated: Broadcast):
    """Keys of evaluation prints, and those keys of training prints that an evaluation print may have.

    Where three frequent shingles make a key that very many prints are expected
    to have, its training prints are divided, and an evaluation print meets each part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = evaluated.value
        for batch in batches:
            fp, side = (batch.column(i).to_numpy() for i in (0, 1))
            if not len(fp):
                continue
            keys, at, parts = _keys_of(fp, s)
            slot = _slot(keys)
            some = (side[at] == 1) | (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 1)
            keys, at, parts = keys[some].astype(np.int32), at[some], parts[some]
            many = np.where(side[at] == 1, parts, 1)
            first = np.cumsum(many) - many
            keys, at, parts = np.repeat(keys, many), np.repeat(at, many), np.repeat(parts, many)
            own = (fp[at].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % parts
            salt = np.where(side[at] == 1, np.arange(len(at)) - np.repeat(first, many), own).astype(np.int16)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(salt), pa.array(fp[at]), pa.array(side[at])], ["key", "salt", "fp", "side"])

    return run


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = gather(batches)
    if not columns:
        return
    keys, salt, prints, side = columns
    keys = keys.astype(np.int64) << 16 | salt
    by = np.lexsort((side, keys))
    keys, prints, side = keys[by], prints[by].view(np.uint64), side[by]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    lengths = np.diff(np.r_[starts, len(keys)])
    trained = np.add.reduceat((side == 0).astype(np.int64), starts)  # the training side comes first in each run
    both = (trained > 0) & (trained < lengths)
    starts, lengths, trained = starts[both], lengths[both], trained[both]
    evals = lengths - trained
    row = np.repeat(starts + trained, evals) + np.arange(evals.sum()) - np.repeat(np.cumsum(evals) - evals, evals)
    begin, many = np.repeat(starts, evals), np.repeat(trained, evals)
    total = np.cumsum(many)
    at = 0
    while at < len(row):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _BLOCK)))
        r, b, m = row[at:end], begin[at:end], many[at:end]
        at = end
        y = np.repeat(r, m)
        x = np.repeat(b, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        p, q = prints[x], prints[y]
        ones = np.bitwise_count(p).astype(np.int8) - np.bitwise_count(q).astype(np.int8)
        length = np.abs(ones) <= RADIUS
        p, q = p[length], q[length]
        near = np.bitwise_count(p ^ q) <= RADIUS
        pairs = np.unique(np.stack([p[near], q[near]], 1).view(np.int64), axis=0)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["trained", "tested"])


def near_across(prints: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """``prints(fp long, side byte)``, distinct, side 0 training and 1 evaluation: pairs ``(trained, tested)`` within distance 5."""
    spark = prints.sparkSession
    byte = lambda i: F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255)) + 256 * i
    counts = prints.select(F.explode(F.array(*(byte(i) for i in range(8)))).alias("token")).groupBy("token").count().collect()  # at most 2,048 rows
    frequency = np.zeros(2048, np.int64)
    for row in counts:
        frequency[row.token] = row["count"]
    n = int(frequency[:256].sum())
    rank = np.empty(2048, np.int64)
    rank[np.lexsort((np.arange(2048), frequency))] = np.arange(2048)
    # a key of two shingles this frequent would be expected to hold more prints than that
    shingles = _Shingles(rank, frequency.astype(float) ** 2 / max(1, n) > hot_key, frequency / max(1, n), n, hot_key)
    # a bitmap of fixed size, 4.4 MB, however many keys there are
    chunks = prints.where("side = 1").select("fp").mapInArrow(_bitmaps(shingles), "chunk int, bits binary").groupBy("chunk").agg(F.bitmap_or_agg("bits").alias("bits")).collect()
    bits = np.zeros((_PAIR_SLOTS + _TRIPLE_SLOTS) // 8, np.uint8)
    for row in chunks:
        bits[row.chunk * _CHUNK // 8 : (row.chunk + 1) * _CHUNK // 8] = np.frombuffer(row.bits, np.uint8)
    keys = prints.mapInArrow(_index_keys(shingles, spark.sparkContext.broadcast(bits)), _KEYS)
    spread = keys.repartition(partitions_for(spark, n * 21, 3 << 20), "key", "salt")
    return written(spread.mapInArrow(_probe, "trained long, tested long").distinct(), "overlap-near")


def overlaps(df: DataFrame) -> DataFrame:
    """Pairs ``(trained, tested)`` of items of which one lies in train, one in val or test, and that are alike.

    ``df(id, side, who, name, exact, fp)``: side is ``train``, ``val``, ``test``
    or null (in none).  Alike: equal ``exact``; prints within distance 5; equal
    ``who`` and ``name``.  A null equals nothing; an item delivered twice counts
    once; no items, no pairs.
    """
    items = df.select("id", "side", "who", "name", "exact", "fp").where("id is not null and side is not null")
    # an item delivered twice gives equal pairs, which are made distinct at the end
    items = written(items.withColumn("eval", (F.col("side") != "train").cast("byte")), "overlap-items")
    train, test = items.where("eval = 0"), items.where("eval = 1")

    def equal(*columns: str) -> DataFrame:
        present = " and ".join(f"{c} is not null" for c in columns)
        left = train.where(present).select(*columns, F.col("id").alias("trained"))
        return left.join(test.where(present).select(*columns, F.col("id").alias("tested")), list(columns)).select("trained", "tested")

    near = near_across(items.where("fp is not null").select("fp", F.col("eval").alias("side")).distinct())
    x = train.where("fp is not null").select(F.col("fp").alias("trained"), F.col("id").alias("x"))
    y = test.where("fp is not null").select(F.col("fp").alias("tested"), F.col("id").alias("y"))
    met = near.join(x, "trained").join(y, "tested").select(F.col("x").alias("trained"), F.col("y").alias("tested"))
    return equal("exact").unionByName(equal("who", "name")).unionByName(met).distinct()


def overlap_report(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Numbers of overlapping pairs and of distinct evaluation items for each (split, source) of the evaluation side."""
    own = items.select(F.col("id").alias("tested"), F.col("side").alias("split"), "source").dropDuplicates(["tested"])
    return pairs.join(own, "tested").groupBy("split", "source").agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct("tested").alias("items"))
