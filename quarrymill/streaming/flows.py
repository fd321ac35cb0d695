"""The acquisition flow as Structured Streaming: keyed duplicate state and caps.

Micro-batches replace the bounded queue, offsets its re-queueing, the checkpoint
its recovery.  Within a micro-batch a key's rows are folded in order of arrival,
so that the stream's result equals the batch operators'.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..settings import DEFAULTS, Settings


def stream_table(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """A folder (or a glob) of Parquet files as a stream, rate-limited by files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def distinct_keys(stream: DataFrame, *keys: str, time: str | None = None, delay: str | None = None) -> DataFrame:
    """First record of each key (URL and md5 level).

    With ``time`` and ``delay``, a key is forgotten once the watermark has
    passed it by the delay; without, all keys are kept as state.
    """
    if time and delay:
        return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
    return stream.dropDuplicates(list(keys))


def _capped(cap: int, order: str, key: str):
    def fold(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        used = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values(order, kind="stable")
        taken = rows.head(max(0, cap - used))
        state.update((used + len(taken),))
        if len(taken):
            yield taken

    return fold


def capped_stream(stream: DataFrame, key: str, order: str, cap: int = DEFAULTS.accepted_cap) -> DataFrame:
    """The first ``cap`` rows of each key; later ones are dropped without a trace."""
    return stream.groupBy(key).applyInPandasWithState(_capped(cap, order, key), stream.schema, "used int", "append", GroupStateTimeout.NoTimeout)


_BLOCK = 1024  # records compared with what is kept in one product


class _Kept:
    """A label's kept values of one kind in an array that grows by doubling."""

    def __init__(self, values: np.ndarray):
        self.n, self.values = len(values), values.copy()

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.values):
            self.values = np.concatenate([self.values[: self.n], np.zeros((max(16, self.n, len(more)), *self.values.shape[1:]), self.values.dtype)])
        self.values[self.n : self.n + len(more)] = more
        self.n += len(more)

    def all(self) -> np.ndarray:
        return self.values[: self.n]


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _prints(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Places of the well-formed fingerprints, and these as numbers."""
    fine = [isinstance(x, str) and len(x) == 64 and not set(x) - {"0", "1"} for x in column]
    return np.flatnonzero(fine), np.array([int(x, 2) for x, ok in zip(column, fine, strict=True) if ok], np.uint64)


def _by_width(column: pd.Series, kind: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each number of dimensions the places of its vectors, and these; without null, infinite and zero ones."""
    found: dict[int, list] = {}
    for at, vector in enumerate(column):
        if vector is not None and np.isfinite(v := np.asarray(vector, kind)).all() and v.any():
            found.setdefault(len(v), []).append((at, v))
    return {width: (np.array([at for at, _ in own]), np.stack([v for _, v in own])) for width, own in found.items()}


def _any_near(x: np.ndarray, kept: np.ndarray, near) -> np.ndarray:
    out = np.zeros(len(x), bool)
    for at in range(0, len(kept), 8 * _BLOCK):
        out |= near(x, kept[at : at + 8 * _BLOCK]).any(axis=1)
    return out


def _deduplicated(order: str, s: Settings, kind: str):
    alike = lambda x, y: np.bitwise_count(x[:, None] ^ y[None, :]) <= s.duplicate_distance
    similar = lambda x, y: x @ y.T >= s.duplicate_cosine

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        md5s, prints, widths, stored = state.get if state.exists else ([], b"", [], [])
        rows = pd.concat(list(batches)).drop_duplicates(order).sort_values(order, kind="stable")
        seen, new_md5s, kept_prints = set(md5s), list(md5s), _Kept(np.frombuffer(bytes(prints), np.uint64))
        vectors = {w: np.frombuffer(bytes(v), kind).reshape(-1, w) for w, v in zip(widths, stored, strict=True)}  # as they came
        kept_units, new_vectors = {w: _Kept(_unit(v)) for w, v in vectors.items()}, {w: [v] for w, v in vectors.items()}
        reasons: list[str] = []
        for start in range(0, len(rows), _BLOCK):
            block = rows.iloc[start : start + _BLOCK]
            n, by_width = len(block), _by_width(block["embedding"], kind)
            at, own = _prints(block["phash"])
            print_lost, print_near = np.zeros(n, bool), np.zeros((n, n), bool)
            print_lost[at] = _any_near(own, kept_prints.all(), alike)
            print_near[np.ix_(at, at)] = alike(own, own)
            vector_lost, vector_near, units = np.zeros(n, bool), np.zeros((n, n), bool), {w: _unit(v) for w, (_, v) in by_width.items()}
            for w, (places, _) in by_width.items():
                if w in kept_units:
                    vector_lost[places] = _any_near(units[w], kept_units[w].all(), similar)
                vector_near[np.ix_(places, places)] = similar(units[w], units[w])
            kept = np.zeros(n, bool)
            for i, md5 in enumerate(block["md5"]):
                if md5 is not None and md5 in seen:
                    reasons.append("dup:md5")
                elif print_lost[i] or (print_near[i] & kept).any():
                    reasons.append("dup:phash")
                elif vector_lost[i] or (vector_near[i] & kept).any():
                    reasons.append("dup:emb")
                else:
                    reasons.append("new")
                    kept[i] = True
                    if md5 is not None:
                        seen.add(md5)
                        new_md5s.append(md5)
            kept_prints.add(own[kept[at]])
            for w, (places, v) in by_width.items():
                kept_units.setdefault(w, _Kept(np.zeros((0, w)))).add(units[w][kept[places]])
                new_vectors.setdefault(w, []).append(v[kept[places]])
        state.update((new_md5s, kept_prints.all().tobytes(), list(new_vectors), [np.concatenate(v).tobytes() for v in new_vectors.values()]))
        yield pd.DataFrame({"label": [k[0]] * len(rows), "seq": rows[order].to_numpy(), "reason": reasons})

    return fold


def deduplicated_stream(stream: DataFrame, order: str = "seq", s: Settings = DEFAULTS) -> DataFrame:
    """``(label, seq, reason)`` for every record of ``(label, seq, md5, phash, embedding)``: new, or the layer that dropped it.

    A label's kept hashes and vectors are its state; vectors meet those of the
    same number of dimensions.  The state of a label lives in one task, as in any
    keyed stream; the batch operators have no such bound.
    """
    rows = stream.where("label is not null").select("label", order, "md5", "phash", "embedding")
    kind = "float32" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "float64"
    return rows.groupBy("label").applyInPandasWithState(_deduplicated(order, s, kind), "label string, seq long, reason string", "md5s array<string>, prints binary, widths array<int>, vectors array<binary>", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run what is available into Parquet and stop; a restart goes on from the checkpoint."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
