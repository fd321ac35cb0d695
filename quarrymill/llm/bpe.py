"""Problem 7: byte-level BPE of the whole corpus with a public vocabulary.

Texts are cut into words by character class, for a batch of documents at once;
each distinct word of a batch is merged once, and the most recent distinct
words are remembered by the worker.

Merging keeps, for every word, a segment tree over its byte positions.  A leaf
holds the rank of the pair that starts there, an inner node the leftmost
minimum of its two children.  The root names the next merge; the merge changes
three leaves (its own, its live left neighbour's, the swallowed one's), and
each change is a logarithmic point update.  Words of like length are merged
side by side, one merge in each per step, so that the trees of thousands of
words are updated by a few array operations.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
SPACE, OTHER, LETTER, NUMBER = 0, 1, 2, 3
# Contractions that are words of their own, case-sensitive.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_NONE = np.int64(1 << 60)
_REMEMBER = 1 << 18
_CHUNK = 1 << 21  # characters segmented at a time
_CUT = re.compile(r"(?<=[^\W_]) (?=[^\W_])")
_WIDE = 32  # words of more bytes are merged one by one


@lru_cache(1)
def char_classes() -> np.ndarray:
    """Class of every code point, for the categories of the vocabulary's pattern."""
    import regex

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        found = "".join(regex.findall(pattern + "+", every))
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return table


def _byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file, by the public rule of byte-level BPE."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(c): b for b, c in [*((b, b) for b in plain), *((b, 256 + i) for i, b in enumerate(rest))]}


class Merges:
    """Ids of single bytes and the ranked pairs of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.of_byte = np.zeros(256, np.int64)
        for symbol, byte in _byte_symbols().items():
            self.of_byte[byte] = vocab[symbol]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        key = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        by = np.argsort(key)
        self.key, self.rank, self.made = key[by], by.astype(np.int64), made
        self.made_of = made.tolist()
        self.ranks = dict(zip(key.tolist(), range(len(key)), strict=True))

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (a >= 0) & (b >= 0), self.rank[at], _NONE)

    def merge_many(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """words(n, width) of bytes, width a power of two: the ids left in place, -1 where a position was swallowed."""
        n, width = words.shape
        ids = np.where(np.arange(width) < lengths[:, None], self.of_byte[words], -1)
        nxt = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
        prv = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
        leaf = np.full((n, width), _NONE)
        if width > 1:
            rank = self.rank_of(ids[:, :-1], ids[:, 1:])
            leaf[:, :-1] = np.where(rank < _NONE, rank * width + np.arange(width - 1), _NONE)
        tree = np.full((n, 2 * width), _NONE)  # node 1 is the root; a value is rank * width + position: its minimum is the leftmost
        tree[:, width:] = leaf
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2

        tree, ids, nxt, prv = tree.ravel(), ids.ravel(), nxt.ravel(), prv.ravel()
        bits = width.bit_length() - 1
        live = np.arange(n)
        while True:
            top = tree[live * 2 * width + 1]
            live, top = live[top < _NONE], top[top < _NONE]
            if not len(live):
                break
            row = live * width
            at, rank = top & (width - 1), top >> bits
            right = nxt[row + at]
            after = nxt[row + right]
            before = prv[row + at]
            ids[row + at] = self.made[rank]
            ids[row + right] = -1
            nxt[row + at] = after
            inside = after < width
            prv[(row + after)[inside]] = at[inside]
            b = np.where(inside, ids[row + np.minimum(after, width - 1)], -1)
            has = before >= 0
            a = np.where(has, ids[row + np.maximum(before, 0)], -1)
            own, left = np.split(self.rank_of(np.concatenate([ids[row + at], a]), np.concatenate([b, ids[row + at]])), 2)
            value = np.concatenate([np.full(len(live), _NONE), np.where(own < _NONE, (own << bits) | at, _NONE), np.where(left < _NONE, (left << bits) | before, _NONE)])
            node = np.concatenate([right, at, np.where(has, before, right)]) + width  # without a left neighbour, the swallowed leaf again
            base = np.tile(live * 2 * width, 3)
            tree[base + node] = value
            while node[0] > 1:
                node >>= 1
                child = base + 2 * node
                tree[base + node] = np.minimum(tree[child], tree[child + 1])
        return ids.reshape(n, width)

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same for one long word, with plain numbers."""
        none, size = int(_NONE), len(word)
        width = 1 << max(1, (size - 1).bit_length())
        ids = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        nxt, prv = list(range(1, size + 1)), list(range(-1, size - 1))
        rank = self.rank_of(np.array(ids[:-1]), np.array(ids[1:])) if size > 1 else np.zeros(0, np.int64)
        tree = np.full(2 * width, _NONE)
        tree[width : width + size - 1] = np.where(rank < _NONE, rank * width + np.arange(size - 1), _NONE)
        level = width
        while level > 1:
            tree[level // 2 : level] = np.minimum(tree[level : 2 * level : 2], tree[level + 1 : 2 * level : 2])
            level //= 2
        tree, ranks, made = tree.tolist(), self.ranks, self.made_of

        def update(at: int, value: int) -> None:
            node = at + width
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    break
                tree[node] = least
                node >>= 1

        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            right = nxt[at]
            ids[at] = made[rank]
            ids[right] = -1
            after = nxt[at] = nxt[right]
            update(right, none)
            value = none
            if after < size:
                prv[after] = at
                r = ranks.get(ids[at] << 20 | ids[after])
                value = none if r is None else r * width + at
            update(at, value)
            before = prv[at]
            if before >= 0:
                r = ranks.get(ids[before] << 20 | ids[at])
                update(before, none if r is None else r * width + before)
        ids = np.array(ids)
        return ids[ids >= 0]


def word_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where words begin in the code points of joined texts; ``first`` marks each text's first character.

    A contraction, or an optional blank and a run of letters, of numbers or of
    other signs is a word; of a longer run of white space its last character
    stays behind, to lead the next word if it is a blank, else on its own.
    """
    n = len(points)
    kind = char_classes()[points]
    before = np.r_[np.uint8(255), kind[:-1]]
    start = first | (kind != before)
    blank = points == 32
    space = kind == SPACE
    last_space = space & ~np.r_[first[1:] | (kind[1:] != SPACE), True]
    ends = space & np.r_[first[1:], True]  # white space that ends its text stays in one run
    final = space & ~last_space & ~ends  # the last of its run, before a word
    start |= final
    lead = np.flatnonzero(final & blank)
    start[lead + 1] = False
    # contractions: an apostrophe that begins a word, directly followed by one of the endings
    mark = np.flatnonzero((points == 39) & start)
    if len(mark):
        padded = np.r_[points, np.zeros(3, points.dtype)]
        limit = np.r_[first, np.ones(3, bool)]
        for tail in sorted(CONTRACTIONS, key=len):
            hit = np.ones(len(mark), bool)
            for i, c in enumerate(tail, 1):
                hit &= (padded[mark + i] == ord(c)) & ~limit[mark + i]
            at = mark[hit]
            start[at + 1] = False
            end = at + 1 + len(tail)
            end = end[end < n]
            start[end] = True
    return np.flatnonzero(start)


class Encoder:
    def __init__(self, path: str):
        self.merges = Merges(path)
        self.known: dict[bytes, np.ndarray] = {}

    def learn(self, words: list[bytes]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > _REMEMBER:
            self.known = {w: self.known[w] for w in words if w in self.known}
        size = np.array([len(w) for w in new], np.int64)
        wide = 2
        while wide <= _WIDE:
            group = np.flatnonzero((size <= wide) & ((size > wide // 2) | (wide == 2)))
            for at in range(0, len(group), step := max(1, (1 << 19) // wide)):
                some = group[at : at + step]
                table = np.frombuffer(b"".join(new[i].ljust(wide, b"\0") for i in some), np.uint8).reshape(len(some), wide)
                ids = self.merges.merge_many(table, size[some])
                kept = ids >= 0
                flat, ends = ids[kept].astype(np.int32), np.cumsum(kept.sum(1))
                for i, a, b in zip(some.tolist(), np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True):
                    self.known[new[i]] = flat[a:b]
            wide *= 2
        for i in np.flatnonzero(size > _WIDE).tolist():
            self.known[new[i]] = self.merges.merge_long(new[i]).astype(np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the number of ids of each."""
        lengths = np.array([len(t) for t in texts], np.int64)
        joined = "".join(texts)
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.zeros(len(points), bool)
        begin = np.cumsum(lengths) - lengths
        first[begin[lengths > 0]] = True
        starts = word_starts(points, first)
        raw = joined.encode("utf-8", "surrogatepass")
        if len(raw) == len(points):
            at = starts
        else:
            width = 1 + (points > 0x7F) + (points > 0x7FF).astype(np.int64) + (points > 0xFFFF)
            at = (np.cumsum(width) - width)[starts]
        size = np.diff(np.r_[at, len(raw)])
        which, ids, counts = self._words(np.frombuffer(raw + b"\0" * 8, np.uint8), raw, at, size)
        many = counts[which]
        before = np.cumsum(counts) - counts
        flat = ids[np.repeat(before[which] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        text_of = np.searchsorted(begin[lengths > 0], starts, "right") - 1
        total = np.zeros(len(texts), np.int64)
        total[lengths > 0] = np.bincount(text_of, many, int((lengths > 0).sum())).astype(np.int64)
        return flat, total

    def _words(self, view: np.ndarray, raw: bytes, at: np.ndarray, size: np.ndarray):
        """Number of each word among the batch's distinct words, and their ids one after another with counts."""
        eight = np.ndarray((len(raw) + 1,), "<u8", view, strides=(1,))  # the eight bytes from each place on
        masks = np.array([(1 << 8 * i) - 1 for i in range(8)], np.uint64)

        def padded(at: np.ndarray, size: np.ndarray) -> np.ndarray:
            """Up to seven bytes and their number as one number: equal numbers are equal words."""
            return (eight[at] & masks[size]) | size.astype(np.uint64) << np.uint64(56)

        which = np.empty(len(at), np.int64)
        short, middle = np.flatnonzero(size <= 7), np.flatnonzero((size > 7) & (size <= 15))
        words: list[bytes] = []
        for some in (short, middle):
            if some is short:
                key = padded(at[some], size[some])
            else:
                head, tail = (pd.factorize(k)[0] for k in (eight[at[some]], padded(at[some] + 8, size[some] - 8)))
                key = head.astype(np.int64) << 32 | tail
            code, distinct = pd.factorize(key)
            which[some] = code + len(words)
            pick = np.empty(len(distinct), np.int64)
            pick[code[::-1]] = some[::-1]
            words += [raw[a:b] for a, b in zip(at[pick].tolist(), (at + size)[pick].tolist(), strict=True)]
        number: dict[bytes, int] = {}
        base = len(words)
        long = np.flatnonzero(size > 15)
        which[long] = [base + number.setdefault(raw[a:b], len(number)) for a, b in zip(at[long].tolist(), (at + size)[long].tolist(), strict=True)]
        words += number
        self.learn(words)
        parts = [self.known[w] for w in words]
        return which, np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _pieces(text: str, most: int) -> Iterator[str]:
    """A text cut where a word begins for certain: at one space between two letters or numbers."""
    at = 0
    while len(text) - at > most and (cut := _CUT.search(text, at + most)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _chunks(texts: list[str | None], most: int) -> Iterator[list[str]]:
    """Texts of about ``most`` characters together; a longer one alone."""
    some, size = [], 0
    for t in texts:
        t = t or ""
        if some and size + len(t) > most:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t)
    if some:
        yield some


def _encode_batches(name: str, counts_only: bool, most: int = _CHUNK):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(SparkFiles.get(name))
        for batch in batches:
            at = 0
            for texts in _chunks(batch.column(1).to_pylist(), most):
                if len(texts) == 1:
                    parts = [enc.encode([p])[0] for p in _pieces(texts[0], most)]
                    flat, total = np.concatenate(parts), np.array([sum(map(len, parts))])
                else:
                    flat, total = enc.encode(texts)
                id_ = batch.column(0).slice(at, len(texts))
                at += len(texts)
                if counts_only:
                    yield pa.RecordBatch.from_arrays([id_, pa.array(total)], ["id", "tokens"])
                else:
                    ends = np.r_[0, np.cumsum(total)].astype(np.int32)
                    yield pa.RecordBatch.from_arrays([id_, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "ids"])

    return run


def _shipped(spark: SparkSession, path: str) -> str:
    """The vocabulary file on every executor: the name it has there."""
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rsplit("/", 1)[-1]


def encode_corpus(df: DataFrame, id_: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(id, ids array<int>)`` for every row of ``df``, without special tokens.

    Text that looks like a control token is ordinary text.  A null and an empty
    text give the empty array; a null id stays; repeated rows stay repeated.
    """
    return df.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(_encode_batches(_shipped(df.sparkSession, tokenizer), False), "id long, ids array<int>")


def token_counts(df: DataFrame, id_: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(id, tokens long)`` for every row; a null and an empty text have 0 tokens."""
    return df.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(_encode_batches(_shipped(df.sparkSession, tokenizer), True), "id long, tokens long")
