"""Portable network graphics from bytes and to bytes, with numpy and zlib.

Reads 8 and 16 bits, gray, gray with alpha, RGB, RGBA and palettes, not interlaced; writes RGB and gray of 8 bits.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .pictures import PIXELS

# The file signature; channels of each colour type.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _unfiltered(raw: np.ndarray, step: int) -> np.ndarray:
    """Rows of filter type and bytes -> bytes; ``step`` is the size of a pixel."""
    kinds, rows = raw[:, 0], raw[:, 1:].copy()
    above = np.zeros(rows.shape[1], np.uint8)
    for kind, row in zip(kinds, rows, strict=True):
        if kind == 1:
            for c in range(step):
                row[c::step] = np.cumsum(row[c::step], dtype=np.uint8)
        elif kind == 2:
            row += above
        elif kind in (3, 4):
            out, up = row.tolist(), above.tolist()
            for i in range(len(out)):
                a, b, c = (out[i - step] if i >= step else 0), up[i], (up[i - step] if i >= step else 0)
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    guess = min((a, b, c), key=lambda x: abs(a + b - c - x))
                out[i] = out[i] + guess & 255
            row[:] = out
        elif kind:
            raise ValueError("unknown filter")
        above = row
    return rows


def decode(content: bytes) -> np.ndarray:
    """height x width x 3, BGR; ValueError for what can't be read."""
    if content[:8] != SIGNATURE:
        raise ValueError("no such signature")
    at, head, data, palette = 8, None, [], None
    while at + 12 <= len(content):
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        body = content[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data.append(body)
        elif kind == b"IEND":
            break
        at += 12 + size
    if head is None or head[2] not in (8, 16) or head[3] not in CHANNELS or head[6]:
        raise ValueError("unsupported kind")
    width, height, depth, colour = head[:4]
    step = CHANNELS[colour] * depth // 8
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, 1 + width * step)
    except zlib.error as e:
        raise ValueError("broken data") from e
    a = _unfiltered(raw, step)[:, :: depth // 8].reshape(height, width, CHANNELS[colour])
    if colour == 3:
        if palette is None:
            raise ValueError("no palette")
        a = palette[a[:, :, 0]]
    return np.repeat(a[:, :, :1], 3, axis=2) if a.shape[2] < 3 else a[:, :, 2::-1]


def encode(bgr: np.ndarray) -> bytes:
    """``bgr``: height x width x 3."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    height, width = bgr.shape[:2]
    rows = np.zeros((height, 1 + width * 3), np.uint8)
    rows[:, 1:] = bgr[:, :, ::-1].reshape(height, -1)
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def decode_udf():
    """binary -> image struct; what can't be read gives null fields."""

    @F.pandas_udf(PIXELS)
    def read(content: pd.Series) -> pd.DataFrame:
        rows = []
        for data in content:
            try:
                a = decode(bytes(data)) if data is not None else None
            except (ValueError, struct.error, IndexError):
                a = None
            rows.append((None,) * 4 if a is None else (a.shape[0], a.shape[1], 3, np.ascontiguousarray(a).tobytes()))
        return pd.DataFrame(rows, columns=["height", "width", "nChannels", "data"])

    return read


def encode_udf():
    """image struct -> binary."""
    from .pictures import _each

    @F.pandas_udf("binary")
    def write(image: pd.DataFrame) -> pd.Series:
        return pd.Series([None if a is None else encode(a) for a in _each(image)], dtype=object)

    return write
