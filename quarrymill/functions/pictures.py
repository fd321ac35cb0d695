"""Operations on pixels, as Arrow-batched UDFs over Spark's image struct (BGR, row-major)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..settings import CHANNEL_MEAN, CHANNEL_STD, DEFAULTS

PIXELS = T.StructType(
    [T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("nChannels", T.IntegerType()), T.StructField("data", T.BinaryType())]
)


def pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """height x width x 3, BGR; gray is repeated, alpha dropped."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(a, 3, axis=2) if channels == 1 else a[:, :, :3]


def gray(bgr: np.ndarray) -> np.ndarray:
    """Luma 0.299 R + 0.587 G + 0.114 B, rounded to whole numbers."""
    return np.rint(bgr[:, :, ::-1].astype(np.float64) @ np.array([0.299, 0.587, 0.114])).astype(np.float64)


def laplacian_variance(g: np.ndarray) -> float:
    """Population variance of the 4-neighbour Laplacian, edges mirrored without repeating the border."""
    mode = "reflect" if min(g.shape) > 1 else "edge"
    p = np.pad(g, 1, mode=mode)
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g).var())


def resized(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear with pixel centres aligned; the aspect ratio isn't kept."""

    def grid(n: int, m: int):
        at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, n - 1), at - low

    (y0, y1, fy), (x0, x1, fx) = grid(a.shape[0], height), grid(a.shape[1], width)
    a = a.astype(np.float64)
    fx = fx[None, :, None] if a.ndim == 3 else fx[None, :]
    fy = fy[:, None, None] if a.ndim == 3 else fy[:, None]
    top = a[y0][:, x0] * (1 - fx) + a[y0][:, x1] * fx
    low = a[y1][:, x0] * (1 - fx) + a[y1][:, x1] * fx
    return top * (1 - fy) + low * fy


@lru_cache(4)
def cosine_matrix(n: int) -> np.ndarray:
    """Orthonormal DCT-II."""
    k, x = np.mgrid[0:n, 0:n]
    m = np.sqrt(2 / n) * np.cos(np.pi * (2 * x + 1) * k / (2 * n))
    m[0] /= np.sqrt(2)
    return m


def perceptual_bits(g: np.ndarray, size: int = 32, low: int = 8) -> str:
    """Signs against the median of the low DCT coefficients (bilinear reduction; see README on exactness)."""
    m = cosine_matrix(size)
    d = (m @ resized(g, size, size) @ m.T)[:low, :low].ravel()
    return "".join("1" if v else "0" for v in d > np.median(d))


def evaluation_tensor(bgr: np.ndarray, size: int = DEFAULTS.image_size, resize_to: int = 256) -> np.ndarray:
    """Shorter side to 256, centre crop, scaled to 0..1, normalised for each channel; channels first, RGB."""
    h, w = bgr.shape[:2]
    scale = resize_to / min(h, w)
    a = resized(bgr[:, :, ::-1], max(size, round(h * scale)), max(size, round(w * scale)))
    y, x = (a.shape[0] - size) // 2, (a.shape[1] - size) // 2
    a = a[y : y + size, x : x + size] / 255
    return ((a - CHANNEL_MEAN) / CHANNEL_STD).transpose(2, 0, 1).astype(np.float32)


def augmented(bgr: np.ndarray, seed: int, size: int = DEFAULTS.image_size) -> np.ndarray:
    """Seeded training view: random crop of 0.8 to 1 of the area, flip, rotation up to 20 degrees, brightness up to 25 %."""
    rng = np.random.default_rng(seed)
    h, w = bgr.shape[:2]
    side = np.sqrt(rng.uniform(0.8, 1.0))
    ch, cw = max(1, int(h * side)), max(1, int(w * side))
    y, x = rng.integers(0, h - ch + 1), rng.integers(0, w - cw + 1)
    a = resized(bgr[y : y + ch, x : x + cw, ::-1], size, size)
    if rng.random() < 0.5:
        a = a[:, ::-1]
    t = np.deg2rad(rng.uniform(-20, 20))
    c = (size - 1) / 2
    yy, xx = np.mgrid[0:size, 0:size] - c
    sy, sx = np.rint(yy * np.cos(t) - xx * np.sin(t) + c).astype(int), np.rint(yy * np.sin(t) + xx * np.cos(t) + c).astype(int)
    inside = (sy >= 0) & (sy < size) & (sx >= 0) & (sx < size)
    a = np.where(inside[:, :, None], a[np.clip(sy, 0, size - 1), np.clip(sx, 0, size - 1)], 0)
    a = np.clip(a * rng.uniform(0.75, 1.25), 0, 255) / 255
    return ((a - CHANNEL_MEAN) / CHANNEL_STD).transpose(2, 0, 1).astype(np.float32)


def turned(a: np.ndarray, orientation: int) -> np.ndarray:
    """A picture set upright by its EXIF orientation, 1 to 8; anything else leaves it."""
    turn = {2: lambda p: p[:, ::-1], 3: lambda p: p[::-1, ::-1], 4: lambda p: p[::-1], 5: lambda p: p.swapaxes(0, 1), 6: lambda p: np.rot90(p, -1), 7: lambda p: np.rot90(p, -1)[:, ::-1], 8: lambda p: np.rot90(p)}
    return turn.get(orientation, lambda p: p)(a)


def exif_orientation(content: bytes) -> int:
    """Orientation 1 to 8 from a JPEG's EXIF segment; 1 where there is none or it is broken."""
    at = 2
    while content[:2] == b"\xff\xd8" and at + 4 <= len(content) and content[at] == 0xFF:
        size = int.from_bytes(content[at + 2 : at + 4], "big")
        body = content[at + 4 : at + 2 + size]
        if content[at + 1] == 0xE1 and body[:6] == b"Exif\0\0":
            tiff = body[6:]
            order = {b"II": "little", b"MM": "big"}.get(tiff[:2])
            if order is None:
                return 1
            number = lambda i, n: int.from_bytes(tiff[i : i + n], order)
            first = number(4, 4)
            for entry in range(first + 2, first + 2 + 12 * number(first, 2), 12):
                if number(entry, 2) == 0x0112:
                    value = number(entry + 8, 2)
                    return value if 1 <= value <= 8 else 1
            return 1
        at += 2 + max(2, size)
    return 1


def _each(image: pd.DataFrame):
    for d, h, w, c in zip(image["data"], image["height"], image["width"], image["nChannels"], strict=True):
        # beside nulls, whole numbers arrive as floats
        yield None if d is None or h is None or w is None or not h > 0 or not w > 0 else pixels(d, int(h), int(w), int(c))


def measures_udf():
    """image struct -> struct<blur, brightness, phash>; an unreadable picture gives nulls."""

    @F.pandas_udf("blur double, brightness double, phash string")
    def measures(image: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for a in _each(image):
            g = None if a is None else gray(a)
            rows.append((None, None, None) if g is None else (laplacian_variance(g), float(g.mean()), perceptual_bits(g)))
        return pd.DataFrame(rows, columns=["blur", "brightness", "phash"])

    return measures


def resize_udf(size: int = DEFAULTS.image_size):
    @F.pandas_udf(PIXELS)
    def resize(image: pd.DataFrame) -> pd.DataFrame:
        rows = [(None,) * 4 if a is None else (size, size, 3, np.rint(resized(a, size, size)).astype(np.uint8).tobytes()) for a in _each(image)]
        return pd.DataFrame(rows, columns=["height", "width", "nChannels", "data"])

    return resize


def crop_udf():
    """image struct and a box of whole numbers -> image struct; an empty crop gives null."""

    @F.pandas_udf(PIXELS)
    def crop(image: pd.DataFrame, box: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for a, (x1, y1, x2, y2) in zip(_each(image), box[["x1", "y1", "x2", "y2"]].itertuples(index=False), strict=True):
            part = a[int(y1) : int(y2), int(x1) : int(x2)] if a is not None and x2 > x1 and y2 > y1 else None
            rows.append((None,) * 4 if part is None or not part.size else (part.shape[0], part.shape[1], 3, part.tobytes()))
        return pd.DataFrame(rows, columns=["height", "width", "nChannels", "data"])

    return crop


def tensor_udf(size: int = DEFAULTS.image_size, resize_to: int = 256):
    @F.pandas_udf("array<float>")
    def tensor(image: pd.DataFrame) -> pd.Series:
        return pd.Series([None if a is None else evaluation_tensor(a, size, resize_to).ravel() for a in _each(image)])

    return tensor
