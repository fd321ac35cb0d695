"""Vector and logit expressions, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-9


def wide(v: Column) -> Column:
    """The vector in double precision; sums in single precision depend on their order."""
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(wide(a), wide(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(wide(v), F.lit(0.0), lambda s, x: s + x * x))


def normalise(v: Column, epsilon: float = EPSILON) -> Column:
    length = norm(v) + epsilon
    return F.transform(wide(v), lambda x: x / length)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def has_length(v: Column, dims: int) -> Column:
    """Exactly ``dims`` elements, no null or NaN, not all zeros."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)) & F.exists(v, lambda x: x != 0)
    return F.coalesce((F.size(v) == dims) & fine, F.lit(False))


def argmax(v: Column) -> Column:
    """Index from 0 of the greatest element, the first one on ties."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda s, x: s + x)
    return F.transform(powers, lambda x: x / total)


def top_k(probabilities: Column, names: Column, k: int = 3, digits: int = 4) -> Column:
    """``array<struct<label, confidence>>`` of the k greatest, the lower index first on ties."""
    keyed = F.transform(probabilities, lambda p, i: F.struct((-p).alias("p"), i.alias("i")))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda s: F.struct(F.element_at(names, s["i"] + 1).alias("label"), F.round(-s["p"], digits).alias("confidence")))


def smoothed_cross_entropy(logits: Column, label: Column, smoothing: float = 0.1) -> Column:
    top = F.array_max(logits)
    log_total = top + F.log(F.aggregate(logits, F.lit(0.0), lambda s, x: s + F.exp(x - top)))
    own = F.element_at(logits, label + 1) - log_total
    mean = F.aggregate(logits, F.lit(0.0), lambda s, x: s + x) / F.size(logits) - log_total
    return -(1 - smoothing) * own - smoothing * mean


def median_of(v: Column) -> Column:
    """Median of an array: the mean of the two middle elements where their number is even."""
    s = F.array_sort(v)
    n = F.size(v)
    return (F.element_at(s, F.floor((n + 1) / 2).cast("int")) + F.element_at(s, F.floor(n / 2 + 1).cast("int"))) / 2


def above_median_bits(v: Column) -> Column:
    """Last stage of the perceptual hash: ``1`` where a coefficient exceeds the median."""
    m = median_of(wide(v))
    return F.array_join(F.transform(wide(v), lambda x: F.when(x > m, "1").otherwise("0")), "")


def bits_to_long(bits: Column) -> Column:
    """64 characters ``0``/``1`` as a long, null where malformed."""
    part = lambda at: F.conv(F.substring(bits, at, 32), 2, 10).cast("long")
    return F.when(bits.rlike("^[01]{64}\\z"), F.shiftleft(part(1), 32).bitwiseOR(part(33)))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def hamming_text(a: Column, b: Column) -> Column:
    """Positions that differ up to the shorter text's length."""
    chars = lambda s: F.slice(F.split(s, ""), 1, F.least(F.length(a), F.length(b)))
    return F.size(F.filter(F.zip_with(chars(a), chars(b), lambda x, y: x != y), lambda d: d))
