"""Vector expressions in double precision."""

from pyspark.sql import functions as F


def doubles(col):
    return F.transform(col, lambda x: x.cast("double"))


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def rms_normalize(col, weight=None, eps=1e-6):
    """x / sqrt(mean(x^2) + eps), times `weight` element by element when given (V1)."""
    scale = F.sqrt(dot(col, col) / F.size(col) + F.lit(eps))
    scaled = F.transform(col, lambda x: x / scale)
    return scaled if weight is None else F.zip_with(scaled, weight, lambda x, w: x * w)
