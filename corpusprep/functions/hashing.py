"""Seeded draws that depend only on the seed, a field name and the row's own id."""

from pyspark.sql import functions as F


def _digits(seed, field, columns, width):
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(field), *[F.col(c) if isinstance(c, str) else c
                                                             for c in columns])
    return F.conv(F.substring(F.md5(text), 1, width), 16, 10).cast("bigint")


def draw_int(seed, field, columns, low, high):
    """Integer in [low, high]; the bounds may be Columns."""
    low, high = [b if not isinstance(b, int) else F.lit(b) for b in (low, high)]
    return (low + _digits(seed, field, columns, 8) % (high - low + 1)).cast("bigint")


def draw_unit(seed, field, columns):
    """Double strictly inside (0, 1), from 52 bits."""
    return (_digits(seed, field, columns, 13).cast("double") + 0.5) / F.lit(float(2 ** 52))


def draw_normal(seed, field, columns):
    """Standard normal by the Box-Muller formula."""
    radius = F.sqrt(-2.0 * F.log(draw_unit(seed, field + ".r", columns)))
    return radius * F.cos(2.0 * F.pi() * draw_unit(seed, field + ".a", columns))


def shuffle_key(seed, columns):
    """Uniform 60-bit sort key."""
    return _digits(seed, "order", columns, 15)
