"""A keyed permutation of 0 .. n - 1 as an expression: a row's place in a random order follows from
its index and the key alone, with neither a sort nor a shuffle."""

from math import isqrt

from pyspark.sql import functions as F

from corpusprep.functions.hashing import draw_int

ROUNDS = 6
# Widths looked at below the square root of n.
_WIDTHS = 512


def sides(n):
    """`(a, b)` near the square root of n with a * b at least n and as little above it as can be."""
    root = isqrt(max(n, 1))
    # Not far below it either, so that both sides mix.
    a = min(range(max(root - _WIDTHS, (root + 1) // 2, 1), root + 1), key=lambda a: (-n % a, -a))
    return a, -(-n // a)


def permuted(index, n, seed, keys=()):
    """The place of `index` (0 .. n - 1) in the order that `seed` and the key columns give.

    A Feistel network over pairs (x, y) with index = x + a * y: rounds add to x, modulo a, a draw
    made from y, then to y, modulo b, one made from x. That is a bijection of 0 .. a * b - 1. A
    value from n on goes through the network again until it is below n, which keeps it one; the
    cycle leaves the a * b - n values above n after as many turns at most.
    """
    if n < 2:
        return F.lit(0).cast("bigint")
    a, b = sides(n)

    def round_of(pair, j):
        even = j % 2 == 0
        other = F.when(even, pair["y"]).otherwise(pair["x"])
        draw = draw_int(seed, "feistel", [*keys, j, other], 0,
                        F.lit((1 << 31) - 1).cast("bigint"))
        return F.struct(F.when(even, (pair["x"] + draw) % a).otherwise(pair["x"]).alias("x"),
                        F.when(even, pair["y"]).otherwise((pair["y"] + draw) % b).alias("y"))

    def once(value):
        start = F.struct((value % a).cast("bigint").alias("x"),
                         F.floor(value / a).cast("bigint").alias("y"))
        return F.aggregate(F.array(*[F.lit(j) for j in range(ROUNDS)]), start, round_of,
                           lambda pair: pair["x"] + a * pair["y"])

    value = once(index)
    if a * b == n:
        return value
    return F.aggregate(F.sequence(F.lit(1), F.lit(a * b - n)), value,
                       lambda v, _: F.when(v < n, v).otherwise(once(v)))
