"""Exact top-k inner products over a bit-sliced index.

Rows are dealt into blocks. In a block every attribute (vector component, as an integer) without
its `dropped` lowest bits is stored as bit slices: slice j holds bit j of all rows, packed. The
inner product with a query is a sum of slices shifted by the query's bits, so it is added with
bitmap arithmetic: carry-save adders over slices of equal weight, complements for negative bits.
The sum's slices are then walked from the most significant downward, which leaves the k best rows
and the value at the boundary. The dropped bits can change a sum by a known amount at most; rows
that close to the boundary are resolved exactly, in integers.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusprep.llm.common import stored

BLOCK_ROWS = 1 << 15
QUERIES_AT_ONCE = 4096
DROPPED = 3


def integers(vectors, scale=1024):
    """`(vec_id, v)` with v = floor(scale * x) of every vector that is fully finite.

    Vectors that are null or hold a null, infinite or not-a-number component are left out.
    """
    x = F.col("embedding")
    ok = F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    return vectors.filter(x.isNotNull() & ok).select(
        F.col("vec_id").cast("long"),
        F.transform(x, lambda y: F.floor(y.cast("double") * scale).cast("long")).alias("v"))


def _packed(bits):
    """Rows of booleans as 64-bit words."""
    pad = -bits.shape[-1] % 64
    if pad:
        bits = np.concatenate([bits, np.zeros((*bits.shape[:-1], pad), dtype=bool)], axis=-1)
    # Of a transposed matrix the packed rows would not lie in one piece.
    return np.packbits(np.ascontiguousarray(bits), axis=-1, bitorder="little").view("<u8")


def _ones(word):
    return int(np.bitwise_count(word).sum())


class Block:
    """Index of some rows: `ids`, integer matrix `x`, and its slices."""

    def __init__(self, ids, x, dropped=DROPPED):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.dropped = ids[order], x[order], dropped
        kept = self.x >> dropped
        self.low = kept.min(axis=0) if kept.size else np.zeros(x.shape[1], np.int64)
        above = kept - self.low
        self.width = int(above.max()).bit_length() if above.size else 0
        self.rows = _packed(np.ones(len(ids), dtype=bool))
        # Slice j of attribute d is in row d * width + j, its complement in the second half.
        slices = np.stack([_packed(((above >> j) & 1).astype(bool).T) for j in range(self.width)],
                          axis=1).reshape(-1, len(self.rows)) if self.width else np.zeros(
                              (0, len(self.rows)), "<u8")
        self.slices = np.concatenate([slices, ~slices])
        # Where parts of one weight and carries to the next are added, kept from query to query.
        self.room = np.empty((2, 0, len(self.rows)), "<u8")
        # Inner products in double are exact while no sum passes 2**53.
        self.most = int(np.abs(self.x).max(initial=0))

    def _sum(self, q):
        """Slices of sum(q * kept), least significant first, and what to add to their value."""
        offset = int(np.dot(q.astype(object), self.low.astype(object))) if len(q) else 0
        digits = []
        for d, value in enumerate(q.tolist()):
            # Non-adjacent form: few bits, each plus or minus.
            bit = 0
            while value:
                if value & 1:
                    digit = 2 - (value & 3)
                    value -= digit
                    digits.append((d, bit, digit < 0))
                    if digit < 0:
                        offset -= ((1 << self.width) - 1) << bit
                value >>= 1
                bit += 1
        d, bit, minus = np.array(digits, dtype=np.int64).reshape(-1, 3).T[:, :, None]
        j = np.arange(self.width)
        weights = (bit + j).ravel()
        parts = (d * self.width + minus * (len(self.slices) // 2) + j).ravel()[
            np.argsort(weights, kind="stable")]
        # Every two parts of a weight leave one carry to the next.
        taken, added = np.bincount(weights).tolist(), []
        while len(added) < len(taken) or added and added[-1] > 1:
            own = taken[len(added)] if len(added) < len(taken) else 0
            added.append(own + (added[-1] // 2 if added else 0))
        if self.room.shape[1] < max(added, default=0):
            self.room = np.empty((2, max(added), len(self.rows)), "<u8")
        found = np.zeros((len(added), len(self.rows)), "<u8")
        first = carried = 0
        for weight, n in enumerate(added):
            now, following = self.room[weight & 1, :n], self.room[1 - (weight & 1)]
            last = first + n - carried
            np.take(self.slices, parts[first:last], axis=0, out=now[carried:], mode="clip")
            first, carried = last, 0
            while len(now) > 2:
                n = len(now) // 3
                a, b, c, carry = now[:n], now[n:2 * n], now[2 * n:3 * n], following[carried:carried + n]
                # In place: a is free once b holds a ^ b; the sums a ^ b ^ c take the place of c.
                np.bitwise_and(a, b, out=carry)
                np.bitwise_xor(a, b, out=b)
                np.bitwise_and(b, c, out=a)
                np.bitwise_or(carry, a, out=carry)
                np.bitwise_xor(b, c, out=c)
                now, carried = now[2 * n:], carried + n
            if len(now) == 2:
                np.bitwise_and(now[0], now[1], out=following[carried])
                carried += 1
                np.bitwise_xor(now[0], now[1], out=found[weight])
            elif len(now):
                found[weight] = now[0]
        return found, offset

    def top(self, query_id, q, k):
        """`(ids, scores)` of the k best rows, ties to the smaller id, rows of `query_id` aside."""
        alive = np.searchsorted(self.ids, [query_id, query_id + 1])
        others = self.rows
        if alive[0] < alive[1]:
            own = np.zeros(len(self.ids), dtype=bool)
            own[alive[0]:alive[1]] = True
            others = self.rows & ~_packed(own)
        found, _ = self._sum(q)
        at_least = others
        if _ones(others) > k:
            sure, tied, bound = np.zeros_like(others), others, 0
            for weight in range(len(found) - 1, -1, -1):
                upper = sure | (tied & found[weight])
                n = _ones(upper)
                if n >= k:
                    tied, bound = tied & found[weight], bound | (1 << weight)
                else:
                    sure, tied = upper, tied & ~found[weight]
            # `bound` is the k-th best sum. Dropped bits of a row add between these, in its units.
            spread = int(np.abs(q).sum()) * ((1 << self.dropped) - 1)
            bound = max(bound - (-(-spread >> self.dropped)), 0)
            above, tied = np.zeros_like(others), others
            for weight in range(max(len(found), bound.bit_length()) - 1, -1, -1):
                part = found[weight] if weight < len(found) else np.zeros_like(others)
                if bound >> weight & 1:
                    tied = tied & part
                else:
                    above, tied = above | (tied & part), tied & ~part
            at_least = above | tied
        rows = np.flatnonzero(np.unpackbits(at_least.view(np.uint8), bitorder="little"))
        if self.most * int(np.abs(q).max(initial=0)) * max(len(q), 1) < 1 << 53:
            scores = (self.x[rows].astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        else:
            scores = np.array(self.x[rows].astype(object) @ q.astype(object), dtype=np.int64)
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][best], scores[best]


def _searched(shared, k, dropped):
    def run(key, table):
        width = key[1].as_py()
        x = table.column("v").combine_chunks().flatten().to_numpy().reshape(table.num_rows, width)
        block, out = Block(table.column("vec_id").to_numpy(), x, dropped), []
        for number, query_id, q in shared.value:
            if len(q) == width:
                out += [(query_id, number, i, s) for i, s in zip(*block.top(query_id, q, k))]
        columns = list(zip(*out)) or [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns],
                        names=["query_id", "number", "vec_id", "score"])
    return run


def top_k(vectors, is_query, k=10, scale=1024, dropped=DROPPED, block_rows=BLOCK_ROWS):
    """`(query_id, rank, vec_id, score)`: the k best rows by inner product for every query row.

    `vectors` has vec_id and embedding; `is_query` is a condition on vec_id. A row competes with
    queries of its own length only, and not with rows of the query's own vec_id; fewer than k rows
    give fewer results, ties go to the smaller vec_id. Rows with a null vec_id take no part. Queries
    go in bounded groups, each against all blocks of rows, so no step holds all of either.
    """
    spark = vectors.sparkSession
    # Numbered, as many rows may have one vec_id: they go to different blocks and groups.
    rows = stored(integers(vectors).filter("vec_id is not null").withColumn(
        "row", F.monotonically_increasing_id()), "sliced-rows")
    n = rows.count()
    blocks = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-n // block_rows))))
    dealt = rows.select("vec_id", "v", blocks.alias("block"), F.size("v").alias("width"))
    queries = stored(rows.filter(is_query), "sliced-queries")
    groups = max(1, -(-queries.count() // QUERIES_AT_ONCE))
    found = None
    for group in range(groups):
        # About QUERIES_AT_ONCE rows, however many queries there are.
        part = queries.filter(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)) == group).collect()
        shared = spark.sparkContext.broadcast(
            [(r["row"], r["vec_id"], np.array(r["v"], dtype=np.int64)) for r in part])
        best = stored(dealt.groupBy("block", "width").applyInArrow(
            _searched(shared, k, dropped), "query_id long, number long, vec_id long, score long"),
            "sliced-best")
        shared.unpersist()
        found = best if found is None else found.union(best)
    by = W.partitionBy("query_id", "number").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
