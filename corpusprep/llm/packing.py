"""Best-fit packing by bin completion.

Only lengths matter, and there are at most `capacity` of them, so the plan is made from the table
of piece lengths and their counts: it lists fillings (which lengths share a sequence) and how
often each is used. Each step completes the largest length left with an undominated filling; the
first filling tried is the best fit, and repeating it while the counts allow gives the incumbent.
When the incumbent uses more sequences than a lower bound (total length, or a dual feasible function
of the lengths), a branch-and-bound over the other undominated fillings goes on, cut off
wherever the waste so far or the bound of what is left rules out a better plan. Four parameters bound
that search: nodes, fillings a node, extensions a node and in all; the incumbent stays valid whenever it
stops. Spark numbers the pieces of each length and looks up every piece's place in the plan.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusprep.llm.common import stored
from corpusprep.llm.token_ids import word_ids

#: Bounds of the search beyond the incumbent: nodes, fillings a node, extensions a node and in all.
NODES, WIDE, TRIES, EFFORT = 600, 3, 2000, 20_000
#: Extensions tried for a best fit before it is worked out from all sums within reach.
FIRST = 300
CELL = 1 << 16
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def fewest(counts, capacity, steps=32):
    """A lower bound on the sequences that pieces of given lengths need, `counts[length]`.

    The volume bound and its dual feasible relatives, in whole numbers: a length weighs
    floor((k + 1) length / capacity) / k (itself, where that division is even), or a length above
    capacity - e weighs a whole sequence and one below e nothing, or the first after the second.
    """
    counts = np.asarray(counts, dtype=np.int64)
    sizes = np.flatnonzero(counts)
    sizes = sizes[sizes > 0]
    if not len(sizes):
        return 0
    many = counts[sizes]
    best = -(-int((many * sizes).sum()) // capacity)
    # Only the lengths that occur change the weights.
    edges = np.unique(np.concatenate([[0], sizes[sizes <= capacity // 2]]))
    for e in edges:
        moved = np.where(sizes > capacity - e, capacity, np.where(sizes < e, 0, sizes))
        best = max(best, -(-int((many * moved).sum()) // capacity))
    for e in edges if len(edges) <= 64 else np.concatenate([[0], edges[::len(edges) // 64 + 1]]):
        moved = np.where(sizes > capacity - e, capacity, np.where(sizes < e, 0, sizes))
        for k in range(1, steps + 1):
            whole, part = np.divmod((k + 1) * moved, capacity)
            weight = np.where(part == 0, k * moved, whole * capacity)
            best = max(best, -(-int((many * weight).sum()) // (k * capacity)))
    return best


def _exact(counts, room):
    """The fullest filling of `room` from `counts`, longest lengths preferred: `(waste, chosen)`.
    Sums within reach are the bits of a number; a length with a count enters by powers of two."""
    reach, trail = 1, []
    mask = (1 << room + 1) - 1
    for x in np.flatnonzero(counts[:room + 1]).tolist():
        left, n = min(int(counts[x]), room // x) if x else 0, 1
        while left:
            n = min(n, left)
            trail.append((x, n, reach))
            reach |= reach << x * n & mask
            left -= n
            n *= 2
    full = at = reach.bit_length() - 1
    chosen = {}
    for x, n, before in reversed(trail):
        if at >= x * n and before >> at - x * n & 1:
            at -= x * n
            chosen[x] = chosen.get(x, 0) + n
    return room - full, tuple(chosen.items())


def _fillings(counts, room, want, tries, effort):
    """Up to `want` undominated fillings of `room` from `counts`, least waste first.

    A filling is a tuple of (length, how many). It is dominated when a length left over could
    be added, or could take the place of a shorter one inside it. `tries` bounds the search; the
    fullest filling is among those returned whatever it is. What they take is taken from `effort`.
    """
    lengths = np.flatnonzero(counts[:room + 1])[::-1]
    lengths = lengths[lengths > 0].tolist()
    found, best, left = [], [room + 1], [min(tries, effort[0])]
    effort[0] -= left[0]

    def dominated(chosen, waste):
        used = dict(chosen)
        free = [x for x in lengths if counts[x] > used.get(x, 0)]
        if any(x <= waste for x in free):
            return True
        return any(any(a < x <= a + waste for x in free) for a in used)

    def extend(first, rest, chosen):
        if left[0] <= 0:
            return
        left[0] -= 1
        fits = [k for k in range(first, len(lengths)) if lengths[k] <= rest]
        if not fits:
            waste = rest
            if (len(found) < want or waste < best[0]) and not dominated(chosen, waste):
                found.append((waste, tuple(chosen)))
                found.sort(key=lambda f: f[0])
                del found[want:]
                best[0] = found[-1][0] if len(found) == want else room + 1
            return
        # An exact single item dominates all else here.
        if lengths[fits[0]] == rest:
            chosen.append((rest, 1))
            extend(len(lengths), 0, chosen)
            chosen.pop()
            if want == 1:
                return
            fits = fits[1:]
        for k in fits:
            x = lengths[k]
            for n in range(min(rest // x, int(counts[x])), 0, -1):
                chosen.append((x, n))
                extend(k + 1, rest - n * x, chosen)
                chosen.pop()
                if want == 1 and found and found[0][0] == 0 or left[0] <= 0:
                    return

    extend(0, room, [])
    effort[0] += max(left[0], 0)
    if left[0] <= 0 and not (found and found[0][0] == 0):
        full = _exact(counts, room)
        if not found or full[0] < found[0][0]:
            found = [full, *found][:want]
    return found


def plan(counts, capacity, nodes=NODES, wide=WIDE, tries=TRIES, effort=EFFORT):
    """Fillings and how often each is used: `[(times, ((length, how many), ...)), ...]`.

    The best-fit incumbent is made in full. The branch-and-bound ends where `fewest` is met, when it
    has seen all undominated fillings, or after `nodes` nodes, each with its `wide` fullest
    fillings found within `tries` extensions. Every piece has a place whenever it ends.
    """
    counts = np.asarray(counts, dtype=np.int64).copy()
    total = int((counts * np.arange(len(counts))).sum())
    least = fewest(counts, capacity)

    def step(counts, filling):
        times = min(int(counts[x]) // n for x, n in filling)
        after = counts.copy()
        for x, n in filling:
            after[x] -= n * times
        return times, after

    def with_largest(counts, want, tries, effort):
        top = int(np.flatnonzero(counts)[-1])
        rest = counts.copy()
        rest[top] -= 1
        for waste, chosen in _fillings(rest, capacity - top, want, tries, effort) or [(capacity - top, ())]:
            merged = dict(chosen)
            merged[top] = merged.get(top, 0) + 1
            yield waste, tuple(sorted(merged.items(), reverse=True))

    incumbent, now = [], counts
    while now.any():
        _, filling = next(with_largest(now, 1, FIRST, [FIRST]))
        times, now = step(now, filling)
        incumbent.append((times, filling))
    best = [sum(t for t, _ in incumbent), incumbent]

    # Depth first over the alternatives, largest length first.
    stack, effort = [(counts, 0, 0, None)], [effort]
    while stack and nodes and effort[0] > 0 and best[0] > least:
        nodes -= 1
        now, used, wasted, trail = stack.pop()
        if not now.any():
            if used < best[0]:
                steps = []
                while trail:
                    steps.append(trail[0])
                    trail = trail[1]
                best[:] = [used, steps[::-1]]
            continue
        if used + fewest(now, capacity, 6) >= best[0]:
            continue
        options = []
        for waste, filling in with_largest(now, wide, tries, effort):
            times, after = step(now, filling)
            allowed = (best[0] - 1) * capacity - total
            if wasted + waste * times <= allowed:
                options.append((after, used + times, wasted + waste * times,
                                ((times, filling), trail)))
        stack += options[::-1]
    return best[1]


def _pieces(tokenizer, end_id, capacity):
    def run(batches):
        encode = word_ids(tokenizer).encode_all
        for batch in batches:
            out = []
            texts = batch.column(1).to_pylist()
            for doc, ids in zip(batch.column(0).to_pylist(), encode(texts)):
                ids = np.append(np.frombuffer(ids, "<u2").astype("<u4"), np.uint32(end_id))
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    out.append((doc, k, at, len(part), zlib.crc32(part)))
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def _places(steps):
    """Per length: first rank, first sequence, pieces per sequence and offset of each use."""
    places, ranks, sequence = {}, {}, 0
    for times, filling in steps:
        offset = 0
        for x, n in filling:
            at = ranks.get(x, 0)
            places.setdefault(x, []).append((at, sequence, n, offset))
            ranks[x] = at + n * times
            offset += n * x
        sequence += times
    return {x: np.array(rows, dtype=np.int64).T for x, rows in places.items()}


def _placed(steps):
    def run(batches):
        places = _places(steps)
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in (3, 5))
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for x in np.unique(length):
                here = np.flatnonzero(length == x)
                first, base, per, start = places[int(x)]
                use = np.searchsorted(first, rank[here], "right") - 1
                k = rank[here] - first[use]
                sequence[here] = base[use] + k // per[use]
                offset[here] = start[use] + k % per[use] * x
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:5], "sequence_id", "offset"])
    return run


def ranked(pieces, cell=CELL):
    """Number the rows of each length from 0. A frequent length is cut into hashed cells of about
    `cell` rows, so that no task sorts all of its pieces."""
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    # One row per length: at most the capacity.
    split = pieces.join(F.broadcast(counts), "length").withColumn(
        "cell", F.pmod(F.xxhash64("doc_id", "piece"), F.ceil(F.col("n") / cell))).drop("n")
    inside = W.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32")
    sizes = split.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias(
        "base"))
    return split.withColumn("no", F.row_number().over(inside) - 1).join(
        starts, ["length", "cell"]).withColumn("rank", F.col("base") + F.col("no"))


def pack(docs, tokenizer, end_id, capacity=2048, nodes=NODES, wide=WIDE, tries=TRIES, effort=EFFORT):
    """Pieces of every document of `docs(doc_id, text)` and their places in packed sequences.

    A null text is empty: its document is the end id alone. Rows sharing a doc_id are packed each
    on its own. Only documents above `capacity` are cut. An empty table gives an empty result.
    `nodes`, `wide`, `tries` and `effort` bound the search for fewer sequences, see `plan`.
    """
    pieces = stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _pieces(tokenizer, end_id, capacity), PIECES), "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked(pieces).select(*names, "rank").mapInArrow(
        _placed(plan(counts, capacity, nodes, wide, tries, effort)), PIECES + ", sequence_id long, offset long")
