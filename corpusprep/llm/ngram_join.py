"""Similarity join on word n-gram sets by vertical partitioning of the global n-gram order.

All n-grams have one global order, rare ones first (how often, estimated by a sketch of fixed size
over all documents, then by hash; any order gives the same result, a good one saves work). Two sets
of the wanted Jaccard must share an n-gram among the first few of each (their prefixes), at places
that leave room for the overlap they need. Candidate pairs found that way are counted exactly:
the order is cut at pivots into fragments of equal weight, each fragment counts the overlap of the
two sets' parts on its own, and the partial counts are summed per pair.

Equal sets are one node throughout, so copies cost nothing. Of the sets that have a prefix n-gram the
one with the fewest n-grams before it is the hub. Each set is first compared with the hub that most
of its n-grams name, then with its other hubs, and at last with all others that share a prefix
n-gram; each time only where the two are not in one component yet. Every link therefore lies inside a
component, and the components are those of all links.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusprep.llm.common import BROADCAST_ROWS, attach, components, discard, stored
from corpusprep.llm.words import hashed_words, mix, shingles, slices, texts

SKETCH_BITS = 22
SKETCH_BLOCK = 1 << 16
FRAGMENTS = 8
KEYS = "block long, places binary, counts binary, doc_id long, n_shingles long, node long"
PREFIX = "token long, node long, n int, pos int"
PARTS = "node long, n int, fragment int, tokens array<long>"


def _sets(batch, n):
    """(doc_ids, hashes, heads, node) of an Arrow slice with columns doc_id, text."""
    value, heads = shingles(*hashed_words(*texts(batch.column(1))), n)
    # A set's own hash does not depend on the order of its members.
    sums = np.zeros(len(heads) - 1, dtype=np.uint64)
    full = np.flatnonzero(np.diff(heads))
    if len(full):
        sums[full] = np.add.reduceat(mix(value), heads[:-1][full])
    node = mix(sums + np.diff(heads).astype(np.uint64))
    return value, heads, node.view(np.int64)


def _packed(part):
    """`(places, counts)` of a block as bytes: counts of the places above zero, or of all places
    (places None) where that is shorter, in as few bytes a count as the largest needs."""
    kind = next(k for k in ("<u1", "<u2", "<u4") if part.max() <= np.iinfo(k).max)
    places = np.flatnonzero(part)
    width = np.dtype(kind).itemsize
    if len(places) * (2 + width) >= len(part) * width:
        return None, part.astype(kind).tobytes()
    return places.astype("<u2").tobytes(), part[places].astype(kind).tobytes()


def _keyed(n, bits):
    schema = pa.schema([("block", pa.int64()), ("places", pa.binary()), ("counts", pa.binary()),
                        ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64())])

    def run(batches):
        sketch = np.zeros(1 << bits, dtype=np.uint32)
        for batch in batches:
            for piece in slices(batch, 1):
                value, heads, node = _sets(piece, n)
                np.add.at(sketch, (value & np.uint64((1 << bits) - 1)).astype(np.int64), 1)
                none = pa.nulls(piece.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [none.cast(pa.int64()), none.cast(pa.binary()), none.cast(pa.binary()),
                     piece.column(0), pa.array(np.diff(heads)), pa.array(node)], schema=schema)
        for block in range(0, 1 << bits, SKETCH_BLOCK):
            part = sketch[block:block + SKETCH_BLOCK]
            if part.any():
                one = pa.nulls(1, pa.int64())
                places, counts = _packed(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([places], pa.binary()),
                     pa.array([counts], pa.binary()), one, one, one], schema=schema)
    return run


def _summed(bits):
    size = min(1 << bits, SKETCH_BLOCK)

    def run(batches):
        total = {}
        for batch in batches:
            # Blocks are read in place, one at a time.
            for block, places, counts in zip(batch.column(0).to_pylist(), batch.column(1),
                                             batch.column(2)):
                at = np.frombuffer(places.as_buffer(), "<u2") if places.is_valid else slice(None)
                counts = counts.as_buffer()
                width = counts.size // (len(at) if places.is_valid else size)
                if block not in total:
                    total[block] = np.zeros(size, dtype=np.uint64)
                total[block][at] += np.frombuffer(counts, f"<u{width}")
        limit = np.uint64(2**32 - 1)
        for block, counts in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array(
                    [np.minimum(counts, limit).astype("<u4").tobytes()], pa.binary())],
                ["block", "counts"])
    return run


def _sketch(keys, bits):
    """The whole sketch; at most 2**bits counters reach the driver, however many documents."""
    blocks = keys.filter("block is not null").select("block", "places", "counts")
    found = blocks.repartition("block").mapInArrow(
        _summed(bits), "block long, counts binary").collect()
    sketch = np.zeros(1 << bits, dtype=np.uint32)
    for r in found:
        sketch[r["block"]:r["block"] + SKETCH_BLOCK] = np.frombuffer(r["counts"], "<u4")
    return sketch


def pivots(sketch, fragments):
    """Places in the global order that cut the corpus's n-grams into parts of equal weight."""
    counts, cells = np.unique(sketch, return_counts=True)
    weight = np.cumsum(counts.astype(np.float64) * cells)
    cuts = []
    for k in range(1, fragments):
        want = weight[-1] * k / fragments
        at = int(np.searchsorted(weight, want))
        below = weight[at - 1] if at else 0.0
        share = (want - below) / max(weight[at] - below, 1.0)
        cuts.append((int(counts[at]) << 32) + int(min(max(share, 0.0), 1.0) * (2**32 - 1)))
    return np.array(cuts, dtype=np.uint64)


def _ordered(batch, n, sketch):
    """Per row of a slice: its set in the global order, with the order's keys."""
    value, heads, node = _sets(batch, n)
    mask = np.uint64(len(sketch) - 1)
    order = (sketch[(value & mask).astype(np.int64)].astype(np.uint64) << np.uint64(32)) | (
        value >> np.uint64(32))
    rows = np.repeat(np.arange(len(heads) - 1), np.diff(heads))
    by = np.lexsort((value, order, rows))
    return value[by], order[by], heads, rows, node


def _prefixes(n, percent, shared):
    def run(batches):
        sketch = shared.value
        for batch in batches:
            for piece in slices(batch, 1):
                value, _, heads, rows, node = _ordered(piece, n, sketch)
                size = np.diff(heads)
                keep = size - (percent * size + 99) // 100 + 1
                place = np.arange(len(value)) - heads[:-1][rows]
                chosen = place < keep[rows]
                rows = rows[chosen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[chosen].view(np.int64)), pa.array(node[rows]),
                     pa.array(size[rows].astype(np.int32)),
                     pa.array(place[chosen].astype(np.int32))], ["token", "node", "n", "pos"])
    return run


def _parts(n, shared, cuts):
    def run(batches):
        sketch = shared.value
        for batch in batches:
            for piece in slices(batch, 1):
                value, order, heads, rows, node = _ordered(piece, n, sketch)
                part = np.searchsorted(cuts, order, "right")
                new = np.ones(len(value), dtype=bool)
                new[1:] = (rows[1:] != rows[:-1]) | (part[1:] != part[:-1])
                first = np.flatnonzero(new)
                ends = np.append(first, len(value)).astype(np.int32)
                size = np.diff(heads).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[rows[first]]), pa.array(size[rows[first]]),
                     pa.array(part[first].astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(value.view(np.int64)))],
                    ["node", "n", "fragment", "tokens"])
    return run


def _room(percent):
    """Whether two sets of sizes n, n2 that share the n-gram at places pos, pos2 can still reach
    the Jaccard, were it their first common one."""
    need = F.ceil(F.expr(f"{percent} * (n + n2) / {100 + percent}"))
    return F.expr(f"100 * least(n, n2) >= {percent} * greatest(n, n2)") & (
        1 + F.least(F.expr("n - pos - 1"), F.expr("n2 - pos2 - 1")) >= need)


def ngram_join(docs, n=3, percent=90, sketch_bits=SKETCH_BITS, fragments=FRAGMENTS):
    """`(doc_id, n_shingles, component_id)` for every row of `docs(doc_id, text)`.

    Documents link when the Jaccard of their n-gram sets is at least `percent` per cent, in exact
    integers. A text with fewer than n words is one n-gram of all of them; null and blank texts
    have none, link with nothing and are their own component. A null doc_id takes no part in ids:
    its component_id is null unless it links with a document that has one. Repeated rows link.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    keys = stored(rows.mapInArrow(_keyed(n, sketch_bits), KEYS), "join-keys")
    sketch = _sketch(keys, sketch_bits)
    cuts, shared = pivots(sketch, fragments), spark.sparkContext.broadcast(sketch)
    owned = keys.filter("block is null").select("doc_id", "n_shingles", "node")
    nodes = owned.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    # Documents all of whose rows repeat the set of an earlier document add no candidates.
    spare = stored(owned.join(nodes, "node").groupBy("doc_id").agg(
        F.min((F.col("doc_id") > F.col("first")).cast("int")).alias("spare")).filter(
        "spare = 1").select("doc_id"), "join-spare")
    chosen = attach(rows, spare, "doc_id", "left_anti")
    prefix = stored(chosen.mapInArrow(_prefixes(n, percent, shared), PREFIX), "join-prefix")
    hubs = prefix.groupBy("token").agg(
        F.count(F.lit(1)).alias("many"), F.min(F.struct("pos", "node", "n")).alias("hub")).filter(
        "many > 1").select("token", F.col("hub.node").alias("node2"),
                           F.col("hub.pos").alias("pos2"), F.col("hub.n").alias("n2"))
    met = stored(prefix.join(hubs, "token"), "join-met")
    discard(prefix)

    def linked(pairs):
        """The pairs `(a, b)` whose exact overlap reaches the Jaccard."""
        many = pairs.count()
        if not many:
            return pairs
        hinted = F.broadcast if many <= BROADCAST_ROWS else (lambda df: df)
        wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(
            nodes, "node").select("node", F.col("first").alias("doc_id")), "join-wanted")
        named = wanted.filter("doc_id is not null").select("doc_id").distinct()
        chosen = attach(rows, named, "doc_id", "left_semi").mapInArrow(
            _parts(n, shared, cuts), PARTS)
        # Sets that only rows without an id hold are found by themselves.
        bare = wanted.filter("doc_id is null").select("node")
        if not bare.isEmpty():
            chosen = chosen.union(attach(rows.filter("doc_id is null").mapInArrow(
                _parts(n, shared, cuts), PARTS), bare, "node", "left_semi"))
        parts = stored(chosen, "join-parts")
        left = parts.withColumnsRenamed({"node": "a", "n": "na", "tokens": "ta"}).join(
            hinted(pairs), "a")
        right = parts.withColumnsRenamed({"node": "b", "n": "nb", "tokens": "tb"}).join(
            hinted(pairs.select("b").distinct()), "b", "left_semi")
        # A repeated document repeats its parts: one count per fragment.
        partial = left.join(right, ["b", "fragment"]).select(
            "a", "b", "na", "nb", "fragment", F.size(F.array_intersect("ta", "tb")).alias("both"))
        summed = partial.groupBy("a", "b", "na", "nb", "fragment").agg(
            F.max("both").alias("both")).groupBy("a", "b", "na", "nb").agg(
            F.sum("both").alias("both"))
        edges = stored(summed.filter(f"100 * both >= {percent} * (na + nb - both)").select(
            "a", "b"), "join-links")
        discard(parts)
        discard(wanted)
        return edges

    def known(pairs, joined):
        """Components of both sides of pairs; a node without links is its own."""
        for side in ("a", "b"):
            names = joined.select(F.col("node").alias(side), F.col("component").alias("c" + side))
            pairs = pairs.join(names, side, "left").withColumn(
                "c" + side, F.coalesce("c" + side, side))
        return pairs

    # First each set with the hub that most of its prefix n-grams name, then with its other hubs
    # where the components still differ.
    named = stored(met.filter((F.col("node") != F.col("node2")) & _room(percent)).groupBy(
        F.col("node").alias("a"), F.col("node2").alias("b")).agg(F.count(F.lit(1)).alias("tokens")),
        "join-hubs")
    closest = named.groupBy("a").agg(F.max(F.struct("tokens", "b")).alias("top"))
    first = stored(closest.select("a", F.col("top.b").alias("b")), "join-pairs")
    edges = linked(first)
    more = stored(known(named.select("a", "b").join(first, ["a", "b"], "left_anti"),
                        components(edges)).filter("ca <> cb").select("a", "b"), "join-pairs")
    tried = first.union(more)
    edges = edges.union(linked(more))
    joined = components(edges)
    # What is left: sets that share a prefix n-gram and are in different components.
    rest = stored(met.select("token", "node", "n", "pos").join(joined, "node", "left").withColumn(
        "component", F.coalesce("component", "node")), "join-rest")
    discard(met)
    open_ = rest.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias(
        "high")).filter("low <> high").select("token")
    rest = rest.join(open_, "token")
    other = rest.select("token", *[F.col(c).alias(c + "2") for c in ("node", "n", "pos",
                                                                     "component")])
    both_ways = tried.union(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    second = rest.join(other, (rest["token"] == other["token"]) & F.expr(
        "node < node2 and component <> component2") & _room(percent)).select(
        F.col("node").alias("a"), F.col("node2").alias("b")).distinct().join(
        both_ways, ["a", "b"], "left_anti")
    found = linked(stored(second, "join-pairs"))
    if not found.isEmpty():
        joined = components(edges.union(found))
    ids = nodes.join(joined, "node", "left").withColumn("component", F.coalesce(
        "component", "node"))
    least = ids.groupBy("component").agg(F.min("first").alias("component_id"))
    named = ids.join(least, "component").select("node", "component_id")
    return owned.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs, n=5, percent=80, sketch_bits=SKETCH_BITS):
    """Rows of `docs` whose document is the first of its component, columns unchanged.

    Of rows that repeat a doc_id and its text all stay together; rows without a doc_id stay.
    """
    found = ngram_join(docs, n, percent, sketch_bits)
    drop = stored(found.filter("component_id <> doc_id").select("doc_id").distinct(), "join-drop")
    return attach(docs, drop, "doc_id", "left_anti")
