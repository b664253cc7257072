"""SpotSigs: fingerprints from chains of content words that follow common-word anchors.

Every common word (anchor) of a text, with the chain of content words after it, is a signature; the
fingerprint is their multiset, which dense menus and lists hardly touch and prose fills. Likeness is
the multiset Jaccard. `similar` finds all alike texts: fingerprints are partitioned by set length,
so that only a partition and the next can hold partners, met through their rarest signatures, and
compared by a Jaccard that stops once the rest cannot reach the threshold.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusprep.llm.common import components, stored
from corpusprep.llm.words import PUNCTUATION, hashed_words, mix, texts

# Common words of English, German, French and Spanish.
ANCHORS = """a an and are as at be but by for from had has have he her his in is it its of on or she
that the their there they this to was were will with you
das dem den der des die ein eine für ist mit nicht sich und von zu
au aux avec ce dans des du elle en est et il la le les ne par pas pour que qui sur un une
como con de del el es esta la las lo los más no para por que se su una y""".split()
CHAIN = 3
_K = np.uint64(0x9E3779B97F4A7C15)


def _words(data, offsets):
    return hashed_words(data, offsets, breaks=PUNCTUATION)


def signatures(data, offsets, chain=CHAIN):
    """Sorted 32-bit signatures of each row of text bytes, repeats kept: `(values, heads)`.

    A chain needs `chain` content words after its anchor inside the text. A text without any
    chain has one signature made of all its words (the empty text too), so that no fingerprint is
    empty and equal texts have equal ones.
    """
    words, heads = _words(data, offsets)
    known = np.frombuffer(" ".join(dict.fromkeys(ANCHORS)).encode(), np.uint8)
    anchor = np.isin(words, _words(known, np.array([0, len(known)]))[0])
    rows = np.repeat(np.arange(len(heads) - 1), np.diff(heads))
    content, content_rows = words[~anchor], rows[~anchor]
    at = np.flatnonzero(anchor)
    after = np.cumsum(~anchor)[at] if len(at) else np.zeros(0, np.int64)
    ends = np.searchsorted(content_rows, rows[at], "right")
    fits = after + chain <= ends
    at, after = at[fits], after[fits]
    value = mix(words[at])
    for k in range(chain):
        value = mix(value * _K + content[after + k])
    owner = rows[at]
    lone = np.setdiff1d(np.arange(len(heads) - 1), owner)
    if len(lone):
        # Order counts here: every word is mixed with its place.
        place = np.arange(len(words)) - heads[:-1][rows]
        whole = np.zeros(len(heads) - 1, dtype=np.uint64)
        np.add.at(whole, rows, mix(words + place.astype(np.uint64) * _K))
        value = np.concatenate([value, mix(whole[lone] + _K)])
        owner = np.concatenate([owner, lone])
    value = (value >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((value, owner))
    return value[order], np.searchsorted(owner[order], np.arange(len(heads)))


def likeness(a, b, least=0.0):
    """Multiset Jaccard of two sorted arrays; 0 when it can't reach `least` (by sizes alone)."""
    small, large = sorted((len(a), len(b)))
    if not large or small < least * large:
        return 0.0
    both = np.concatenate([a, b])
    side = np.concatenate([np.ones(len(a), np.int64), np.full(len(b), 1 << 32)])
    order = np.argsort(both, kind="stable")
    both, side = both[order], side[order]
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    counts = np.add.reduceat(side, first)
    shared = int(np.minimum(counts & 0xFFFFFFFF, counts >> 32).sum())
    return shared / (small + large - shared)


def _split(values, heads):
    return [values[a:b] for a, b in zip(heads[:-1], heads[1:])]


def _of_strings(found):
    """Fingerprints of a list of strings."""
    data, offsets = texts(pa.array(found, pa.large_string()))
    return _split(*signatures(data, offsets))


def text_form(fingerprint):
    """Lower-case hexadecimal, 8 digits a signature, in ascending order."""
    return fingerprint.astype(">u4").tobytes().hex()


def _runs(sizes, limit=1 << 21):
    start, total = 0, 0
    for k, n in enumerate(sizes):
        total += n
        if total >= limit:
            yield start, k + 1
            start, total = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _edited_rows(docs, found, following):
    n = [len(t) for t in found]
    edited = [t[:k - k // 2] + f[:k // 2] for t, f, k in zip(found, following, n)]
    # The next text's fingerprint is mostly the one made for its own row.
    own = _of_strings(found + following[-1:])
    after = own[1:]
    for i in range(len(found) - 1):
        if following[i] is not found[i + 1]:
            after[i] = _of_strings([following[i]])[0]
    new = _of_strings(edited)
    sha = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]
    columns = [pa.array(docs, pa.int64()), pa.array(n, pa.int64()), pa.array(sha),
               pa.array([text_form(f) for f in own[:-1]]), pa.array([text_form(f) for f in new]),
               pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()),
               pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64())]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in EDITED.split(", ")])


def _with_next(batches):
    """Rows come by part, then descending; a part ends with the first row of the part after it."""
    held = None
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        rows = rows if held is None else [held, *rows]
        held = rows[-1] if rows else held
        docs, found, following = [], [], []
        for (part, extra, doc, text), (part2, _, _, text2) in zip(rows, rows[1:]):
            if not extra and part == part2:
                docs.append(doc)
                found.append(text)
                following.append(text2)
        for a, b in _runs([len(t) for t in found]):
            yield _edited_rows(docs[a:b], found[a:b], following[a:b])


def against_edited(docs):
    """Fingerprints of every text of `docs(doc_id, text)` and of its edited text.

    The edited text keeps the first half of the code points (the larger half) and goes on with as
    many as were cut from the next document in descending doc_id (after the last: the first).
    Null texts are empty; null doc_ids come last; rows sharing a doc_id go by text, descending. The
    texts are dealt out once, by ranges of doc_id; each range also gets the row that follows it.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = rows.select("doc_id").approxQuantile(
        "doc_id", [k / parts for k in range(1, parts)], 0.1 / parts) if parts > 1 else []
    bounds = sorted({int(b) for b in bounds})
    part = F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<long>"),
                                      lambda b: b <= F.col("doc_id"))), F.lit(0))
    cut = rows.withColumn("part", part)
    # One row per part: the first doc_id of each, and the part that it ends.
    heads = cut.groupBy("part").agg(F.max("doc_id").alias("head")).orderBy(
        F.desc("part")).collect()
    ends = spark.createDataFrame(
        [(heads[k - 1]["part"], r["head"], r["part"]) for k, r in enumerate(heads)],
        "ends int, head long, own int")
    extra = cut.join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("head")) & (
        F.col("part") == F.col("own"))).select(F.col("ends").alias("part"), F.lit(1).alias(
            "extra"), "doc_id", "text")
    ordered = cut.select("part", F.lit(0).alias("extra"), "doc_id", "text").union(
        extra).repartition("part").sortWithinPartitions(
        "part", "extra", F.col("doc_id").desc_nulls_last(), F.desc("text"))
    return ordered.mapInArrow(_with_next, EDITED)


def _sets(batches):
    for batch in batches:
        found = batch.column(1).fill_null("").to_pylist()
        for a, b in _runs([len(t) for t in found]):
            values, heads = signatures(*texts(pa.array(found[a:b], pa.large_string())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[a:b],
                 pa.ListArray.from_arrays(pa.array(heads.astype(np.int32)),
                                          pa.array(values.astype(np.int64)))],
                ["doc_id", "signatures"])


def fingerprints(docs):
    """`(doc_id, signatures)`: the sorted multiset of every whole text."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _sets, "doc_id long, signatures array<long>")


def similar(docs, least=0.8):
    """`(doc_id, class_id)`: documents joined by chains of likeness of at least `least`.

    Equal fingerprints are one node. Copies of a signature within a text are told apart by their
    number, which makes the multisets plain sets.
    """
    sets = stored(fingerprints(docs).withColumn("node", F.xxhash64("signatures")), "spots")
    numbered = F.transform("signatures", lambda s, i: F.xxhash64(
        s, i - F.array_position("signatures", s)))
    nodes = stored(sets.groupBy("node").agg(
        F.min("doc_id").alias("doc"), F.first("signatures").alias("signatures")).select(
        "node", "doc", F.size("signatures").alias("n"),
        F.array_sort(numbered).alias("marks")), "spot-nodes")
    # Partition p holds lengths in [least**-p, least**-(p+1)): partners lie in p or p + 1.
    lengths = F.floor(F.log(F.col("n").cast("double")) / -np.log(least)).cast("int")
    first = F.expr(f"slice(marks, 1, cast(n - ceil({least} * n) + 1 as int))")
    met = nodes.select("node", "n", lengths.alias("p"), F.explode(first).alias("mark"))
    left = met.withColumn("q", F.explode(F.array(F.col("p"), F.col("p") + 1)))
    right = met.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("p").alias("q"),
                       F.col("mark").alias("mark2"))
    pairs = left.join(right, (left["q"] == right["q"]) & (left["mark"] == right["mark2"]) & F.expr(
        f"n <= nb and n >= {least} * nb and node <> b and (n < nb or node < b)")).select(
        F.col("node").alias("a"), "b").distinct()
    small = nodes.select(F.col("node").alias("a"), F.col("marks").alias("ma"))
    large = nodes.select(F.col("node").alias("b"), F.col("marks").alias("mb"))
    shared = F.size(F.array_intersect("ma", "mb"))
    edges = pairs.join(small, "a").join(large, "b").filter(
        shared >= least * (F.size("ma") + F.size("mb") - shared)).select("a", "b")
    joined = components(stored(edges, "spot-links"))
    named = nodes.join(joined, "node", "left").withColumn("c", F.coalesce("component", "node"))
    ids = named.join(named.groupBy("c").agg(F.min("doc").alias("class_id")), "c")
    return sets.select("doc_id", "node").join(ids.select("node", "class_id"), "node").select(
        "doc_id", "class_id")
