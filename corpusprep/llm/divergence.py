"""How the sources of a language differ in their words, by single-pass in-memory indexing.

Index. Each task reads its texts once and builds a block in memory: per term the postings
`(source, occurrences)` and the number of documents. When the block holds `MEMORY` postings it is
spilled as a run: sorted by term, cut by the hash of the term into shards, each shard into chunks.
One task per shard then merges the runs with a heap: chunks come sorted by their first term, so a run's
chunk is opened when its first term is due and dropped at its end, and a term's postings of
all runs meet at the top of the heap. Terms in fewer than `least` documents of their language go
there; the rest are written as frequencies.

Divergence. Every source gives every kept term a smoothed probability in billionths, in exact
integers. Two sources differ, over all terms, as if neither had any word, which needs one number per
source; each term that occurs corrects that sum. A term of one source only moves the sum by an
amount that depends on its count and the other source's number, so those terms are grouped by count
first; only terms that both have are paired.
"""

import heapq
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusprep.llm.common import attach, discard, stored

#: Postings that a block holds before it is spilled, and terms in a chunk of a run.
MEMORY = 1 << 20
CHUNK = 512
#: Characters of a text worked on at a time.
PIECE = 1 << 21
SCALE = 1_000_000_000
SMOOTH = 5
#: UTF-8 bytes with A to Z lower-cased, and a space for every ASCII byte that is no letter.
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 32 for b in bytes(range(256)).lower())
RUNS = ("shard int, lang string, first binary, terms array<binary>, docs array<long>, "
        "ends array<int>, sources array<string>, counts array<long>")
FREQUENCIES = "lang string, term string, source string, count long"


def _terms(text):
    """Terms of a text, a piece at a time; only A to Z are lower-cased."""
    data = text.encode().translate(_LETTERS)
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        if end < len(data):
            # Back to where no term is cut, or on to the end of one that fills the piece.
            edge = data.rfind(b" ", at, end) + 1 or data.find(b" ", end) + 1
            end = edge or len(data)
        yield data[at:end].split()
        at = end


class Block:
    """Postings in memory: occurrences by (lang, source) and documents by lang, per term."""

    def __init__(self):
        self.occurrences, self.documents = {}, {}

    def add(self, lang, source, text):
        counts = self.occurrences.setdefault((lang, source), Counter())
        seen = set()
        for terms in _terms(text):
            counts.update(terms)
            seen.update(terms)
        self.documents.setdefault(lang, Counter()).update(seen)

    def size(self):
        return sum(map(len, self.occurrences.values()))

    def run(self, shards, chunk=CHUNK):
        """Chunks `(shard, lang, [(term, documents, [(source, occurrences)])])`, sorted by term
        inside a language and shard."""
        for lang, documents in self.documents.items():
            posts = {}
            for (at, source), counts in self.occurrences.items():
                if at == lang:
                    for term, n in counts.items():
                        held = posts.get(term)
                        if held is None:
                            posts[term] = [(source, n)]
                        else:
                            held.append((source, n))
            by_shard = {}
            for term in sorted(documents):
                by_shard.setdefault(zlib.crc32(term) % shards, []).append(term)
            for shard, terms in by_shard.items():
                for at in range(0, len(terms), chunk):
                    yield shard, lang, [(t, documents[t], posts[t]) for t in terms[at:at + chunk]]


def _row(shard, lang, entries):
    posts = [p for e in entries for p in e[2]]
    ends, at = [], 0
    for e in entries:
        at += len(e[2])
        ends.append(at)
    return (shard, lang, entries[0][0], [e[0] for e in entries], [e[1] for e in entries], ends,
            [p[0] for p in posts], [p[1] for p in posts])


_RUN_TYPES = [pa.int32(), pa.string(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()),
              pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64())]
_RUN_NAMES = [f.split(" ")[0] for f in RUNS.split(", ")]


def _batch(rows, types, names):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _spilled(shards, memory):
    """Runs of a task's documents `(text, lang, source)`."""
    def run(batches):
        def spill(block):
            rows = []
            for part in block.run(shards):
                rows.append(_row(*part))
                if len(rows) >= 64:
                    yield _batch(rows, _RUN_TYPES, _RUN_NAMES)
                    rows = []
            if rows:
                yield _batch(rows, _RUN_TYPES, _RUN_NAMES)

        block, since = Block(), 0
        for batch in batches:
            for text, lang, source in zip(*(c for c in batch.columns)):
                text = text.as_py()
                if text:
                    block.add(lang.as_py(), source.as_py(), text)
                since += len(text)
                # New postings are at most the characters read, so the block is measured seldom.
                if since >= memory:
                    since = 0
                    if block.size() >= memory:
                        yield from spill(block)
                        block = Block()
        yield from spill(block)
    return run


def _entries(row):
    _, _, _, terms, docs, ends, sources, counts = row
    at = 0
    for term, n, end in zip(terms, docs, ends):
        yield term, n, sources[at:end], counts[at:end]
        at = end


def merged(chunks):
    """`(lang, term, documents, {source: occurrences})` from chunk rows sorted by language and first
    term. A heap holds the next entry of every open chunk."""
    chunks = iter(chunks)
    coming, heap, order = next(chunks, None), [], 0
    while coming or heap:
        key = heap[0][:2] if heap else coming[1:3]
        while coming and tuple(coming[1:3]) <= tuple(key):
            entries = _entries(coming)
            heapq.heappush(heap, (coming[1], coming[2], order, next(entries), entries))
            order += 1
            key = heap[0][:2]
            coming = next(chunks, None)
        lang, term = heap[0][:2]
        documents, posts = 0, {}
        while heap and heap[0][:2] == (lang, term):
            _, _, at, (_, n, sources, counts), entries = heap[0]
            documents += n
            for s, c in zip(sources, counts):
                posts[s] = posts.get(s, 0) + c
            following = next(entries, None)
            if following:
                heapq.heapreplace(heap, (lang, following[0], at, following, entries))
            else:
                heapq.heappop(heap)
        yield lang, term, documents, posts


def _rows(batch):
    """Rows of a batch as lists; the values of a list column are made in one go."""
    def listed(column):
        if not pa.types.is_list(column.type):
            return column.to_pylist()
        ends = column.offsets.to_pylist()
        # What the offsets count from; a slice does not begin at its values' first.
        values = column.values.slice(ends[0], ends[-1] - ends[0]).to_numpy(
            zero_copy_only=False).tolist()
        return [values[a - ends[0]:b - ends[0]] for a, b in zip(ends, ends[1:])]
    return zip(*map(listed, batch.columns))


def _frequencies(least, rows_out=1 << 15):
    names, types = zip(*[("lang", pa.string()), ("term", pa.string()), ("source", pa.string()),
                         ("count", pa.int64())])

    def run(batches):
        def rows():
            for batch in batches:
                yield from _rows(batch)

        def by_shard(given):
            # Shards of one task come one after another, each sorted by language and term.
            ahead = next(given, None)
            while ahead:
                shard = ahead[0]

                def one():
                    nonlocal ahead
                    while ahead and ahead[0] == shard:
                        now, ahead = ahead, next(given, None)
                        yield now
                yield one()

        out = []
        for shard in by_shard(rows()):
            for lang, term, documents, posts in merged(shard):
                if documents >= least:
                    name = term.decode()
                    out += [(lang, name, s, c) for s, c in posts.items()]
                    if len(out) >= rows_out:
                        yield _batch(out, types, names)
                        out = []
        if out:
            yield _batch(out, types, names)
    return run


def frequencies(docs, least=30, memory=MEMORY, shards=None):
    """`(lang, term, source, count)` of terms in at least `least` rows of their language; `docs` has
    non-null text, lang, source."""
    spark = docs.sparkSession
    shards = shards or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = docs.select("text", "lang", "source").mapInArrow(_spilled(shards, memory), RUNS)
    dealt = runs.repartition(shards, "shard").sortWithinPartitions("shard", "lang", "first")
    return stored(dealt.mapInArrow(_frequencies(least), FREQUENCIES), "term-frequencies")


def _p(count, mass):
    """Smoothed probability in billionths, in whole decimals."""
    return (F.expr(f"({SCALE}BD * ({count} + {SMOOTH})) div {mass}") + 1).cast("long")


def divergence(docs, least=30, top=50, memory=MEMORY, shards=None):
    """`(lang, source, part, item, value, rank)` for every (lang, source) of `docs`.

    Part `pair`: each other source of the language with the sum, over all kept terms, of the
    absolute differences of probability. Part `term`: the `top` terms that the source uses and gives
    more probability than its language does, with the difference. Null text, lang and source are
    empty strings; rows count as documents whatever their doc_id, repeated ones each. A language
    without kept terms has pairs of value 0. An empty table gives an empty result.
    """
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in (
        "text", "lang", "source")])
    found = frequencies(rows, least, memory, shards)
    per_lang = found.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"))
    langs = per_lang.groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("lang_count").alias("lang_n"))
    groups = rows.groupBy("lang", "source").count().drop("count")
    own = found.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    # One row per group; zero stands in where a language or a group has no kept term.
    mass = F.expr(f"cast(n + {SMOOTH} * v as decimal(20,0))")
    facts = stored(groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(
        0, ["n", "v", "lang_n"]).withColumn("mass", mass).select(
        "lang", "source", "v", "lang_n", "mass", F.when(F.col("v") > 0, _p(
            "0", "nullif(mass, 0)")).otherwise(0).alias("p0")), "term-groups")
    many = facts.count()
    used = stored(attach(found, facts.drop("v", "lang_n"), ["lang", "source"],
                         rows_of_small=many).withColumn("p", _p("count", "mass")).select(
        "lang", "term", "source", "count", "p", "p0"), "term-used")

    # Terms: what the whole language gives each.
    q = per_lang.join(F.broadcast(langs) if many <= 1 << 19 else langs, "lang").withColumn(
        "lang_mass", F.expr(f"cast(lang_n + {SMOOTH} * v as decimal(20,0))")).select(
        "lang", "term", _p("lang_count", "lang_mass").alias("q"))
    over = used.join(q, ["lang", "term"]).filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.col("p") - F.col("q")).alias("value"))

    # Pairs: all terms as if no source had any, then the corrections.
    a = facts.select("lang", "source", "v", F.col("p0").alias("p0a"))
    b = facts.select("lang", F.col("source").alias("item"), F.col("p0").alias("p0b"))
    pairs = a.join(b, "lang").filter("source <> item")
    base = pairs.select("lang", "source", "item", (F.col("v") * F.abs(
        F.col("p0a") - F.col("p0b"))).alias("value"))
    # Terms of one side, by their probability there: what they change against each other source.
    levels = used.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("terms"))
    one_side = levels.join(b, "lang").filter("source <> item").groupBy(
        "lang", "source", "item").agg(F.sum(F.col("terms") * (
            F.abs(F.col("p") - F.col("p0b")) - F.abs(F.col("p0") - F.col("p0b")))).alias("value"))
    # Terms of both sides: the difference itself in place of the two changes counted so far.
    met = used.groupBy("lang", "term").agg(F.sort_array(F.collect_list(
        F.struct("source", "p", "p0"))).alias("s")).filter("size(s) > 1").select(
        "lang", F.posexplode("s").alias("at", "x"), "s").select(
        "lang", "x", F.explode(F.expr("slice(s, at + 2, size(s))")).alias("y"))
    both = met.groupBy("lang", F.col("x.source").alias("source"), F.col("y.source").alias(
        "item")).agg(F.sum(F.expr("""abs(x.p - y.p) - abs(x.p - y.p0) - abs(x.p0 - y.p)
            + abs(x.p0 - y.p0)""")).alias("value"))

    def turned(df):
        return df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                         "value")

    summed = base.unionByName(one_side).unionByName(turned(one_side)).unionByName(
        both).unionByName(turned(both)).groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value")).withColumn("part", F.lit("pair"))
    place = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = [df.withColumn("rank", place).select("lang", "source", "part", "item", "value", "rank")
              for df in (summed, over)]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top))
