"""Byte-level BPE: word counts, training, encoding, decoding, vocabulary growth."""

from dataclasses import dataclass, field
from functools import reduce
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.constants import BOS, EOS, MIN_FREQUENCY, PAD, SPECIAL_TOKENS, UNK, USER, VOCAB_SIZE
from corpusprep.functions.text import (
    BYTE_ALPHABET, byte_pieces, normalize_segments, normalize_text, raw_words)
from corpusprep.plans.lineage import cut, delete, scratch_path
from corpusprep.plans.scan import position
from corpusprep.schemas import MERGES, VOCAB

# Merges go by (count, left id, right id); this many leading pairs are looked at per round.
_LEADERS = 256
# Words are found through the pair index once a round touches less than one in so many, and the
# table has more words than are read over in less time than an index takes to look up.
_RARE, _SMALL = 8, 1 << 20
# Generations of rewritten words laid over the word table, and pair buckets of the index.
_LAYERS = 8
_BUCKETS = 64
# Up to so many entries a model is trained by proposals, which takes a square table of them; and up to
# so many times _SMALL words.
_SQUARE, _PASSED = 2048, 256
# Most frequent words that proposals start from, and merges proposed at a time.
_KNOWN, _PROPOSED = 1 << 15, 512
# Rows that a task sums before it hands them on.
_SUMMED = 1 << 21
# Words that may be broadcast by id.
_BROADCAST = 1 << 19
_BYTE_OF = {symbol: b for b, symbol in enumerate(BYTE_ALPHABET)}
_NUMERIC = frozenset(s for s in BYTE_ALPHABET if s.isnumeric())
# Words a task remembers.
_REMEMBERED = 1 << 18


@dataclass
class BpeModel:
    """Tokens by id and merges `(left_id, right_id, new_id)` by rank; at most vocab_size each."""

    tokens: list
    merges: list = field(default_factory=list)

    def frames(self, spark):
        """Vocabulary and merges as tables."""
        vocab = spark.createDataFrame([(t, i) for i, t in enumerate(self.tokens)], VOCAB)
        merges = spark.createDataFrame([(r, *m) for r, m in enumerate(self.merges)], MERGES)
        return vocab, merges

    def special_id(self, name):
        """Id of a token, None when absent."""
        return self.tokens.index(name) if name in self.tokens else None


def word_counts(df, text_col="text"):
    """`word, n` over all texts. Raw words are counted first and split into pretokens after."""
    raw = df.select(F.explode(raw_words(normalize_text(F.col(text_col)))).alias("raw"))
    counted = raw.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    pieces = counted.select(F.explode(byte_pieces(F.col("raw"))).alias("word"), "n")
    return pieces.groupBy("word").agg(F.sum("n").alias("n"))


def _mergeable(leaders, complete, room):
    """The leading pairs that can be merged in one round, in order.

    A pair joins while it shares no symbol with an earlier one and its count is above anything
    the earlier merges can create. A new pair with (a, b) is no more frequent than (a, b), nor
    than the most frequent pair ending in a or starting with b.
    """
    floor = 0 if complete else leaders[-1][2]
    ending, starting = {}, {}
    for left, right, count in leaders:
        ending[right] = max(ending.get(right, floor), count)
        starting[left] = max(starting.get(left, floor), count)
    chosen, used, bound = [], set(), 0
    for left, right, count in leaders[:room]:
        if chosen and (left == right or {left, right} & used or count <= bound):
            break
        chosen.append((left, right))
        if left == right:
            break
        used |= {left, right}
        bound = max(bound, min(count, max(ending.get(left, floor), starting.get(right, floor))))
    return chosen


def _independent(leaders, room):
    """`(chosen, skipped)`: leading pairs, in order, of which none takes occurrences from a later
    one, each with the number of pairs skipped before it. A pair is skipped when an earlier one takes
    from it; how much is known once that is merged, so no pair after it may take from it as well.
    """
    chosen, skipped = [], []
    ends, starts, late_ends, late_starts = set(), set(), set(), set()
    for left, right, count in leaders:
        # Occurrences overlap only where one pair goes on where another ends.
        if len(chosen) == room or chosen and (
                left == right or left in late_ends or right in late_starts):
            break
        if right in starts or left in ends:
            skipped.append((left, right))
            late_starts.add(left)
            late_ends.add(right)
            continue
        chosen.append((left, right, count, len(skipped)))
        if left == right:
            break
        starts.add(left)
        ends.add(right)
    return chosen, skipped


def _pairs(words, sign="n"):
    """`(a, b, c)` of each adjacent pair of each word ` 12  45 `."""
    return (words.selectExpr("split(trim(w), '  ') AS s", f"{sign} AS c")
            .selectExpr("c", "slice(s, 1, size(s) - 1) AS a", "slice(s, 2, size(s) - 1) AS b")
            .selectExpr("c", "inline(arrays_zip(a, b))")
            .selectExpr("int(a) AS a", "int(b) AS b", "c"))


def _rewritten(words, merges):
    """Apply `(left, right, new)` merges to every word; `old` keeps it, null where it is the same."""
    # One expression whatever the merges are, so its generated code is compiled once.
    pairs = ", ".join(f"array(' {a}  {b} ', ' {new} ')" for a, b, new in merges)
    return words.selectExpr("wid", "n", "w AS before", (
        f"aggregate(array({pairs}), w, (x, m) -> replace(x, m[0], m[1])) AS w")).selectExpr(
        "wid", "n", "nullif(before, w) IS NOT NULL AS changed", "before", "w")


class _PairIndex:
    """Word table, pair counts, and pair -> words, all as written tables.

    `counts(a, b, c)` is kept by differences: a round adds, for the words it changes, their pairs after
    less their pairs before. Words are ` 12  45 `, ids in spaces, so that a merge is one string
    replacement. While a round changes many words the table is written anew; later the index gives
    the words of a pair, and the few that change are laid over the table as a generation until
    there are enough of those to write both anew.
    """

    def __init__(self, words):
        self.spark = words.sparkSession
        self.base = self._write(words)
        self.size = self.base.count()
        self.layers, self.index = [], None
        self.counts = self._write(self._summed(_pairs(self.base)))

    def _write(self, df, *by):
        path = scratch_path(self.spark, "bpe")
        (df.write.partitionBy(*by) if by else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @staticmethod
    def _summed(pairs):
        return pairs.groupBy("a", "b").agg(F.sum("c").alias("c")).filter("c <> 0")

    @staticmethod
    def _bucket(a, b):
        return (a * 31 + b) % _BUCKETS

    def leaders(self, min_frequency):
        found = self.counts.filter(F.col("c") >= min_frequency).orderBy(
            F.desc("c"), "a", "b").limit(_LEADERS).collect()
        return [(r["a"], r["b"], r["c"]) for r in found]

    def _current(self, wids=None, small=True):
        """The newest form of all words or of those in `wids`."""
        tables = [t.select("wid", "n", "w", F.lit(k).alias("age"))
                  for k, t in enumerate([self.base, *self.layers])]
        if wids is not None:
            tables = [t.join(F.broadcast(wids) if small else wids, "wid", "left_semi")
                      for t in tables]
        if len(tables) == 1:
            return tables[0].drop("age")
        every = reduce(DataFrame.unionByName, tables)
        return every.groupBy("wid").agg(F.max_by(F.struct("n", "w"), "age").alias("x")).select(
            "wid", "x.n", "x.w")

    def _holding(self, merges):
        """Ids of the words that hold, or held, one of the pairs."""
        keys = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b, _ in merges]
        wanted = F.struct("a", "b").isin(*keys)
        # The buckets are folders, so only those of the pairs are read.
        buckets = sorted({self._bucket(a, b) for a, b, _ in merges})
        found = [self.index.filter(F.col("bucket").isin(buckets) & wanted).select("wid")]
        found += [_pairs(t.withColumnRenamed("wid", "m"), "m").filter(wanted).selectExpr(
            "c AS wid") for t in self.layers]
        return reduce(DataFrame.union, found).distinct()

    def merge(self, merges, touched):
        """Merge pairs everywhere. `touched` bounds the words that hold them. Returns what `keep`
        takes: nothing changes until then."""
        if self.index is None:
            made = self._write(_rewritten(self._current(), merges))
            changed = made.filter("changed")
        else:
            wids = self._holding(merges)
            made = self._write(_rewritten(self._current(wids, touched <= _BROADCAST), merges).filter(
                "changed"))
            changed = made
        after = _pairs(changed)
        before = _pairs(changed.selectExpr("n", "before AS w"), "-n")
        counts = self._write(self._summed(self.counts.union(after).union(before)))
        return made, touched, counts

    def keep(self, state):
        made, touched, counts = state
        delete(self.counts)
        self.counts = counts
        # A word of one symbol has no pairs left.
        if self.index is not None:
            self.layers.append(made)
            if len(self.layers) >= _LAYERS:
                self._renew()
            return
        delete(self.base)
        self.base = made.select("wid", "n", "w")
        if touched * _RARE < self.size and self.size > _SMALL:
            self._renew()

    def drop(self, state):
        delete(state[0])
        delete(state[2])

    def _renew(self):
        old = [self.base, *self.layers, *([self.index] if self.index is not None else [])]
        self.base = self._write(self._current().filter(F.contains("w", F.lit("  "))))
        self.size, self.layers = self.base.count(), []
        pairs = _pairs(self.base.withColumn("m", F.col("wid")), "m").withColumnRenamed(
            "c", "wid").distinct()
        # A frequent pair's words are cut into files by the writing tasks, not gathered.
        self.index = self._write(pairs.withColumn("bucket", self._bucket(F.col("a"), F.col("b"))), "bucket")
        for table in old:
            delete(table)

    def close(self):
        for table in [self.base, self.counts, *self.layers, *(
                [self.index] if self.index is not None else [])]:
            delete(table)


def _afterwards(counts, merges, first, skipped):
    """What a round has to be checked by: for each new id the largest count that a pair with it had
    at any time within the round (a neighbour that was merged later counts as the symbol it
    began, or ended, with), and the counts of the skipped pairs."""
    def origin(side, column):
        pairs = [F.lit(x) for m in merges for x in (m[2], m[side])]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.col(column))

    left = counts.filter(F.col("a") >= first).groupBy(F.col("a").alias("id"), origin(
        0, "b").alias("o")).agg(F.sum("c").alias("c"))
    right = counts.filter(F.col("b") >= first).groupBy(F.col("b").alias("id"), origin(
        1, "a").alias("o")).agg(F.sum("c").alias("c"))
    # One row per merge and skipped pair of the round.
    rows = left.union(right).groupBy("id").agg(F.max("c").alias("c")).select(
        F.col("id").alias("a"), F.lit(-1).alias("b"), "c")
    if skipped:
        rows = rows.union(counts.select("a", "b", "c").filter(F.struct("a", "b").isin(*[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in skipped])))
    found = {(r["a"], r["b"]): r["c"] for r in rows.collect()}
    return {a: c for (a, b), c in found.items() if b < 0}, [found.get(p, 0) for p in skipped]


class _Symbols:
    """Words as one array of ids with a gap (-1) before, between and after them; `n` has the count of
    each place's word. A pair is named `left * entries + right`."""

    def __init__(self, words, n, by_point, entries):
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        ends = np.cumsum(lengths)
        ids = np.where(points < len(by_point), by_point[np.minimum(points, len(by_point) - 1)], -2)
        ids = np.concatenate([[-1], np.insert(ids, ends, -1)])
        counts = np.concatenate([[0], np.insert(np.repeat(n, lengths), ends, 0)])
        self.ids, self.n = ids[ids > -2].astype(np.int32), counts[ids > -2].astype(np.int64)
        self.entries = entries

    def copy(self):
        other = object.__new__(_Symbols)
        other.ids, other.n, other.entries = self.ids.copy(), self.n, self.entries
        return other

    def pairs(self, at):
        """Names and counts of the pairs at places."""
        a, b = self.ids[at], self.ids[at + 1]
        real = (a >= 0) & (b >= 0)
        return a[real].astype(np.int64) * self.entries + b[real], self.n[at][real]

    def merge(self, left, right, new, wanted=True):
        """Merge a pair, leftmost first; names of pairs and what their counts change by."""
        at = np.flatnonzero((self.ids[:-1] == left) & (self.ids[1:] == right))
        if left == right and len(at):
            # Of a run of places every other one, from its start.
            starts = np.concatenate([[True], np.diff(at) > 1])
            at = at[(at - np.maximum.accumulate(np.where(starts, at, 0))) % 2 == 0]
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if wanted:
            gone, less = self.pairs(np.unique(np.concatenate([at - 1, at, at + 1])))
        self.ids[at] = new
        keep = np.ones(len(self.ids), dtype=bool)
        keep[at + 1] = False
        self.ids, self.n = self.ids[keep], self.n[keep]
        if wanted:
            now = at - np.arange(len(at))
            come, more = self.pairs(np.unique(np.concatenate([now - 1, now])))
            return _summed_keys(np.concatenate([gone, come]), np.concatenate([-less, more]))


def _summed_keys(keys, values):
    """Distinct keys and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


def _changes(words, by_point, entries, done, proposed):
    """`(step, pair, c)`: how each merge of `proposed`, one after another, changes the counts of
    pairs, after the merges `done`; with none proposed the counts themselves, as step 0. Sums over all
    words, so their number goes by the entries, not by the words."""
    square = entries * entries

    def run(batches):
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(keys // square, pa.int32()), pa.array(keys % square), pa.array(sums)],
                ["step", "pair", "c"])

        for batch in batches:
            symbols = _Symbols(batch.column(0).to_pylist(), batch.column(1).to_numpy(
                zero_copy_only=False), by_point, entries)
            for merge in done:
                symbols.merge(*merge, wanted=False)
            found = [(0, *symbols.pairs(np.arange(len(symbols.ids) - 1)))] if not proposed else [
                (step, *symbols.merge(*merge)) for step, merge in enumerate(proposed)]
            keys, sums = _summed_keys(
                np.concatenate([keys, *[k + step * square for step, k, _ in found]]),
                np.concatenate([sums, *[c for _, _, c in found]]))
            if len(keys) > _SUMMED:
                yield rows()
                keys, sums = keys[:0], sums[:0]
        yield rows()

    found = words.mapInArrow(run, "step int, pair long, c long").groupBy("step", "pair").agg(
        F.sum("c").alias("c")).filter("c <> 0").toArrow()
    steps, pairs, sums = (found.column(c).to_numpy() for c in ("step", "pair", "c"))
    order = np.argsort(steps, kind="stable")
    cuts = np.searchsorted(steps[order], np.arange(1, max(1, len(proposed))))
    return list(zip(np.split(pairs[order], cuts), np.split(sums[order], cuts)))


def _next(counts, tokens, ids, entries, least):
    """The most frequent pair, ties to the smallest ids, as a merge; None when it is too rare."""
    pair = int(counts.argmax())
    if counts[pair] < least or len(tokens) >= entries:
        return None
    left, right = divmod(pair, entries)
    return left, right, ids.get(tokens[left] + tokens[right], len(tokens))


def _take(merge, tokens, ids):
    left, right, new = merge
    if new == len(tokens):
        tokens.append(tokens[left] + tokens[right])
        ids[tokens[new]] = new


def _propose(counts, symbols, tokens, entries, least, seen):
    """Likely merges from here on; the first one is certain. `counts` are those of all words. A merge
    changes them as it did when it was last tried on all words (`seen`), or else as it
    does in `symbols`, some of the words, in proportion."""
    counts, symbols, tokens = counts.astype(np.float64), symbols.copy(), list(tokens)
    ids, out = {t: i for i, t in enumerate(tokens)}, []
    while len(out) < _PROPOSED and (merge := _next(counts, tokens, ids, entries, least)):
        out.append(merge)
        _take(merge, tokens, ids)
        left, right, _ = merge
        pair = left * entries + right
        keys, change = symbols.merge(*merge)
        known = seen.get((tokens[left], tokens[right]))
        if known:
            # Tokens may have got other ids since.
            names, keys, change = known
            now = np.array([ids.get(t, -1) for t in names])
            a, b = now[keys // entries], now[keys % entries]
            keys, change = (a * entries + b)[(a >= 0) & (b >= 0)], change[(a >= 0) & (b >= 0)]
        elif len(keys):
            change = change * (counts[pair] / max(1, -change[keys == pair].sum()))
        counts[keys] += change
        counts[pair] = 0
    return out


def _train_by_proposals(words, tokens, vocab_size, min_frequency, by_point):
    """Add to `tokens`; the merges, as one at a time would find them.

    Each round proposes many merges in a row and goes over all words once, to sum what each
    would change. With these sums the driver follows the counts of pairs and takes the proposed
    merges up to the first that was not the next one. That one is known then, and so is what the
    others change, so the next round comes further. The driver holds a square table of entries.
    """
    entries, least = vocab_size, max(1, min_frequency)
    by_point, ids = np.array(by_point), {t: i for i, t in enumerate(tokens)}
    counts = np.zeros(entries * entries, dtype=np.int64)
    (pairs, sums), = _changes(words, by_point, entries, [], [])
    counts[pairs] = sums
    known = words.orderBy(F.desc("n"), "word").limit(_KNOWN).collect()
    symbols = _Symbols([r["word"] for r in known], np.array(
        [r["n"] for r in known], dtype=np.int64), by_point, entries)
    merges, seen = [], {}
    while _next(counts, tokens, ids, entries, least):
        proposed = _propose(counts, symbols, tokens, entries, least, seen)
        names = list(tokens)
        for left, right, new in proposed:
            if new == len(names):
                names.append(names[left] + names[right])
        same = True
        for merge, (pairs, change) in zip(proposed, _changes(
                words, by_point, entries, merges, proposed)):
            same = same and merge == _next(counts, tokens, ids, entries, least)
            if same:
                _take(merge, tokens, ids)
                merges.append(merge)
                symbols.merge(*merge, wanted=False)
                counts[pairs] += change
            seen[names[merge[0]], names[merge[1]]] = names, pairs, change
    return merges


def special_id(name, model):
    """Id of a special token named by a column, null when it is none or the model lacks it."""
    pairs = [F.lit(x) for t in SPECIAL_TOKENS if t in model.tokens
             for x in (t, model.tokens.index(t))]
    ids = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,int>")
    return F.try_element_at(ids, name)


def train_bpe(counts, vocab_size=VOCAB_SIZE, min_frequency=MIN_FREQUENCY, all_bytes=False):
    """Learn merges from `counts(word, n)`. With `all_bytes` all 256 byte symbols are in the
    alphabet, else those that occur.

    Next is the most frequent pair, ties to the smallest ids. Words stay distributed. Up to _SQUARE
    entries `_train_by_proposals` finds the merges in a few passes over the words. For more, pair
    counts and an index from
    pairs to words stay distributed, too (see `_PairIndex`); a round rewrites only words that hold one of
    its pairs and brings only the leading pairs to the driver. It merges as many leading pairs as do
    not take occurrences from each other, then looks whether a pair that came up meanwhile was
    due before one of them; if so that round is done again up to there. The counts must hold no
    word twice and no null.
    """
    # Small as bytes but costly per row, so spread over all cores rather than by size.
    cores = counts.sparkSession.sparkContext.defaultParallelism
    counts = cut(counts.select("word", "n").repartition(cores, "word"))
    # Byte symbols: 256 at most.
    letters = counts.select(F.explode(F.split("word", "")).alias("c")).distinct().collect()
    alphabet = set(BYTE_ALPHABET) if all_bytes else set()
    tokens = SPECIAL_TOKENS + sorted(alphabet | {r[0] for r in letters if r[0]})
    ids = {t: i for i, t in enumerate(tokens)}
    points = [ids.get(chr(c), UNK) for c in range(512)]
    if vocab_size <= _SQUARE and len(tokens) < vocab_size and counts.count() <= _PASSED * _SMALL:
        merges = _train_by_proposals(counts, tokens, vocab_size, min_frequency, points)
        return BpeModel(tokens, merges)
    by_point = F.array(*[F.lit(i) for i in points])
    as_ids = F.transform(F.split("word", ""), lambda c: F.concat(
        F.lit(" "), F.get(by_point, F.ascii(c)).cast("string"), F.lit(" ")))
    # The id has to be the same whenever a lost partition is worked out again.
    index = _PairIndex(counts.filter(F.length("word") > 1).select(
        F.xxhash64("word").alias("wid"), "n", F.array_join(as_ids, "").alias("w")))
    merges, limit = [], 1
    leaders = index.leaders(min_frequency) if len(tokens) < vocab_size else []
    while leaders and len(tokens) < vocab_size:
        room = vocab_size - len(tokens)
        certain = _mergeable(leaders, len(leaders) < _LEADERS, room)
        chosen = []
        batch, skipped = _independent(leaders, room)
        for at, (left, right, count, before) in enumerate(batch[:max(limit, len(certain))]):
            known = ids.get(tokens[left] + tokens[right])
            if known is not None and at:
                # A second way to spell a token changes other counts: leave it for a round alone.
                break
            chosen.append((left, right, len(tokens) + at if known is None else known, count, before))
            if known is not None:
                break
        first = len(tokens)
        state = index.merge([m[:3] for m in chosen], sum(m[3] for m in chosen))
        if len(chosen) > max(1, len(certain)):
            peak, left_over = _afterwards(state[2], chosen, first, skipped[:chosen[-1][4]])
            highest, sure = 0, 0
            for left, right, new, count, before in chosen:
                if sure and count <= max([highest, *left_over[:before]]):
                    break
                sure += 1
                highest = max(highest, peak.get(new, 0))
            if sure < len(chosen):
                index.drop(state)
                chosen, limit = chosen[:sure], sure
                state = index.merge([m[:3] for m in chosen], sum(m[3] for m in chosen))
            else:
                limit = 2 * len(chosen)
        else:
            limit = max(limit, 2 * len(chosen))
        index.keep(state)
        for left, right, new, *_ in chosen:
            if new == len(tokens):
                tokens.append(tokens[left] + tokens[right])
                ids[tokens[new]] = new
            merges.append((left, right, new))
        leaders = index.leaders(min_frequency)
    index.close()
    return BpeModel(tokens, merges)


class _Encoder:
    """Ids of one word at a time, remembered within a task."""

    def __init__(self, tokens, merges):
        self.ids = {t: i for i, t in enumerate(tokens)}
        self.ranks = {(a, b): (rank, new) for rank, (a, b, new) in enumerate(merges)}
        self.known = {t: [self.ids[t]] for t in SPECIAL_TOKENS if t in self.ids}
        self.fixed = dict(self.known)

    def word(self, raw):
        found = self.known.get(raw)
        if found is None:
            symbols = [BYTE_ALPHABET[b] for b in raw.encode("utf-8")]
            found, run = [], []
            for s in symbols:
                if s in _NUMERIC:
                    found += self._merge(run) + self._merge([s])
                    run = []
                else:
                    run.append(s)
            found += self._merge(run)
            if len(self.known) >= _REMEMBERED:
                self.known = dict(self.fixed)
            self.known[raw] = found
        return found

    def _merge(self, symbols):
        """Lowest rank first, leftmost among equals: a heap over a linked list of symbols."""
        ids = [self.ids.get(s, UNK) for s in symbols]
        end = len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = []

        def offer(left):
            if left >= 0 and after[left] < end:
                pair = ids[left], ids[after[left]]
                if pair in self.ranks:
                    heappush(heap, (*self.ranks[pair], left, pair))

        for at in range(end - 1):
            offer(at)
        while heap:
            _, new, at, pair = heappop(heap)
            right = after[at]
            # An offer is void once one of its symbols went into another merge.
            if right >= end or (ids[at], ids[right]) != pair:
                continue
            ids[at], ids[right] = new, None
            after[at] = after[right]
            if after[at] < end:
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [i for i in ids if i is not None]


def raw_tokens(df, text, out):
    """Add special tokens as they are and everything else as raw words, in order."""
    names = "|".join(t.strip("<>") for t in SPECIAL_TOKENS)
    segments = F.filter(F.split(text, f"(?=<(?:{names})>)|(?<=<(?:{names})>)"), lambda s: s != "")
    parts = df.withColumns({"_text": text, "_segments": segments})
    parts = parts.withColumn("_normal", normalize_segments(F.col("_text"), F.col("_segments")))
    words = F.zip_with("_normal", "_segments", lambda n, s: F.when(
        s.isin(SPECIAL_TOKENS), F.array(s)).otherwise(raw_words(n)))
    return parts.withColumn(out, F.flatten(words)).drop("_text", "_segments", "_normal")


def _encode_udf(spark, model):
    # Both lists are bounded by the vocabulary size.
    shared = spark.sparkContext.broadcast((model.tokens, model.merges))
    task = {}

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(lists):
        if not task:
            task["encoder"] = _Encoder(*shared.value)
        words = lists.flatten().dictionary_encode()
        # Each distinct word of the batch is looked up once; the rest is array arithmetic.
        coded = [task["encoder"].word(w) for w in words.dictionary.to_pylist()]
        table = pa.array(coded, pa.list_(pa.int32()))
        spread = table.take(words.indices)
        ends = np.concatenate([[0], np.cumsum([len(c) for c in coded] or [0], dtype="int64")])
        lengths = np.diff(ends)[words.indices.to_numpy(zero_copy_only=False)] if len(words) else \
            np.zeros(0, "int64")
        before = np.concatenate([[0], np.cumsum(lengths)])
        counts = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()],
                          dtype="int64")
        starts = np.concatenate([[0], np.cumsum(counts)])
        offsets = pa.array(before[starts].astype("int32"))
        return pa.ListArray.from_arrays(offsets, spread.flatten())

    return encode


def bpe_encode(df, text, model, out="ids"):
    """Add the ids of `text`. No shuffle: words repeat, so tasks remember them instead."""
    encode = _encode_udf(df.sparkSession, model)
    return raw_tokens(df, text, "_words").withColumn(out, encode("_words")).drop("_words")


def bpe_decode(spark, ids, model, mode="joined"):
    """Ids to text. `joined` puts a space between tokens and keeps byte symbols; `bytes` inverts
    the byte alphabet. Special tokens and unknown ids are left out in both."""
    def piece(token):
        if token in SPECIAL_TOKENS:
            return None
        return token.encode() if mode != "bytes" else b"".join(
            bytes([_BYTE_OF[c]]) if c in _BYTE_OF else c.encode() for c in token)

    shared = spark.sparkContext.broadcast([piece(t) for t in model.tokens])

    @F.arrow_udf(T.StringType())
    def decode(lists):
        import pyarrow.compute as pc
        pieces = pa.array([*shared.value, None], pa.binary())
        flat = lists.flatten()
        known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(pieces) - 1))
        found = pieces.take(pc.if_else(known, flat, len(pieces) - 1).fill_null(len(pieces) - 1))
        keep = found.is_valid().to_numpy(zero_copy_only=False)
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        kept = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(counts)])]
        rows = pa.ListArray.from_arrays(
            pa.array(kept.astype("int32")), found.drop_null(), mask=lists.is_null())
        joined = pc.binary_join(rows, b"" if mode == "bytes" else b" ")
        if mode != "bytes":
            return joined.cast(pa.string())
        return pa.array([r if r is None else r.decode("utf-8", "replace")
                         for r in joined.to_pylist()], pa.string())

    return decode(ids)


class BpeTokenizer:
    """Carries ids, cut to the wanted tail, through shuffles."""

    pad_id, unk_id, bos_id, eos_id = PAD, UNK, BOS, EOS
    stop_ids = (EOS, USER)
    tag_tokens = 1

    def __init__(self, model):
        self.model = model

    def prepare(self, df, text, keep_last=None):
        coded = bpe_encode(df, text, self.model, "payload")
        coded = coded.withColumn("n_tokens", F.size("payload").cast("bigint"))
        if keep_last is not None:
            first = F.greatest(F.lit(1), F.size("payload") - keep_last + 1)
            coded = coded.withColumn("payload", F.slice("payload", first, F.lit(keep_last)))
        return coded

    def ids(self, payload):
        return payload


def expand_vocab(vocab, requested):
    """Append tokens of `requested(token, at)` that are new, in order of first request."""
    first = requested.filter(F.length("token") > 0).groupBy("token").agg(F.min("at").alias("at"))
    new = position(first.join(vocab, "token", "left_anti"), [], F.col("at").cast("bigint"), "_p",
                   ties=("token",))
    start = vocab.agg(F.coalesce(F.max("id"), F.lit(-1)) + 1).scalar()
    return vocab.select("token", F.col("id").cast("bigint").alias("id")).unionByName(
        new.select("token", (F.col("_p") + start).alias("id")))


def expansion_count(vocab, requested):
    """Number of requests for new tokens, repeats included."""
    return requested.filter(F.length("token") > 0).join(vocab, "token", "left_anti").agg(
        F.count(F.lit(1)).alias("added"))


def vocab_size(vocab):
    """Number of entries."""
    return vocab.agg(F.count(F.lit(1)).alias("size"))
