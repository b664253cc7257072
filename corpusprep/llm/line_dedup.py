"""Line deduplication by a segment-partition edit join, in DataFrame functions only.

Every line is a node named by its 64-bit hash, so exact copies are one node. A line within `edits`
edits of another must contain, unchanged and nearly in place, one of `edits + 1` segments the other
is cut into. Each line therefore publishes its segments and probes the substrings, by length and
place, that the pigeonhole argument still allows for lines of its own length down to `edits`
shorter. Lines that meet, first with one publisher per signature and then across components only, are
verified by a banded bit-parallel edit distance: one 64-bit word holds, for each number of errors,
which diagonals of the band are alive, and is updated per character.

With `percent` the bound grows with the line: `percent` % of the longer line's code points, where that
is more than `edits`. Segments would need cubically many probes there. Instead, lines within such
a bound share an unchanged piece of a length that the pigeonhole argument gives, so they share the
smallest hash of a window of that length; each line publishes its smallest hashes, by length class,
and probes the class of the shortest lines it may match. Spark's banded `levenshtein` verifies them.

With `word_percent` the same join runs once more over words in place of characters: a line also
matches lines within that share of the longer one's words, up to four words left out, put in or
replaced. One changed word, which costs many characters, is then one edit. The bound steps up
in bands of the number of words; each line is cut into its band's segments, and into the next band's where
a line of that band may match it, and probes by its own band only.
"""

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusprep.llm.common import attach, components, discard, stored

#: A line with more copies than this publishes and probes from its first copy only.
HOT_COPIES = 1000


def lines_of(docs, least):
    """`(doc_id, line_no, line, chars, node)` for lines of at least `least` code points."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).filter(
        F.length("line") >= least).withColumns(
        {"chars": F.length("line"), "node": F.xxhash64("line")})


def _segments(length, parts):
    """`(start, size)` of each of `parts` even segments of a line of `length`, longer ones last."""
    base, longer = F.floor(length / parts), length % parts
    for i in range(parts):
        late = i - parts + longer
        yield i * base + F.greatest(late, F.lit(0)), base + (late >= 0).cast("int")


def _probes(edits):
    """`(segment, shorter, shift)` of what a line publishes (neither shorter nor shifted) and of the
    substrings it probes for partners up to `edits` shorter."""
    for shorter in range(edits + 1):
        for i in range(edits + 1):
            # Where segment i can lie so that the edits left and right of it stay within bounds.
            low, high = max(-i, shorter - (edits - i)), min(i, shorter + (edits - i))
            for shift in range(low, high + 1):
                yield i, shorter, shift


def _signatures(edits):
    """All `(signature, published)` of a line: its own segments, then its probes."""
    n, found = F.col("chars"), []
    cuts = [list(_segments(n - shorter, edits + 1)) for shorter in range(edits + 1)]
    for i, shorter, shift in _probes(edits):
        start, size = cuts[shorter][i]
        # The end of the line may cut a shifted probe short; it then matches nothing.
        piece = F.col("line").substr((start + shift + 1).cast("int"), size.cast("int"))
        found.append(F.struct(F.xxhash64(F.lit(i), n - shorter, piece).alias("signature"),
                              F.lit(shorter == 0 and shift == 0).alias("own")))
    return F.array(*found)


def _bound(edits, percent, *chars):
    """Most edits between two lines, from the length of the longer."""
    longer = F.greatest(*chars) if len(chars) > 1 else chars[0]
    return F.greatest(F.lit(edits), F.floor(longer * percent / 100).cast("int"))


def wide_from(edits, percent):
    """The shortest line whose bound is above `edits`."""
    return -(-100 * (edits + 1) // percent)


def shared_piece(edits, percent):
    """Code points in a row that lines share at least, if they are within the bound of a line from
    `wide_from` on. The bound steps up at multiples of 100 / percent; the piece is least there, and
    over 100 / percent steps on it stays above the first."""
    first = wide_from(edits, percent)
    return min(-(-(n - n * percent // 100) // (n * percent // 100 + 1))
               for n in range(first, first + 10_000))


#: Code points of a line that are cut into windows at a time.
BLOCK = 256


def _length_class(chars, percent):
    return F.floor(F.log(chars) / F.log(F.lit(100 / (100 - percent)) * 1.05)).cast("int")


def _window_signatures(lines, edits, percent):
    """`(signature, node, own)` of lines that may be in a pair with a bound above `edits`: the
    smallest hash in each window of as many code points as such lines must share, published for
    the own length class and probed from there down to the class of the shortest partner."""
    first, piece = wide_from(edits, percent), shared_piece(edits, percent)
    window = piece // 2
    gram = piece - window + 1
    # Blocks overlap so that each window is in one of them; a long line costs no more a place.
    blocks = lines.withColumn("chars", F.length("line")).filter(
        F.col("chars") >= first - edits - 1).select("node", "chars", F.explode(F.transform(
            F.sequence(F.lit(0), F.floor((F.col("chars") - piece) / BLOCK).cast("int")),
            lambda b: F.substring("line", b * BLOCK + 1, F.lit(BLOCK + piece - 1)))).alias("block"))
    hashes = F.transform(F.sequence(F.lit(1), F.length("block") - (gram - 1)),
                         lambda i: F.xxhash64(F.substring("block", i, F.lit(gram))))
    hashed = _named(blocks, ["node", "chars"], hashes=hashes)
    least = F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size("hashes") - (window - 1)),
        lambda i: F.array_min(F.slice("hashes", i, window))))
    own = _length_class(F.col("chars"), percent)
    low = _length_class(F.col("chars") - _bound(edits, percent, F.col("chars")), percent)
    return hashed.select("node", own.alias("_own"), F.explode(F.sequence(low, own)).alias("_class"),
                         least.alias("least")).select(
        "node", "_own", "_class", F.explode("least").alias("hash")).select(
        F.xxhash64(F.lit("window"), "_class", "hash").alias("signature"), "node",
        (F.col("_class") == F.col("_own")).alias("own"))


#: Words that may differ at most.
MOST_WORDS = 4


def _bands(percent):
    """`(least number of words, edits)` of the bands of a word bound."""
    return [(-(-100 * k // percent), k) for k in range(1, MOST_WORDS + 1)]


def _word_bound(percent, *sizes):
    """Most word edits between two lines, from the number of words of the longer."""
    longer = F.greatest(*sizes) if len(sizes) > 1 else sizes[0]
    return F.least(F.lit(MOST_WORDS), F.floor(longer * percent / 100).cast("int"))


def words_of(line):
    """The parts between spaces; joined by spaces again they are the line."""
    return F.split(line, " ", -1)


def _word_signatures(lines, percent):
    """`(signature, node, own)` of lines for the join over words."""
    bands, size = _bands(percent), F.size("words")

    def listed(edits, publish_only=False):
        found = [F.struct(*[F.lit(v).alias(k) for k, v in (
            ("edits", edits), ("i", i), ("shorter", shorter), ("shift", shift))])
            for i, shorter, shift in _probes(edits) if not (publish_only and (shorter or shift))]
        return F.array(*found)

    wanted = F.array().cast("array<struct<edits:int,i:int,shorter:int,shift:int>>")
    for first, edits in bands:
        wanted = F.when(size >= first, listed(edits)).otherwise(wanted)
    for first, edits in bands:
        wanted = F.when((size < first) & (size >= first - edits),
                        F.concat(wanted, listed(edits, True))).otherwise(wanted)
    # One row per probe first, so that cutting and hashing stay in generated code.
    each = lines.select("node", words_of(F.col("line")).alias("words")).filter(
        size >= bands[0][0] - bands[0][1]).select(
        "node", "words", F.explode(wanted).alias("p")).select("node", "words", "p.*")
    length, parts = F.size("words") - F.col("shorter"), F.col("edits") + 1
    base = F.floor(length / parts).cast("int")
    late = F.col("i") - parts + length % parts
    start = F.col("i") * base + F.greatest(late, F.lit(0)) + F.col("shift")
    piece = F.slice("words", start + 1, base + (late >= 0).cast("int"))
    return each.select(
        F.xxhash64(F.lit("words"), "edits", "i", length, piece).alias("signature"), "node",
        ((F.col("shorter") == 0) & (F.col("shift") == 0)).alias("own"))


def within_edits(ca, cb, edits, most=None):
    """Whether two arrays of characters are within `edits` edits (up to 4) of each other, by a
    banded bit-parallel automaton; with `most`, a Column, within that many (from 1) of them.

    Field e of a word has one bit per diagonal that e errors can reach. A character keeps the
    diagonals where it matches; an error moves to the next field, on the same diagonal
    (replaced), the one below (left out) or, after the step, the one above (put in).
    """
    width, fields = 2 * edits + 2, edits + 1
    ones = sum(1 << (e * width) for e in range(fields))

    def mask(low):
        return ones * ((1 << (2 * edits + 1)) - (1 << low))

    def put_in(word):
        for k in range(1, edits + 1):
            yield F.shiftleft(word, k * (width + 1)).bitwiseAND(F.lit(mask(k)).cast("long"))

    def closed(word):
        return reduce(lambda x, y: x.bitwiseOR(y), put_in(word), word)

    def step(word, i):
        match = reduce(lambda x, y: x + y, [
            F.when(F.get(ca, i) == F.get(cb, i + (d - edits)), F.lit(ones << d).cast("long")
                   ).otherwise(F.lit(0).cast("long")) for d in range(2 * edits + 1)])
        moved = F.shiftleft(word, width)
        now = word.bitwiseAND(match).bitwiseOR(moved).bitwiseOR(F.shiftright(moved, 1)).bitwiseAND(
            F.lit(mask(0)).cast("long"))
        # A one-element array names the word, so that it is worked out once.
        return F.element_at(F.transform(F.array(now), closed), 1)

    gap = F.size(cb) - F.size(ca)
    start = 1 << edits
    for k in range(1, edits + 1):
        start |= (1 << edits << (k * (width + 1))) & mask(k)
    # Alive on the last diagonal after any number of errors, or up to `most`.
    goals = [sum(1 << (e * width) for e in range(k + 1)) << (g + edits)
             for k in (range(1, fields) if most is not None else [edits])
             for g in range(-edits, edits + 1)]
    place = F.greatest(F.least(gap, F.lit(edits)), F.lit(-edits)) + edits + 1
    if most is not None:
        place = place + (most - 1) * (2 * edits + 1)
    goal = F.element_at(F.array(*[F.lit(g).cast("long") for g in goals]), place)
    steps = F.when(F.size(ca) > 0, F.sequence(F.lit(0), F.size(ca) - 1)).otherwise(
        F.array().cast("array<int>"))
    return (F.abs(gap) <= (edits if most is None else most)) & F.aggregate(
        steps, F.lit(start).cast("long"), step, lambda word: word.bitwiseAND(goal) != 0)


def _named(df, keep, **columns):
    """`keep` and new columns, each worked out once: the optimizer would otherwise put their
    expressions in every place that uses them."""
    return df.select(*keep, F.inline(F.array(F.struct(*[
        c.alias(name) for name, c in columns.items()]))))


def _equal_part(side, cuts=8):
    """Code points that two texts have in common at one end, by eighths of the shorter one."""
    short = F.least(F.length("ta"), F.length("tb"))
    at = [F.floor(short * k / cuts).cast("int") for k in range(1, cuts)]
    return F.greatest(F.lit(0), *[F.when(side("ta", k) == side("tb", k), k).otherwise(0)
                                  for k in at])


def verified(pairs, edits):
    """`(a, b)` of the rows of `pairs(a, b, ta, tb)` whose texts are within `edits` edits."""
    ids = ["a", "b"]
    # Equal beginnings and ends are cut off first; the distance stays.
    found = _named(pairs, [*ids, "ta", "tb"], head=_equal_part(F.left))
    found = _named(found, ids, **{c: F.expr(f"substring({c}, head + 1)") for c in ("ta", "tb")})
    found = _named(found, [*ids, "ta", "tb"], tail=_equal_part(F.right))
    # Splitting an empty string gives one empty string instead of nothing.
    found = _named(found, ids, **{c: F.filter(F.split(F.expr(f"left({c}, length({c}) - tail)"), ""),
                                              lambda x: x != "") for c in ("ta", "tb")})
    return found.filter(within_edits(F.col("ta"), F.col("tb"), edits)).select(*ids)


# Letters in groups of similar total frequency, for counting.
GROUPS = ("e", "t", "a", "o", "i", "n", "s", "r", "h", "l", "d", "u", "cm", "fw", "gy", "pbvk")


def _bag(line):
    """How often a line has letters of each group; every edit changes at most two of the counts,
    by one each."""
    return F.array(*[F.length(line) - F.length(F.translate(line, g, "")) for g in GROUPS])


# Letters that stand for groups of words.
_GROUPS = "".join(map(chr, range(48, 112)))


def _coded(words):
    """Words as one letter each, that of their group."""
    groups = F.array(*[F.lit(g) for g in _GROUPS])
    return F.array_join(F.transform(words, lambda w: F.get(
        groups, F.pmod(F.xxhash64(w), F.lit(len(_GROUPS))).cast("int"))), "")


def _word_bag(coded):
    """How many words fall into each group; every word edit changes at most two of the counts, by
    one each."""
    return F.array(*[F.length(coded) - F.length(F.replace(coded, F.lit(g), F.lit("")))
                     for g in _GROUPS])


def line_classes(docs, edits=2, exact_chars=10, near_chars=24, percent=0, word_percent=0):
    """`(doc_id, line_no, node, class_doc_id, class_line_no, kept)` per line of `docs`.

    Lines are parts between newlines. Those under `exact_chars` code points are no one's copy and
    do not appear; those from there on are classed with exact copies, and from `near_chars` on with
    every line within `edits` edits, or `percent` % of the longer one's code points where that is
    more, and with every line within `word_percent` % of the longer one's words (up to MOST_WORDS),
    in chains. A class is named by its first line in doc_id and
    line order (a null doc_id comes first), and that line is the one kept; rows repeating a doc_id
    and text keep the line each. Null and empty texts have no lines.
    """
    occurrences = lines_of(docs, exact_chars).select("doc_id", "line_no", "chars", "node")
    firsts = stored(occurrences.groupBy("node").agg(
        F.min(F.struct("doc_id", "line_no")).alias("first"), F.count(F.lit(1)).alias("copies"),
        F.first("chars").alias("chars")), "line-firsts")
    hot = firsts.filter((F.col("copies") > HOT_COPIES) & (F.col("chars") >= near_chars)).select(
        "node", "first")
    near = lines_of(docs, near_chars)
    one_each = attach(near, stored(hot, "line-hot"), "node", "left").filter(
        F.col("first").isNull() | (F.struct("doc_id", "line_no") == F.col("first")))
    signatures = one_each.select("node", F.explode(_signatures(edits)).alias("s")).select(
        "s.signature", "node", "s.own")
    if percent:
        signatures = signatures.union(_window_signatures(one_each, edits, percent))
    if word_percent:
        signatures = signatures.union(_word_signatures(one_each, word_percent))
    signed = signatures.repartition("signature").groupBy("signature", "node").agg(
        F.max("own").alias("own"))
    # Signatures that two lines share, one of which published it.
    by = W.partitionBy("signature")
    met = stored(signed.withColumns({
        "low": F.min("node").over(by), "high": F.max("node").over(by),
        "any_own": F.max("own").over(by)}).filter("low <> high and any_own").select(
        "signature", "node", "own"), "line-met")
    wanted = stored(met.select("node").distinct(), "line-wanted")
    texts = stored(attach(one_each.select("node", "line"), wanted, "node", "left_semi").groupBy(
        "node").agg(F.first("line").alias("line")), "line-texts")

    def bound(*chars):
        return _bound(edits, percent, *chars) if percent else F.lit(edits)

    def by_words(pairs):
        """Pairs within the word bound, by the same automaton over words."""
        named = _named(pairs, ["a", "b"], wa=words_of(F.col("ta")), wb=words_of(F.col("tb")))
        named = named.withColumn("most", _word_bound(word_percent, F.size("wa"), F.size("wb"))).filter(
            F.abs(F.size("wa") - F.size("wb")) <= F.col("most"))
        return named.filter(F.col("most") > 0).filter(within_edits(
            F.col("wa"), F.col("wb"), MOST_WORDS, F.col("most"))).select("a", "b")

    def linked(pairs):
        both = pairs.join(texts.select(F.col("node").alias("a"), F.col("line").alias("ta")), "a").join(
            texts.select(F.col("node").alias("b"), F.col("line").alias("tb")), "b")
        if word_percent:
            both = stored(both, "line-compared")
        close = both.filter(
            F.abs(F.length("ta") - F.length("tb")) <= bound(F.length("ta"), F.length("tb")))
        if not percent:
            found = verified(close, edits)
        else:
            wide = close.withColumn("most", bound(F.length("ta"), F.length("tb")))
            far = wide.filter((F.col("most") > edits) & (
                F.expr("levenshtein(ta, tb, most)") >= 0)).select("a", "b")
            found = verified(wide.filter(F.col("most") <= edits), edits).union(far)
        if not word_percent:
            return stored(found, "line-links")
        found = stored(found.union(by_words(both)).distinct(), "line-links")
        discard(both)
        return found

    # Pairs whose letters, or words, differ too much are left out before their texts are looked up.
    facts = texts.select("node", F.length("line").alias("chars"), _bag(F.col("line")).alias("bag"))
    if word_percent:
        coded = _named(texts.select("node", "line", words_of(F.col("line")).alias("w")), [
            "node", "line", "w"], coded=_coded(F.col("w")))
        # Written, so that pairs are compared by finished numbers.
        facts = stored(coded.select(
            "node", F.length("line").alias("chars"), _bag(F.col("line")).alias("bag"),
            F.size("w").alias("words"), _word_bag(F.col("coded")).alias("word_bag")), "line-facts")
    most = bound(F.col("chars"), F.col("chars2"))

    def apart(bag):
        return F.expr(f"aggregate(zip_with({bag}, {bag}2, (x, y) -> abs(x - y)), 0, (s, x) -> s + x)")

    may = (F.abs(F.col("chars") - F.col("chars2")) <= most) & (apart("bag") <= 2 * most)
    if word_percent:
        most_words = _word_bound(word_percent, F.col("words"), F.col("words2"))
        may = may | (most_words > 0) & (F.abs(F.col("words") - F.col("words2")) <= most_words) & (
            apart("word_bag") <= 2 * most_words)
    second = facts.select(*[F.col(c).alias(c + "2") for c in facts.columns])
    # First every line with one publisher of its signature, so that groups of near copies grow
    # together by as many pairs as they have lines.
    hubs = met.filter("own").groupBy("signature").agg(F.min("node").alias("b"))
    hubbed = met.join(hubs, "signature").filter("node <> b").select(
        F.col("node").alias("a"), "b").distinct()
    if word_percent:
        hubbed = hubbed.join(facts, F.col("a") == F.col("node")).join(
            second, F.col("b") == F.col("node2")).filter(may).select("a", "b")
    edges = linked(stored(hubbed, "line-pairs"))
    # Then all pairs that are not in one component.
    open_ = met.join(components(edges), "node", "left").withColumn(
        "component", F.coalesce("component", "node")).join(
        facts, "node")
    other = open_.select(*[F.col(c).alias(c + "2") for c in (
        "signature", "node", "own", "component", *facts.columns[1:])])
    pairs = open_.join(other, F.expr("""signature = signature2 and own and component <> component2
        and (not own2 or node < node2)""") & may).select(
        F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()
    joined = components(edges.union(linked(stored(pairs, "line-pairs"))))
    classed = firsts.select("node", "first").join(joined, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    # Only nodes in links need their class's first line looked up.
    least = classed.join(joined.select("component").distinct(), "component").groupBy(
        "component").agg(F.min("first").alias("class_first"))
    named = classed.join(least, "component", "left").select("node", F.coalesce(
        "class_first", "first").alias("class"))
    return occurrences.join(named, "node").select(
        "doc_id", "line_no", "node", F.col("class.doc_id").alias("class_doc_id"),
        F.col("class.line_no").alias("class_line_no"),
        (F.struct("doc_id", "line_no") == F.col("class")).alias("kept"))


def dedup_lines(docs, edits=2, exact_chars=10, near_chars=24, percent=0, word_percent=0):
    """`docs` without lines that repeat an earlier one; other columns unchanged (n_chars, where
    there is one, counts the code points kept). Documents left without any text by this are
    dropped; those that had none stay.
    """
    plain = docs.select("doc_id", "text")
    gone = line_classes(plain, edits, exact_chars, near_chars, percent, word_percent).filter(
        "not kept").groupBy(F.col("doc_id").alias("gone_doc")).agg(
        F.collect_set(F.struct("line_no", "node")).alias("gone"))
    # The given columns travel in a struct, so that none can clash.
    joined = docs.select(F.struct(*docs.columns).alias("row")).join(
        gone, F.col("row.doc_id").eqNullSafe(F.col("gone_doc")), "left")
    kept = F.filter(F.transform(F.split("row.text", "\n"), lambda line, i: F.when(
        ~F.array_contains(F.col("gone"), F.struct(i.alias("line_no"), F.xxhash64(line).alias(
            "node"))), line)), lambda line: line.isNotNull())
    left = F.when(F.col("gone").isNotNull(), F.array_join(kept, "\n"))
    # Another row of the same document may hold none of the lines that go.
    changed = F.coalesce(left != F.col("row.text"), F.lit(False))
    text = F.when(changed, left).otherwise(F.col("row.text"))
    out = joined.withColumns({"text": text, "changed": changed}).filter(
        ~F.col("changed") | (F.length(F.trim("text")) > 0))
    changed = F.col("changed")
    put = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        put["n_chars"] = F.when(changed, F.length("text")).otherwise(F.col("row.n_chars")).cast(
            docs.schema["n_chars"].dataType)
    return out.select(*[put.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
