"""Mixing sources to target weights by entropy balancing.

The mix keeps every document's expected number of copies (its rate) as close as possible, in
relative entropy, to one copy each, subject to each source's expected words meeting its target and
to no rate above `most`. The convex dual has one multiplier per source; its solution is the
exponentially tilted rate `min(most, exp(multiplier * size / mean size))`. Newton steps, kept
inside a bracket, run over a table of distinct (source, size), one grouping per step. Rates become
copies: their whole part, and one more copy for the documents whose hash comes first relative to
the rate's fraction, up to the point where the source's target is met.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusprep.llm.common import attach, stored

WHITE = "\\x20\\x09-\\x0D"
CELLS = 4096


def word_count(column):
    """Runs of characters other than space and U+0009 to U+000D; null has none."""
    marks = F.regexp_replace(column, f"[^{WHITE}]++[{WHITE}]*+", "x")
    return F.coalesce(F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def source_targets(per_source, most=3, cycle=3):
    """`(source, source_size, target)`: all sizes shared by weights 1, 2, ..., cycle, repeating in
    code point order with null last; no target above `most` times its source's size."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    weighed = per_source.withColumn("w", (F.row_number().over(order) - 1) % cycle + 1).withColumn(
        "limit", F.col("source_size").cast("double") * most)
    # The capped sources come first in the order of limit by weight; the rest share one level.
    by_level = W.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    whole = W.partitionBy()
    filled = weighed.withColumns({
        "before": F.coalesce(F.sum("limit").over(
            by_level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "left_w": F.sum("w").over(by_level.rowsBetween(0, W.unboundedFollowing)),
        "total": F.sum("source_size").over(whole)})
    level = (F.col("total") - F.col("before")) / F.col("left_w")
    levels = filled.withColumn("level", level).withColumn(
        "final", F.max(F.when(F.col("limit") / F.col("w") >= F.col("level"), F.col("level"))).over(
            whole))
    return levels.select("source", "source_size", F.least(
        F.col("limit"), F.coalesce("final", F.lit(0.0)) * F.col("w")).alias("target"))


def tilts(sizes, targets, most=3, tolerance=1e-7, limit=80):
    """`(source, target, mean, tilt)`: the dual's solution; an infinite tilt means rate `most`."""
    table = stored(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")).filter(
        "size > 0"), "mix-sizes")
    means = table.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    keyed = targets.join(means, targets["source"].eqNullSafe(means["source"]), "left").select(
        targets["source"], "source_size", "target", F.coalesce("mean", F.lit(1.0)).alias("mean"))
    full = F.col("target") >= F.col("source_size") * most
    state = keyed.withColumns({
        "tilt": F.when(full, F.lit(float("inf"))).otherwise(0.0),
        "low": F.lit(None).cast("double"), "high": F.lit(None).cast("double"), "done": full})
    state = stored(state, "mix-tilts")
    n = state.count()
    for _ in range(limit):
        if not n or state.filter("not done").isEmpty():
            return state.select("source", "target", "mean", "tilt")
        # Null sources take part under a marker key.
        keys = {"key": F.struct(F.coalesce("source", F.lit("")), F.col("source").isNull())}
        going = state.filter("not done").withColumns(keys).select("key", "mean", "tilt")
        x = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(most)), F.exp(F.col("tilt") * x))
        words = F.col("n") * F.col("size")
        sums = attach(table.withColumns(keys).select("key", "size", "n"), going, "key",
                      rows_of_small=n).groupBy("key").agg(
            F.sum(words * rate).alias("value"),
            F.sum(F.when(rate < most, words * x * rate).otherwise(0.0)).alias("slope"))
        off = F.col("value") - F.col("target")
        low = F.when(off < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("tilt")).otherwise(F.col("high"))
        stepped = state.withColumns(keys).join(sums, "key", "left").withColumns(
            {"low": low, "high": high,
             "newton": F.col("tilt") - F.when(F.col("slope") > 0, off / F.col("slope"))})
        # Outside the bracket a step gives way to bisection, or to doubling while it is open.
        reach = F.abs("tilt") * 2 + 1
        inside = ((F.col("low").isNull() | (F.col("newton") > F.col("low")))
                  & (F.col("high").isNull() | (F.col("newton") < F.col("high")))
                  & (F.abs("newton") <= reach))
        other = F.when(F.col("low").isNull(), -reach).when(
            F.col("high").isNull(), reach).otherwise((F.col("low") + F.col("high")) / 2)
        met = (F.abs(off) <= F.greatest(F.col("target") * tolerance, F.lit(1e-3))) | F.coalesce(
            F.col("high") - F.col("low") < 1e-12, F.lit(False))
        state = stored(stepped.select(
            "source", "source_size", "target", "mean",
            F.when(F.col("done") | F.coalesce(met, F.lit(True)), F.col("tilt")).when(
                inside, F.col("newton")).otherwise(other).alias("tilt"),
            "low", "high", (F.col("done") | F.coalesce(met, F.lit(True))).alias("done")),
            "mix-tilts")
    return state.select("source", "target", "mean", "tilt")


def _key():
    """Sources as a join key under which null is a value of its own."""
    return F.struct(F.coalesce("source", F.lit("")), F.col("source").isNull())


def _rated(rows, facts, most, n):
    """Rows with rate, its whole part, and the place `at` (and its cell) in the order in which the
    open fractions of their source are rounded up; no place where nothing is open."""
    x = F.col("size") / F.col("mean")
    # Infinity times zero is not a number, so empty texts and full sources come first.
    rate = F.when(F.col("size") == 0, 1.0).when(
        F.col("tilt") == float("inf"), float(most)).otherwise(
        F.least(F.lit(float(most)), F.exp(F.col("tilt") * x)))
    given = F.col("draw") if "draw" in rows.columns else F.xxhash64("doc_id", "source")
    draw = (F.shiftrightunsigned(given, 11).cast("double") + 0.5) / 2**53
    part = F.col("rate") - F.floor("rate")
    return attach(rows.withColumn("key", _key()), facts, "key", rows_of_small=n).withColumn(
        "rate", rate).withColumn("at", F.when(part > 0, draw / part)).withColumn(
        "cell", F.least(F.lit(CELLS - 1), F.floor(
            F.col("at") / (F.col("at") + 1) * CELLS)).cast("int"))


def mix_plan(sizes, most=3, cycle=3):
    """One row per source of `sizes(doc_id, source, size)`: all that the mix needs to know.

    An empty table gives an empty plan; a null source is a source of its own.
    """
    per_source = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")),
                        "mix-sources")
    targets = stored(source_targets(per_source, most, cycle), "mix-targets")
    facts = stored(targets.withColumn("key", _key()).select("key", "source_size", "target").join(
        tilts(sizes, targets, most).select(_key().alias("key"), "mean", "tilt"), "key"),
        "mix-facts")
    n = facts.count()
    rated = _rated(sizes, facts, most, n)
    sums = stored(rated.groupBy("key", "cell").agg(
        F.sum(F.when(F.col("cell").isNotNull(), F.col("size")).otherwise(0)).alias("open"),
        F.sum(F.floor("rate") * F.col("size")).alias("fixed")), "mix-cells")
    need = sums.groupBy("key").agg(F.sum("fixed").alias("fixed")).join(facts, "key").select(
        "key", (F.col("target") - F.col("fixed")).alias("need"))
    cells = sums.filter("cell is not null").withColumn(
        "upto", F.sum("open").over(W.partitionBy("key").orderBy("cell"))).join(need, "key")
    # Cells before the first one that reaches the need are taken whole; that one is settled row
    # by row (one of 4,096 parts of a source), up to the place nearest to the need.
    cut = stored(cells.filter("upto >= need").groupBy("key").agg(F.min(F.struct(
        "cell", (F.col("need") - F.col("upto") + F.col("open")).alias("rest"))).alias("cut")).select(
        "key", F.col("cut.cell").alias("cut_cell"), "cut.rest"), "mix-cut")
    inside = attach(rated, cut, "key", rows_of_small=n).filter("cell = cut_cell")
    passed = F.sum("size").over(W.partitionBy("key", "cell").orderBy("at"))
    last = inside.withColumn("passed", passed).filter("passed - size / 2 <= rest").groupBy(
        "key").agg(F.max("at").alias("last"))
    return stored(facts.join(cut, "key", "left").join(last, "key", "left"), "mix-plan")


def apply_plan(rows, plan, most=3):
    """Rows of any table with doc_id, source and size, with their source's size and target, their
    rate, copies and taken words. One pass without a shuffle while the sources fit a broadcast.

    Rows of one `draw`, or without that column alike in doc_id and source, get the same copies.
    """
    extra = F.when(F.col("cell").isNull(), 0).when(F.col("cut_cell").isNull(), 1).when(
        F.col("cell") < F.col("cut_cell"), 1).when(
        (F.col("cell") == F.col("cut_cell")) & (F.col("at") <= F.col("last")), 1).otherwise(0)
    return _rated(rows, plan, most, None).withColumn(
        "copies", (F.floor("rate") + extra).cast("int")).withColumn(
        "taken", (F.col("copies") * F.col("size")).cast("long")).select(
        *rows.columns, "source_size", "target", "taken", "rate", "copies")


def _drawn(docs, *more):
    """`docs` reduced to doc_id, source, size, the columns of `more` and `draw`, a hash that tells
    rows apart: by id and text, and where rows repeat both, by their place in the table."""
    named = docs.select(*more, "doc_id", "source", word_count(F.col("text")).alias("size"),
                        F.xxhash64("doc_id", "source", "text").alias("draw"))
    again = stored(docs.select(F.xxhash64("doc_id", "source", "text").alias("draw")).groupBy(
        "draw").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(
        "draw", F.lit(True).alias("again")), "mix-repeated")
    many = again.count()
    if not many:
        return named
    placed = named.withColumn("place", F.monotonically_increasing_id())
    return attach(placed, again, "draw", "left", many).withColumn("draw", F.when(
        F.col("again"), F.xxhash64("draw", "place")).otherwise(F.col("draw"))).drop(
        "place", "again")


def document_sizes(docs):
    """`(doc_id, source, size, draw)` of each document."""
    return _drawn(docs)


def mix_documents(docs, most=3, cycle=3):
    """The documents of the mix: each row as often as the mix takes it, columns unchanged.

    Null and empty texts keep a rate of one. The given columns travel in one struct, so none of
    their names can clash with the plan's.
    """
    plan = mix_plan(stored(document_sizes(docs), "mix-documents"), most, cycle)
    whole = _drawn(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return apply_plan(whole, plan, most).filter("copies > 0").select(
        "row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
