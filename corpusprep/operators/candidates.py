"""Scored candidates `(group_id, item_id, score)`: filters and sampling.

Ties are ordered by ascending item id. A removed candidate is a missing row.

Filters run as windows over the group as long as every group fits in a task. When a counting job
finds larger groups, the score range that holds a group's cut is narrowed by histograms first,
so that only a bounded range is ever sorted and everything above it is kept unsorted.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.constants import SAMPLING_DEFAULTS
from corpusprep.functions.hashing import draw_unit
from corpusprep.operators.metrics import log_sum_exp
from corpusprep.plans import skew
from corpusprep.plans.lineage import cut
from corpusprep.plans.scan import WHOLE_TABLE, running_total

GROUP = ["group_id"]
# Parts a score range is divided into at a time.
PARTS = 4096
# Masses are whole multiples of 2**-32 of the largest: their sums are exact in any order.
_UNIT = float(1 << 32)


def _group():
    return Window.partitionBy("group_id")


def _down():
    return _group().orderBy(F.desc("score"), "item_id")


def _value(x):
    return F.lit(x) if isinstance(x, (int, float)) else x


def _join_group(df, per_group, how="inner", hot=None):
    return skew.join_per_key(df, per_group, GROUP, ["item_id"], how, hot)


def softmax(df, temperature=SAMPLING_DEFAULTS["temperature"]):
    """Add `prob`, the softmax of `score / temperature` within the group."""
    scaled = df.withColumn("_x", F.col("score") / _value(temperature))
    return _probabilities(scaled, "_x", skew.hot_keys(df, GROUP)).drop("_x")


def _probabilities(df, score, hot, out="prob"):
    if hot is None:
        scaled = df.withColumn("_e", F.exp(F.col(score) - F.max(score).over(_group())))
        return scaled.withColumn(out, F.col("_e") / F.sum("_e").over(_group())).drop("_e")
    totals = log_sum_exp(df, GROUP, F.col(score), "_lse")
    return _join_group(df, totals, hot=hot).withColumn(
        out, F.exp(F.col(score) - F.col("_lse"))).drop("_lse")


def repetition_penalty(df, seen, penalty=SAMPLING_DEFAULTS["repetition_penalty"]):
    """Push down the score of items in `seen(group_id, item_id)`, once per item."""
    marks = seen.select("group_id", "item_id").distinct().withColumn("_seen", F.lit(True))
    by = _value(penalty)
    pushed = F.when(F.col("score") < 0, F.col("score") * by).otherwise(F.col("score") / by)
    return df.join(marks, ["group_id", "item_id"], "left").withColumn(
        "score", F.when(F.col("_seen"), pushed).otherwise(F.col("score"))).drop("_seen")


def _weights(df, hot):
    """Add `_w`, the softmax mass of an item in units of `_UNIT`, and `_total` of its group.

    The best score has one unit; a score that is minus infinity, not a number, or 23 or more below
    the best has none. Both are decimals, so sums do not depend on their order.
    """
    def unit(best):
        share = F.when(F.col("score") == best, 1.0).otherwise(
            F.nanvl(F.exp(F.col("score") - best), F.lit(0.0)))
        return F.round(share * _UNIT).cast("decimal(20,0)")
    if hot is None:
        scored = df.withColumn("_w", unit(F.max("score").over(_group())))
        return scored.withColumn("_total", F.sum("_w").over(_group()))
    best = df.groupBy("group_id").agg(F.max("score").alias("_best"))
    scored = _join_group(df, best, hot=hot).withColumn("_w", unit(F.col("_best"))).drop("_best")
    totals = scored.groupBy("group_id").agg(F.sum("_w").alias("_total"))
    return _join_group(scored, totals, hot=hot)


def _finite(score):
    return ~F.isnan(score) & (F.abs(score) < float("inf"))


def _ranges(df, weight, limit, hot):
    """Per group, the score range `[lo, hi]` that holds its cut: `group_id, lo, hi, above, n`.

    `above` is the weight of the items over `hi`, `n` the number of items in the range. A range
    of more than TASK_ROWS items is divided and replaced by the part with the cut, until it is
    small enough or a single score. Infinite and not-a-number scores are parts of their own, so
    what is divided evenly is finite, and its ends always fall in different parts.
    """
    zero = F.lit(0).cast("decimal(38,0)")
    ranges = df.groupBy("group_id").agg(
        F.min("score").alias("lo"), F.max("score").alias("hi"), zero.alias("above"),
        F.count(F.lit(1)).alias("n"))
    large = (F.col("n") > skew.TASK_ROWS) & (F.col("lo") < F.col("hi"))
    down = _group().orderBy("_part")
    lo, hi, score = F.col("lo"), F.col("hi"), F.col("score")
    by_kind = F.when(F.isnan(score), 0).when(score == float("inf"), 1).when(
        score == float("-inf"), 3).otherwise(2)
    wide = hi - lo
    # Halves keep the width of a range finite.
    share = F.when(_finite(wide), (hi - score) / wide).otherwise(
        (hi / 2 - score / 2) / (hi / 2 - lo / 2))
    part = F.when(_finite(lo) & _finite(hi), F.least(
        F.floor(share * PARTS), F.lit(PARTS - 1))).otherwise(by_kind)
    while True:
        # A written result per round, so that no round repeats the ones before.
        ranges = cut(ranges)
        if ranges.filter(large).isEmpty():
            return ranges
        inside = _join_group(df, ranges.filter(large).drop("n"), hot=hot).filter(
            F.col("score").between(F.col("lo"), F.col("hi")))
        parts = inside.withColumn("_part", part).groupBy("group_id", "_part").agg(
            F.min("score").alias("lo"), F.max("score").alias("hi"), F.max("above").alias("_base"),
            F.sum(weight).alias("_sum"), F.count(F.lit(1)).alias("n"), F.max(limit).alias("_limit"))
        parts = parts.withColumn("above", (F.col("_base") + F.coalesce(F.sum("_sum").over(
            down.rowsBetween(Window.unboundedPreceding, -1)), zero)).cast("decimal(38,0)"))
        # The cut lies in the last part that starts within the limit.
        reached = parts.filter((F.col("above") <= F.col("_limit")) | (F.col("above") == 0))
        last = F.row_number().over(_group().orderBy(F.desc("_part")))
        chosen = reached.withColumn("_r", last).filter("_r = 1")
        ranges = ranges.filter(~large).unionByName(chosen.select(ranges.columns))


def _top_k(df, k, hot, max_k=None):
    """Rows scoring at least as high as the k-th; `max_k` is a literal bound on a column k."""
    k = _value(k)
    if hot is None:
        ranked = df.withColumn("_r", F.rank().over(_group().orderBy(F.desc("score"))))
        if max_k is not None:
            ranked = ranked.filter(F.col("_r") <= max_k)
        return ranked.filter((F.col("_r") <= k) | (k <= 0)).drop("_r")
    unlimited = F.when(k <= 0, F.lit(float("inf"))).otherwise((k - 1).cast("double"))
    limited = df.withColumn("_k", unlimited)
    ranges = _ranges(limited, F.lit(1).cast("decimal(20,0)"), F.col("_k"), hot)
    small = _join_group(limited, ranges.filter(F.col("n") <= skew.TASK_ROWS), hot=hot).filter(
        F.col("score").between(F.col("lo"), F.col("hi")))
    kept = small.withColumn("_r", F.row_number().over(_down()) - 1 + F.col("above")).filter(
        F.col("_r") <= F.col("_k"))
    cuts = kept.groupBy("group_id").agg(F.min("score").alias("_cut")).unionByName(
        ranges.filter(F.col("n") > skew.TASK_ROWS).select("group_id", F.col("lo").alias("_cut")))
    return _join_group(df, cuts, hot=hot).filter(F.col("score") >= F.col("_cut")).select(
        df.columns)


def _top_p(df, p, hot):
    """Rows before which the softmax mass of the group is at most p, and the first row."""
    columns = df.columns
    p = _value(p)
    scored = _weights(df, hot)
    mass = F.coalesce(F.sum("_w").over(
        _down().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("decimal(38,0)"))
    first = F.row_number().over(_down()) == 1
    # The mass before an item is compared in units, the same in all branches below.
    scored = scored.withColumn("_p", F.when(p >= 1.0, F.lit(float("inf"))).otherwise(
        p * F.col("_total").cast("double")))
    if hot is None:
        kept = scored.withColumns({"_mass": mass.cast("double"), "_first": first})
        return kept.filter(F.col("_first") | (F.col("_mass") <= F.col("_p"))).select(columns)
    ranges = _ranges(scored, F.col("_w"), F.col("_p"), hot)
    tagged = _join_group(scored, ranges, hot=hot)
    keep_all = F.col("_p") == float("inf")
    sure = tagged.filter((F.col("score") > F.col("hi")) | keep_all)
    inside = tagged.filter(F.col("score").between(F.col("lo"), F.col("hi")) & ~keep_all)
    sorted_part = inside.filter(F.col("n") <= skew.TASK_ROWS).withColumns(
        {"_mass": (mass + F.col("above")).cast("double"), "_first": first & (F.col("above") == 0)})
    out = sure.select(columns).unionByName(sorted_part.filter(
        F.col("_first") | (F.col("_mass") <= F.col("_p"))).select(columns))
    if ranges.filter(F.col("n") > skew.TASK_ROWS).isEmpty():
        return out
    # Only copies of one score are left: their masses are equal, their order is by id.
    ties = running_total(inside.filter(F.col("n") > skew.TASK_ROWS), GROUP, F.col("item_id"),
                         {"_rank": F.lit(1).cast("bigint")}, WHOLE_TABLE)
    before = (F.col("above") + F.col("_rank") * F.col("_w")).cast("double")
    return out.unionByName(ties.filter(
        (before <= F.col("_p")) | ((F.col("_rank") == 0) & (F.col("above") == 0))).select(columns))


def top_k_filter(df, k=SAMPLING_DEFAULTS["top_k"]):
    """Keep scores at or above the k-th highest; ties at the cut survive; k <= 0 keeps all."""
    if k <= 0:
        return df
    return _top_k(df, k, skew.hot_keys(df, GROUP))


def top_k_by(df, k, most):
    """The same with a positive column k of at most `most`."""
    return _top_k(df, k, skew.hot_keys(df, GROUP), None if most is None else most + 1)


def top_p_filter(df, p=SAMPLING_DEFAULTS["top_p"]):
    """Keep an item while the softmax mass before it is at most p; the first always stays."""
    if p >= 1.0:
        return df
    return _top_p(df, p, skew.hot_keys(df, GROUP))


def sample_one(df, seed, out="item_id"):
    """One item per group with probability softmax(score).

    Adding a Gumbel draw to each score and taking the largest needs neither the normaliser nor a
    window: one aggregate that combines before its shuffle.
    """
    gumbel = F.col("score") - F.log(-F.log(draw_unit(seed, "sample", ["group_id", "item_id"])))
    alive = df.filter(F.col("score") > float("-inf"))
    return alive.select("group_id", "item_id", gumbel.alias("_g")).groupBy("group_id").agg(
        F.max_by("item_id", "_g").alias(out))


def filtered_candidates(df, params, seen=None, step=1):
    """Temperature, repetition penalty (not at step 0), top-k and top-p, in this order.

    `params` has one resolved row per group (see `templates.resolve_params`).
    """
    wanted = params.select("group_id", "temperature", "top_k", "top_p", "repetition_penalty")
    hot = skew.hot_keys(df, GROUP)
    rows = _join_group(df, wanted, hot=hot).withColumn(
        "score", F.col("score") / F.col("temperature"))
    if step > 0 and seen is not None:
        rows = repetition_penalty(rows, seen, F.col("repetition_penalty"))
    rows = rows.select("group_id", "item_id", "score", "top_k", "top_p")
    # One number lets Spark prune ranks before the shuffle; each group is cut at its own k.
    low, high = params.agg(F.min("top_k"), F.max("top_k")).first()
    survivors = _top_k(rows, F.col("top_k"), hot, high if low is not None and low > 0 else None)
    # What survived may still hold a large group of ties.
    still_hot = hot if hot is None else skew.hot_keys(survivors, GROUP)
    return _top_p(survivors, F.col("top_p"), still_hot).select("group_id", "item_id", "score")


def sample_next(df, params, seed, seen=None, step=1):
    """One sampled item per group after all filters."""
    return sample_one(filtered_candidates(df, params, seen, step), seed)
