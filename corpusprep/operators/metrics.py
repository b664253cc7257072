"""Perplexity, cross-entropy, curriculum gate and run statistics (M1-M3, M5)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.constants import IGNORE_INDEX, STAGES
from corpusprep.plans.skew import hot_keys, join_per_key

# Scores are summed in bands of this width, so exp() inside a band cannot overflow. The top 13
# bands span more than 745, beyond which exp() is zero.
_BAND = 64.0
_BANDS = 13


def log_sum_exp(df, keys, score, out="lse", hit=None):
    """`ln(sum(exp(score)))` per key, without a prior pass for the maximum.

    Bands are plain sums, combined before their shuffle, and only the top bands of a key are
    brought together. `hit` is a Column of which the maximum per key is kept as well.
    """
    band = F.floor(score / _BAND).cast("double")
    sums = [F.sum(F.exp(score - F.col("_band") * _BAND)).alias("_s")]
    if hit is not None:
        sums.append(F.max(hit).alias("hit"))
    banded = df.withColumn("_band", band).groupBy(*keys, "_band").agg(*sums)
    key = Window.partitionBy(*keys)
    if hit is not None:
        banded = banded.withColumn("hit", F.max("hit").over(key))
    top = banded.withColumn("_r", F.row_number().over(key.orderBy(F.desc("_band")))).filter(
        F.col("_r") <= _BANDS)
    scaled = top.withColumn("_top", F.max("_band").over(key)).withColumn(
        "_s", F.col("_s") * F.exp((F.col("_band") - F.col("_top")) * _BAND))
    kept = [] if hit is None else [F.max("hit").alias("hit")]
    return scaled.groupBy(*keys).agg(
        (F.max("_top") * _BAND + F.log(F.sum("_s"))).alias(out), *kept)


def perplexity(log, by=("run",)):
    """`exp(sum(loss * n) / sum(n))` per group over batches with tokens; +inf when there is none."""
    scored = F.when(F.col("n_tokens") > 0, F.col("loss") * F.col("n_tokens"))
    summed = log.groupBy(*by).agg(F.sum(scored).alias("_loss"), F.sum("n_tokens").alias("tokens"))
    value = F.when(F.col("tokens") > 0, F.exp(F.col("_loss") / F.col("tokens"))).otherwise(
        F.lit(float("inf")))
    return summed.withColumn("ppl", value).drop("_loss")


def position_losses(logits, targets):
    """Loss of each supervised position: `row_id, position, loss`.

    `logits(row_id, position, item_id, score)`, `targets(row_id, position, target)`. A position
    has one logit per vocabulary entry, which bounds its group.
    """
    wanted = targets.filter(F.col("target") != IGNORE_INDEX)
    joined = logits.join(wanted, ["row_id", "position"])
    hit = F.when(F.col("item_id") == F.col("target"), F.col("score"))
    per = log_sum_exp(joined, ["row_id", "position"], F.col("score"), hit=hit)
    return per.select("row_id", "position", (F.col("lse") - F.col("hit")).alias("loss"))


def token_cross_entropy(logits, targets):
    """Mean loss over supervised positions; NaN when there is none."""
    return position_losses(logits, targets).agg(
        F.coalesce(F.avg("loss"), F.lit(float("nan"))).alias("cross_entropy"),
        F.count("loss").alias("positions"))


def _with_passes(attempts, thresholds, hot):
    """Attempts with the attempt that ends each stage of their run, nothing gathered per run."""
    passes = None
    for i, threshold in enumerate(thresholds, 1):
        good = attempts.filter(F.col("ppl") <= threshold).select("run", "attempt")
        earlier = [f"pass_{j}" for j in range(1, i)]
        if passes is not None:
            good = join_per_key(good, reached, ["run"], ["attempt"], hot=hot).filter(
                F.col("attempt") > F.col(earlier[-1]))
        reached = good.groupBy("run").agg(F.min("attempt").alias(f"pass_{i}"))
        passes = reached if passes is None else passes.join(reached, "run", "left")
    return join_per_key(attempts, passes, ["run"], ["attempt"], "left", hot=hot)


def curriculum_gate(attempts, stages=None):
    """The stage of every attempt `(run, attempt, ppl)` until the last stage is passed.

    A stage ends with its first attempt at or below the threshold, so each stage needs one
    minimum per run over the attempts after the previous stage: windows over one shuffle while
    every run fits in a task, else an aggregate per stage, so that no run is brought together.
    Attempts after completion are dropped; inf and NaN never pass.
    """
    thresholds = [float(s[2]) for s in (stages or STAGES)]
    hot = hot_keys(attempts, ["run"])
    rows = attempts.select("run", "attempt", "ppl") if hot is None else _with_passes(
        attempts, thresholds, hot)
    if hot is None:
        every = Window.partitionBy("run")
        for i, threshold in enumerate(thresholds, 1):
            good = F.col("ppl") <= threshold
            if i > 1:
                good = good & (F.col("attempt") > F.col(f"pass_{i - 1}"))
            rows = rows.withColumn(f"pass_{i}", F.min(F.when(good, F.col("attempt"))).over(every))
    marks = [F.col(f"pass_{i}") for i in range(1, len(thresholds) + 1)]
    beyond = [F.coalesce(F.col("attempt") > m, F.lit(False)) for m in marks]
    stage = F.lit(1)
    for b in beyond[:-1]:
        stage = stage + b.cast("int")
    passed = F.lit(False)
    for m in marks:
        passed = passed | F.coalesce(F.col("attempt") == m, F.lit(False))
    return rows.filter(~beyond[-1]).select("run", "attempt", "ppl", stage.alias("stage"),
                                           passed.alias("passed"))


def latest_stats(log):
    """Last step of each run and its learning rate; steps are distinct within a run."""
    return log.groupBy("run").agg(F.max("step").alias("step"),
                                  F.max_by("lr", "step").alias("lr"))
