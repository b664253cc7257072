"""Exact order, batches, padding and splits."""

from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.constants import ACCUMULATION_STEPS, IGNORE_INDEX, PAD, STAGES, TRAIN_FRACTION
from corpusprep.functions.hashing import shuffle_key
from corpusprep.functions.permute import permuted
from corpusprep.operators.examples import supervised_tokens
from corpusprep.plans.lineage import cut
from corpusprep.plans.scan import HASHED, WHOLE_TABLE, position


def ordered_index(df, id_col, keys=(), out="position"):
    """0-based position by ascending id; ids must be distinct within `keys`."""
    return position(df, list(keys), F.col(id_col), out, WHOLE_TABLE)


def shuffled_index(df, id_cols, seed, keys=(), out="position"):
    """0-based position in a seeded random order; ids must be distinct within `keys`."""
    keyed = df.withColumn("_order", shuffle_key(seed, [*keys, *id_cols]))
    return position(keyed, list(keys), F.col("_order"), out, HASHED, id_cols).drop("_order")


def batch_plan(lengths, batch_size, id_col="conv_id", keys=(), seed=None):
    """Where each example goes: `keys, id, n, batch_id, slot, width`.

    `lengths` holds `keys, id, n` only, so the arrays are not moved to find their batch. Order is
    ascending id, or a seeded shuffle when `seed` is given.
    """
    size = F.lit(batch_size) if isinstance(batch_size, int) else batch_size
    indexed = (ordered_index(lengths, id_col, keys, "_at") if seed is None
               else shuffled_index(lengths, [id_col], seed, keys, "_at"))
    placed = indexed.withColumns({"batch_id": F.floor(F.col("_at") / size),
                                  "slot": (F.col("_at") % size).cast("int")})
    batch = Window.partitionBy(*keys, "batch_id")
    return placed.withColumn("width", F.max("n").over(batch)).drop("_at")


def pad(examples, plan, id_col="conv_id", keys=(), pad_id=PAD, ignore=IGNORE_INDEX):
    """Right-pad every example to the width of its batch."""
    def fill(col, value):
        return F.concat(col, F.array_repeat(F.lit(value), F.col("width") - F.size(col)))
    where = plan.select(*keys, id_col, "batch_id", "slot", "width")
    return examples.join(where, [*keys, id_col]).withColumns(
        {"input_ids": fill("input_ids", pad_id), "targets": fill("targets", ignore)})


def batch_and_pad(examples, batch_size, id_col="conv_id", keys=(), seed=None,
                  pad_id=PAD, ignore=IGNORE_INDEX):
    """Consecutive batches, the last one possibly short, padded to their own longest example."""
    extra = [] if isinstance(batch_size, int) else ["batch_size"]
    lengths = examples.select(*keys, *extra, id_col, F.size("input_ids").alias("n"))
    plan = batch_plan(lengths, batch_size, id_col, keys, seed)
    return pad(examples, plan, id_col, keys, pad_id, ignore)


# Examples that meet an attempt in one row of the join.
_TOGETHER = 12


def attempt_batches(lengths, gated, seed, stages=None, id_col="conv_id"):
    """Batches of every attempt at its stage's size, in a fresh order each: `run, attempt, stage,
    id, batch_id, slot, n, width`.

    `lengths(id, n)` has the ids and labels of each example before truncation, `gated(run, attempt,
    stage)` the attempts as `metrics.curriculum_gate` gives them; ids, runs and attempts are not
    null. Examples are indexed once; an attempt's order is a keyed permutation of that index, so no
    attempt sorts or shuffles its examples to find their batch. `n` is the length that the stage
    leaves, `width` the longest of the batch. Without examples or attempts there are no rows.
    """
    indexed = cut(ordered_index(lengths.select(id_col, "n"), id_col, out="_at"))
    count = indexed.count()
    rules = F.create_map(*[x for i, (length, size, _) in enumerate(stages or STAGES, 1) for x in (
        F.lit(i), F.struct(F.lit(length).alias("max_len"), F.lit(size).alias("size")))])
    # Every attempt reads every example: it meets them a cell at a time.
    cells = F.sequence(F.lit(0).cast("bigint"), F.lit(max(count - 1, 0) >> _TOGETHER).cast("bigint"))
    asked = gated.select("run", "attempt", "stage", rules[F.col("stage").cast("int")].alias("_rule"),
                         F.explode(cells).alias("_cell"))
    met = indexed.withColumn("_cell", F.shiftright("_at", _TOGETHER)).join(asked, "_cell")
    place = permuted(F.col("_at"), count, seed, ["run", "stage", "attempt"])
    placed = met.select("run", "attempt", "stage", id_col, "_rule", F.greatest(F.least(
        F.col("n"), F.col("_rule.max_len")) - 1, F.lit(0)).alias("n"), place.alias("_place"))
    batches = placed.select(
        "run", "attempt", "stage", id_col, F.floor(F.col("_place") / F.col("_rule.size")).alias(
            "batch_id"), (F.col("_place") % F.col("_rule.size")).cast("int").alias("slot"), "n")
    return batches.withColumn("width", F.max("n").over(
        Window.partitionBy("run", "attempt", "batch_id")))


def stage_plan(staged, id_col="conv_id"):
    """Per stage: examples, batches, optimizer steps, supervised tokens and padding."""
    lengths = staged.select("stage", "batch_size", id_col, F.size("input_ids").alias("n"),
                            supervised_tokens("targets").alias("supervised"))
    plan = batch_plan(lengths, F.col("batch_size"), id_col, ["stage"])
    batches = F.ceil(F.col("examples") / F.col("batch_size"))
    return (plan.groupBy("stage", "batch_size")
            .agg(F.count(F.lit(1)).alias("examples"),
                 F.sum("supervised").alias("supervised_tokens"),
                 F.sum("n").alias("tokens"),
                 F.sum("width").cast("bigint").alias("cells"))
            .withColumn("batches", batches)
            .withColumn("steps", F.floor(F.col("batches") / ACCUMULATION_STEPS))
            .withColumn("padded_cells", F.col("cells") - F.col("tokens"))
            .withColumn("padding_ratio", F.when(
                F.col("cells") > 0, F.col("padded_cells") / F.col("cells")).otherwise(0.0)))


def seeded_shuffle_split(df, id_cols, seed, fraction=TRAIN_FRACTION, n=None):
    """Label rows `train` or `validation`, cut at exactly `int(count * fraction)` or at `n`.

    Membership needs no total order: all hashed cells but the one the cut falls into are decided
    by their count, so only that one of 65,536 cells is ranked. Ids must be distinct.
    """
    keyed = df.withColumn("_order", shuffle_key(seed, id_cols)).withColumn(
        "_cell", F.shiftright("_order", HASHED[0]))
    # At most 65,536 rows from here to the edge.
    every = Window.partitionBy(F.lit(0))
    earlier = every.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = keyed.groupBy("_cell").agg(F.count(F.lit(1)).alias("rows")).withColumns({
        "before": F.coalesce(F.sum("rows").over(earlier), F.lit(0)),
        "total": F.sum("rows").over(every)})
    limit = F.lit(n) if n is not None else F.floor(
        F.col("total") * F.lit(Decimal(str(fraction))))
    # At most one cell straddles the limit; none when it takes every row.
    edge = cells.withColumn("take", limit - F.col("before")).filter(
        (F.col("take") >= 0) & (F.col("take") < F.col("rows"))).agg(F.struct(
            F.max("_cell").alias("cell"), F.max("take").alias("take"))).scalar()
    at_edge = F.coalesce(F.col("_cell") == edge["cell"], F.lit(False))
    sure = keyed.filter(~at_edge).withColumn("split", F.when(
        edge["cell"].isNull() | (F.col("_cell") < edge["cell"]), "train").otherwise("validation"))
    rank = F.row_number().over(Window.partitionBy("_cell").orderBy("_order", *id_cols))
    edge_rows = keyed.filter(at_edge).withColumn("split", F.when(
        rank <= edge["take"], "train").otherwise("validation"))
    return sure.unionByName(edge_rows).drop("_order", "_cell")
