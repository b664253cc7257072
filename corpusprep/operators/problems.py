"""Synthetic arithmetic word problems: generation and verification."""

from pyspark.sql import functions as F

from corpusprep.functions.hashing import draw_int

# The three problem texts (%d and %s are filled in reading order), the items and
# the ranges of the drawn numbers. Names are ours.
STARTS = ("%s starts with %d %s. They buy %d more, then give away %d to %s. "
          "How many %s do they have left?")
BAKERY = ("A bakery has %d cakes. They bake %d more in the morning and sell %d in the afternoon. "
          "How many cakes are left at the end of the day?")
GIVES = ("%s has %d %s. %s gives them %d %s, and they find another %d. Then, they lose %d. "
         "How many %s remain?")
TWO_STEPS = "%d + %d = %d; %d - %d = %d"
THREE_STEPS = "%d + %d = %d; %d + %d = %d; %d - %d = %d"
ITEMS = ["apples", "books", "coins", "marbles", "stickers"]
FIRST_RANGE, SECOND_RANGE, FOUND_RANGE = (20, 50), (5, 25), (1, 15)
NAMES = ["Ada", "Bela", "Chidi", "Dana", "Emre", "Farah", "Goran", "Hana", "Ivo", "Jun",
         "Kofi", "Lena", "Mei", "Nils", "Oona", "Priya", "Quinn", "Rosa", "Sami", "Tala"]

_STEP = r"\A\d+ [+-] \d+ = -?\d+\z"


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def generate_problems(ids, seed, id_col="id", keep=()):
    """One problem per row of `ids`: `id, *keep, prompt, completion`, fixed by seed and id."""
    def draw(field, low, high):
        return draw_int(seed, field, [id_col], low, high)
    drawn = ids.select(
        id_col, *keep, draw("template", 0, 2).alias("template"),
        _pick(NAMES, draw("name1", 0, len(NAMES) - 1)).alias("name1"),
        _pick(NAMES, draw("name2", 0, len(NAMES) - 1)).alias("name2"),
        _pick(ITEMS, draw("item", 0, len(ITEMS) - 1)).alias("item"),
        draw("n1", *FIRST_RANGE).alias("n1"), draw("n2", *SECOND_RANGE).alias("n2"),
        draw("found", *FOUND_RANGE).alias("found"))
    long = F.col("template") == 2
    held = F.col("n1") + F.col("n2") + F.when(long, F.col("found")).otherwise(0)
    drawn = drawn.withColumn("held", held).withColumn(
        "gone", draw("gone", F.lit(1), F.col("held") - 1))
    first, left = F.col("n1") + F.col("n2"), F.col("held") - F.col("gone")
    prompt = (F.when(F.col("template") == 0, F.format_string(
                  STARTS, "name1", "n1", "item", "n2", "gone", "name2", "item"))
              .when(F.col("template") == 1, F.format_string(BAKERY, "n1", "n2", "gone"))
              .otherwise(F.format_string(
                  GIVES, "name1", "n1", "item", "name2", "n2", "item", "found", "gone", "item")))
    completion = F.when(long, F.format_string(
        THREE_STEPS, F.col("n1"), F.col("n2"), first, first, F.col("found"), F.col("held"),
        F.col("held"), F.col("gone"), left)).otherwise(F.format_string(
            TWO_STEPS, F.col("n1"), F.col("n2"), first, first, F.col("gone"), left))
    return drawn.select(id_col, *keep, prompt.alias("prompt"), completion.alias("completion"))


def generate_n_problems(spark, n=1000, seed=0):
    """`n` problems with ids 0 .. n-1."""
    return generate_problems(spark.range(n), seed)


def verify_completions(problems):
    """Check every step of `completion` against the arithmetic, the chain and the prompt.

    Adds `n_steps, well_formed, arithmetic_ok, chain_ok, operands_ok, valid, answer`.
    """
    def parsed(words):
        return F.struct(F.get(words, F.lit(1)).alias("op"), *[
            F.get(words, F.lit(i)).try_cast("bigint").alias(c)
            for i, c in ((0, "a"), (2, "b"), (4, "r"))])
    words = F.transform(F.split("completion", "; "),
                        lambda step: F.when(step.rlike(_STEP), F.split(step, " ")))
    steps = problems.withColumn("_s", F.transform(words, parsed))
    def good(step):
        value = F.when(step["op"] == "+", step["a"] + step["b"]).when(
            step["op"] == "-", step["a"] - step["b"])
        return F.coalesce(value == step["r"], F.lit(False))
    chained = F.transform(F.sequence(F.lit(1), F.size("_s")), lambda i: (i == 1) | F.coalesce(
        F.get("_s", i - 1)["a"] == F.get("_s", i - 2)["r"], F.lit(False)))
    operands = F.concat(F.array(F.get("_s", F.lit(0))["a"]), F.transform("_s", lambda s: s["b"]))
    stated = F.transform(F.regexp_extract_all("prompt", F.lit(r"\d+"), 0),
                         lambda x: x.try_cast("bigint"))
    checked = steps.withColumns({
        "n_steps": F.size("_s"),
        "well_formed": F.forall("_s", lambda s: s["r"].isNotNull()),
        "arithmetic_ok": F.forall("_s", good),
        "chain_ok": F.forall(chained, lambda c: c),
        "operands_ok": operands.eqNullSafe(stated),
        "answer": F.element_at("_s", -1)["r"]})
    return checked.withColumn("valid", F.col("well_formed") & F.col("arithmetic_ok") & F.col(
        "chain_ok") & F.col("operands_ok")).drop("_s")
