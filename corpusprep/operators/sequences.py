"""Sampling whole sequences from logged scores of every step (L6 over many steps).

The penalty of a step touches one score only, that of the token drawn before it. So a step is a map
from the last token to the drawn one: one default, and exceptions for the few tokens whose penalty
changes what is drawn. All maps are worked out at once, whatever was drawn before. Maps compose to
maps of the same size, so the token before any step follows from a prefix over cells of steps, and
no request is worked through step by step.
"""

from pyspark.sql import functions as F

from corpusprep.functions.hashing import draw_unit
from corpusprep.functions.templates import truncate_at_stop
from corpusprep.operators import candidates

#: Steps composed in one row at a time.
CELL = 32
_UNIT = float(1 << 32)


def _draw(items, last, request):
    """The token drawn from `items(item_id, score, noise)` after the token `last`, null for none.

    `request` has the columns top_k, top_p and repetition_penalty. The filters are those of
    `candidates`: ties at the k-th score stay, and an item stays while the mass before it is at most
    top_p, masses being whole multiples of 2**-32 of the best.
    """
    by = request["repetition_penalty"]
    pushed = F.transform(items, lambda x: F.struct(
        # Negated, so that plain ascending order is descending score, then ascending id.
        (-F.when(~x["item_id"].eqNullSafe(last), x["score"]).when(
            x["score"] < 0, x["score"] * by).otherwise(x["score"] / by)).alias("down"),
        x["item_id"].alias("item_id"), x["noise"].alias("noise")))
    # A one-element array names a value, so that it is worked out once.
    def given(value, use):
        return F.element_at(F.transform(F.array(value), use), 1)

    def drawn(best):
        def share(x):
            return F.when(x["down"] == best[0]["down"], 1.0).otherwise(
                F.exp(best[0]["down"] - x["down"]))

        def unit(x):
            return F.round(share(x) * _UNIT).cast("long")

        def chosen(limit):
            start = F.struct(F.lit(0).cast("long").alias("mass"), F.lit(None).cast("double").alias(
                "top"), F.lit(None).cast("long").alias("item_id"), F.lit(True).alias("first"))

            def step(acc, x):
                value = x["noise"] - x["down"]
                better = (acc["first"] | (acc["mass"].cast("double") <= limit)) & (
                    x["down"] < float("inf")) & (acc["top"].isNull() | (value > acc["top"]))
                return F.struct(
                    (acc["mass"] + unit(x)).alias("mass"),
                    F.when(better, value).otherwise(acc["top"]).alias("top"),
                    F.when(better, x["item_id"]).otherwise(acc["item_id"]).alias("item_id"),
                    F.lit(False).alias("first"))
            return F.aggregate(best, start, step, lambda acc: acc["item_id"])

        total = F.aggregate(best, F.lit(0).cast("long"), lambda acc, x: acc + unit(x))
        return given(F.when(request["top_p"] >= 1.0, F.lit(float("inf"))).otherwise(
            request["top_p"] * total.cast("double")), chosen)

    def cut(ordered):
        kth = F.element_at(ordered, F.least(request["top_k"], F.size(ordered)).cast("int"))["down"]
        return given(F.filter(ordered, lambda x: x["down"] <= kth), drawn)

    return given(F.sort_array(pushed), cut)


def step_maps(scores, params, seed):
    """`(request_id, step, usual, others)`: the token that a step draws, and `(last, drawn)` for the
    last tokens after which it draws another one.

    Only the best top_k + 1 scores of a step (and what ties with them) can matter: a penalised
    token among the kept ones may fall behind the next, and penalising any other changes nothing.
    """
    low, weak = params.agg(F.min("top_k"), F.min("repetition_penalty")).first()
    if low is not None and low <= 0:
        raise ValueError("top_k has to be positive: it bounds what a step depends on")
    if weak is not None and weak < 1:
        raise ValueError("a penalty below 1 is not supported")
    settings = ["temperature", "top_k", "top_p", "repetition_penalty"]
    key = F.struct("request_id", "step")
    usable = scores.filter("score is not null and not isnan(score) and item_id is not null")
    scaled = usable.join(params.select("request_id", *settings), "request_id").select(
        key.alias("group_id"), "item_id", (F.col("score") / F.col("temperature")).alias("score"),
        "top_k", "top_p", "repetition_penalty")
    best = candidates.top_k_by(scaled, F.col("top_k") + 1, params.agg(F.max("top_k")).first()[0])
    noise = -F.log(-F.log(draw_unit(seed, "sequence", [
        "group_id.request_id", "group_id.step", "item_id"])))
    rows = best.withColumn("noise", noise).groupBy("group_id").agg(
        F.collect_list(F.struct("item_id", "score", "noise")).alias("items"),
        *[F.first(c).alias(c) for c in settings[1:]])
    request = {c: F.col(c) for c in settings[1:]}
    usual = _draw(F.col("items"), F.lit(None).cast("long"), request)
    named = rows.select("group_id", "items", *settings[1:], F.explode(F.array(usual)).alias("usual"))
    # Another token's penalty leaves this draw as it is unless it is among the best.
    after = F.transform("items", lambda x: F.struct(
        x["item_id"].alias("last"), _draw(F.col("items"), x["item_id"], request).alias("drawn")))
    return named.select("group_id.request_id", "group_id.step", "usual", F.filter(
        after, lambda e: ~e["drawn"].eqNullSafe(F.col("usual"))).alias("others"))


def _apply(one, last):
    """What the map draws after `last`; its exceptions are few."""
    found = F.filter(one["others"], lambda e: e["last"] == last)
    return F.when(F.size(found) > 0, F.get(found, F.lit(0))["drawn"]).otherwise(one["usual"])


def tokens_before(maps, cell=CELL):
    """Add `last`, the token drawn before each step of `maps(request_id, step, usual, others)`, null
    before the first. Steps are 0, 1, 2, ... of each request."""
    cells = maps.withColumn("cell", F.floor(F.col("step") / cell)).groupBy("request_id", "cell").agg(
        F.array_sort(F.collect_list(F.struct("step", "usual", "others"))).alias("steps"))

    def through(last):
        return F.aggregate(F.col("steps"), last, lambda x, one: _apply(one, x))

    none = F.lit(None).cast("long")
    last_step = maps.agg(F.max("step")).first()[0]
    if last_step is None or last_step < cell:
        entered = cells.withColumn("last", none)
    else:
        # A cell as a map: its exceptions are those of its first step.
        keys = F.transform(F.col("steps")[0]["others"], lambda e: e["last"])
        composed = cells.withColumn("usual", through(F.lit(-1).cast("long"))).select(
            "request_id", F.col("cell").alias("step"), "usual", F.transform(
                keys, lambda k: F.struct(k.alias("last"), through(k).alias("drawn"))).alias("others"))
        above = tokens_before(composed.select("request_id", "step", "usual", "others"), cell)
        entered = cells.join(above.select("request_id", F.col("step").alias("cell"), "last"),
                             ["request_id", "cell"])
    # Through the steps of the cell, noting what came before each.
    noted = F.aggregate(
        F.col("steps"), F.struct(F.col("last").alias("last"), F.array().cast("array<long>").alias(
            "seen")),
        lambda acc, one: F.struct(_apply(one, acc["last"]).alias("last"), F.concat(
            acc["seen"], F.array(acc["last"])).alias("seen")), lambda acc: acc["seen"])
    return entered.select("request_id", F.explode(F.arrays_zip("steps", noted.alias(
        "seen"))).alias("x")).select("request_id", "x.steps.*", F.col("x.seen").alias("last"))


def sample_sequences(scores, params, seed, stop_ids=()):
    """`(request_id, tokens)`: the tokens that each request draws from `scores(request_id, step,
    item_id, score)` step after step, up to its first stop id or `max_length` tokens.

    Steps of a request are numbered from 0 without gaps. `params` has one resolved row per request
    (see `templates.resolve_params`) with one max_length for all. The penalty is on the token drawn last, as in
    generation; the first step has none. Null and NaN scores are no candidates, minus infinity is
    never drawn; a step without any candidate ends its request. Requests without scores have no
    tokens and no row.
    """
    longest = params.agg(F.max("max_length")).first()[0]
    if longest is None:
        longest = 0
    maps = step_maps(scores.filter(F.col("step") < longest), params, seed)
    drawn = tokens_before(maps).withColumn("token", _apply(
        {"usual": F.col("usual"), "others": F.col("others")}, F.col("last")))
    # At most max_length tokens a request. A gap, or a step that draws nothing, ends it.
    gathered = drawn.groupBy("request_id").agg(
        F.array_sort(F.collect_list(F.struct("step", "token"))).alias("all"))
    sound = F.filter("all", lambda x, i: x["token"].isNull() | (x["step"] != i))
    end = F.when(F.size(sound) > 0, F.array_position(F.col("all"), sound[0]) - 1).otherwise(
        F.size("all"))
    tokens = F.transform(F.slice("all", F.lit(1), end.cast("int")), lambda x: x["token"].cast("int"))
    return gathered.select("request_id", truncate_at_stop(tokens, stop_ids, longest).alias("tokens"))
