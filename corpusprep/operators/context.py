"""Chat context per session: exchanges, rendered history and trimming to a token budget.

`turn` is the list position of a message, 0-based and gapless (see `examples.number_turns`).
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.constants import MAX_HISTORY_TOKENS
from corpusprep.plans import scan
from corpusprep.plans.scan import fits_in_task, running_total


_STRETCH = "_stretch"


def exchanges(turns, plain=None):
    """User messages with the assistant reply that directly follows, null when there is none."""
    plain = fits_in_task(turns, ["conv_id"]) if plain is None else plain
    chat = turns.filter(F.col("role").isin("user", "assistant"))
    scope = ["conv_id"]
    if not plain:
        # A long session is cut into stretches of turns; a reply that opens a stretch is also
        # shown to the one before it.
        stretch = F.shiftright("turn", scan.WITHIN_KEY[0])
        opens = (F.col("turn") % (1 << scan.WITHIN_KEY[0]) == 0) & (F.col("role") == "assistant")
        homes = F.when(opens, F.array(stretch, stretch - 1)).otherwise(F.array(stretch))
        chat = chat.withColumn(_STRETCH, F.explode(homes))
        scope = ["conv_id", _STRETCH]
    window = Window.partitionBy(*scope).orderBy("turn")
    after = F.struct("turn", "role", "text")
    paired = chat.withColumn("_next", F.lead(after).over(window)).filter(F.col("role") == "user")
    answered = (F.col("_next.turn") == F.col("turn") + 1) & (F.col("_next.role") == "assistant")
    return paired.select("conv_id", "turn", F.col("text").alias("user_text"),
                         F.when(answered, F.col("_next.text")).alias("response"))


def _current(user_text):
    return F.concat(F.lit("<user>"), user_text, F.lit("<assistant>"))


def render_history(turns):
    """The rendered history of each conversation as ordered pieces.

    `conv_id, turn, start_char, piece, is_current`: one piece per completed exchange, then the
    last user message when it has no reply. Concatenating `piece` by `turn` gives the context.
    """
    plain = fits_in_task(turns, ["conv_id"])
    pairs = exchanges(turns, plain)
    last = pairs.groupBy("conv_id").agg(F.max("turn").alias("turn"))
    done = pairs.filter(F.col("response").isNotNull())
    open_turn = pairs.filter(F.col("response").isNull()).join(last, ["conv_id", "turn"])
    pieces = done.unionByName(open_turn.select(done.columns)).select(
        "conv_id", "turn", F.col("response").isNull().alias("is_current"),
        F.concat(_current(F.col("user_text")), F.coalesce("response", F.lit(""))).alias("piece"))
    return running_total(pieces, ["conv_id"], F.col("turn"),
                         {"start_char": F.length("piece").cast("bigint")}, plain=plain)


def trim_history(turns, tokenizer, max_tokens=MAX_HISTORY_TOKENS):
    """The context of every user message, trimmed to `max_tokens`.

    `conv_id, turn, context, n_tokens, n_exchanges`. The oldest exchanges are dropped until
    history and current message fit; an oversized current message is kept whole. Token counts of
    segments add up, so an exchange is kept exactly when its offset lies in a range that ends at
    the current message. Offsets are bucketed by `max_tokens`: a range meets at most two buckets
    and a bucket holds only what fits in `max_tokens`, whatever the size of the session.
    """
    plain = fits_in_task(turns, ["conv_id"])
    pairs = exchanges(turns, plain)
    exchange = F.when(F.col("response").isNotNull(),
                      F.concat(_current(F.col("user_text")), F.col("response")))
    current = tokenizer.prepare(pairs, _current(F.col("user_text"))).withColumnsRenamed(
        {"n_tokens": "cur_tokens"}).drop("payload")
    sized = tokenizer.prepare(current.withColumn("piece", exchange), F.col("piece")).drop("payload")
    placed = running_total(sized, ["conv_id"], F.col("turn"), {"start": F.col("n_tokens")},
                           plain=plain)
    past = placed.filter(F.col("piece").isNotNull()).select(
        "conv_id", F.floor(F.col("start") / max_tokens).alias("bucket"),
        F.col("start").alias("at"), F.col("n_tokens").alias("piece_tokens"), "piece")
    lower = F.greatest(F.col("start") + F.col("cur_tokens") - max_tokens, F.lit(0))
    now = placed.select("conv_id", "turn", F.col("start").alias("upper"), lower.alias("lower"))
    reach = F.sequence(F.floor(F.col("lower") / max_tokens),
                       F.floor((F.col("upper") - 1) / max_tokens))
    wanted = now.filter(F.col("lower") < F.col("upper")).withColumn("bucket", F.explode(reach))
    in_range = (F.col("at") >= F.col("lower")) & (F.col("at") < F.col("upper"))
    meeting = ["conv_id", "bucket"]
    if not plain:
        # Many unanswered messages may look at one bucket: give each stretch of them a copy.
        wanted = wanted.withColumn(_STRETCH, F.shiftright("turn", scan.WITHIN_KEY[0]))
        past = past.join(wanted.select(*meeting, _STRETCH).distinct(), meeting)
        meeting = [*meeting, _STRETCH]
    history = wanted.join(past, meeting).filter(in_range).select(
        "conv_id", "turn", "at", "piece", "piece_tokens", F.lit(1).alias("is_past"))
    own = placed.select("conv_id", "turn", F.col("start").alias("at"),
                        _current(F.col("user_text")).alias("piece"),
                        F.col("cur_tokens").alias("piece_tokens"), F.lit(0).alias("is_past"))
    ordered = F.array_sort(F.collect_list(F.struct(
        (1 - F.col("is_past")).alias("late"), "at", "piece")))
    return history.unionByName(own).groupBy("conv_id", "turn").agg(
        F.array_join(F.transform(ordered, lambda p: p["piece"]), "").alias("context"),
        F.sum("piece_tokens").alias("n_tokens"), F.sum("is_past").alias("n_exchanges"))
