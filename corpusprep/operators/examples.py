"""Label-masked, truncated, shifted training examples."""

from pyspark.sql import functions as F

from corpusprep.constants import IGNORE_INDEX, STAGES
from corpusprep.functions.templates import render_message
from corpusprep.plans.scan import fits_in_task, position, running_total


def number_turns(df, order_col):
    """Replace any per-conversation ordering column by the 0-based list position `turn`."""
    return position(df, ["conv_id"], F.col(order_col).cast("bigint"), "turn",
                    plain=fits_in_task(df, ["conv_id"]))


def encode_turns(turns, tokenizer, keep_last=None):
    """One row per message: `conv_id, turn, supervised, n_tokens, payload`."""
    message = turns.select("conv_id", "turn", (F.col("role") == "assistant").alias("supervised"),
                           render_message(F.col("role"), F.col("text")).alias("_message"))
    return tokenizer.prepare(message, F.col("_message"), keep_last).drop("_message")


def _labels(ids, supervised):
    return F.transform(ids, lambda i: F.when(supervised, i).otherwise(IGNORE_INDEX))


def assemble(turns, tokenizer):
    """Every token of every conversation with its label, one row per piece.

    The pieces of a conversation are `<bos>` (piece -1), its messages and `<eos>` (last);
    `start` is the token offset of the piece. Long form, so that a conversation of any length
    stays spread over tasks.
    """
    encoded = encode_turns(turns, tokenizer)
    placed = running_total(encoded, ["conv_id"], F.col("turn"), {"start": F.col("n_tokens")},
                           plain=fits_in_task(turns, ["conv_id"]))
    ids = tokenizer.ids(F.col("payload"))
    body = placed.select(
        "conv_id", F.col("turn").alias("piece"), (F.col("start") + 1).alias("start"),
        "supervised", ids.alias("input_ids"))
    body = body.select("conv_id", "piece", "start", "input_ids",
                       _labels(F.col("input_ids"), F.col("supervised")).alias("labels"))
    ends = encoded.groupBy("conv_id").agg(F.sum("n_tokens").alias("n"), F.max("turn").alias("last"))
    def mark(piece, start, token, label):
        return F.struct(piece.cast("bigint").alias("piece"), start.cast("bigint").alias("start"),
                        F.array(F.lit(token)).alias("input_ids"),
                        F.array(F.lit(label)).alias("labels"))
    marks = F.array(mark(F.lit(-1), F.lit(0), tokenizer.bos_id, IGNORE_INDEX),
                    mark(F.col("last") + 1, F.col("n") + 1, tokenizer.eos_id, tokenizer.eos_id))
    return body.unionByName(ends.select("conv_id", F.inline(marks)))


def truncate_left(tokens, max_length):
    """The last `max_length` elements."""
    limit = F.lit(max_length) if isinstance(max_length, int) else max_length
    return F.slice(tokens, F.greatest(F.lit(1), F.size(tokens) - limit + 1), limit)


def shift(df):
    """`ids, labels` to next-token pairs `input_ids, targets`."""
    last = F.greatest(F.size("ids") - 1, F.lit(0))
    return df.withColumns({"input_ids": F.slice("ids", 1, last),
                           "targets": F.slice("labels", 2, last)}).drop("ids", "labels")


def training_windows(turns, tokenizer, max_length):
    """The last `max_length` ids and labels of each conversation: `conv_id, ids, labels`.

    Only messages that reach into that tail are brought together, found by a running total from
    the end, so a row never gathers more than `max_length` tokens. Messages of a role other than
    the assistant get the ignore label; `<eos>` is always supervised.
    """
    encoded = encode_turns(turns, tokenizer, keep_last=max_length)
    backwards = F.bitwise_not(F.col("turn"))
    placed = running_total(encoded, ["conv_id"], backwards, {"after": F.col("n_tokens")},
                           plain=fits_in_task(turns, ["conv_id"]))
    # The last message always stays, so that a conversation survives max_length = 1.
    tail = placed.filter((F.col("after") < max_length - 1) | (F.col("after") == 0))
    piece = F.struct("turn", "supervised", "payload")
    whole = (F.col("turn") == 0) & (F.col("after") + F.col("n_tokens") + 2 <= max_length)
    gathered = tail.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"),
                                           F.max(whole).alias("whole"))
    encoded_pieces = F.transform("pieces", lambda p: F.struct(
        p["supervised"].alias("supervised"), tokenizer.ids(p["payload"]).alias("ids")))
    gathered = gathered.select("conv_id", "whole", encoded_pieces.alias("pieces"))
    def between_marks(first, body, last):
        start = F.when(F.col("whole"), F.array(F.lit(first))).otherwise(
            F.array().cast("array<int>"))
        return F.concat(start, body, F.array(F.lit(last)))
    labels = F.flatten(F.transform("pieces", lambda p: _labels(p["ids"], p["supervised"])))
    ids = F.flatten(F.transform("pieces", lambda p: p["ids"]))
    joined = gathered.select(
        "conv_id", between_marks(tokenizer.bos_id, ids, tokenizer.eos_id).alias("ids"),
        between_marks(IGNORE_INDEX, labels, tokenizer.eos_id).alias("labels"))
    return joined.withColumns({c: truncate_left(F.col(c), max_length) for c in ("ids", "labels")})


def training_examples(turns, tokenizer, max_length=512):
    """`conv_id, input_ids, targets`, at most `max_length - 1` long."""
    return shift(training_windows(turns, tokenizer, max_length))


def curriculum_examples(turns, tokenizer, stages=None):
    """The examples of every stage: `stage, max_len, batch_size, threshold, conv_id, ...`.

    Built once at the longest stage; a shorter stage is the tail of a longer one.
    """
    stages = stages or STAGES
    windows = training_windows(turns, tokenizer, max(s[0] for s in stages))
    rows = F.array(*[
        F.struct(F.lit(i).alias("stage"), F.lit(length).alias("max_len"),
                 F.lit(batch).alias("batch_size"), F.lit(float(threshold)).alias("threshold"))
        for i, (length, batch, threshold) in enumerate(stages, 1)])
    staged = windows.select("conv_id", "ids", "labels", F.inline(rows))
    cut = staged.withColumns({c: truncate_left(F.col(c), F.col("max_len"))
                              for c in ("ids", "labels")})
    return shift(cut)


def supervised_tokens(targets):
    """Number of targets that are not ignored (M4)."""
    return F.size(F.filter(targets, lambda t: t != IGNORE_INDEX))
