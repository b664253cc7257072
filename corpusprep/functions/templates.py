"""Column expressions over messages, responses and generation parameters."""

from pyspark.sql import functions as F

from corpusprep.constants import SAMPLING_DEFAULTS

# Unicode-aware: F.trim removes spaces only.
_STRIP = r"(?U)^\s+|\s+$"


def user_content(context, instruction):
    """`context`, a blank line and `instruction`; only `instruction` when context is null or ''."""
    joined = F.concat(context, F.lit("\n\n"), instruction)
    return F.when(F.length(context) > 0, joined).otherwise(instruction)


def instruction_text(context, instruction, response):
    """Tokenizer training text of one instruction record."""
    return F.concat(F.lit("<user>"), user_content(context, instruction),
                    F.lit("<assistant>"), response)


def to_conversation(df, id_col="rec_id"):
    """Two turns per instruction record, as `(conv_id, turn, role, text)`."""
    question = F.struct(F.lit(0).cast("bigint").alias("turn"), F.lit("user").alias("role"),
                        user_content(F.col("context"), F.col("instruction")).alias("text"))
    answer = F.struct(F.lit(1).cast("bigint").alias("turn"), F.lit("assistant").alias("role"),
                      F.col("response").alias("text"))
    return df.select(F.col(id_col).alias("conv_id"), F.inline(F.array(question, answer)))


def render_message(role, content):
    """`<role>content`."""
    return F.concat(F.lit("<"), role, F.lit(">"), content)


def clean_response(text, n_tokens):
    """Text before `<user>`, then before `<eos>`, stripped; `...` when nothing was generated."""
    cut = F.substring_index(F.substring_index(text, "<user>", 1), "<eos>", 1)
    return F.when(n_tokens > 0, F.regexp_replace(cut, _STRIP, "")).otherwise(F.lit("..."))


def truncate_at_stop(tokens, stop_ids, max_length=SAMPLING_DEFAULTS["max_length"]):
    """Tokens before the first stop id, at most `max_length` of them."""
    limit = F.least(F.size(tokens), F.lit(max_length))
    if not stop_ids:
        return F.slice(tokens, 1, limit)
    first = [F.array_position(tokens, F.lit(s).cast("int")) for s in stop_ids]
    ends = [F.when(p > 0, p - 1).otherwise(limit) for p in first]
    return F.slice(tokens, 1, F.least(limit, *ends).cast("int"))


def resolve_params(requests, defaults=None):
    """Per-request values where given, defaults elsewhere; other columns pass through."""
    defaults = {**SAMPLING_DEFAULTS, **(defaults or {})}
    filled = {}
    for name, value in defaults.items():
        default = F.lit(value)
        filled[name] = F.coalesce(F.col(name), default) if name in requests.columns else default
    return requests.withColumns(filled)


def override_defaults(**changes):
    """New defaults; names that are not generation parameters are ignored."""
    return {k: changes.get(k, v) for k, v in SAMPLING_DEFAULTS.items()}
