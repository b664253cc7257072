"""P1-P7, C1-C2."""

from pyspark.sql import functions as F

from corpusprep.constants import MAX_HISTORY_TOKENS, SAMPLING_DEFAULTS
from corpusprep.functions import templates
from corpusprep.functions.chars import CharTokenizer, char_encode
from corpusprep.operators.context import render_history, trim_history
from corpusprep.queries.registry import (
    CONTENT_SQL, INSTRUCTIONS_SQL, chars_sql, conversations, listed, instructions, query, table)

# A full stop ends a sentence in the derived token streams.
STOPS = (3, 7 + ord("."))


@query("user_content", f"WITH {INSTRUCTIONS_SQL} SELECT rec_id, {CONTENT_SQL} AS content "
                       "FROM instructions")
def user_content(spark, sf_dir):
    return instructions(spark, sf_dir).select("rec_id", templates.user_content(
        F.col("context"), F.col("instruction")).alias("content"))


@query("instruction_text", f"WITH {INSTRUCTIONS_SQL} SELECT rec_id, '<user>' || {CONTENT_SQL} || "
                           "'<assistant>' || response AS text FROM instructions")
def instruction_text(spark, sf_dir):
    return instructions(spark, sf_dir).select("rec_id", templates.instruction_text(
        F.col("context"), F.col("instruction"), F.col("response")).alias("text"))


@query("to_conversation", f"""
WITH {INSTRUCTIONS_SQL}
SELECT rec_id AS conv_id, 0::BIGINT AS turn, 'user' AS role, {CONTENT_SQL} AS text FROM instructions
UNION ALL
SELECT rec_id, 1, 'assistant', response FROM instructions""")
def to_conversation(spark, sf_dir):
    return templates.to_conversation(instructions(spark, sf_dir))


@query("render_message",
       "SELECT conv_id, turn, '<' || role || '>' || text AS message FROM conversations")
def render_message(spark, sf_dir):
    return conversations(spark, sf_dir).select("conv_id", "turn", templates.render_message(
        F.col("role"), F.col("text")).alias("message"))


@query("clean_response", """
SELECT conv_id, turn, CASE WHEN n_tokens = 0 THEN '...' ELSE regexp_replace(
         split_part(split_part(raw, '<user>', 1), '<eos>', 1), '^\\s+|\\s+$', '', 'g') END
       AS response
FROM (SELECT conv_id, turn, CASE WHEN role = 'system' THEN 0 ELSE length(text) END AS n_tokens,
        chr(10) || text || CASE role WHEN 'user' THEN chr(9) || '<eos> tail<user>'
                                WHEN 'assistant' THEN ' <user>next<eos>' ELSE '' END AS raw
      FROM conversations)""")
def clean_response(spark, sf_dir):
    tail = (F.when(F.col("role") == "user", F.lit("\t<eos> tail<user>"))
            .when(F.col("role") == "assistant", F.lit(" <user>next<eos>")).otherwise(F.lit("")))
    size = F.when(F.col("role") == "system", 0).otherwise(F.length("text"))
    return conversations(spark, sf_dir).select("conv_id", "turn", templates.clean_response(
        F.concat(F.lit("\n"), "text", tail), size).alias("response"))


@query("truncate_at_stop", f"""
SELECT conv_id, turn, (ids[1:least(
    len(ids), {SAMPLING_DEFAULTS['max_length']},
    coalesce(nullif(list_position(ids, {STOPS[0]}), 0) - 1, len(ids)),
    coalesce(nullif(list_position(ids, {STOPS[1]}), 0) - 1, len(ids)))])::VARCHAR AS ids
FROM (SELECT conv_id, turn, {chars_sql('text')} AS ids FROM conversations)""")
def truncate_at_stop(spark, sf_dir):
    tokens = conversations(spark, sf_dir).withColumn("tokens", char_encode(F.col("text")))
    return tokens.select("conv_id", "turn", listed(
        templates.truncate_at_stop(F.col("tokens"), STOPS)).alias("ids"))


@query("resolve_params", f"""
SELECT event_id, {SAMPLING_DEFAULTS['max_length']}::BIGINT AS max_length,
       coalesce(CASE event_type WHEN 'click' THEN value / 100 END,
                {SAMPLING_DEFAULTS['temperature']})::DOUBLE AS temperature,
       {SAMPLING_DEFAULTS['top_p']}::DOUBLE AS top_p,
       coalesce(CASE event_type WHEN 'view' THEN user_id END,
                {SAMPLING_DEFAULTS['top_k']})::BIGINT AS top_k,
       {SAMPLING_DEFAULTS['repetition_penalty']}::DOUBLE AS repetition_penalty
FROM events""")
def resolve_params(spark, sf_dir):
    requests = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "click", F.col("value") / 100).alias("temperature"),
        F.when(F.col("event_type") == "view", F.col("user_id")).alias("top_k"))
    return templates.resolve_params(requests).withColumns(
        {c: F.col(c).cast("bigint") for c in ("max_length", "top_k")})


_EXCHANGES_SQL = """
nxt AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
  FROM conversations),
pairs AS (
  SELECT conv_id, turn, '<user>' || text || '<assistant>' AS current,
         CASE WHEN next_role = 'assistant' THEN next_text END AS response
  FROM nxt WHERE role = 'user')
"""


@query("render_history", f"""
WITH {_EXCHANGES_SQL},
pieces AS (
  SELECT conv_id, turn, response IS NULL AS is_current, current || coalesce(response, '') AS piece
  FROM pairs p
  WHERE response IS NOT NULL
     OR turn = (SELECT max(turn) FROM pairs q WHERE q.conv_id = p.conv_id))
SELECT conv_id, turn, is_current, piece,
       coalesce(sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY turn
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_char
FROM pieces""")
def history(spark, sf_dir):
    return render_history(conversations(spark, sf_dir))


TRIM_SQL = f"""
WITH {_EXCHANGES_SQL},
sized AS (
  SELECT *, length(current) AS cur, coalesce(length(current || response), 0) AS len,
         coalesce(sum(length(current || response)) OVER (PARTITION BY conv_id ORDER BY turn
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM pairs)
SELECT t.conv_id, t.turn,
       coalesce(string_agg(j.current || j.response, '' ORDER BY j.turn), '')
         || any_value(t.current) AS context,
       (coalesce(sum(j.len), 0) + any_value(t.cur))::BIGINT AS n_tokens,
       count(j.turn)::BIGINT AS n_exchanges
FROM sized t LEFT JOIN sized j
  ON t.conv_id = j.conv_id AND j.turn < t.turn AND j.response IS NOT NULL
 AND t.start - j.start + t.cur <= {MAX_HISTORY_TOKENS}
GROUP BY t.conv_id, t.turn"""


@query("trim_history", TRIM_SQL)
def trimmed(spark, sf_dir):
    return trim_history(conversations(spark, sf_dir), CharTokenizer())
