"""L6 over many steps: a user's events, eight a step, are the scores of that user's request."""

from pyspark.sql import functions as F

from corpusprep.functions.templates import resolve_params
from corpusprep.operators.sequences import sample_sequences
from corpusprep.plans.scan import fits_in_task, position
from corpusprep.queries.registry import listed, query, table

SEED = 7
STOP = 3
ITEMS = 11

_SQL = f"""
WITH RECURSIVE placed AS (
  SELECT user_id AS request_id, event_id % {ITEMS} AS item_id, (value - 25) / 20 AS score,
         (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 8 AS step FROM events),
scores AS (SELECT request_id, step, item_id, max(score) AS score FROM placed GROUP BY 1, 2, 3),
params AS (
  SELECT user_id AS request_id, 1 + count(CASE WHEN event_type = 'click' THEN 1 END) % 7 AS top_k,
         0.5 + 0.1 * (user_id % 6) AS top_p, 1 + 0.5 * (user_id % 3) AS penalty
  FROM events GROUP BY user_id),
lasts AS (SELECT unnest([NULL, {', '.join(map(str, range(ITEMS)))}]) AS last),
pushed AS (
  SELECT request_id, step, last, item_id, top_k, top_p, CASE WHEN item_id IS DISTINCT FROM last THEN score / 0.7
         WHEN score < 0 THEN score / 0.7 * penalty ELSE score / 0.7 / penalty END AS score
  FROM scores JOIN params USING (request_id), lasts),
topk AS (
  SELECT * FROM pushed
  QUALIFY rank() OVER (PARTITION BY request_id, step, last ORDER BY score DESC) <= top_k),
e AS (SELECT *, exp(score - max(score) OVER (PARTITION BY request_id, step, last)) AS e FROM topk),
probs AS (SELECT *, e / sum(e) OVER (PARTITION BY request_id, step, last) AS prob FROM e),
mass AS (
  SELECT *, coalesce(sum(prob) OVER (PARTITION BY request_id, step, last ORDER BY score DESC, item_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM probs),
drawn AS (
  SELECT request_id, step, last, arg_max(item_id, score - ln(-ln(
         (('0x' || substr(md5('{SEED}|sequence|' || request_id || '|' || step || '|' || item_id), 1, 13))::BIGINT
          + 0.5::DOUBLE) / 4503599627370496))) AS token
  FROM mass WHERE before <= top_p OR before = 0 GROUP BY 1, 2, 3),
walked AS (
  SELECT request_id, step, token FROM drawn WHERE step = 0 AND last IS NULL
  UNION ALL
  SELECT d.request_id, d.step, d.token FROM walked w JOIN drawn d
  ON d.request_id = w.request_id AND d.step = w.step + 1 AND d.last = w.token
  WHERE d.step < 200),
whole AS (SELECT request_id, list(token ORDER BY step) AS t FROM walked GROUP BY 1)
SELECT request_id, (CASE WHEN list_contains(t, {STOP}) THEN t[1:list_position(t, {STOP}) - 1] ELSE t END
       )::VARCHAR AS tokens FROM whole"""


@query("sample_sequences", _SQL)
def sequences(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    placed = position(events, ["user_id"], F.col("event_id"), "at",
                      plain=fits_in_task(events, ["user_id"]))
    scores = placed.groupBy(
        F.col("user_id").alias("request_id"), F.floor(F.col("at") / 8).alias("step"),
        (F.col("event_id") % ITEMS).alias("item_id")).agg(
        F.max((F.col("value") - 25) / 20).alias("score"))
    user = F.col("user_id")
    params = resolve_params(events.groupBy(user.alias("request_id")).agg(
        (1 + F.count(F.when(F.col("event_type") == "click", 1)) % 7).alias("top_k"),
        (0.5 + 0.1 * (F.first(user) % 6)).alias("top_p"),
        (1 + 0.5 * (F.first(user) % 3)).alias("repetition_penalty")))
    return sample_sequences(scores, params, SEED, (STOP,)).select(
        "request_id", listed(F.col("tokens")).alias("tokens"))
