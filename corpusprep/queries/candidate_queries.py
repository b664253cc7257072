"""L1-L6 over events: a user's events are the candidates of that user."""

from pyspark.sql import functions as F

from corpusprep.functions.templates import resolve_params
from corpusprep.operators import candidates
from corpusprep.queries.registry import query, table

SEED = 7

_SCORES_SQL = """
scores AS (
  SELECT user_id AS group_id, event_id AS item_id, (value - 25) / 20 AS score FROM events),
seen AS (SELECT user_id AS group_id, event_id AS item_id FROM events WHERE event_type = 'click')
"""


def _scores(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("group_id"), F.col("event_id").alias("item_id"),
        ((F.col("value") - 25) / 20).alias("score"))


def _seen(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(F.col("event_type") == "click").select(
        F.col("user_id").alias("group_id"), F.col("event_id").alias("item_id"))


@query("softmax", f"""
WITH {_SCORES_SQL},
e AS (SELECT *, exp(score / 0.7 - max(score / 0.7) OVER (PARTITION BY group_id)) AS e FROM scores)
SELECT group_id, item_id, round(e / sum(e) OVER (PARTITION BY group_id), 6) + 0.0::DOUBLE AS prob FROM e""")
def softmax(spark, sf_dir):
    return candidates.softmax(_scores(spark, sf_dir)).select(
        "group_id", "item_id", F.round("prob", 6).alias("prob"))


_PENALISED = ("CASE WHEN n.item_id IS NULL THEN {s} WHEN {s} < 0 THEN {s} * {p} "
              "ELSE {s} / {p} END")
_SEEN_JOIN = ("LEFT JOIN (SELECT DISTINCT * FROM seen) n "
              "ON s.group_id = n.group_id AND s.item_id = n.item_id")


@query("repetition_penalty", f"""
WITH {_SCORES_SQL}
SELECT s.group_id, s.item_id, round({_PENALISED.format(s='s.score', p=1.1)}, 6) + 0.0::DOUBLE AS score
FROM scores s {_SEEN_JOIN}""")
def repetition_penalty(spark, sf_dir):
    return candidates.repetition_penalty(_scores(spark, sf_dir), _seen(spark, sf_dir)).withColumn(
        "score", F.round("score", 6))


@query("top_k_filter", f"""
WITH {_SCORES_SQL}
SELECT group_id, item_id, score FROM scores
QUALIFY rank() OVER (PARTITION BY group_id ORDER BY score DESC) <= 50""")
def top_k_filter(spark, sf_dir):
    return candidates.top_k_filter(_scores(spark, sf_dir))


def _top_p_sql(source, p):
    return f"""
e AS (SELECT *, exp(score - max(score) OVER (PARTITION BY group_id)) AS e FROM {source}),
probs AS (SELECT *, e / sum(e) OVER (PARTITION BY group_id) AS prob FROM e),
mass AS (
  SELECT *, coalesce(sum(prob) OVER (PARTITION BY group_id ORDER BY score DESC, item_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM probs),
kept AS (SELECT group_id, item_id, score FROM mass WHERE before <= {p})"""


@query("top_p_filter", f"""
WITH {_SCORES_SQL}, {_top_p_sql('scores', 0.9)}
SELECT group_id, item_id, score FROM kept""")
def top_p_filter(spark, sf_dir):
    return candidates.top_p_filter(_scores(spark, sf_dir))


_SAMPLE_SQL = f"""
SELECT group_id, arg_max(item_id, score - ln(-ln(
         (('0x' || substr(md5('{SEED}|sample|' || group_id || '|' || item_id), 1, 13))::BIGINT
          + 0.5::DOUBLE) / 4503599627370496))) AS item_id"""


@query("sample_one", f"WITH {_SCORES_SQL} {_SAMPLE_SQL} FROM scores GROUP BY 1")
def sample_one(spark, sf_dir):
    return candidates.sample_one(_scores(spark, sf_dir), SEED)


def _params(spark, sf_dir):
    """One request per user; views set the temperature, purchases the number of candidates."""
    events = table(spark, sf_dir, "events")
    return resolve_params(events.groupBy(F.col("user_id").alias("group_id")).agg(
        F.max(F.when(F.col("event_type") == "view", 0.5 + F.col("value") / 500)).alias(
            "temperature"),
        F.count(F.when(F.col("event_type") == "click", 1)).alias("top_k")))


_FILTERED_SQL = f"""
{_SCORES_SQL},
params AS (
  SELECT user_id AS group_id,
         coalesce(max(CASE WHEN event_type = 'view' THEN 0.5 + value / 500 END), 0.7) AS temperature,
         count(CASE WHEN event_type = 'click' THEN 1 END) AS top_k
  FROM events GROUP BY 1),
pushed AS (
  SELECT s.group_id, s.item_id, {_PENALISED.format(s='(s.score / temperature)', p=1.1)} AS score,
         top_k
  FROM scores s JOIN params USING (group_id) {_SEEN_JOIN}),
topk AS (
  SELECT group_id, item_id, score FROM pushed
  QUALIFY rank() OVER (PARTITION BY group_id ORDER BY score DESC) <= top_k OR top_k <= 0),
{_top_p_sql('topk', 0.9)}
"""


@query("filtered_candidates", f"""
WITH {_FILTERED_SQL} SELECT group_id, item_id, round(score, 6) + 0.0::DOUBLE AS score FROM kept""")
def filtered_candidates(spark, sf_dir):
    return candidates.filtered_candidates(
        _scores(spark, sf_dir), _params(spark, sf_dir), _seen(spark, sf_dir)).withColumn(
        "score", F.round("score", 6))


@query("sample_next", f"WITH {_FILTERED_SQL} {_SAMPLE_SQL} FROM kept GROUP BY 1")
def sample_next(spark, sf_dir):
    return candidates.sample_next(
        _scores(spark, sf_dir), _params(spark, sf_dir), SEED, _seen(spark, sf_dir))
