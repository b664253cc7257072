"""M1-M3, M5 (M4 is with the examples)."""

from pyspark.sql import functions as F

from corpusprep.constants import STAGES
from corpusprep.operators import metrics, vectors
from corpusprep.queries.registry import query, table
from corpusprep.queries.vector_queries import CENTROIDS_SQL, centroids, vector_table


def loss_log(events):
    """Training log: runs are users, losses are scaled values, some batches have no tokens."""
    return events.select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), "ts",
                         (F.col("value") / 100).alias("loss"),
                         (F.col("event_id") % 7).alias("n_tokens"))


def attempts(events):
    return events.select(F.col("user_id").alias("run"), F.col("event_id").alias("attempt"),
                         F.col("value").alias("ppl"))


@query("perplexity", """
SELECT user_id AS run, sum(event_id % 7)::BIGINT AS tokens,
       CASE WHEN sum(event_id % 7) > 0
            THEN round(exp(sum(value / 100 * (event_id % 7)) / sum(event_id % 7)), 6) + 0.0::DOUBLE
            ELSE 'infinity'::DOUBLE END AS ppl
FROM events GROUP BY 1""")
def perplexity(spark, sf_dir):
    return metrics.perplexity(loss_log(table(spark, sf_dir, "events"))).withColumn(
        "ppl", F.round("ppl", 6))


def _logits(spark, sf_dir):
    """Ten times the dot products with the label centroids; class 0 is not supervised."""
    scores = vectors.score_experts(vector_table(spark, sf_dir), centroids(spark, sf_dir))
    logits = scores.select(F.col("vec_id").alias("row_id"), F.lit(0).alias("position"),
                           F.col("expert_id").alias("item_id"),
                           (F.col("score") * 10).alias("score"))
    target = F.when(F.col("label") == 0, -100).otherwise(F.col("label"))
    return logits, table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.lit(0).alias("position"), target.alias("target"))


_LOSS_SQL = f"""
{CENTROIDS_SQL},
logits AS (
  SELECT vec_id, label, expert_id, 10 * list_dot_product(embedding::DOUBLE[], vec) AS score
  FROM embeddings, centroids),
losses AS (
  SELECT vec_id, max(score) FILTER (WHERE expert_id = label) AS hit, ln(sum(exp(score))) AS lse
  FROM logits WHERE label <> 0 GROUP BY vec_id)
"""


@query("token_cross_entropy", f"""
WITH {_LOSS_SQL}
SELECT round(avg(lse - hit), 6) + 0.0::DOUBLE AS cross_entropy, count(*)::BIGINT AS positions FROM losses""")
def token_cross_entropy(spark, sf_dir):
    return metrics.token_cross_entropy(*_logits(spark, sf_dir)).withColumn(
        "cross_entropy", F.round("cross_entropy", 6))


@query("position_losses", f"""
WITH {_LOSS_SQL}
SELECT vec_id AS row_id, round(lse - hit, 6) + 0.0::DOUBLE AS loss FROM losses""")
def position_losses(spark, sf_dir):
    return metrics.position_losses(*_logits(spark, sf_dir)).select(
        "row_id", F.round("loss", 6).alias("loss"))


_THRESHOLD = "CASE g.stage " + " ".join(
    f"WHEN {i} THEN {t}" for i, (_, _, t) in enumerate(STAGES, 1)) + " END"

GATE_SQL = f"""
WITH RECURSIVE ordered AS (
  SELECT user_id AS run, event_id AS attempt, value AS ppl,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
g AS (
  SELECT run, attempt, ppl, rn, 1 AS stage FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.run, o.attempt, o.ppl, o.rn,
         g.stage + CASE WHEN g.ppl <= {_THRESHOLD} THEN 1 ELSE 0 END
  FROM g JOIN ordered o ON o.run = g.run AND o.rn = g.rn + 1
  WHERE g.stage <= {len(STAGES)})
SELECT run, attempt, ppl, stage::BIGINT AS stage, ppl <= {_THRESHOLD} AS passed
FROM g WHERE stage <= {len(STAGES)}"""


@query("curriculum_gate", GATE_SQL)
def curriculum_gate(spark, sf_dir):
    return metrics.curriculum_gate(attempts(table(spark, sf_dir, "events"))).withColumn(
        "stage", F.col("stage").cast("bigint"))


@query("latest_stats", """
SELECT user_id AS run, max(event_id) AS step, arg_max(value, event_id) AS lr
FROM events GROUP BY 1""")
def latest_stats(spark, sf_dir):
    return metrics.latest_stats(table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.col("event_id").alias("step"),
        F.col("value").alias("lr")))
