"""Shapes of physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from corpusprep.functions.chars import CharTokenizer
from corpusprep.operators import batching, candidates, examples, metrics, vectors
from corpusprep.queries.vector_queries import centroids
from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture
def scores(spark):
    return spark.read.parquet(f"{SF}/events.parquet").select(
        F.col("user_id").alias("group_id"), F.col("event_id").alias("item_id"),
        F.col("value").alias("score"))


def test_examples_shuffle_once(given):
    assert shuffles(examples.training_examples(given, CharTokenizer())) == 1
    assert shuffles(examples.curriculum_examples(given, CharTokenizer())) == 1


def test_scans_read_only_what_they_need(given):
    text = plan(given.select("conv_id", F.length("text")))
    assert "ReadSchema: struct<conv_id:bigint,text:string>" in text


def test_filters_share_a_shuffle(scores):
    both = candidates.top_p_filter(candidates.top_k_filter(scores, 50), 0.9)
    assert shuffles(both) == 1
    assert "WindowGroupLimit" in plan(candidates.top_k_filter(scores, 50))


def test_sampling_combines_before_its_shuffle(scores):
    text = plan(candidates.sample_one(scores, 1))
    assert shuffles(candidates.sample_one(scores, 1)) == 1 and "partial_max_by" in text
    assert "SortAggregate" not in text


def test_order_has_no_window_over_everything(spark):
    lines = plan(batching.shuffled_index(spark.range(1000), ["id"], 1)).splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    # Only the table of cell totals, at most 65,536 rows, is accumulated in one task.
    assert len(single) == 1 and "HashAggregate(keys=[_cell" in lines[single[0] + 1]


def test_no_cartesian_products(spark, given):
    vecs = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        "vec_id", F.col("embedding").alias("vec"))
    made = [vectors.top_k_assign(vecs, centroids(spark, SF)),
            examples.curriculum_examples(given, CharTokenizer())]
    assert not any("Cartesian" in plan(df) or "NestedLoop" in plan(df) for df in made)


def test_metrics_are_hash_aggregates(spark, scores):
    log = scores.select(F.col("group_id").alias("run"), F.col("item_id").alias("step"),
                        F.col("score").alias("lr"))
    text = plan(metrics.latest_stats(log))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_one_block_of_centroids_needs_no_shuffle(spark):
    vecs = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)],
                                 "vec_id long, vec array<double>")
    cents = vecs.limit(4).withColumnRenamed("vec_id", "expert_id")
    assert "Exchange" not in plan(vectors.top_k_assign(vecs, cents, 2))
    assert shuffles(vectors.vector_balance(vecs, cents)) == 1


def test_gate_reads_its_attempts_twice(spark):
    """Once to look for large runs, once for all stages, in one shuffle."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    tries = events.select(F.col("user_id").alias("run"), F.col("event_id").alias("attempt"),
                          F.col("value").alias("ppl"))
    made = metrics.curriculum_gate(tries)
    assert plan(made).count("FileScan") == 1 and shuffles(made) == 1


def test_verification_reads_its_problems_once(spark):
    from corpusprep.queries import QUERIES
    assert plan(QUERIES["verify_completions"](spark, SF)).count("FileScan") == 1
