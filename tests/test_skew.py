"""Hot keys take other plans; their results must be the plain ones."""

import pytest
from pyspark.sql import functions as F

from corpusprep.functions.chars import CharTokenizer
from corpusprep.functions.templates import resolve_params
from corpusprep.operators import batching, candidates, context, examples, metrics
from corpusprep.plans import scan, skew
from tests.conftest import SF


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()))


@pytest.fixture
def hot(monkeypatch):
    """Treat nearly every key as too large for a task, with cells of two turns."""
    def switch():
        monkeypatch.setattr(scan, "PLAIN_ROWS", 1)
        monkeypatch.setattr(scan, "WITHIN_KEY", (1, 2))
        monkeypatch.setattr(skew, "TASK_ROWS", 3)
    return switch


@pytest.mark.parametrize("make", [
    lambda t: examples.training_windows(t, CharTokenizer(), 300),
    lambda t: examples.training_windows(t, CharTokenizer(), 5000),
    lambda t: examples.assemble(t, CharTokenizer()),
    lambda t: context.render_history(t),
    lambda t: context.trim_history(t, CharTokenizer(), 700),
    lambda t: examples.number_turns(t.drop("turn").withColumn("when", F.length("text") * 0 + F.hash(
        "text").cast("bigint")), "when"),
])
def test_long_conversations(given, hot, make):
    plain = rows(make(given))
    hot()
    assert rows(make(given)) == plain


def scores(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    one = events.select(F.lit(-1).cast("bigint").alias("group_id"), F.col("event_id").alias(
        "item_id"), F.floor(F.col("value") / 20).cast("double").alias("score"))
    return events.select(F.col("user_id").alias("group_id"), F.col("event_id").alias("item_id"),
                         ((F.col("value") - 25) / 20).alias("score")).unionByName(one)


@pytest.mark.parametrize("make", [
    lambda d: candidates.softmax(d).withColumn("prob", F.round("prob", 9)),
    lambda d: candidates.top_k_filter(d, 4),
    lambda d: candidates.top_k_filter(d, 2000),
    lambda d: candidates.top_p_filter(d, 0.55),
    lambda d: candidates.top_p_filter(d, 0.0),
    lambda d: candidates.sample_next(d, resolve_params(d.select("group_id").distinct()), 3, d),
])
def test_large_groups(spark, hot, make):
    df = scores(spark)
    plain = rows(make(df))
    hot()
    assert rows(make(df)) == plain


def test_gate_of_long_runs(spark, hot):
    attempts = scores(spark).select(F.col("group_id").alias("run"), F.col("item_id").alias(
        "attempt"), (F.col("score") * 20).alias("ppl"))
    plain = rows(metrics.curriculum_gate(attempts))
    hot()
    assert rows(metrics.curriculum_gate(attempts)) == plain


def test_join_spreads_a_hot_key(spark, hot):
    hot()
    left = spark.range(1000).select((F.col("id") % 3 % 2).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    joined = skew.join_per_key(left, right, ["k"], ["v"])
    assert rows(joined) == rows(left.join(right, "k"))
    assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("shifts", [(1, 3, 5), (2, 4), (60,)])
def test_position_of_any_ids(spark, shifts):
    ids = [-2 ** 62, -5, -4, -3, 0, 1, 2, 3, 4, 7, 1000, 2 ** 40, 2 ** 62]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = scan.running_total(df, [], F.col("id"), {"p": F.lit(1).cast("bigint")}, shifts)
    assert [r.p for r in got.orderBy("id").collect()] == list(range(len(ids)))


@pytest.mark.parametrize("count, limit", [(0, 0), (1, 0), (20, 19), (1000, 950)])
def test_split_sizes(spark, count, limit):
    split = batching.seeded_shuffle_split(spark.range(count), ["id"], 1)
    assert split.filter("split = 'train'").count() == limit
    assert split.count() == count


def test_split_follows_the_shuffle(spark):
    ids = spark.range(1000)
    order = {r.id: r.position for r in batching.shuffled_index(ids, ["id"], 9).collect()}
    split = batching.seeded_shuffle_split(ids, ["id"], 9, n=900)
    assert all((order[r.id] < 900) == (r.split == "train") for r in split.collect())
    assert sorted(order.values()) == list(range(1000))
    assert [order[i] for i in range(1000)] != list(range(1000))


def special(spark):
    """Ties whose mass meets p exactly, infinities, not-a-number and an overflowing range."""
    inf, nan, huge = float("inf"), float("nan"), 1.7e308
    groups = {1: [0.0] * 10, 2: [1.0] * 4 + [0.0] * 6, 3: [0.5, 0.2, 0.1] + [-inf] * 8,
              4: [huge, -huge, 1.0, 0.0, 3.0, -1.0], 5: [-inf] * 7, 6: [inf, inf, 1.0, 2.0, -inf],
              7: [nan, nan, 1.0, 2.0, -inf, 4.0], 8: [5e-324, 0.0, -5e-324, 0.0, 5e-324, 1.0]}
    found = [(g, i, s) for g, scores in groups.items() for i, s in enumerate(scores)]
    return spark.createDataFrame(found, "group_id long, item_id long, score double")


@pytest.mark.parametrize("p", [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])
def test_top_p_is_the_same_on_both_sides_of_the_switch(spark, hot, p):
    df = special(spark)
    plain = candidates.top_p_filter(df, p)
    plain = sorted(map(str, plain.collect()))
    hot()
    assert sorted(map(str, candidates.top_p_filter(df, p).collect())) == plain
    # Of ten equal scores those stay before which at most p of the mass lies.
    assert sum("group_id=1," in r for r in plain) == int(p * 10 + 1e-9) + 1


@pytest.mark.parametrize("k", [1, 2, 3, 5, 20])
def test_top_k_ends_on_unbounded_ranges(spark, hot, k):
    df = special(spark)
    plain = sorted(map(str, candidates.top_k_filter(df, k).collect()))
    hot()
    assert sorted(map(str, candidates.top_k_filter(df, k).collect())) == plain


def test_more_hot_keys_than_a_broadcast_takes(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 1)
    df = spark.range(400).selectExpr("id % 100 AS key", "id AS n")
    per = spark.range(90).selectExpr("id AS key", "id * 10 AS value")
    few = skew.join_per_key(df, per, ["key"], ["n"], "left")
    plain = rows(few)
    monkeypatch.setattr(skew, "HOT_KEYS", 7)
    assert skew.hot_keys(df, ["key"]).count() == 100
    assert rows(skew.join_per_key(df, per, ["key"], ["n"], "left")) == plain
