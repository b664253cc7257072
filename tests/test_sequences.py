"""Sampling many steps, keyed permutations and batches per attempt."""

import math
import random

import pytest
from pyspark.sql import functions as F

from corpusprep.functions.permute import permuted, sides
from corpusprep.functions.templates import resolve_params
from corpusprep.operators import batching, sequences


def drawn_slowly(spark, scores, params, seed, stops):
    """One step after another, each with the token before it."""
    noise = {(r.request_id, r.step, r.item_id): r.g for r in spark.createDataFrame(
        scores, "request_id long, step long, item_id long, score double").select(
        "request_id", "step", "item_id", (-F.log(-F.log(sequences.draw_unit(seed, "sequence", [
            "request_id", "step", "item_id"])))).alias("g")).collect()}
    out = {}
    for request, (k, p, penalty, longest) in params.items():
        by = {}
        for r, step, item, score in scores:
            if r == request and score is not None and not math.isnan(score):
                by.setdefault(step, {})[item] = score / 0.7
        last, tokens = None, []
        for step in range(longest):
            if step not in by:
                break
            rows = {i: s if i != last else s * penalty if s < 0 else s / penalty for i, s in by[step].items()}
            rows = sorted(rows.items(), key=lambda x: (-x[1], x[0]))
            rows = [x for x in rows if x[1] >= rows[min(k, len(rows)) - 1][1]]
            mass = [round((1.0 if s == rows[0][1] else math.exp(s - rows[0][1])) * 2**32) for _, s in rows]
            kept, before = [], 0
            for (item, s), w in zip(rows, mass):
                if not kept or p >= 1 or before <= p * sum(mass):
                    kept.append((s + noise[request, step, item], -item))
                before += w
            kept = [x for x in kept if x[0] > -math.inf]
            last = -max(kept)[1] if kept else None
            if last is None or last in stops:
                break
            tokens.append(last)
        if by:
            out[request] = tokens
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sequences_equal_a_walk_over_steps(spark, seed):
    draw = random.Random(seed)
    scores, params = [], {}
    for request in range(30):
        params[request] = (draw.randint(1, 6), draw.choice([0.0, 0.5, 0.9, 1.0]), draw.choice([1.0, 1.3, 4.0]), 90)
        for step in range(draw.choice([1, 2, 5, 33, 70])):
            # Few values, so that scores tie; a repeated winner, so that penalties bite.
            for item in draw.sample(range(7), draw.randint(1, 7)):
                scores.append((request, step, item, draw.choice([-1.5, -0.5, 0.0, 0.5, 2.0, 2.0, 4.0])))
    scores += [(50, 0, 1, 1.0), (50, 0, 2, None), (50, 0, 3, float("nan")), (50, 2, 1, 1.0),
               (51, 0, 1, float("-inf")), (51, 1, 1, 1.0), (52, 1, 1, 1.0), (53, 0, 4, float("-inf")), (53, 0, 5, 0.0)]
    params |= {r: (3, 0.9, 1.1, 90) for r in (50, 51, 52, 53, 99)}
    table = spark.createDataFrame(scores, "request_id long, step long, item_id long, score double")
    wanted = resolve_params(spark.createDataFrame(
        [(r, *p) for r, p in params.items()],
        "request_id long, top_k int, top_p double, repetition_penalty double, max_length int"))
    got = {r.request_id: r.tokens for r in sequences.sample_sequences(table, wanted, seed, (6,)).collect()}
    assert got == drawn_slowly(spark, scores, params, seed, (6,))


def test_sequences_stop_at_the_longest(spark):
    table = spark.range(40).selectExpr("7L AS request_id", "id AS step", "id % 3 AS item_id", "1.0D AS score")
    params = resolve_params(spark.createDataFrame([(7, 5)], "request_id long, max_length int"))
    assert sequences.sample_sequences(table, params, 1).first().tokens == [0, 1, 2, 0, 1]
    assert sequences.sample_sequences(table.limit(0), params, 1).count() == 0
    assert sequences.sample_sequences(table, params.limit(0), 1).count() == 0
    for bad in ({"top_k": 0}, {"repetition_penalty": 0.5}):
        with pytest.raises(ValueError):
            sequences.sample_sequences(table, params.withColumns({k: F.lit(v) for k, v in bad.items()}), 1)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 97, 100, 1009, 5000])
def test_permutations(spark, n):
    a, b = sides(n)
    assert a * b >= n and a * b - n < max(a, b)
    keys = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1)], "run string, attempt int")
    rows = spark.range(n).join(keys).select("id", "run", "attempt", permuted(
        F.col("id"), n, 5, ["run", "attempt"]).alias("at")).collect()
    orders = {}
    for r in rows:
        orders.setdefault((r.run, r.attempt), {})[r.id] = r["at"]
    for order in orders.values():
        assert sorted(order.values()) == list(range(n))
    if n >= 97:
        assert len({tuple(o[i] for i in range(n)) for o in orders.values()}) == 3
        # No order is near the given one, nor near another.
        for order in orders.values():
            assert sum(order[i] == i for i in order) < 10
            assert sum(abs(order[i] - order[i + 1]) < n / 20 for i in range(n - 1)) < 0.2 * n


def test_attempts_read_every_example_once(spark):
    lengths = spark.range(100, 150).selectExpr("id AS conv_id", "id * 7 % 40 + 1 AS n")
    gated = spark.createDataFrame(
        [("a", 0, 1), ("a", 3, 1), ("a", 4, 2), ("b", 1, 1)], "run string, attempt long, stage int")
    stages = [(30, 8, 5.0), (35, 3, 1.0)]
    got = batching.attempt_batches(lengths, gated, 3, stages).collect()
    size = {r.conv_id: r.n for r in lengths.collect()}
    by = {}
    for r in got:
        by.setdefault((r.run, r.attempt, r.stage), []).append(r)
    assert set(by) == {tuple(r) for r in gated.collect()}
    orders = set()
    for (_, _, stage), rows in by.items():
        length, many, _ = stages[stage - 1]
        assert sorted(r.conv_id for r in rows) == sorted(size)
        rows.sort(key=lambda r: (r.batch_id, r.slot))
        assert [(r.batch_id, r.slot) for r in rows] == [(k // many, k % many) for k in range(len(rows))]
        for r in rows:
            assert r.n == min(size[r.conv_id], length) - 1
            assert r.width == max(s.n for s in rows if s.batch_id == r.batch_id)
        orders.add(tuple(r.conv_id for r in rows))
    assert len(orders) == 4
    assert batching.attempt_batches(lengths.limit(0), gated, 3, stages).count() == 0
    assert batching.attempt_batches(lengths, gated.limit(0), 3, stages).count() == 0


def test_attempts_neither_sort_nor_shuffle_to_order(spark):
    """One exchange brings examples to attempts, one brings a batch together."""
    lengths = spark.range(5000).selectExpr("id AS conv_id", "id % 9 + 2 AS n")
    gated = spark.createDataFrame([("a", 0, 1)], "run string, attempt long, stage int")
    plan = batching.attempt_batches(lengths, gated, 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") <= 3 and "rangepartitioning" not in text
