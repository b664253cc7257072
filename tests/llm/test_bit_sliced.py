"""Exact top-k by bit slices beside numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import bit_sliced

SCHEMA = "vec_id long, embedding array<float>, score int"


def brute(rows, k):
    kept = [(i, np.floor(1024 * np.array(v, dtype=np.float32).astype(np.float64)).astype(object))
            for i, v, _ in rows if i is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)]
    found = []
    for q, v in kept:
        if q % 100 == 0:
            scored = sorted((-int(sum(v * w)), i) for i, w in kept if i != q and len(w) == len(v))
            found += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found)


def searched(spark, rows, k=10, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, bit_sliced.top_k(df, F.col("vec_id") % 100 == 0, k,
                                              **options).collect()))


@pytest.mark.parametrize("dropped, block", [(0, 1 << 15), (3, 1 << 15), (3, 200), (9, 1 << 15)])
def test_beside_numpy(spark, dropped, block):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(0, 0.12, 24)], 1) for i in range(700)]
    # Ties, copies and zero vectors.
    rows += [(700 + i, rows[i % 5][1], 1) for i in range(60)] + [(800, [0.0] * 24, 1)]
    assert searched(spark, rows, dropped=dropped, block_rows=block) == brute(rows, 10)


def test_edges(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [0.5, -0.5], 1), (2, None, 1), (3, [1.0, None], 1),
            (4, [float("nan"), 1.0], 1), (5, [float("inf"), 1.0], 1), (6, [1.0], 1), (100, [], 1),
            (200, [3e4, -3e4], 1), (None, [1.0, 1.0], 1), (7, [], 1)]
    assert searched(spark, rows) == brute(rows, 10)
    assert searched(spark, []) == []
    assert searched(spark, rows[:1]) == []


def test_queries_in_groups(spark, monkeypatch):
    monkeypatch.setattr(bit_sliced, "QUERIES_AT_ONCE", 3)
    rng = np.random.default_rng(8)
    rows = [(50 * i, [float(x) for x in rng.normal(0, 1, 5)], 1) for i in range(40)]
    assert searched(spark, rows, k=4) == brute(rows, 4)


@pytest.mark.parametrize("n", [64, 65, 128, 192])
def test_blocks_of_whole_words(spark, n):
    rng = np.random.default_rng(9)
    rows = [(25 * i, [float(x) for x in rng.normal(0, 0.12, 6)], 1) for i in range(n)]
    assert searched(spark, rows) == brute(rows, 10)


def test_one_id_of_many_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(bit_sliced, "QUERIES_AT_ONCE", 8)
    sizes = tmp_path / "sizes"
    first = bit_sliced.Block.__init__

    def noted(block, ids, *rest):
        with open(sizes, "a") as out:
            out.write(f"{len(ids)}\n")
        first(block, ids, *rest)

    monkeypatch.setattr(bit_sliced.Block, "__init__", noted)
    rng = np.random.default_rng(10)
    rows = [(i % 2 * 100, [float(x) for x in rng.normal(0, 1, 5)], 1) for i in range(80)]
    assert searched(spark, rows, k=4, block_rows=16) == brute(rows, 4)
    assert max(map(int, sizes.read_text().split())) < 40
