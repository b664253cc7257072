"""Entropy balancing on small tables."""

import numpy as np
import pytest

from corpusprep.llm import mixing

SCHEMA = "doc_id long, source string, size long"


def mixed(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return mixing.apply_plan(df, mixing.mix_plan(df)).collect()


def test_rates_solve_the_dual(spark):
    rng = np.random.default_rng(1)
    rows = [(i, f"s{i % 4}", int(rng.integers(1, 400))) for i in range(800)]
    by = {}
    for r in mixed(spark, rows):
        by.setdefault(r.source, []).append(r)
    for found in by.values():
        expected = sum(r.rate * r["size"] for r in found)
        assert expected == pytest.approx(found[0].target, rel=1e-5)
        # Tilted: the logarithm of an uncapped rate is proportional to the size.
        slopes = [np.log(r.rate) / r["size"] for r in found if r.rate < 3]
        assert np.ptp(slopes) < 1e-9
        assert abs(sum(r.taken for r in found) - found[0].target) <= 400


def test_edges(spark):
    assert mixed(spark, []) == []
    rows = [(1, None, 10), (1, None, 10), (None, "a", 5), (2, "a", 0), (3, "b", 1000), (4, "", 7)]
    found = mixed(spark, rows)
    assert len(found) == 6
    same = [r.copies for r in found if r.source is None]
    assert same[0] == same[1]
    assert all(0 <= r.taken <= 3 * r["size"] for r in found)
    assert all(r.target <= 3 * r.source_size for r in found)
    assert {r.source_size for r in found if r.source == ""} == {7}


def test_nothing_but_empty_texts(spark):
    assert [r.taken for r in mixed(spark, [(1, "a", 0), (2, None, 0)])] == [0, 0]


def test_one_source_takes_all_of_itself(spark):
    rows = [(i, "x", 3) for i in range(50)]
    assert sum(r.taken for r in mixed(spark, rows)) == 150


def test_documents_keep_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b", "x", 9, 0.5), (2, None, "y", 8, 0.25), (3, "a b c d e", "y", 7, 0.1)],
        "doc_id long, text string, source string, size long, rate double")
    got = mixing.mix_documents(docs)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} <= {tuple(r) for r in docs.collect()}


def test_word_count(spark):
    texts = ["", None, " a\tb\n", "a\x0bb\x0cc\rd", "x\xa0y", "  ", "é è"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(mixing.word_count(df.text)).collect()]
    assert got == [0, 0, 2, 4, 1, 0, 2]


@pytest.mark.parametrize("same_text", [False, True])
def test_one_id_for_a_whole_source(spark, same_text):
    rows = [(None, " ".join(["w"] * 10) + ("" if same_text else f" n{k}"), "hot") for k in range(100)]
    rows += [(k, "a b c", "other") for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).cache()
    sizes = mixing.document_sizes(df).cache()
    for part in (mixing.apply_plan(sizes, mixing.mix_plan(sizes)).collect(),):
        taken = {s: sum(r.taken for r in part if r.source == s) for s in ("hot", "other")}
        target = {r.source: r.target for r in part}
        assert abs(taken["hot"] - target["hot"]) <= 11 and abs(taken["other"] - target["other"]) <= 3
    # What the pipeline keeps is the same mix.
    out = mixing.mix_documents(df).groupBy("source").count().collect()
    assert abs({r.source: r["count"] for r in out}["hot"] * (10 + (not same_text)) - target["hot"]) <= 11
