"""Token counts through the digest cache."""

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusprep.llm import token_counts
from corpusprep.llm.queries import QUERIES
from corpusprep.plans.lineage import scratch_path
from tests.conftest import SF

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
SCHEMA = "doc_id long, text string, content string, n_tokens int, missing int, claimed string"


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2, "y") for d, t in rows], SCHEMA)


def test_query_equals_the_library(spark):
    got = {r.doc_id: r for r in QUERIES["op11_token_counts"](spark, SF).collect()}
    given = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(given)
    for r in given:
        n = len(LIBRARY.encode(r.text or ""))
        assert tuple(got[r.doc_id]) == (r.doc_id, len((r.text or "").encode()), n, n > 4096)


ODD = [(1, None), (2, ""), (3, " "), (None, "a b"), (None, "a b"), (4, "a b"), (5, "<s> </s> <unk>"),
       (6, "▁x▁ y\x00z\n\n é ÅＡ 😀"), (4, "other"), (7, "word " * 9000)]


@pytest.mark.parametrize("path", [PIECES, WORDS])
def test_odd_rows(spark, path):
    def size(text):
        if path == PIECES:
            return len(LIBRARY.encode(text))
        return len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)

    cache = scratch_path(spark, "cache")
    got = token_counts.token_counts(docs(spark, ODD), cache, path, limit=100)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(d, len((t or "").encode()), size(t or ""), size(t or "") > 100) for d, t in ODD]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert token_counts.token_counts(docs(spark, []), scratch_path(spark, "c"), path).count() == 0


def test_only_misses_are_encoded(spark):
    """A stored count is taken as it is, a missing one is made and appended once per content."""
    cache, version = scratch_path(spark, "cache"), token_counts.tokenizer_version(PIECES)
    first = token_counts.token_counts(docs(spark, [(1, "one two"), (2, "one two"), (3, "x")]), cache, PIECES)
    assert first.count() == 3
    assert token_counts.cached(spark, cache, version).count() == 2
    # Counts that no library would give show where a result comes from.
    marked = scratch_path(spark, "cache")
    token_counts.cached(spark, cache, version).select(
        "content", (F.col("n_tokens") + 1000).alias("n_tokens"), F.lit(version).alias("tokenizer")
    ).write.partitionBy("tokenizer").parquet(marked)
    again = {r.doc_id: r.n_tokens for r in token_counts.token_counts(
        docs(spark, [(1, "one two"), (5, "new"), (6, "new")]), marked, PIECES).collect()}
    assert again[1] == 1000 + len(LIBRARY.encode("one two"))
    assert again[5] == again[6] == len(LIBRARY.encode("new"))
    assert token_counts.cached(spark, marked, version).count() == 3
    # Another tokenizer shares nothing.
    other = token_counts.token_counts(docs(spark, [(1, "one two")]), marked, WORDS).collect()
    assert other[0].n_tokens < 1000
    # The same content appended twice, as by two runs at a time, counts once.
    spark.read.schema(token_counts.CACHE).parquet(marked).write.mode("append").partitionBy(
        "tokenizer").parquet(marked + "-2")
    spark.read.schema(token_counts.CACHE).parquet(marked).write.mode("append").partitionBy(
        "tokenizer").parquet(marked + "-2")
    assert token_counts.cached(spark, marked + "-2", version).count() == 3


def test_long_texts_are_cut_without_change(monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE", 40)
    made = token_counts.Counter(PIECES)
    assert made.cuttable
    texts = ["a  b   " * 60, " " * 300, "▁ ▁" * 50, "x" * 500, "don't ▁▁ stop  <s> é\n\n" * 30,
             "", "end with spaces" + " " * 90, "y" * 50 + " " + "z" * 50]
    assert made.count(texts) == [len(LIBRARY.encode(t)) for t in texts]
