"""A training-data pipeline over `documents`.

Each stage takes `(spark, docs, sf_dir)` and returns a DataFrame, which is written as Parquet to the
shared folder and read again as the next stage's `docs`. All but the last return the columns of
documents. An empty table passes through every stage; extra columns travel along.
"""

import public_tokenizers

from corpusprep.llm import line_dedup, mixing, ngram_join, packing, toxicity
from corpusprep.llm.common import stored

# Fixed by the rule for near-duplicates: five words and a similarity of 0.8 or more.
WORDS, PERCENT = 5, 80
# Share of a line's words that a near copy may differ by; any line may by 2 code points.
LINE_PERCENT = 5


def without_toxic(spark, docs, sf_dir):
    """Documents that score below one half for toxicity."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_lines(spark, docs, sf_dir):
    """Documents without lines that repeat an earlier line or nearly do."""
    return line_dedup.dedup_lines(docs, word_percent=LINE_PERCENT)


def one_of_each_group(spark, docs, sf_dir):
    """The first document of each group of near-duplicates."""
    return ngram_join.keep_one(docs, WORDS, PERCENT)


def mixed(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_documents(docs)


def packed(spark, docs, sf_dir):
    """Pieces of all documents, placed in sequences of at most 2,048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 0)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources", mixed),
    ("best-fit packing", packed),
]

# Tokenizer, model and hashes are beyond SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
