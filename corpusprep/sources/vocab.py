"""Tokenizer vocabularies as Parquet tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from corpusprep.operators.bpe import BpeModel

# A model is brought to the driver and broadcast, so its tables have to stay small.
MAX_ENTRIES = 1 << 20


def save_vocab(vocab, path, merges=None, mode="error"):
    """Write `vocab(token, id[, at])` and `merges`; `at` is the order of entry, else the id."""
    ordered = vocab if "at" in vocab.columns else vocab.withColumn("at", F.col("id"))
    ordered.write.mode(mode).parquet(f"{path}/vocab")
    if merges is not None:
        merges.write.mode(mode).parquet(f"{path}/merges")


def _read(spark, path):
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no vocabulary at {path}") from error
        raise


def load_vocab(spark, path):
    """`token, id`; of several tokens with one id the last one entered stays."""
    return _read(spark, f"{path}/vocab").groupBy("id").agg(
        F.max_by("token", "at").alias("token")).select("token", "id")


def load_merges(spark, path):
    return _read(spark, f"{path}/merges")


def load_model(spark, path):
    """A BPE model saved with its merges."""
    def rows(table, order):
        found = table.orderBy(order).limit(MAX_ENTRIES + 1).collect()
        if len(found) > MAX_ENTRIES:
            raise ValueError(f"more than {MAX_ENTRIES} entries below {path}")
        return found
    tokens = [r["token"] for r in rows(load_vocab(spark, path), "id")]
    merges = [(r["left_id"], r["right_id"], r["new_id"])
              for r in rows(load_merges(spark, path), "rank")]
    return BpeModel(tokens, merges)
