"""Token counts through a digest cache.

A count belongs to a content (the text that the tokenizer sees, null taken as empty) and to a
tokenizer version (library, its release, the bytes of the file). Both are named by SHA-256 digests.
Each run joins the digests of its documents with the counts stored for its version, encodes every
distinct content that has none once, and appends those counts to the cache. A run that is broken
off after the append, or a second run, finds them there.

The cache is a Parquet folder `tokenizer=<version>/` with `content binary, n_tokens long`, appended
by committed jobs only. Two runs may append the same content at the same time; a reader takes one
of the equal counts. Only digests, never texts, take part in the grouping; texts move once, and
only when something is missing.
"""

import hashlib
import os
import sys
import types

import pyarrow as pa
from pyspark.sql import functions as F

from corpusprep.llm.common import stored, text_of
from corpusprep.plans.skew import join_per_key

CACHE = "content binary, n_tokens long, tokenizer string"
COUNTED = "content binary, n_tokens long"
#: Characters handed to the library at a time, where its vocabulary allows a cut at a space.
PIECE = 1 << 20


def tokenizer_version(path):
    """Digest of the library that reads `path`, its release and the file."""
    if path.endswith(".json"):
        import tokenizers as library
    else:
        import sentencepiece as library
    with open(path, "rb") as file:
        body = hashlib.sha256(file.read()).hexdigest()
    return hashlib.sha256(f"{library.__name__} {library.__version__} {body}".encode()).hexdigest()


class Counter:
    """Numbers of tokens as the library gives them, without any added ones."""

    def __init__(self, path):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.cuttable = False
        if path.endswith(".json"):
            from tokenizers import Tokenizer
            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            self._sizes = lambda texts: [
                len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            import sentencepiece
            library = sentencepiece.SentencePieceProcessor(model_file=path)
            self._sizes = lambda texts: [len(i) for i in library.encode(texts, num_threads=1)]
            # Where no piece goes on past a space and spaces are kept as they are, what stands
            # before a space and what stands from there on are encoded independently, and the
            # space is the mark that the library puts before any text.
            pieces = map(library.id_to_piece, range(library.get_piece_size()))
            self.cuttable = all("▁" not in p.lstrip("▁") for p in pieces) and \
                library.normalize("a  ÅＡ ") == "▁a▁▁ÅＡ▁"

    def parts(self, text):
        at = 0
        while self.cuttable and len(text) - at > PIECE:
            space = text.find(" ", at + PIECE)
            # A cut needs something other than a space before it.
            while space > 0 and text[space - 1] in " ▁":
                space = text.find(" ", space + 1)
            if space < 0:
                break
            yield text[at:space]
            at = space + 1
        yield text[at:]

    def count(self, texts):
        """Tokens of each text; only texts beyond PIECE are cut."""
        if all(len(t) <= PIECE for t in texts):
            return self._sizes(texts) if texts else []
        return [sum(self._sizes([part])[0] for part in self.parts(t)) for t in texts]


def counter(path):
    """The worker's tokenizer; kept between tasks, since modules here are sent by value."""
    kept = sys.modules.setdefault("_corpusprep_worker", types.ModuleType("_corpusprep_worker"))
    made = kept.__dict__.setdefault("counters", {})
    if path not in made:
        made[path] = Counter(path)
    return made[path]


def _counted(path, rows=256):
    def run(batches):
        count = counter(path).count
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                # Rows that repeat a document stand next to each other or in one batch mostly.
                texts = dict(zip(part.column(0).to_pylist(), part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(texts), pa.binary()),
                     pa.array(count(list(texts.values())), pa.int64())], ["content", "n_tokens"])
    return run


def _exists(spark, path):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def cached(spark, cache, version):
    """`(content, n_tokens)` stored for one tokenizer version, a row per content."""
    if not _exists(spark, cache):
        return spark.createDataFrame([], COUNTED)
    # Appends that met hold equal counts.
    return spark.read.schema(CACHE).parquet(cache).filter(
        F.col("tokenizer") == version).groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs, cache, tokenizer, limit=4096):
    """`(doc_id, n_bytes, n_tokens, over_limit)` for every row of `docs(doc_id, text)`.

    `cache` is the folder of stored counts; it is made when missing. A null text is empty: no
    bytes, and the tokens of the empty text. Null and repeated doc_ids are rows like others, each
    distinct text among them encoded once. Other columns are not read. An empty table gives an
    empty result and leaves the cache as it is.
    """
    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    content = F.unhex(F.sha2(text_of(), 256)).alias("content")
    rows = stored(docs.select(F.col("doc_id").cast("long"), content, F.coalesce(F.octet_length(
        "text"), F.lit(0)).cast("long").alias("n_bytes")), "token-digests")
    distinct = rows.groupBy("content").agg(F.min("doc_id").alias("claimed"))
    misses = stored(distinct.join(cached(spark, cache, version), "content", "left_anti"),
                    "token-misses")
    if not misses.isEmpty():
        # The document with the smallest id brings the text; the others' texts go no further.
        claims = misses.select(F.col("content").alias("missing"), "claimed").hint("shuffle_hash")
        texts = docs.select(F.col("doc_id").cast("long"), content, text_of().alias("text")).join(
            claims, (F.col("content") == F.col("missing"))
            & F.col("doc_id").eqNullSafe(F.col("claimed"))).select("content", "text")
        counts = texts.mapInArrow(_counted(tokenizer), COUNTED).groupBy("content").agg(
            F.min("n_tokens").alias("n_tokens"))
        counts.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy(
            "tokenizer").parquet(cache)
    found = join_per_key(rows, cached(spark, cache, version), ["content"], ["doc_id", "n_bytes"])
    return found.select("doc_id", "n_bytes", "n_tokens",
                        (F.col("n_tokens") > limit).alias("over_limit"))
