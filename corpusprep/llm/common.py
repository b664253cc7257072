"""Shared tables, checked broadcasts and connected components for the operators of this folder."""

import os

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.plans.lineage import scratch_path

# Rows a small table may have to be sent to every task; beyond it the join is shuffled.
BROADCAST_ROWS = 1 << 19


def stored(df, label, codec="zstd"):
    """Write `df` once to the shared folder and go on from the files, so that lost executors
    cost no recomputation of what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df):
    """Delete the files of a table made by `stored` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def attach(rows, small, keys, how="inner", rows_of_small=None):
    """Join a table with one row per key; broadcast only when its counted rows are few."""
    n = small.count() if rows_of_small is None else rows_of_small
    return rows.join(F.broadcast(small) if n <= BROADCAST_ROWS else small, keys, how)


def parts(texts, limit=1 << 20):
    """Runs `(first, rows)` of an Arrow text column of about `limit` bytes each, one row at least, so
    that a task makes Python's strings of a part of a batch at a time."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    first = 0
    while first < len(size):
        before = ends[first - 1] if first else 0
        end = min(int(np.searchsorted(ends, before + limit)) + 1, len(size))
        yield first, end - first
        first = end


def text_of(column="text"):
    return F.coalesce(F.col(column), F.lit(""))


def components(edges, limit=64):
    """Smallest id reachable from each node of `edges(a, b)`, as `(node, component)`.

    Alternates the large-star and small-star steps, each one grouping per node combined before
    its shuffle; the edge list is written to the shared folder after each pair of steps.
    Nodes without edges do not appear.
    """
    spark = edges.sparkSession
    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .filter("a <> b").distinct(), "edges")
    state = None
    for _ in range(limit):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: neighbours above the centre move to the smallest neighbour.
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: neighbours below the centre, and the centre, move to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array("a", "b")).alias("n"), "m").filter("n <> m").select(
            F.col("n").alias("a"), F.col("m").alias("b")).distinct()
        following = stored(small, "edges")
        discard(current)
        current = following
        seen = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                           ).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def empty_like(spark, schema):
    return spark.createDataFrame([], T._parse_datatype_string(schema))
