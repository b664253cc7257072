"""Explicit schemas; nothing is inferred from data."""

from pyspark.sql import types as T

INSTRUCTION = T.StructType([
    T.StructField("instruction", T.StringType()),
    T.StructField("context", T.StringType()),
    T.StructField("response", T.StringType()),
])

CONVERSATION = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
])

PROBLEM = T.StructType([
    T.StructField("prompt", T.StringType()),
    T.StructField("completion", T.StringType()),
])

VOCAB = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("id", T.IntegerType()),
])

MERGES = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("left_id", T.IntegerType()),
    T.StructField("right_id", T.IntegerType()),
    T.StructField("new_id", T.IntegerType()),
])
