"""JSON lines, conversation tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.schemas import CONVERSATION, INSTRUCTION, PROBLEM


def read_jsonl(spark, path, schema=PROBLEM, pattern=None, corrupt_column=None):
    """One JSON object per line, every matching file below `path`.

    A malformed line fails the job, or lands in `corrupt_column` when one is named.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if corrupt_column:
        marked = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        return reader.schema(marked).option(
            "columnNameOfCorruptRecord", corrupt_column).json(path)
    return reader.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df, path, mode="error"):
    df.write.mode(mode).json(path)


def read_instructions(spark, path, pattern="*.jsonl"):
    """Instruction records with `rec_id`, distinct per row and derived from the content: a digest,
    and a number that tells copies of a record apart. File listing and splits have no part in it."""
    rows = read_jsonl(spark, path, INSTRUCTION, pattern)
    names = [f.name for f in INSTRUCTION]
    # Null and empty fields differ, and a length keeps field borders apart.
    fields = [F.coalesce(F.concat(F.length(n).cast("string"), F.lit(":"), n), F.lit("-"))
              for n in names]
    hashed = rows.withColumn("_digest", F.sha2(F.concat(*fields), 256))
    # Copies are alike, so it does not matter which one gets which number.
    spread = hashed.withColumn("_part", F.spark_partition_id())
    copies = spread.groupBy("_digest", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_digest").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ends = copies.withColumn("_end", F.sum("_n").over(before))
    numbered = ends.select("_digest", F.explode(F.sequence(
        F.col("_end") - F.col("_n"), F.col("_end") - 1)).alias("_copy"))
    firsts = hashed.groupBy("_digest").agg(*[F.first(n).alias(n) for n in names])
    return firsts.join(numbered, "_digest").select(*names, F.concat_ws(
        "-", "_digest", "_copy").alias("rec_id"))


def read_conversations(spark, path):
    """Turns as `(conv_id, turn, role, text)`."""
    return spark.read.schema(CONVERSATION).parquet(path)
