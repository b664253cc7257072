"""Where queries register, and the inputs they derive from the tables."""

from pyspark.sql import functions as F

from corpusprep.operators.context import exchanges
from corpusprep.plans.skew import hot_keys, join_per_key
from corpusprep.sources.tables import read_conversations

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a function `(spark, sf_dir) -> DataFrame` and its SQL. The SQL adds 0.0 to what it
    rounds, since rounding leaves a negative zero there and not in Spark."""
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return add


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversations(spark, sf_dir):
    return read_conversations(spark, f"{sf_dir}/conversations.parquet")


def listed(column):
    """Array as text, `[1, 2, 3]`, so that results compare as plain columns."""
    return column.cast("string")


def instructions(spark, sf_dir):
    """A user message, the reply after it, and the conversation's system message as context."""
    turns = conversations(spark, sf_dir)
    system = turns.filter(F.col("role") == "system").groupBy("conv_id").agg(
        F.max("text").alias("context"))
    pairs = exchanges(turns).filter(F.col("response").isNotNull())
    hot = hot_keys(turns, ["conv_id"])
    return join_per_key(pairs, system, ["conv_id"], ["turn"], "left", hot).select(
        F.concat_ws("-", "conv_id", "turn").alias("rec_id"),
        F.col("user_text").alias("instruction"), "context", "response")


INSTRUCTIONS_SQL = """
nxt AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
  FROM conversations),
sys AS (SELECT conv_id, max(text) AS context FROM conversations WHERE role = 'system' GROUP BY 1),
instructions AS (
  SELECT n.conv_id || '-' || n.turn AS rec_id, n.text AS instruction, s.context AS context,
         n.next_text AS response
  FROM nxt n LEFT JOIN sys s ON n.conv_id = s.conv_id
  WHERE n.role = 'user' AND n.next_role = 'assistant')
"""

CONTENT_SQL = ("CASE WHEN length(context) > 0 THEN context || chr(10) || chr(10) || instruction "
               "ELSE instruction END")


def chars_sql(text):
    """Character ids of a text, as a list."""
    return (f"CASE WHEN length({text}) = 0 THEN []::INTEGER[] ELSE list_transform("
            f"string_split({text}, ''), lambda c: CASE WHEN ord(c) < 256 "
            f"THEN (ord(c) + 7)::INTEGER ELSE 1 END) END")
