"""S1-S4."""

from pyspark.sql import functions as F

from corpusprep.functions.chars import FIRST_CHAR
from corpusprep.operators.problems import generate_problems
from corpusprep.plans.lineage import scratch_path
from corpusprep.queries.problem_queries import PROBLEMS_SQL, SEED
from corpusprep.queries.registry import (
    INSTRUCTIONS_SQL, conversations, instructions, query, table)
from corpusprep.sources.tables import read_instructions, read_jsonl, write_jsonl
from corpusprep.sources.vocab import load_vocab, save_vocab


@query("read_instructions", f"""
WITH {INSTRUCTIONS_SQL}
SELECT instruction, context, response FROM instructions""")
def read_instruction_files(spark, sf_dir):
    path = scratch_path(spark, "instructions")
    rows = instructions(spark, sf_dir).drop("rec_id")
    write_jsonl(rows, f"{path}/deep/below")
    return read_instructions(spark, path, "*.json").drop("rec_id")


@query("read_conversations", "SELECT conv_id, turn, role, text FROM conversations")
def read_turns(spark, sf_dir):
    return conversations(spark, sf_dir)


@query("jsonl_round_trip", f"WITH {PROBLEMS_SQL} SELECT prompt, completion FROM problems")
def jsonl_round_trip(spark, sf_dir):
    path = scratch_path(spark, "problems")
    problems = generate_problems(table(spark, sf_dir, "orders"), SEED, "o_orderkey")
    write_jsonl(problems.select("prompt", "completion"), path)
    return read_jsonl(spark, path)


@query("vocab_round_trip", """
SELECT c AS token, (ord(c) + 7)::BIGINT AS id
FROM (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM conversations)
WHERE c <> ''""")
def vocab_round_trip(spark, sf_dir):
    letters = conversations(spark, sf_dir).select(F.explode(F.split("text", "")).alias("token"))
    vocab = letters.filter("token <> ''").distinct().select(
        "token", (F.ascii("token") + FIRST_CHAR).cast("bigint").alias("id"))
    path = scratch_path(spark, "vocab")
    save_vocab(vocab, path)
    return load_vocab(spark, path)
