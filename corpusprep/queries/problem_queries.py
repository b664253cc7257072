"""G1-G2."""

from pyspark.sql import functions as F

from corpusprep.operators.problems import ITEMS, NAMES, generate_problems, verify_completions
from corpusprep.queries.registry import query, table

SEED = 11


def _draw(field, low, high):
    return (f"({low} + ('0x' || substr(md5('{SEED}|{field}|' || o_orderkey), 1, 8))::BIGINT "
            f"% ({high} - ({low}) + 1))")


def _choose(values, field):
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_draw(field, 0, len(values) - 1)} + 1]"


PROBLEMS_SQL = f"""
drawn AS (
  SELECT o_orderkey, {_draw('template', 0, 2)} AS template,
         {_choose(NAMES, 'name1')} AS name1, {_choose(NAMES, 'name2')} AS name2,
         {_choose(ITEMS, 'item')} AS item, {_draw('n1', 20, 50)} AS n1, {_draw('n2', 5, 25)} AS n2,
         {_draw('found', 1, 15)} AS found
  FROM orders),
held AS (
  SELECT *, n1 + n2 AS s1, n1 + n2 + CASE WHEN template = 2 THEN found ELSE 0 END AS held
  FROM drawn),
gone AS (SELECT *, {_draw('gone', 1, 'held - 1')} AS gone FROM held),
problems AS (
  SELECT o_orderkey,
    CASE template
      WHEN 0 THEN name1 || ' starts with ' || n1 || ' ' || item || '. They buy ' || n2
        || ' more, then give away ' || gone || ' to ' || name2 || '. How many ' || item
        || ' do they have left?'
      WHEN 1 THEN 'A bakery has ' || n1 || ' cakes. They bake ' || n2
        || ' more in the morning and sell ' || gone
        || ' in the afternoon. How many cakes are left at the end of the day?'
      ELSE name1 || ' has ' || n1 || ' ' || item || '. ' || name2 || ' gives them ' || n2 || ' '
        || item || ', and they find another ' || found || '. Then, they lose ' || gone
        || '. How many ' || item || ' remain?' END AS prompt,
    n1 || ' + ' || n2 || ' = ' || s1 || '; '
      || CASE WHEN template = 2 THEN s1 || ' + ' || found || ' = ' || held || '; ' ELSE '' END
      || held || ' - ' || gone || ' = ' || (held - gone) AS completion
  FROM gone)
"""


def _problems(spark, sf_dir):
    return generate_problems(table(spark, sf_dir, "orders"), SEED, "o_orderkey")


@query("generate_problems",
       f"WITH {PROBLEMS_SQL} SELECT o_orderkey, prompt, completion FROM problems")
def problems(spark, sf_dir):
    return _problems(spark, sf_dir)


@query("verify_completions", f"""
WITH {PROBLEMS_SQL},
given AS (
  SELECT o.o_orderkey AS o_orderkey, prompt,
         CASE o_orderstatus WHEN 'F' THEN replace(completion, ' + ', ' - ')
              WHEN 'P' THEN completion || '; 1 + x = 2' ELSE completion END AS completion
  FROM problems p JOIN orders o ON p.o_orderkey = o.o_orderkey),
steps AS (
  SELECT o_orderkey, prompt, s, i,
         regexp_extract(s, '^(\\d+) ([+-]) (\\d+) = (-?\\d+)$', 2) AS op,
         TRY_CAST(regexp_extract(s, '^(\\d+) ([+-]) (\\d+) = (-?\\d+)$', 1) AS BIGINT) AS a,
         TRY_CAST(regexp_extract(s, '^(\\d+) ([+-]) (\\d+) = (-?\\d+)$', 3) AS BIGINT) AS b,
         TRY_CAST(regexp_extract(s, '^(\\d+) ([+-]) (\\d+) = (-?\\d+)$', 4) AS BIGINT) AS r
  FROM (SELECT o_orderkey, prompt, unnest(string_split(completion, '; ')) AS s,
               generate_subscripts(string_split(completion, '; '), 1) AS i FROM given)),
linked AS (
  SELECT *, lag(r) OVER (PARTITION BY o_orderkey ORDER BY i) AS before FROM steps),
checked AS (
  SELECT o_orderkey, count(*)::BIGINT AS n_steps, bool_and(r IS NOT NULL) AS well_formed,
    bool_and(coalesce(CASE op WHEN '+' THEN a + b WHEN '-' THEN a - b END = r, false))
      AS arithmetic_ok,
    bool_and(i = 1 OR coalesce(a = before, false)) AS chain_ok,
    coalesce(list_concat([min(a) FILTER (WHERE i = 1)], list(b ORDER BY i))
      = list_transform(regexp_extract_all(any_value(prompt), '\\d+'), lambda x: x::BIGINT), false)
      AS operands_ok,
    arg_max(coalesce(r, -1), i) AS answer
  FROM linked GROUP BY 1)
SELECT o_orderkey, n_steps, well_formed, arithmetic_ok, chain_ok, operands_ok, answer,
       well_formed AND arithmetic_ok AND chain_ok AND operands_ok AS valid
FROM checked""")
def verified(spark, sf_dir):
    """Correct problems, with a wrong operator for status F and a malformed step for status P."""
    made = generate_problems(table(spark, sf_dir, "orders"), SEED, "o_orderkey", ["o_orderstatus"])
    spoiled = (F.when(F.col("o_orderstatus") == "F", F.replace(
                   F.col("completion"), F.lit(" + "), F.lit(" - ")))
               .when(F.col("o_orderstatus") == "P", F.concat("completion", F.lit("; 1 + x = 2")))
               .otherwise(F.col("completion")))
    return verify_completions(made.withColumn("completion", spoiled)).select(
        "o_orderkey", F.col("n_steps").cast("bigint").alias("n_steps"), "well_formed",
        "arithmetic_ok", "chain_ok", "operands_ok",
        F.coalesce("answer", F.lit(-1).cast("bigint")).alias("answer"), "valid")
