"""E1-E8, M4 and exact order."""

from pyspark.sql import functions as F

from corpusprep.constants import STAGES, VALIDATION_BATCH
from corpusprep.functions.chars import CharTokenizer
from corpusprep.operators import batching, examples, metrics
from corpusprep.queries.registry import chars_sql, conversations, listed, query, table

MAX_LENGTH = 512
SEED = 42

_IDS_SQL = f"""
msgs AS (
  SELECT conv_id, turn, role, {chars_sql("('<' || role || '>' || text)")} AS ids
  FROM conversations),
labelled AS (
  SELECT *, CASE WHEN role = 'assistant' THEN ids
                 ELSE list_transform(ids, lambda i: -100) END AS labels FROM msgs),
"""

_PIECES_SQL = f"""{_IDS_SQL}
placed AS (
  SELECT conv_id, turn AS piece, ids, labels, 1 + coalesce(sum(len(ids)) OVER (
           PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS start
  FROM labelled),
pieces AS (
  SELECT conv_id, piece, start::BIGINT AS start, ids, labels FROM placed
  UNION ALL SELECT DISTINCT conv_id, -1, 0, [2], [-100] FROM msgs
  UNION ALL SELECT conv_id, max(turn) + 1, sum(len(ids)) + 1, [3], [3] FROM msgs GROUP BY conv_id)
"""


def _windows_sql(length):
    return f"""{_IDS_SQL}
whole AS (
  SELECT conv_id, list_concat(list_concat([2], flatten(list(ids ORDER BY turn))), [3]) AS ids,
         list_concat(list_concat([-100], flatten(list(labels ORDER BY turn))), [3]) AS labels
  FROM labelled GROUP BY conv_id),
windows AS (
  SELECT conv_id, ids[greatest(1, len(ids) - {length} + 1):] AS ids,
         labels[greatest(1, len(ids) - {length} + 1):] AS labels FROM whole),
shifted AS (
  SELECT conv_id, ids[1:len(ids) - 1] AS input_ids, labels[2:] AS targets FROM windows)
"""


def _turns(spark, sf_dir):
    return conversations(spark, sf_dir)


@query("assemble", f"""
WITH {_PIECES_SQL}
SELECT conv_id, piece, start::BIGINT AS start, ids::VARCHAR AS input_ids FROM pieces""")
def assemble(spark, sf_dir):
    return examples.assemble(_turns(spark, sf_dir), CharTokenizer()).select(
        "conv_id", "piece", "start", listed(F.col("input_ids")).alias("input_ids"))


@query("label_mask", f"""
WITH {_PIECES_SQL}
SELECT conv_id, piece, start::BIGINT AS start, labels::VARCHAR AS labels FROM pieces""")
def label_mask(spark, sf_dir):
    return examples.assemble(_turns(spark, sf_dir), CharTokenizer()).select(
        "conv_id", "piece", "start", listed(F.col("labels")).alias("labels"))


@query("truncate_left", f"""
WITH {_windows_sql(MAX_LENGTH)}
SELECT conv_id, ids::VARCHAR AS ids, labels::VARCHAR AS labels
FROM windows""")
def truncate_left(spark, sf_dir):
    return examples.training_windows(_turns(spark, sf_dir), CharTokenizer(), MAX_LENGTH).select(
        "conv_id", listed(F.col("ids")).alias("ids"), listed(F.col("labels")).alias("labels"))


@query("training_examples", f"""
WITH {_windows_sql(MAX_LENGTH)}
SELECT conv_id, input_ids::VARCHAR AS input_ids,
       targets::VARCHAR AS targets FROM shifted""")
def training_examples(spark, sf_dir):
    return examples.training_examples(_turns(spark, sf_dir), CharTokenizer(), MAX_LENGTH).select(
        "conv_id", listed(F.col("input_ids")).alias("input_ids"),
        listed(F.col("targets")).alias("targets"))


@query("supervised_tokens", f"""
WITH {_windows_sql(MAX_LENGTH)}
SELECT conv_id, len(input_ids)::BIGINT AS n_tokens,
       len(list_filter(targets, lambda t: t <> -100))::BIGINT AS n_supervised FROM shifted""")
def supervised_tokens(spark, sf_dir):
    made = examples.training_examples(_turns(spark, sf_dir), CharTokenizer(), MAX_LENGTH)
    return made.select("conv_id", F.size("input_ids").cast("bigint").alias("n_tokens"),
                       examples.supervised_tokens("targets").cast("bigint").alias("n_supervised"))


_BATCH_SQL = """
indexed AS (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS idx FROM shifted),
batched AS (
  SELECT *, idx // {size} AS batch_id, idx % {size} AS slot,
         max(len(input_ids)) OVER (PARTITION BY idx // {size}) AS width FROM indexed)
SELECT conv_id, batch_id::BIGINT AS batch_id, slot::BIGINT AS slot, width::BIGINT AS width,
  list_concat(input_ids, list_transform(range(width - len(input_ids)),
                                                        lambda x: 0))::VARCHAR AS input_ids,
  list_concat(targets, list_transform(range(width - len(targets)),
                                                      lambda x: -100))::VARCHAR AS targets
FROM batched"""


def _batch_columns(df):
    return df.select("conv_id", "batch_id", F.col("slot").cast("bigint").alias("slot"),
                     F.col("width").cast("bigint").alias("width"),
                     listed(F.col("input_ids")).alias("input_ids"),
                     listed(F.col("targets")).alias("targets"))


@query("batch_and_pad", f"WITH {_windows_sql(2048)}, "
                        + _BATCH_SQL.format(order="conv_id", size=VALIDATION_BATCH))
def batch_and_pad(spark, sf_dir):
    made = examples.training_examples(_turns(spark, sf_dir), CharTokenizer(), 2048)
    return _batch_columns(batching.batch_and_pad(made, VALIDATION_BATCH))


@query("shuffled_batches", f"WITH {_windows_sql(2048)}, " + _BATCH_SQL.format(
    order=f"substr(md5('{SEED}|order|' || conv_id), 1, 15), conv_id", size=16))
def shuffled_batches(spark, sf_dir):
    made = examples.training_examples(_turns(spark, sf_dir), CharTokenizer(), 2048)
    return _batch_columns(batching.batch_and_pad(made, 16, seed=SEED))


_STAGES_SQL = "stages AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {n}, {b}, {t})" for i, (n, b, t) in enumerate(STAGES, 1)) + \
    ") v(stage, max_len, batch_size, threshold)),"

_STAGED_SQL = f"""{_windows_sql(1 << 40)},
{_STAGES_SQL}
tails AS (
  SELECT stage, max_len, batch_size, conv_id,
         ids[greatest(1, len(ids) - max_len + 1):] AS ids,
         labels[greatest(1, len(ids) - max_len + 1):] AS labels
  FROM whole, stages),
staged AS (
  SELECT stage, max_len, batch_size, conv_id, ids[1:len(ids) - 1] AS input_ids,
         labels[2:] AS targets FROM tails)
"""


@query("curriculum_examples", f"""
WITH {_STAGED_SQL}
SELECT stage::BIGINT AS stage, conv_id, input_ids::VARCHAR AS input_ids,
       targets::VARCHAR AS targets FROM staged""")
def curriculum_examples(spark, sf_dir):
    return examples.curriculum_examples(_turns(spark, sf_dir), CharTokenizer()).select(
        F.col("stage").cast("bigint").alias("stage"), "conv_id",
        listed(F.col("input_ids")).alias("input_ids"), listed(F.col("targets")).alias("targets"))


@query("stage_plan", f"""
WITH {_STAGED_SQL},
indexed AS (
  SELECT stage, batch_size, len(input_ids) AS n,
         len(list_filter(targets, lambda t: t <> -100)) AS supervised,
         (row_number() OVER (PARTITION BY stage ORDER BY conv_id) - 1) // batch_size AS batch_id
  FROM staged),
wide AS (SELECT *, max(n) OVER (PARTITION BY stage, batch_id) AS width FROM indexed)
SELECT stage::BIGINT AS stage, count(*)::BIGINT AS examples,
       (max(batch_id) + 1)::BIGINT AS batches, ((max(batch_id) + 1) // 8)::BIGINT AS steps,
       sum(supervised)::BIGINT AS supervised_tokens, sum(n)::BIGINT AS tokens,
       sum(width - n)::BIGINT AS padded_cells,
       round(sum(width - n) / sum(width)::DOUBLE, 6) + 0.0::DOUBLE AS padding_ratio
FROM wide GROUP BY stage""")
def stage_plan(spark, sf_dir):
    staged = examples.curriculum_examples(_turns(spark, sf_dir), CharTokenizer())
    return batching.stage_plan(staged).select(
        F.col("stage").cast("bigint").alias("stage"), "examples", "batches", "steps",
        "supervised_tokens", "tokens", "padded_cells",
        F.round("padding_ratio", 6).alias("padding_ratio"))


_ATTEMPTS_SQL = """
attempts AS (
  SELECT event_type AS run, event_id % 12 AS attempt, avg(value) * (12 - event_id % 12) / 12 AS ppl
  FROM events GROUP BY 1, 2),
ordered AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY attempt) AS rn FROM attempts),
gate AS (
  SELECT run, attempt, ppl, rn, 1 AS stage FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.run, o.attempt, o.ppl, o.rn, s.stage + CASE WHEN g.ppl <= s.threshold THEN 1 ELSE 0 END
  FROM gate g JOIN stages s USING (stage) JOIN ordered o ON o.run = g.run AND o.rn = g.rn + 1),
examples AS (SELECT conv_id, len(ids) AS n, row_number() OVER (ORDER BY conv_id) - 1 AS at FROM whole),
total AS (SELECT count(*) AS n FROM examples),
sides AS (
  SELECT n, a, (n + a - 1) // a AS b FROM total, (
    SELECT unnest(range(1, 1 + floor(sqrt((SELECT n FROM total)))::BIGINT)) AS a)
  WHERE a >= greatest(floor(sqrt(n)) - 512, (floor(sqrt(n))::BIGINT + 1) // 2) ORDER BY a * ((n + a - 1) // a) - n, a DESC LIMIT 1),
walk AS (
  SELECT run, attempt, stage, conv_id, e.n, e.at % a AS x, e.at // a AS y, 0 AS j
  FROM gate JOIN stages USING (stage), examples e, sides
  UNION ALL
  SELECT run, attempt, stage, conv_id, n, CASE WHEN j % 2 = 0 THEN (x + d) % a ELSE x END,
         CASE WHEN j % 2 = 0 THEN y ELSE (y + d) % b END, j + 1
  FROM (
    SELECT w.*, a, b, s.n AS total, ('0x' || substr(md5('{seed}|feistel|' || run || '|' || stage || '|'
           || attempt || '|' || j % 6 || '|' || CASE WHEN j % 2 = 0 THEN y ELSE x END), 1, 8)
           )::BIGINT % 2147483648 AS d
    FROM walk w, sides s) q
  WHERE j % 6 <> 0 OR j = 0 OR x + a * y >= total),
-- The first value below the total after a whole pass of six rounds.
ended AS (
  SELECT run, attempt, stage, conv_id, w.n, arg_min(x + a * y, j) AS place
  FROM walk w, sides s WHERE j > 0 AND j % 6 = 0 AND x + a * y < s.n GROUP BY ALL),
placed AS (
  SELECT run, attempt, stage, conv_id, least(n, max_len) - 1 AS n, place // batch_size AS batch_id,
         place % batch_size AS slot FROM ended JOIN stages USING (stage))
SELECT run, attempt, stage::BIGINT AS stage, conv_id, batch_id::BIGINT AS batch_id,
       slot::BIGINT AS slot, n::BIGINT AS n,
       max(n) OVER (PARTITION BY run, attempt, batch_id)::BIGINT AS width FROM placed
"""


@query("attempt_batches", f"WITH RECURSIVE {_windows_sql(1 << 40)}, {_STAGES_SQL}"
                          + _ATTEMPTS_SQL.replace("{seed}", str(SEED)))
def attempt_batches(spark, sf_dir):
    """Every attempt of every run reads all conversations in its own order, at its stage's size."""
    events = table(spark, sf_dir, "events")
    tries = events.groupBy(F.col("event_type").alias("run"), (F.col("event_id") % 12).alias(
        "attempt")).agg(F.avg("value").alias("mean")).select("run", "attempt", (
            F.col("mean") * (12 - F.col("attempt")) / 12).alias("ppl"))
    windows = examples.training_windows(_turns(spark, sf_dir), CharTokenizer(), STAGES[-1][0])
    made = batching.attempt_batches(windows.select("conv_id", F.size("ids").alias("n")),
                                    metrics.curriculum_gate(tries), SEED)
    return made.select("run", "attempt", *[F.col(c).cast("bigint").alias(c) for c in (
        "stage", "conv_id", "batch_id", "slot", "n", "width")])


_SHUFFLED_SQL = f"""
shuffled AS (
  SELECT doc_id, row_number() OVER (ORDER BY substr(md5('{SEED}|order|' || doc_id), 1, 15), doc_id)
         - 1 AS idx, count(*) OVER () AS n FROM documents)
"""


@query("shuffled_index",
       f"WITH {_SHUFFLED_SQL} SELECT doc_id, idx::BIGINT AS position FROM shuffled")
def shuffled_index(spark, sf_dir):
    return batching.shuffled_index(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"],
                                   SEED)


@query("ordered_index", """
SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS position FROM documents""")
def ordered_index(spark, sf_dir):
    return batching.ordered_index(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("seeded_shuffle_split", f"""
WITH {_SHUFFLED_SQL}
SELECT doc_id, CASE WHEN idx < floor(n * 0.95) THEN 'train' ELSE 'validation' END AS split
FROM shuffled""")
def seeded_shuffle_split(spark, sf_dir):
    return batching.seeded_shuffle_split(
        table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], SEED)


@query("fixed_size_split", f"""
WITH {_SHUFFLED_SQL}
SELECT doc_id, CASE WHEN idx < 900 THEN 'train' ELSE 'validation' END AS split FROM shuffled""")
def fixed_size_split(spark, sf_dir):
    return batching.seeded_shuffle_split(
        table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], SEED, n=900)
