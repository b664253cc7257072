"""V1-V6 over embeddings; centroids are the mean vectors of the labels."""

from pyspark.sql import functions as F

from corpusprep.functions.vectors import doubles, rms_normalize
from corpusprep.operators import vectors
from corpusprep.plans.scan import fits_in_task, position
from corpusprep.queries.registry import conversations, query, table

SEED = 5
DIM = 64

CENTROIDS_SQL = """
parts AS (
  SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos
  FROM embeddings),
centroids AS (
  SELECT label AS expert_id, list(m ORDER BY pos) AS vec
  FROM (SELECT label, pos, avg(x) AS m FROM parts GROUP BY 1, 2) GROUP BY 1)
"""

_DOT = "list_dot_product(embedding::DOUBLE[], vec)"


def vector_table(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))


def centroids(spark, sf_dir):
    """Mean vector per label: one sum per dimension, combined before the shuffle."""
    rows = table(spark, sf_dir, "embeddings")
    sums = rows.groupBy(F.col("label").cast("bigint").alias("expert_id")).agg(
        *[F.avg(F.col("embedding")[i].cast("double")).alias(f"d{i}") for i in range(DIM)])
    return sums.select("expert_id", F.array(*[f"d{i}" for i in range(DIM)]).alias("vec"))


def _flat(df, *keys):
    """Vectors as rows of `pos, x`, rounded for comparison."""
    return df.select(*keys, F.posexplode("vec").alias("pos", "x")).select(
        *keys, F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x"))


@query("rms_normalize", """
WITH scaled AS (
  SELECT vec_id, embedding::DOUBLE[] AS v,
         sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) / len(embedding) + 1e-6)
           AS scale
  FROM embeddings)
SELECT vec_id, generate_subscripts(v, 1) - 1 AS pos, round(unnest(v) / scale, 6) + 0.0::DOUBLE AS x
FROM scaled""")
def rms(spark, sf_dir):
    return _flat(vector_table(spark, sf_dir).withColumn(
        "vec", rms_normalize(doubles("vec"))), "vec_id")


_ASSIGN_SQL = f"""
{CENTROIDS_SQL},
scored AS (SELECT vec_id, expert_id, {_DOT} AS score FROM embeddings, centroids),
best AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, expert_id) AS rank
  FROM scored QUALIFY rank <= 2),
assigned AS (
  SELECT *, exp(score) / sum(exp(score)) OVER (PARTITION BY vec_id) AS weight FROM best)
"""


@query("top_k_assign", f"""
WITH {_ASSIGN_SQL}
SELECT vec_id, rank::BIGINT AS rank, expert_id::BIGINT AS expert_id, round(score, 6) + 0.0::DOUBLE AS score,
       round(weight, 6) + 0.0::DOUBLE AS weight FROM assigned""")
def top_k_assign(spark, sf_dir):
    return vectors.top_k_assign(vector_table(spark, sf_dir), centroids(spark, sf_dir)).select(
        "vec_id", F.col("rank").cast("bigint").alias("rank"), "expert_id",
        F.round("score", 6).alias("score"), F.round("weight", 6).alias("weight"))


@query("weighted_combine", f"""
WITH {_ASSIGN_SQL},
flat AS (
  SELECT vec_id, generate_subscripts(vec, 1) AS pos, unnest(vec) * weight AS x
  FROM assigned JOIN centroids USING (expert_id)
  UNION ALL
  SELECT vec_id, generate_subscripts(embedding, 1), unnest(embedding)::DOUBLE FROM embeddings)
SELECT vec_id, (pos - 1)::BIGINT AS pos, round(sum(x), 6) + 0.0::DOUBLE AS x FROM flat GROUP BY 1, 2""")
def weighted_combine(spark, sf_dir):
    rows, experts = vector_table(spark, sf_dir), centroids(spark, sf_dir)
    assigned = vectors.top_k_assign(rows, experts)
    return _flat(vectors.weighted_combine(assigned, experts, rows), "vec_id")


@query("assignment_balance", f"""
WITH {CENTROIDS_SQL},
scored AS (SELECT vec_id, expert_id, {_DOT} AS score FROM embeddings, centroids),
probs AS (
  SELECT expert_id, exp(score) / sum(exp(score)) OVER (PARTITION BY vec_id) AS p FROM scored),
load AS (SELECT expert_id, avg(p) AS f FROM probs GROUP BY 1),
z AS (SELECT avg(lse * lse) AS z FROM (
        SELECT ln(sum(exp(score))) AS lse FROM scored GROUP BY vec_id)),
b AS (SELECT count(*)::BIGINT AS n_experts, count(*) * sum(f * f) AS balance FROM load)
SELECT n_experts, round(balance, 6) + 0.0::DOUBLE AS balance, round(z, 6) + 0.0::DOUBLE AS z_loss,
       round(0.01 * balance + 0.001 * z, 6) + 0.0::DOUBLE AS total FROM b, z""")
def assignment_balance(spark, sf_dir):
    found = vectors.vector_balance(vector_table(spark, sf_dir), centroids(spark, sf_dir))
    return found.select(
        "n_experts", *[F.round(c, 6).alias(c) for c in ("balance", "z_loss", "total")])


@query("embedding_lookup", """
WITH flat AS (
  SELECT conv_id || '-' || turn AS row_id, unnest(string_split(text, ' ')) AS word,
         generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM conversations)
SELECT row_id, pos::BIGINT AS pos, length(word)::BIGINT AS token, round(embedding[1]::DOUBLE, 6) + 0.0::DOUBLE AS first,
       round(list_sum(embedding::DOUBLE[]), 6) + 0.0::DOUBLE AS total
FROM flat LEFT JOIN embeddings ON vec_id = length(word)""")
def embedding_lookup(spark, sf_dir):
    """Word lengths stand for token ids, embeddings for the table."""
    tokens = conversations(spark, sf_dir).select(
        F.concat_ws("-", "conv_id", "turn").alias("row_id"),
        F.transform(F.split("text", " "), lambda w: F.length(w).cast("bigint")).alias("ids"))
    found = vectors.embedding_lookup(tokens, table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("token"), F.col("embedding").alias("vec")))
    total = F.aggregate(doubles("vec"), F.lit(0.0), lambda s, x: s + x)
    return found.select("row_id", F.col("pos").cast("bigint").alias("pos"), "token",
                        F.round(F.col("vec")[0].cast("double"), 6).alias("first"),
                        F.round(total, 6).alias("total"))


def _unit(field):
    return (f"((('0x' || substr(md5('{SEED}|grow.{field}|' || id || '|' || i), 1, 13))::BIGINT"
            f" + 0.5::DOUBLE) / 4503599627370496)")


@query("grow_table", f"""
WITH size AS (SELECT max(vec_id) + 1 AS old, count(*) AS n FROM embeddings),
new AS (SELECT unnest(range(old, old + n)) AS id FROM size)
SELECT vec_id AS token, generate_subscripts(embedding, 1) - 1 AS pos,
       round(unnest(embedding)::DOUBLE, 6) + 0.0::DOUBLE AS x FROM embeddings
UNION ALL
SELECT id, i, round(0.02 * sqrt(-2 * ln({_unit('r')})) * cos(2 * pi() * {_unit('a')}), 6) + 0.0::DOUBLE
FROM new, range({DIM}) r(i)""")
def grow_table(spark, sf_dir):
    """Twice as many rows as there are embeddings."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("token"), F.col("embedding").alias("vec"))
    last, count = rows.agg(F.max("token"), F.count(F.lit(1))).first()
    return _flat(vectors.grow_table(rows, last + 1 + count, DIM, SEED), "token")


def _window_sql(window):
    return f"""
WITH seq AS (
  SELECT label::BIGINT AS seq_id, embedding::DOUBLE[] AS v,
         row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM embeddings),
pairs AS (
  SELECT q.seq_id, q.pos, k.v AS v, exp(list_dot_product(q.v, k.v) / sqrt({DIM})) AS e
  FROM seq q JOIN seq k ON q.seq_id = k.seq_id AND k.pos BETWEEN q.pos - {window} AND q.pos),
flat AS (
  SELECT seq_id, pos, generate_subscripts(v, 1) - 1 AS i, unnest(v) * e AS x, e FROM pairs)
SELECT seq_id, pos::BIGINT AS q, i::BIGINT AS pos, round(sum(x) / sum(e), 6) + 0.0::DOUBLE AS x
FROM flat GROUP BY 1, 2, 3"""


def _window(spark, sf_dir, window):
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("bigint").alias("seq_id"), "vec_id", F.col("embedding").alias("vec"))
    placed = position(rows, ["seq_id"], F.col("vec_id"), "pos",
                      plain=fits_in_task(rows, ["seq_id"]))
    found = vectors.causal_window_average(placed, window).withColumnRenamed("pos", "q")
    return _flat(found, "seq_id", "q")


@query("causal_window_average", _window_sql(128))
def causal_window(spark, sf_dir):
    return _window(spark, sf_dir, 128)


@query("causal_short_window", _window_sql(16))
def causal_short_window(spark, sf_dir):
    return _window(spark, sf_dir, 16)
