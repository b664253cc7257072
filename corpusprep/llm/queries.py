"""Registered queries of this subpackage, each over its whole tables."""

from pyspark.sql import functions as F

from corpusprep.llm import (
    bit_sliced, divergence, host_paths, line_dedup, mixing, ngram_join, packing, sanitise, spotsigs,
    token_counts, token_file, toxicity, whitening)
from corpusprep.llm.common import stored
from corpusprep.plans.lineage import scratch_path

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return add


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_mix_sources")
def op1(spark, sf_dir):
    sizes = stored(mixing.document_sizes(table(spark, sf_dir, "documents")), "mix-documents")
    return mixing.apply_plan(sizes, mixing.mix_plan(sizes)).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def tokenizer_path(name="word_bpe_49k.json"):
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op2_token_file")
def op2(spark, sf_dir):
    path = scratch_path(spark, "token-file")
    token_file.write_token_file(table(spark, sf_dir, "documents"), path, tokenizer_path(), 2)
    return token_file.read_token_digests(spark, path)


@query("op3_pack_documents")
def op3(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), 0)


@query("op4_spot_signatures")
def op4(spark, sf_dir):
    return spotsigs.against_edited(table(spark, sf_dir, "documents"))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op5_bit_sliced_top_k", OP5_SQL)
def op5(spark, sf_dir):
    return bit_sliced.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op7_toxicity")
def op7(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP9_SQL = """
WITH RECURSIVE lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents WHERE text IS NOT NULL
), kept AS (SELECT * FROM lines WHERE length(line) >= 10
), nodes AS (
  SELECT line, length(line) AS n, min({'d': doc_id, 'l': line_no}) AS first FROM kept GROUP BY line
), linked AS (
  SELECT a.first AS a, b.first AS b FROM nodes a JOIN nodes b
  ON a.n >= 24 AND b.n >= 24 AND b.n BETWEEN a.n - 2 AND a.n + 2 AND a.line <> b.line
  WHERE levenshtein(a.line, b.line) <= 2
), reach AS (
  SELECT first AS a, first AS b FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
), class AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT k.doc_id, k.line_no::INTEGER AS line_no, c.c.d AS class_doc_id,
       c.c.l::INTEGER AS class_line_no, (k.doc_id = c.c.d AND k.line_no = c.c.l) AS kept
FROM kept k JOIN nodes n ON k.line = n.line JOIN class c ON n.first = c.a
"""


@query("op9_line_classes", OP9_SQL)
def op9(spark, sf_dir):
    return line_dedup.line_classes(table(spark, sf_dir, "documents")).drop("node")


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 3
    THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1),
      lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words
), marks AS (SELECT doc_id, len(s) AS n, unnest(s) AS m FROM sets
), linked AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM marks a JOIN marks b
  ON a.m = b.m AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
), class AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.c AS component_id
FROM sets s JOIN class c ON s.doc_id = c.a
"""


@query("op10_ngram_join", OP10_SQL)
def op10(spark, sf_dir):
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


@query("op6_host_paths")
def op6(spark, sf_dir):
    return host_paths.extract_pages(table(spark, sf_dir, "pages"))


@query("op8_sanitise")
def op8(spark, sf_dir):
    return sanitise.find_personal_data(table(spark, sf_dir, "documents"))


@query("op11_token_counts")
def op11(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), scratch_path(
        spark, "token-cache"), tokenizer_path("piece_bpe_32k.model"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30
), g AS (SELECT DISTINCT lang, source FROM d
), c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY 1, 2, 3
), f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
), p AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER own + 5 * count(*) OVER own) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 5)) // (sum(lang_n) OVER own + 5 * count(*) OVER own) AS q
  FROM f WINDOW own AS (PARTITION BY lang, source)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM both_parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query("op12_source_divergence", OP12_SQL)
def op12(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query("op13_whitening")
def op13(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
