"""T1-T12."""

from pyspark.sql import functions as F

from corpusprep.functions import chars
from corpusprep.functions.templates import render_message
from corpusprep.functions.text import BYTE_ALPHABET, normalize_text, pretokenize
from corpusprep.operators import bpe
from corpusprep.queries.registry import chars_sql, conversations, listed, query, table

# Entries of the models trained here, on all messages; the operator's default is
# constants.VOCAB_SIZE, which takes thousands of rounds.
ENTRIES = 384
_models = {}


def model(spark, sf_dir):
    """A model of all rendered messages for the queries that use one; `train_bpe` makes its own."""
    if sf_dir not in _models:
        _models[sf_dir] = bpe.train_bpe(_message_words(spark, sf_dir), ENTRIES)
    return _models[sf_dir]


def _messages(spark, sf_dir):
    return conversations(spark, sf_dir).select("conv_id", "turn", render_message(
        F.col("role"), F.col("text")).alias("message"))


def _message_words(spark, sf_dir):
    return bpe.word_counts(_messages(spark, sf_dir), "message")


@query("char_vocab", f"""
WITH used AS (
  SELECT unnest({chars_sql('text')}) AS id FROM conversations),
vocab AS (
  SELECT i AS id, CASE WHEN i < 7 THEN
           (['<pad>', '<unk>', '<bos>', '<eos>', '<user>', '<assistant>', '<system>'])[i + 1]
         ELSE chr((i - 7)::INTEGER) END AS token
  FROM range(263) r(i))
SELECT hex(token) AS token_hex, v.id::BIGINT AS id, count(u.id)::BIGINT AS n
FROM vocab v LEFT JOIN used u ON v.id = u.id GROUP BY 1, 2""")
def char_vocab(spark, sf_dir):
    """The vocabulary with the use of each entry in the corpus."""
    used = conversations(spark, sf_dir).select(F.explode(chars.char_encode(F.col("text"))).alias(
        "id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return chars.char_vocab(spark).join(used, "id", "left").select(
        F.hex("token").alias("token_hex"), F.col("id").cast("bigint").alias("id"),
        F.coalesce("n", F.lit(0)).alias("n"))


@query("char_encode", f"""
SELECT conv_id, turn, ({chars_sql('text')})::VARCHAR AS ids FROM conversations""")
def char_encode(spark, sf_dir):
    return conversations(spark, sf_dir).select(
        "conv_id", "turn", listed(chars.char_encode(F.col("text"))).alias("ids"))


@query("char_decode", """
SELECT conv_id, turn, '<bos>' || text || '<eos>' AS text FROM conversations""")
def char_decode(spark, sf_dir):
    """Encoded text between marks and with an id outside the vocabulary, decoded again."""
    ids = F.concat(F.array(F.lit(2)), chars.char_encode(F.col("text")),
                   F.array(F.lit(999), F.lit(3)))
    return conversations(spark, sf_dir).withColumn("ids", ids).select(
        "conv_id", "turn", chars.char_decode(F.col("ids")).alias("text"))


@query("special_id", """
SELECT conv_id, turn, CASE role WHEN 'user' THEN 4 WHEN 'assistant' THEN 5 WHEN 'system' THEN 6
       ELSE 1 END::BIGINT AS role_id, 1::BIGINT AS bare_id FROM conversations""")
def special_id(spark, sf_dir):
    tag = F.concat(F.lit("<"), "role", F.lit(">"))
    return conversations(spark, sf_dir).select(
        "conv_id", "turn", chars.special_id(tag).cast("bigint").alias("role_id"),
        chars.special_id(F.col("role")).cast("bigint").alias("bare_id"))


@query("normalize_text", "SELECT doc_id, strip_accents(lower(text)) AS text FROM documents")
def normalized(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", normalize_text(F.col("text")).alias("text"))


def _literals(values):
    return "[" + ", ".join(f"chr({ord(v)})" for v in values) + "]"


def words_sql(source, key, text):
    """Raw words in order; RE2 has no lookahead, so a mark stands before the last space of a run."""
    return f"""
normal AS (SELECT {key}, strip_accents(lower({text})) AS t FROM {source}),
spaced AS (
  SELECT {key}, regexp_replace(CASE WHEN t = '' OR starts_with(t, ' ') THEN t ELSE ' ' || t END,
                               '(\\s)(\\S)', chr(1) || '\\1\\2', 'g') AS t FROM normal),
raw AS (
  SELECT {key}, unnest(w) AS word, generate_subscripts(w, 1) AS idx FROM (
    SELECT {key}, regexp_extract_all(t,
      '''s|''t|''re|''ve|''m|''ll|''d| ?\\pL+| ?\\pN+| ?[^\\s\\x01\\pL\\pN]+|\\s+') AS w FROM spaced)),
bytes AS (
  SELECT {key}, idx, array_to_string(list_transform(regexp_extract_all(hex(encode(word)), '..'),
         lambda h: ({_literals(BYTE_ALPHABET)})[('0x' || h)::INTEGER + 1]), '') AS word FROM raw),
pieces AS (
  SELECT {key}, idx, unnest(p) AS word, generate_subscripts(p, 1) AS part FROM (
    SELECT {key}, idx, regexp_extract_all(word, '\\pN|\\PN+') AS p FROM bytes))
"""


@query("pretokenize", f"""
WITH {words_sql('documents', 'doc_id', 'text')}
SELECT doc_id, string_agg(word, ' ' ORDER BY idx, part) AS words, count(*)::BIGINT AS n
FROM pieces GROUP BY 1""")
def pretokens(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(
        "doc_id", pretokenize(F.col("text")).alias("w"))
    return words.select("doc_id", F.array_join("w", " ").alias("words"),
                        F.size("w").cast("bigint").alias("n"))


@query("word_counts", f"""
WITH {words_sql('documents', 'doc_id', 'text')}
SELECT word, count(*)::BIGINT AS n FROM pieces GROUP BY 1""")
def word_counts(spark, sf_dir):
    return bpe.word_counts(table(spark, sf_dir, "documents"))


# Training as one recursive query: a state row holds every word as ids in spaces, and each step
# merges the most frequent pair, ties to the smallest ids. Words that are only to be encoded take
# part with no count.
_BPE_SQL = f"""
messages AS (SELECT conv_id, turn, '<' || role || '>' || text AS message FROM conversations),
trained AS (
  WITH {words_sql('messages', 'conv_id, turn', 'message')}
  SELECT word, count(*)::BIGINT AS n FROM pieces GROUP BY 1),
coded AS (
  WITH {words_sql('conversations', 'conv_id, turn', 'text')}
  SELECT conv_id, turn, idx, part, word FROM pieces),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT * FROM trained UNION ALL SELECT DISTINCT word, 0 FROM coded) GROUP BY 1),
letters AS (
  SELECT c, 6 + row_number() OVER (ORDER BY ord(c)) AS id FROM (
    SELECT DISTINCT unnest(string_split(word, '')) AS c FROM trained) WHERE c <> ''),
ids AS (SELECT map(list(c), list(id)) AS id_of, list(c ORDER BY id) AS names FROM letters),
steps AS (
  SELECT 0 AS rank, NULL::BIGINT AS left_id, NULL::BIGINT AS right_id, NULL::BIGINT AS new_id,
         list(word ORDER BY word) AS word, list(n ORDER BY word) AS n,
         list(array_to_string(list_transform(list_filter(string_split(word, ''), lambda c: c <> ''),
              lambda c: ' ' || coalesce(id_of[c], 1) || ' '), '') ORDER BY word) AS w,
         any_value(['<pad>', '<unk>', '<bos>', '<eos>', '<user>', '<assistant>', '<system>']
                   || names) AS tokens
  FROM words, ids
  UNION ALL
  SELECT rank + 1, l, r, coalesce(list_position(tokens, name) - 1, len(tokens)), word, n,
         list_transform(w, lambda x: replace(x, ' ' || l || '  ' || r || ' ',
           ' ' || coalesce(list_position(tokens, name) - 1, len(tokens)) || ' ')),
         CASE WHEN list_contains(tokens, name) THEN tokens ELSE list_append(tokens, name) END
  FROM (
    SELECT s.*, b.l, b.r, s.tokens[b.l + 1] || s.tokens[b.r + 1] AS name FROM steps s, LATERAL (
      SELECT p[1]::BIGINT AS l, p[2]::BIGINT AS r FROM (
        SELECT n, unnest(list_zip(x[1:len(x) - 1], x[2:])) AS p FROM (
          SELECT unnest(s.n) AS n, string_split(trim(unnest(s.w)), '  ') AS x))
      GROUP BY 1, 2 HAVING sum(n) >= 2 ORDER BY sum(n) DESC, 1, 2 LIMIT 1) b
    WHERE len(s.tokens) < {ENTRIES})),
final AS (SELECT * FROM steps ORDER BY rank DESC LIMIT 1),
spelled AS (
  SELECT word, string_split(trim(w), '  ') AS ids FROM (
    SELECT unnest(word) AS word, unnest(w) AS w FROM final)),
encoded AS (
  SELECT c.conv_id, c.turn, [CASE c.role WHEN 'user' THEN 4 WHEN 'assistant' THEN 5 ELSE 6 END]
         || flatten(coalesce(list(s.ids::BIGINT[] ORDER BY d.idx, d.part)
                    FILTER (s.ids IS NOT NULL), [])) AS ids
  FROM conversations c LEFT JOIN coded d USING (conv_id, turn) LEFT JOIN spelled s USING (word)
  GROUP BY c.conv_id, c.turn, c.role)
"""


@query("train_bpe", f"""
WITH RECURSIVE {_BPE_SQL}
SELECT v.token, v.id::BIGINT AS id, s.rank::BIGINT AS rank, s.left_id, s.right_id
FROM (SELECT unnest(tokens) AS token, unnest(range(len(tokens))) AS id FROM final) v
LEFT JOIN (SELECT rank - 1 AS rank, left_id, right_id, new_id FROM steps WHERE rank > 0) s
ON s.new_id = v.id""")
def train_bpe(spark, sf_dir):
    """Vocabulary with the merges that make its entries."""
    made = bpe.train_bpe(_message_words(spark, sf_dir), ENTRIES)
    vocab, merges = made.frames(spark)
    return vocab.join(merges, vocab["id"] == merges["new_id"], "left").select(
        "token", *[F.col(c).cast("bigint").alias(c) for c in ("id", "rank", "left_id", "right_id")])


@query("bpe_encode", f"""
WITH RECURSIVE {_BPE_SQL}
SELECT conv_id, turn, '[' || array_to_string(ids, ', ') || ']' AS ids FROM encoded""")
def bpe_encode(spark, sf_dir):
    coded = bpe.bpe_encode(_messages(spark, sf_dir), F.col("message"), model(spark, sf_dir))
    return coded.select("conv_id", "turn", listed(F.col("ids")).alias("ids"))


@query("bpe_decode", """
SELECT conv_id, turn, ' ' || ltrim(strip_accents(lower(text)), ' ') AS text FROM conversations
WHERE NOT starts_with(text, ' ')
UNION ALL
SELECT conv_id, turn, strip_accents(lower(text)) FROM conversations WHERE starts_with(text, ' ')""")
def bpe_decode(spark, sf_dir):
    """Decoding by bytes gives the normalised message back; the role tag is a special token."""
    trained = model(spark, sf_dir)
    coded = bpe.bpe_encode(_messages(spark, sf_dir), F.col("message"), trained)
    return coded.select("conv_id", "turn", bpe.bpe_decode(
        spark, F.col("ids"), trained, "bytes").alias("text"))


@query("bpe_decode_joined", f"""
WITH RECURSIVE {_BPE_SQL}
SELECT conv_id, turn, array_to_string(list_transform(list_filter(ids, lambda i: i >= 7),
       lambda i: tokens[i + 1]), ' ') AS text FROM encoded, final""")
def bpe_decode_joined(spark, sf_dir):
    trained = model(spark, sf_dir)
    coded = bpe.bpe_encode(_messages(spark, sf_dir), F.col("message"), trained)
    return coded.select("conv_id", "turn", bpe.bpe_decode(
        spark, F.col("ids"), trained).alias("text"))


def _requests(spark, sf_dir):
    """Document sources as new tokens, then roles, in order of id."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("<"), "source", F.lit(">")).alias("token"), F.col("doc_id").alias("at"))
    roles = conversations(spark, sf_dir).select(
        F.concat(F.lit("<"), "role", F.lit(">")).alias("token"),
        F.col("conv_id").alias("at"))
    return docs.unionByName(roles)


_REQUESTS_SQL = """
requested AS (
  SELECT '<' || source || '>' AS token, doc_id AS seen_at FROM documents
  UNION ALL SELECT '<' || role || '>', conv_id FROM conversations),
vocab AS (
  SELECT i AS id, CASE WHEN i < 7 THEN
           (['<pad>', '<unk>', '<bos>', '<eos>', '<user>', '<assistant>', '<system>'])[i + 1]
         ELSE chr((i - 7)::INTEGER) END AS token
  FROM range(263) r(i)),
fresh AS (SELECT token, seen_at FROM requested WHERE token NOT IN (SELECT token FROM vocab)),
grown AS (
  SELECT token, id FROM vocab
  UNION ALL
  SELECT token, 262 + row_number() OVER (ORDER BY seen_at, token)
  FROM (SELECT token, min(seen_at) AS seen_at FROM fresh GROUP BY 1))
"""


@query("expand_vocab", f"WITH {_REQUESTS_SQL} SELECT hex(token) AS token_hex, id::BIGINT AS id "
                       "FROM grown")
def expand_vocab(spark, sf_dir):
    return bpe.expand_vocab(chars.char_vocab(spark), _requests(spark, sf_dir)).select(
        F.hex("token").alias("token_hex"), "id")


@query("expansion_count", f"WITH {_REQUESTS_SQL} SELECT count(*)::BIGINT AS added FROM fresh")
def expansion_count(spark, sf_dir):
    return bpe.expansion_count(chars.char_vocab(spark), _requests(spark, sf_dir))


@query("vocab_size", f"WITH {_REQUESTS_SQL} SELECT count(*)::BIGINT AS size FROM grown")
def vocab_size(spark, sf_dir):
    return bpe.vocab_size(bpe.expand_vocab(chars.char_vocab(spark), _requests(spark, sf_dir)))
