"""Character tokenizer as column expressions."""

from pyspark.sql import functions as F

from corpusprep.constants import BOS, EOS, PAD, SPECIAL_TOKENS, UNK

FIRST_CHAR = len(SPECIAL_TOKENS)
SIZE = FIRST_CHAR + 256


def char_vocab(spark):
    """All 263 entries `(token, id)`."""
    ids = spark.range(SIZE).select(F.col("id").cast("int").alias("id"))
    return ids.select(_token(F.col("id")).alias("token"), "id")


def _token(i):
    names = F.array(*[F.lit(t) for t in SPECIAL_TOKENS])
    return (F.when((i >= 0) & (i < FIRST_CHAR), F.try_element_at(names, i + 1))
            .when((i >= FIRST_CHAR) & (i < SIZE), F.chr(i - FIRST_CHAR))
            .otherwise(F.lit("")))


def char_encode(text):
    """One id per code point; special-token spellings are encoded letter by letter."""
    def one(c):
        point = F.ascii(c)
        return F.when(point < 256, point + FIRST_CHAR).otherwise(UNK)
    # Splitting '' yields ['']; drop that element.
    letters = F.when(F.length(text) > 0, F.split(text, "")).otherwise(
        F.array().cast("array<string>"))
    return F.transform(letters, one)


def char_decode(ids):
    """Ids back to text; unknown ids vanish, special ids give their names."""
    return F.array_join(F.transform(ids, _token), "")


def special_id(name):
    """Id of a special token; the unknown id for any other name."""
    out = F.lit(UNK)
    for i, token in enumerate(SPECIAL_TOKENS):
        out = F.when(name == token, F.lit(i)).otherwise(out)
    return out


class CharTokenizer:
    """Carries text through shuffles and turns it into ids only where ids are asked for."""

    pad_id, unk_id, bos_id, eos_id = PAD, UNK, BOS, EOS
    stop_ids = (EOS,)
    tag_tokens = len("<assistant>")

    def prepare(self, df, text, keep_last=None):
        """Add `n_tokens` and `payload`, the payload cut to its last `keep_last` tokens."""
        payload = text if keep_last is None else F.when(
            F.length(text) > keep_last, F.substring(text, -keep_last, keep_last)).otherwise(text)
        return df.withColumns({"n_tokens": F.length(text).cast("bigint"), "payload": payload})

    def ids(self, payload):
        return char_encode(payload)
