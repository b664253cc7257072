"""Normalisation and byte-level pretokenisation."""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The word pattern, in Java syntax with Unicode classes, and the digit pattern.
WORD_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DIGIT_PATTERN = r"\p{N}|\P{N}+"

_NOT_ASCII = r"[^\x00-\x7F]"


def byte_alphabet():
    """Printable stand-in of each byte 0..255: itself if visible, else code points from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


BYTE_ALPHABET = byte_alphabet()
_MOVED = [b for b in range(256) if BYTE_ALPHABET[b] != chr(b)]


def _normalized(strings):
    """Decompose, lowercase, drop marks: three vectorised passes over an Arrow array."""
    import pyarrow.compute as pc
    lowered = pc.utf8_lower(pc.utf8_normalize(strings, "NFD"))
    return pc.replace_substring_regex(lowered, r"\pM+", "")


@F.arrow_udf(T.StringType())
def _normalize(texts):
    return _normalized(texts)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _normalize_each(lists):
    import pyarrow as pa
    parts = _normalized(lists.flatten())
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(offsets), parts, mask=lists.is_null())


def normalize_text(text):
    """NFD, lowercase, no marks. Only rows with other than ASCII characters leave the JVM."""
    wide = text.rlike(_NOT_ASCII)
    return F.when(wide, _normalize(F.when(wide, text))).otherwise(F.lower(text))


def normalize_segments(text, segments):
    """The same for an array of parts of `text`."""
    wide = text.rlike(_NOT_ASCII)
    return F.when(wide, _normalize_each(F.when(wide, segments))).otherwise(
        F.transform(segments, F.lower))


def raw_words(normalized):
    """Words of normalised text; a space is put in front unless there is one."""
    start = F.when((F.length(normalized) > 0) & ~F.startswith(normalized, F.lit(" ")),
                   F.concat(F.lit(" "), normalized)).otherwise(normalized)
    return F.regexp_extract_all(start, F.lit(WORD_PATTERN), F.lit(0))


def to_byte_symbols(word):
    """UTF-8 bytes of a word, one printable character each."""
    latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, "".join(map(chr, _MOVED)),
                       "".join(BYTE_ALPHABET[b] for b in _MOVED))


def byte_pieces(word):
    """The pretokens of one raw word: byte symbols with every numeric one on its own."""
    # Visible ASCII without digits, the bulk of the words, changes in its space only.
    usual = F.array(F.replace(word, F.lit(" "), F.lit(BYTE_ALPHABET[32])))
    split = F.regexp_extract_all(to_byte_symbols(word), F.lit(DIGIT_PATTERN), F.lit(0))
    return F.when(word.rlike(r"\A ?[!-/:-~]+\z"), usual).otherwise(split)


def pretokenize(text):
    """Pretokens of raw text, in order."""
    return F.flatten(F.transform(raw_words(normalize_text(text)), byte_pieces))
