"""What the operators ask of a tokenizer."""

from typing import Protocol

from pyspark.sql import Column, DataFrame


class Tokenizer(Protocol):
    """Implemented by `chars.CharTokenizer` and `bpe.BpeTokenizer`; any other class may be passed.

    Token counts of message segments have to add up to the count of their concatenation.
    """

    pad_id: int
    unk_id: int
    bos_id: int
    eos_id: int
    stop_ids: tuple
    tag_tokens: int
    """Tokens of a bare `<assistant>` tag."""

    def prepare(self, df: DataFrame, text: Column, keep_last: int | None = None) -> DataFrame:
        """Add `n_tokens` and a `payload`, the payload cut to its last `keep_last` tokens."""

    def ids(self, payload: Column) -> Column:
        """Ids of a payload, as an array."""
