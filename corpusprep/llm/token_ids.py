"""Token ids of whole texts by a public tokenizer, with word-level reuse.

Every alternative of the tokenizer's splitting pattern stays inside a run of characters that are
not white space, and its normaliser works character by character on the plain letters accepted
below. So a text made of such characters has the ids of its white-space separated words, in
order. Arrow splits a run of texts and names its distinct words; a word of letters and signs after
them has the ids of the letters, then of the signs, since the pattern takes letters in one piece. New
words are encoded together by the library, and remembered by the worker. Words of letters are told
apart by the ids that end a word, others by a mark between them. Every other text is encoded whole.
"""

import os
import re
import sys
import types
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept per worker; when full the older half goes (results do not depend on it).
REMEMBERED = 700_000
#: Characters of texts whose words are looked up together, and words encoded in one call.
CHARACTERS, TOGETHER = 1 << 21, 20_000
_MARKS = "★♥☆日"
_SPACE = re.compile(r"\s")
#: Signs that end a run of letters and are one piece after it.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡§«¶·»¿–—‘’‚“”„…"
_LETTERS = "".join(filter(str.isalpha, map(chr, range(0x180))))
_WHOLE = "[^\t-\r -~¡-įı-ňŊ-ſ–-„…]|<\\|"


class WordIds(dict):
    """Ids of a lower-case word as little-endian unsigned 16-bit bytes."""

    def __init__(self, path):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 65536:
            raise ValueError("token ids need more than 16 bits")
        # Plain words are normalised already, by str.lower.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        # Ids that are the last of a piece, where the vocabulary tells.
        suffix, self.last = getattr(self.tokenizer.model, "end_of_word_suffix", None), None
        if suffix:
            self.last = np.zeros(1 << 16, dtype=bool)
            self.last[[k for t, k in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        # A sign that no plain word has and that is one id between words: it parts new words.
        self.mark, self.mark_id = next(((c, found[1]) for c in _MARKS if len(found := self._ids(
            f"a {c} a")) == 3 and found == [*self._ids("a"), *self._ids(c), *self._ids("a")]),
            (None, None))

    def _ids(self, text):
        # The fast form leaves out the places of tokens.
        return self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def whole(self, text):
        made = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(made.ids, "<u2").tobytes()

    def learn(self, words):
        """Ids of new words, which are remembered; the older half may be forgotten for them."""
        made, others = {}, words
        if self.last is not None:
            letters, others = [w for w in words if w.isalpha()], [w for w in words if not w.isalpha()]
            for part in _runs(letters):
                ids = np.array(self._ids(" ".join(part)), "<u2")
                ends = 2 * np.flatnonzero(self.last[ids]) + 2
                if len(ends) != len(part):
                    # Some word is several pieces.
                    others += part
                    continue
                ids, ends = ids.tobytes(), ends.tolist()
                made.update(zip(part, (ids[a:b] for a, b in zip([0, *ends], ends))))
        for part in _runs(others):
            if self.mark is None:
                made.update(zip(part, map(self.whole, part)))
                continue
            ids = np.array(self._ids(f" {self.mark} ".join(part)), "<u2")
            marks = 2 * np.flatnonzero(ids == self.mark_id)
            ids = ids.tobytes()
            starts, ends = [0, *(marks + 2).tolist()], [*marks.tolist(), len(ids)]
            made.update(zip(part, (ids[a:b] for a, b in zip(starts, ends, strict=True)),
                            strict=True))
        if len(self) + len(made) > REMEMBERED:
            for old in list(islice(self, len(self) // 2)):
                del self[old]
        self.update(made)
        return made

    def of_words(self, words):
        """Ids of each of some distinct words."""
        found = list(map(self.get, words))
        late = [w for w, ids in zip(words, found) if ids is None]
        if late:
            # Words that begin alike are encoded faster one after another.
            made = self.learn(sorted(late))
            found = [made[w] if ids is None else ids for w, ids in zip(words, found)]
        return found

    def encode_all(self, texts):
        """Ids of each whole text as `<u2` bytes, in order; null is the empty text."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < CHARACTERS:
                size += len(texts[end] or "")
                end += 1
            yield from self._together(texts[at:end])
            at = end

    def _together(self, texts):
        if not texts:
            return
        given = pa.array(texts, pa.string())
        plain = pc.and_(pc.greater(pc.binary_length(given), 0), pc.invert(
            pc.match_substring_regex(given, _WHOLE))).fill_null(False)
        if len(texts) > 1:
            # A long text is worked on in pieces, between two words.
            for k, t in enumerate(texts):
                if t and len(t) > CHARACTERS and plain[k].as_py():
                    yield from self._together(texts[:k])
                    yield b"".join(self.encode_all(_pieces(t)))
                    yield from self._together(texts[k + 1:])
                    return
        elif plain[0].as_py() and len(texts[0]) > CHARACTERS:
            pieces = _pieces(texts[0])
            if len(pieces) > 1:
                yield b"".join(self.encode_all(pieces))
                return
        words = pc.utf8_split_whitespace(pc.utf8_lower(given.filter(plain)))
        named = words.values.dictionary_encode()
        # Every distinct word is two pieces: letters and the signs after them, or itself and nothing.
        word = named.dictionary
        letters = pc.utf8_rtrim(word, _SIGNS)
        parted = pc.utf8_is_alpha(letters)
        letters = pc.if_else(parted, letters, word).dictionary_encode()
        signs = pc.if_else(parted, pc.utf8_ltrim(word, _LETTERS), "").dictionary_encode()
        pieces = self.of_words(_strings(letters.dictionary))
        at = np.stack([letters.indices.to_numpy(), signs.indices.to_numpy() + len(pieces)], axis=1)
        pieces += self.of_words(_strings(signs.dictionary))
        # From the ids of the distinct pieces to those of the distinct words, then of all words.
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) // 2)
        ids, ends = _gathered(np.frombuffer(b"".join(pieces), "<u2"), ends, at.ravel())
        ids, ends = _gathered(ids, ends[1::2], named.indices.to_numpy())
        ids = ids.tobytes()
        ends = iter((2 * np.append(0, ends)[words.offsets.to_numpy()]).tolist())
        start = next(ends)
        for text, known in zip(texts, plain.to_pylist()):
            if known:
                end = next(ends)
                yield ids[start:end]
                start = end
            else:
                yield self.whole(text) if text else b""

    def encode(self, text):
        return next(self.encode_all([text]))


def _runs(words):
    return (words[at:at + TOGETHER] for at in range(0, len(words), TOGETHER))


def _gathered(ids, ends, index):
    """The pieces `index` of `ids`, one after another, and their ends; piece k ends at `ends[k]`."""
    many = np.diff(ends, prepend=0)[index]
    out = np.cumsum(many)
    at = np.repeat(ends[index] - out, many)
    at += np.arange(len(at))
    return ids[at], out


def _strings(array):
    return array.to_numpy(zero_copy_only=False).tolist()


def _pieces(text):
    """Parts of about CHARACTERS / 2 that end with a word."""
    out, at = [], 0
    while at < len(text):
        end = at + CHARACTERS // 2
        space = _SPACE.search(text, end) if end < len(text) else None
        end = space.start() if space else len(text)
        out.append(text[at:end])
        at = end
    return out


def word_ids(path):
    """The worker's tokenizer; kept between tasks, since modules here are sent by value."""
    kept = sys.modules.setdefault("_corpusprep_worker", types.ModuleType("_corpusprep_worker"))
    made = kept.__dict__.setdefault("tokenizers", {})
    if path not in made:
        made[path] = WordIds(path)
    return made[path]
