"""Words of whole Arrow text columns as 64-bit hashes, in numpy.

Words are runs of bytes other than space and U+0009 to U+000D (all single bytes in UTF-8, so
bytes are safe to cut at). A word's hash is a polynomial over random per-byte values, mixed.
"""

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: The same with every ASCII sign that is neither letter nor digit as a word break too.
PUNCTUATION = _SPACE.copy()
PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
#: Bytes worked on at a time; a piece grows beyond it only to end at a word's end.
PIECE = 1 << 21


def mix(x):
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def texts(column):
    """Bytes and row offsets of a string or binary Arrow array; nulls are empty."""
    import pyarrow as pa
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type)
                                  or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def _edges(data, offsets, breaks):
    """First byte and end of every word of `data`, never across a row's end."""
    word = ~breaks[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = word[cuts]
    last[cuts - 1] = word[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hashes(data, first, end):
    size = end - first
    if not len(first):
        return np.zeros(0, np.uint64)
    powers = np.full(int(size.max()), _BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    inside = np.arange(int(size.sum())) - np.repeat(starts, size)
    value = _VALUE[data[inside + np.repeat(first, size)]] * powers[inside]
    return mix(np.add.reduceat(value, starts) + size.astype(np.uint64) * _STEP)


def hashed_words(data, offsets, lower=True, breaks=_SPACE):
    """Word hashes of all rows, one after another, and each row's first word (n + 1 numbers)."""
    found, counts, at, row = [], np.zeros(len(offsets) - 1, dtype=np.int64), 0, 0
    if lower:
        data = _LOWER[data]
    while at < len(data):
        upto = min(at + PIECE, len(data))
        if upto < len(data):
            # End at a row's end or at white space, whichever comes last inside the piece.
            k = int(np.searchsorted(offsets, upto, "right")) - 1
            cut = int(offsets[k]) if offsets[k] > at else 0
            space = np.flatnonzero(breaks[data[at:upto]])
            cut = max(cut, at + int(space[-1]) + 1 if len(space) else 0)
            if not cut:
                rest = np.flatnonzero(breaks[data[upto:offsets[k + 1]]])
                cut = upto + int(rest[0]) if len(rest) else int(offsets[k + 1])
            upto = cut
        low = max(int(np.searchsorted(offsets, at, "right")) - 1, 0)
        high = int(np.searchsorted(offsets, upto, "left"))
        inner = np.clip(offsets[low:high + 1], at, upto) - at
        part = data[at:upto]
        first, end = _edges(part, inner, breaks)
        found.append(_hashes(part, first, end))
        where = np.searchsorted(first, inner)
        counts[low:low + len(inner) - 1] += np.diff(where)
        at, row = upto, high
    heads = np.concatenate([[0], np.cumsum(counts)])
    return np.concatenate(found) if found else np.zeros(0, np.uint64), heads


def shingles(words, heads, n):
    """Sorted distinct n-word shingle hashes of every row: `(hashes, heads)`.

    A row with fewer words is one shingle of all of them; a row without words has none.
    """
    size = np.diff(heads)
    rows = np.repeat(np.arange(len(size)), size)
    value = words.copy()
    for k in range(1, n):
        # The k-th word after each; rows that are too short stop contributing at their end.
        ahead = np.zeros_like(words)
        ahead[:max(len(words) - k, 0)] = words[k:]
        inside = np.arange(len(words)) + k < heads[1:][rows]
        value = np.where(inside, mix(value * _BASE + np.uint64(k)) + ahead, value)
    place = np.arange(len(words)) - heads[:-1][rows]
    keep = place <= np.maximum(size[rows] - n, 0)
    value, rows = mix(value[keep] + np.minimum(size[rows[keep]], n).astype(np.uint64)), rows[keep]
    order = np.lexsort((value, rows))
    value, rows = value[order], rows[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    value, rows = value[new], rows[new]
    return value, np.searchsorted(rows, np.arange(len(size) + 1))


def slices(batch, text_at, limit=PIECE):
    """Cut an Arrow batch into runs of rows of about `limit` bytes of text (at least one row)."""
    data, offsets = texts(batch.column(text_at))
    row = 0
    while row < batch.num_rows:
        end = max(int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1, row + 1)
        end = min(end, batch.num_rows)
        yield batch.slice(row, end - row)
        row = end
