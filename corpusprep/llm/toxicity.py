"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams (hashed into a fixed table), a text the
mean of its words (and of a few blank ones, so that a handful of words can't shout), and a linear
softmax over two classes reads the text's vector. Table and softmax are trained together in numpy, by
small batches with Adam, on a bounded sample of labelled texts, in one Spark task; an empty text of
the clean class is in every batch, so that the intercept is what blank words deserve. Since everything
after the table is linear, a word adds one number to a text's logit; scoring computes that number
once per distinct word of a worker, n-grams of unseen spellings included, and averages it over the
whole text.
"""

import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import parts, stored
from corpusprep.llm.words import mix

#: Toxic and clean texts that the model is fitted on at most, by smallest hash of their id.
SAMPLE = (2500, 7500)
#: Bytes of text of each class that the model is fitted on at most, in the same order.
SAMPLE_BYTES = 24 << 20
BUCKETS = 1 << 17
DIMENSIONS = 2
BLANK = 20
#: Weight of the empty text in a batch, in average texts.
EMPTY = 2
SCALE = np.float32(30)
SHORTEST, LONGEST = 3, 5
#: At least so many passes over the sample, and so many steps of small batches.
EPOCHS, STEPS, BATCH = 8, 800, 64
REMEMBERED = 500_000
#: Words whose n-grams are made together; it bounds a worker's memory.
TOGETHER = 1 << 14
_WORD = re.compile(r"\w+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text):
    return _WORD.findall(text.lower()) if text else []


def subwords(words, buckets=BUCKETS):
    """`(rows, heads)`: table rows of every word's n-grams, one word after another.

    N-grams are taken inside `<word>`; a word shorter than the shortest n-gram is one n-gram.
    """
    rows, size = [], [np.zeros(1, np.int64)]
    for at in range(0, len(words), TOGETHER):
        found, many = _subwords(words[at:at + TOGETHER], buckets)
        rows.append(found)
        size.append(many)
    return np.concatenate(rows or [np.zeros(0, np.int32)]), np.cumsum(np.concatenate(size))


def _subwords(words, buckets):
    marked = [f"<{w}>" for w in words]
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(
        np.uint64)
    size = np.array([len(w) for w in marked], dtype=np.int64)
    word = np.repeat(np.arange(len(words), dtype=np.int32), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(chars))
    found, owners, value = [], [], np.zeros(len(chars), dtype=np.uint64)
    for n in range(1, LONGEST + 1):
        ahead = np.zeros_like(chars)
        ahead[:max(len(chars) - n + 1, 0)] = chars[n - 1:]
        value = mix(value * _STEP + ahead + np.uint64(1))
        if n >= SHORTEST:
            fits = left >= n
            found.append((value[fits] % np.uint64(buckets)).astype(np.int32))
            owners.append(word[fits])
    rows, owners = np.concatenate(found), np.concatenate(owners)
    return rows[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))


def _bag(words, rows, heads):
    """Distinct table rows of a text given as word numbers, with their weights in its mean."""
    words, count = np.unique(words, return_counts=True)
    size = heads[words + 1] - heads[words]
    at = np.repeat(heads[words] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    weight = np.repeat(count / (count.sum() + BLANK) / size, size)
    found, where = np.unique(rows[at], return_inverse=True)
    return found, np.bincount(where, weight).astype(np.float32)


def fit(texts, labels, weights, rate=0.05):
    """Embeddings and softmax trained jointly; deterministic.

    `texts` may be any iterable, read once before `labels` are. `weights` by class undo the sampling. Returns
    `(table, intercept)`: a word's number is the mean of its n-grams' table entries, each the
    difference of the classes' logits.
    """
    # Numbers take the place of words at once, so that no text is held as a list of words.
    vocabulary = {}
    numbered = [np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)),
                            np.int32) for t in texts]
    keep = [k for k, b in enumerate(numbered) if len(b)]
    if not keep:
        return np.zeros(1, np.float32), -20.0
    rows, heads = subwords(list(vocabulary))
    del vocabulary
    bags = [_bag(numbered[k], rows, heads) for k in keep]
    labels = np.asarray(labels)[keep]
    target = np.eye(2, dtype=np.float32)[labels]
    weight = np.array([weights[0], weights[1]], dtype=np.float32)[labels]
    weight /= weight.mean()
    rng = np.random.default_rng(0)
    table = rng.normal(0, 0.001, (BUCKETS, DIMENSIONS)).astype(np.float32)
    soft = (rng.normal(0.5, 0.1, (DIMENSIONS, 1)) * [[-1, 1]]).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    params = [table, soft, bias]
    first, second = ([np.zeros_like(p) for p in params] for _ in "ab")
    batches = -(-len(bags) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // batches))
    steps, t = epochs * batches, 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for start in range(0, len(bags), BATCH):
            chosen = order[start:start + BATCH]
            row = np.concatenate([bags[k][0] for k in chosen])
            share = np.concatenate([bags[k][1] for k in chosen])
            size = np.array([len(bags[k][0]) for k in chosen])
            owner = np.repeat(np.arange(len(chosen)), size)
            text = np.add.reduceat(table[row] * share[:, None], np.cumsum(size) - size, axis=0)
            logit = SCALE * text @ soft + bias
            chance = np.exp(logit - logit.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            slope = (chance - target[chosen]) * weight[chosen, None] / len(chosen)
            # The empty text is nothing but blanks, and clean.
            blank = 1 / (1 + np.exp(bias[0] - bias[1])) / len(chosen) * EMPTY
            pull = SCALE * slope @ soft.T
            slopes = [np.stack([np.bincount(row, pull[:, d][owner] * share, BUCKETS)
                                for d in range(DIMENSIONS)], axis=1), SCALE * text.T @ slope,
                      slope.sum(axis=0) + np.array([-blank, blank], dtype=np.float32)]
            t += 1
            for p, g, m, v in zip(params, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                # The floor keeps n-grams with hardly any slope from moving like the others.
                size_of = np.sqrt(v / (1 - 0.99**t))
                size_of += 0.003 * size_of.max() + 1e-12
                p -= rate * (1 - t / steps) * (m / (1 - 0.9**t)) / size_of
    return SCALE * (table @ (soft[:, 1] - soft[:, 0])), float(bias[1] - bias[0])


class Scorer(dict):
    """Numbers of words, made for a batch of new words at a time."""

    def __init__(self, table, intercept):
        super().__init__()
        self.table, self.intercept = table, intercept

    def scores(self, texts):
        bags = [words_of(t) for t in texts]
        new = list({w for b in bags for w in b}.difference(self))
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list({w for b in bags for w in b})
        for at in range(0, len(new), TOGETHER):
            some = new[at:at + TOGETHER]
            rows, heads = subwords(some, len(self.table))
            self.update(zip(some, (np.add.reduceat(self.table[rows].astype(np.float64), heads[:-1])
                                   / np.diff(heads)).tolist()))
        get = self.__getitem__
        logit = np.array([sum(map(get, b)) / (len(b) + BLANK) for b in bags]) + self.intercept
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500))), np.array(
            [len(b) for b in bags], dtype=np.int64)


def train(docs, labels, sample=SAMPLE, limit=SAMPLE_BYTES):
    """Model from `docs(doc_id, text)` and `labels(doc_id, toxic)`: `(table, intercept)`.

    Rows that are held out, or whose label is neither 0 nor 1, are left out. Of the others at most
    `sample` (toxic, clean) ids are read, those that hash lowest, and of each class texts of `limit`
    bytes (one at least); only their texts leave the scan.
    Without texts of both classes the model scores every text alike.
    """
    ids = labels.select("doc_id", F.col("toxic").alias("label")).filter(
        F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    counts = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return np.zeros(1, np.float32), 20.0 if counts.get(1) else -20.0
    hashed = F.xxhash64(F.lit("sample"), "doc_id")
    most = {1: sample[0], 0: sample[1]}
    chosen = stored(ids.filter("label = 0").orderBy(hashed, "doc_id").limit(most[0]).union(
        ids.filter("label = 1").orderBy(hashed, "doc_id").limit(most[1])), "toxic-sample")
    # As many ids as the sample has at most.
    texts = docs.filter("text is not null").select("doc_id", "text").join(
        F.broadcast(chosen), "doc_id")
    share = {k: max(1.0, counts[k] / most[k]) for k in (0, 1)}

    def run(frames):
        # Texts come by the order of the sample and are read one by one, up to the bound.
        taken, left = [], {0: limit, 1: limit}

        def rows():
            for frame in frames:
                for text, label in zip(frame["text"], frame["label"].astype(int)):
                    size = len(text.encode())
                    if left[label] < limit and size > left[label]:
                        left[label] = -1
                        continue
                    left[label] -= size
                    taken.append(label)
                    yield text

        import pandas as pd
        # The weights follow the labels, which are complete once the texts are read.
        numbered = rows()
        first = next(numbered, None)
        if first is None:
            return
        table, intercept = fit(itertools.chain([first], numbered), taken, share)
        yield pd.DataFrame({"table": [table.astype("<f4").tobytes()], "intercept": [intercept]})

    made = texts.select("doc_id", "text", "label", hashed.alias("at")).repartition(
        1).sortWithinPartitions("at", "doc_id", "text", "label").mapInPandas(
        run, "table binary, intercept double").first()
    if made is None:
        return np.zeros(1, np.float32), -20.0
    return np.frombuffer(made["table"], "<f4"), made["intercept"]


def score(docs, model):
    """`(row, score, words)`: each row of `docs` as a struct, the score (0 to 1) of its whole text
    and the words in it; a text without words has the intercept's score."""
    made = {}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        if "scorer" not in made:
            made["scorer"] = Scorer(*shared.value)
        # A batch is scored and handed on in parts: only a part's texts are Python's.
        for batch in batches:
            column = pc.struct_field(batch.column(0), "text")
            for first, rows in parts(column):
                scores, words = made["scorer"].scores(column.slice(first, rows).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(scores), pa.array(words)],
                    ["row", "score", "words"])

    kinds = T.StructType([T.StructField("row", docs.schema), T.StructField(
        "score", T.DoubleType()), T.StructField("words", T.LongType())])
    return docs.select(F.struct(*docs.columns).alias("row")).mapInArrow(run, kinds)


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 0


def toxicity(docs, labels, sample=SAMPLE):
    """`(doc_id, held_out, score, predicted)` for every row of `docs(doc_id, text)`.

    Null and empty texts, and texts without words, have the score of nothing but blanks, below one
    half. Null and repeated doc_ids are rows like others. Other columns are not read.
    """
    model = train(docs, labels, sample)
    return score(docs.select("doc_id", "text"), model).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs, labels, sample=SAMPLE):
    """Rows of `docs` that score below one half, and all without words, columns unchanged."""
    model = train(docs, labels, sample)
    return score(docs, model).filter("score < 0.5 or words = 0").select("row.*")
