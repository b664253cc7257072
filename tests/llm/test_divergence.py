"""Source divergence beside a plain computation."""

import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from corpusprep.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, value int, part string"


def brute(rows, least, top):
    rows = [[x or "" for x in r] for r in rows]
    found = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    words = [(found.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t)), lang, s) for t, lang, s in rows]
    documents, counts = Counter(), Counter()
    for w, lang, s in words:
        documents.update((lang, t) for t in set(w))
        counts.update((lang, s, t) for t in w)
    groups = sorted({(lang, s) for _, lang, s in words})
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for at, t in documents if at == lang and documents[at, t] >= least]
        sources = [s for at, s in groups if at == lang]
        whole = {t: sum(counts[lang, s, t] for s in sources) for t in kept}

        def p(table):
            mass = sum(table.values()) + 5 * len(kept)
            return {t: 1 + int(Fraction(10**9 * (table[t] + 5), mass)) for t in kept}

        q, each = p(whole), {s: p({t: counts[lang, s, t] for t in kept}) for s in sources}
        for s in sources:
            pairs = [(sum(abs(each[s][t] - each[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(each[s][t] - q[t], t) for t in kept if counts[lang, s, t] and each[s][t] > q[t]]
            for part, values, most in (("pair", pairs, None), ("term", terms, top)):
                values.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(values[:most])]
    return sorted(out)


def corpus(seed, n=160):
    rng = random.Random(seed)
    words = ["Der", "die", "und", "é", "ÀB", "a-b", "x1y", "ß", "日本", "the", "OF", "zu", "im", "q", "r"]
    rows = []
    for _ in range(n):
        source = rng.choice(["hot"] * 5 + ["a", "b", "ä", None, ""])
        rows.append((" ".join(rng.choices(words, range(1, 16), k=rng.randint(0, 9))),
                     rng.choice(["de", "en", None]), source))
    return rows + [(None, "xx", "lonely"), ("", "xx", "z"), ("only here", "yy", "z")]


@pytest.mark.parametrize("memory,chunk", [(1 << 20, 512), (40, 3)])
def test_equals_brute_force(spark, monkeypatch, memory, chunk):
    monkeypatch.setattr(divergence.Block.run, "__defaults__", (chunk,))
    rows = corpus(memory)
    df = spark.createDataFrame([(k % 7, *r, "x", 1, "y") for k, r in enumerate(rows)], SCHEMA).repartition(5)
    got = divergence.divergence(df, least=6, top=4, memory=memory, shards=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 6, 4)


def test_empty(spark):
    assert divergence.divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_meet_in_term_order():
    blocks = []
    for seed in range(9):
        block, rng = divergence.Block(), random.Random(seed)
        for _ in range(30):
            block.add(rng.choice("xy"), rng.choice("st"), " ".join(rng.choices(list("abcdefghij"), k=5)))
        blocks.append(block)
    chunks = sorted((divergence._row(*part) for b in blocks for part in b.run(1, 2)),
                    key=lambda r: r[:3])
    found = list(divergence.merged(chunks))
    assert [f[:2] for f in found] == sorted({f[:2] for f in found})
    whole, documents = Counter(), Counter()
    for b in blocks:
        for (lang, s), c in b.occurrences.items():
            whole.update({(lang, t, s): n for t, n in c.items()})
        for lang, c in b.documents.items():
            documents.update({(lang, t): n for t, n in c.items()})
    assert {(lang, t, s): n for lang, t, _, posts in found for s, n in posts.items()} == whole
    assert {(lang, t): n for lang, t, n, _ in found} == documents


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 11)
    text = "short words é日本語日本語日本語 and" + "x" * 60 + " 12345678901234567890 End"
    whole = re.findall(rb"[A-Za-z\x80-\xff]+", text.encode().lower())
    assert [t for part in divergence._terms(text) for t in part] == whole


def test_rows_of_a_batch_and_of_its_slices():
    import pyarrow as pa
    rows = [(k, "de", b"a%d" % k, [b"x"] * k, list(range(k)), [k], ["s", "t"][:k], []) for k in range(5)]
    batch = divergence._batch(rows, divergence._RUN_TYPES, divergence._RUN_NAMES)
    assert list(divergence._rows(batch)) == rows
    assert list(divergence._rows(batch.slice(2, 2))) == rows[2:4]
    assert list(divergence._rows(batch.slice(5))) == []
    assert pa.RecordBatch.from_arrays(batch.columns, batch.schema.names).equals(batch)


def test_block_keeps_each_term_s_postings_together():
    block = divergence.Block()
    for source, text in (("s", "B a; B\x00é"), ("t", "b É"), ("s", "A")):
        block.add("de", source, text)
    block.add("en", "s", "b")
    found = {(lang, e[0]): e[1:] for _, lang, entries in block.run(3) for e in entries}
    assert found == {("de", b"a"): (2, [("s", 2)]), ("de", b"b"): (2, [("s", 2), ("t", 1)]),
                     ("de", "é".encode()): (1, [("s", 1)]), ("de", "É".encode()): (1, [("t", 1)]),
                     ("en", b"b"): (1, [("s", 1)])}
