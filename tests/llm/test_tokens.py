"""Word-level reuse of the tokenizer, the token file and packing."""

import itertools

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusprep.llm import packing, token_file
from corpusprep.llm.token_ids import WordIds
from corpusprep.plans.lineage import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
KNOWN = WordIds(PATH)


def library(text):
    return np.array(KNOWN.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aB1'st reéÉß_-.,!?\t\n\x0b\x1c\x85\xa0İΣσ<|>́½²"),
                                  st.characters()), max_size=40))
def test_ids_are_the_library_s(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    assert KNOWN.encode(text) == library(text)


@pytest.mark.parametrize("text", ["", "<|endoftext|> x", "It's  WE'LL 12,5", "ΑΣ ΑΣ.", "a\x1cb",
                                  "x" * 3000, "Å Å", "don't\xa0go", "ŉ ŀ İ I"])
def test_hard_texts(text):
    assert KNOWN.encode(text) == library(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=700), st.integers(1, 40))
def test_coder_round_trip(ids, lanes):
    ids = np.array(ids, "<u4")
    freq = token_file.scaled(np.bincount(ids, minlength=301) if len(ids) else np.ones(301))
    coder = token_file.Coder(freq, lanes=lanes)
    assert (coder.unpack(coder.pack(ids)) == ids).all()


def test_sections_and_damage():
    ids = np.random.default_rng(0).zipf(1.5, 600_000).clip(0, 5000).astype("<u4")
    coder = token_file.Coder(token_file.scaled(np.bincount(ids)))
    payload = coder.pack(ids)
    assert (coder.unpack(payload) == ids).all()
    p = np.bincount(ids) / len(ids)
    p = p[p > 0]
    assert len(payload) * 8 < 1.1 * len(ids) * -(p * np.log2(p)).sum()
    with pytest.raises(ValueError):
        coder.unpack(payload[:-1] + bytes([payload[-1] ^ 1]))


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, start int, ids string")


def test_file_edges(spark):
    rows = [(5, "hello world", 1, "x"), (None, "null id", 1, "x"), (2, None, 1, "x"),
            (7, "", 1, "x"), (5, "hello again", 1, "x"), (9, "word " * 50_000, 1, "x")]
    for given_rows in (rows, []):
        path = scratch_path(spark, "file")
        token_file.write_token_file(docs(spark, given_rows), path, PATH, 2)
        got = token_file.read_token_file(spark, path).orderBy("start").collect()
        ordered = sorted(given_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        want = [np.frombuffer(library(t or ""), "<u2").tolist() + [2] for _, t, *_ in ordered]
        assert [r["ids"] for r in got] == want
        assert [r.doc_id for r in got] == [r[0] for r in ordered]
        assert [r.start for r in got] == list(
            itertools.accumulate([0, *map(len, want)]))[:len(want)]


def fewest(lengths, capacity):
    """Fewest bins by trying all assignments."""
    def fits(bins, rest):
        if not rest:
            return True
        tried = set()
        for k, b in enumerate(bins):
            if b >= rest[0] and b not in tried:
                tried.add(b)
                if fits(bins[:k] + [b - rest[0]] + bins[k + 1:], rest[1:]):
                    return True
        return False
    lengths = sorted(lengths, reverse=True)
    n = -(-sum(lengths) // capacity)
    while not fits([capacity] * n, lengths):
        n += 1
    return n


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=11))
def test_plan_is_best_on_small_inputs(lengths):
    counts = np.bincount(lengths, minlength=31) if lengths else np.zeros(31)
    steps = packing.plan(counts, 30)
    used = np.zeros(31, dtype=int)
    for times, filling in steps:
        assert sum(x * n for x, n in filling) <= 30
        for x, n in filling:
            used[x] += times * n
    assert (used == counts).all()
    assert sum(t for t, _ in steps) == fewest(lengths, 30)


def test_packing_edges(spark):
    assert packing.pack(docs(spark, []), PATH, 0).count() == 0
    rows = [(1, None, 1, ""), (None, "a b", 1, ""), (2, "word " * 5000, 1, ""),
            (3, "same text", 1, ""), (3, "same text", 1, ""), (4, "", 1, "")]
    got = packing.pack(docs(spark, rows), PATH, 0, capacity=64).collect()
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.length for r in got) == sum(
        len(library(t or "")) // 2 + 1 for _, t, *_ in rows)
    assert len([r for r in got if r.doc_id == 3]) == 2


def test_frequent_length_is_numbered_in_cells(spark):
    pieces = spark.range(1000).selectExpr(
        "id as doc_id", "0 as piece", "0L as start", "if(id % 10 = 0, 5L, 7L) as length",
        "0L as ids_crc32")
    found = packing.ranked(pieces, cell=50).groupBy("length").agg({"rank": "collect_list"}).collect()
    for r in found:
        assert sorted(r[1]) == list(range(len(r[1])))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=10))
def test_bound_is_never_too_high(lengths):
    counts = np.bincount(lengths, minlength=31) if lengths else np.zeros(31, dtype=int)
    assert packing.fewest(counts, 30) <= fewest(lengths, 30)


def test_bound_ends_the_search_for_large_pieces():
    rng = np.random.default_rng(0)
    for length, many, want in ((700, 12_000, 6000), (300, 26_000, 4334)):
        counts = np.zeros(2049, dtype=int)
        np.add.at(counts, rng.integers(length - 5, length + 5, many) if length == 300
                  else np.full(many, length), 1)
        np.add.at(counts, rng.integers(5, 80, 3000), 1)
        assert packing.fewest(counts, 2048) == want
        steps = packing.plan(counts, 2048, nodes=0)
        assert sum(t for t, _ in steps) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=12), st.integers(1, 60))
def test_fullest_filling(lengths, room):
    counts = np.bincount(lengths, minlength=31) if lengths else np.zeros(31, dtype=int)
    waste, chosen = packing._exact(counts, room)
    assert room - sum(x * n for x, n in chosen) == waste
    assert all(n <= counts[x] for x, n in chosen)
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums if s + x <= room}
    assert room - waste == max(sums)


def test_words_are_forgotten_and_learnt_again(monkeypatch):
    from corpusprep.llm import token_ids
    monkeypatch.setattr(token_ids, "REMEMBERED", 12)
    monkeypatch.setattr(token_ids, "TOGETHER", 3)
    monkeypatch.setattr(token_ids, "CHARACTERS", 60)
    made = token_ids.WordIds(PATH)
    texts = [" ".join(f"Word{(k * j) % 40}x" for j in range(9)) for k in range(30)]
    texts += ["a" * 100, "bc d " * 80, None, "", "\n", "x  日本 y", "soft\xadhyphen \xad \xad a"]
    assert list(made.encode_all(texts)) == [library(t or "") for t in texts]
    assert [made.encode(t) for t in texts] == [library(t or "") for t in texts]


def test_signs_after_letters_are_not_new_words(monkeypatch):
    from corpusprep.llm import token_ids
    made = token_ids.WordIds(PATH)
    texts = ["Tree tree. tree, tree?! it's it's. 'tree' 12. a1. tree'", "tree… tree; _tree_ x"]
    assert list(made.encode_all(texts)) == list(map(library, texts))
    assert {"tree", ".", ",", "?!", "it's"} <= set(made)
    assert not {"tree.", "tree,", "tree?!", "tree'", "tree…"} & set(made)


def test_long_text_after_another(monkeypatch):
    from corpusprep.llm import token_ids
    monkeypatch.setattr(token_ids, "CHARACTERS", 40)
    texts = ["short one", "a long text of many words, " * 20, None, "日 x", "end. of it"]
    assert list(token_ids.WordIds(PATH).encode_all(texts)) == [library(t or "") for t in texts]


def test_plain_characters_split_and_lower_as_in_python():
    import re

    import pyarrow as pa
    import pyarrow.compute as pc
    from corpusprep.llm import token_ids
    plain = [c for c in map(chr, range(0xd800)) if not re.search(token_ids._WHOLE, c)]
    assert len(plain) > 300
    assert pc.utf8_lower(pa.array(plain)).to_pylist() == [c.lower() for c in plain]
    assert pc.utf8_is_alpha(pa.array(plain)).to_pylist() == [c.isalpha() for c in plain]
    apart = [f"a{c}b" for c in plain]
    assert pc.utf8_split_whitespace(pa.array(apart)).to_pylist() == [t.split() for t in apart]
