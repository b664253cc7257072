"""Parity with the public `tokenizers` library, and rules it rarely meets."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusprep.constants import SPECIAL_TOKENS
from corpusprep.functions.chars import char_vocab
from corpusprep.functions.text import normalize_text, pretokenize
from corpusprep.operators import bpe
from corpusprep.operators.examples import training_examples
from corpusprep.sources.vocab import load_model, save_vocab

tokenizers = pytest.importorskip("tokenizers")

HARD = ["", "é ÿ Ā", "漢字 😀", "<user>a<USER>b</user>", "x² ½ 3¼ вгд АБВ", "ΑΣ ς Σας", "İstanbul",
        "١٢٣ ①②", "two  spaces\n\nit's  we'LL\t\t", "a b c ", "한국어 각", "ẹ́ q҈",
        "foo<eos><pad> <bos>", " lead", "x\u0085y z", "<user>", "<assistant>yes<system>", "�\x00\x7f"]


def library(texts, size):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers, trainers
    made = Tokenizer(models.BPE(unk_token="<unk>"))
    made.normalizer = normalizers.Sequence(
        [normalizers.NFD(), normalizers.Lowercase(), normalizers.StripAccents()])
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.ByteLevel(), pre_tokenizers.Digits(individual_digits=True)])
    made.train_from_iterator(texts, trainers.BpeTrainer(
        vocab_size=size, special_tokens=SPECIAL_TOKENS, min_frequency=2, show_progress=False))
    return made


def by_id(made):
    return [t for t, _ in sorted(made.get_vocab().items(), key=lambda x: x[1])]


def texts_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, text string")


@pytest.fixture(scope="module")
def trained(spark, given):
    messages = given.select(F.concat(F.lit("<"), "role", F.lit(">"), "text").alias("text"))
    texts = [r.text for r in messages.collect()]
    return texts, bpe.train_bpe(bpe.word_counts(messages), 384), library(texts, 384)


def test_vocabulary_matches(trained):
    _, model, made = trained
    assert model.tokens == by_id(made)


def test_encoding_matches(spark, trained):
    texts, model, made = trained
    df = texts_of(spark, texts + HARD)
    coded = bpe.bpe_encode(df, F.col("text"), model)
    got = {r.i: r for r in coded.select(
        "i", "ids", bpe.bpe_decode(spark, F.col("ids"), model).alias("joined"),
        bpe.bpe_decode(spark, F.col("ids"), model, "bytes").alias("exact")).collect()}
    for i, text in enumerate(texts + HARD):
        assert got[i].ids == made.encode(text).ids, text
        assert got[i].joined == made.decode(got[i].ids), text
    tag = len("<user>")
    assert got[0].exact.startswith(" ") and texts[0][tag:tag + 3].lower() in got[0].exact


def test_normalisation_and_pretokens_match(spark, trained):
    texts, _, made = trained
    df = texts_of(spark, texts + HARD)
    for r in df.select("text", normalize_text(F.col("text")).alias("n"),
                       pretokenize(F.col("text")).alias("p")).collect():
        normal = made.normalizer.normalize_str(r.text)
        assert r.n == normal
        assert r.p == [w for w, _ in made.pre_tokenizer.pre_tokenize_str(normal)]


@pytest.mark.parametrize("texts, size", [
    (["aaaa aaaa aaa aa"], 40), (["ab ab cd cd ef ef"], 40), (["x"], 40),
    (["abab abab cabab"] * 3, 60), (["the cat the hat that hat"] * 2, 30)])
def test_small_corpora(spark, texts, size):
    counts = bpe.word_counts(texts_of(spark, texts))
    assert bpe.train_bpe(counts, size).tokens == by_id(library(texts, size))


def test_pair_index_gives_the_same(spark, monkeypatch):
    """The path of large tables: words found by pair, changes in layers, renewed now and then."""
    monkeypatch.setattr(bpe, "_SMALL", 0)
    monkeypatch.setattr(bpe, "_RARE", 0)
    monkeypatch.setattr(bpe, "_LAYERS", 3)
    texts = ["the cat the hat that hat cats hats", "abab abab cabab cab", "mississippi missing kiss"] * 2
    counts = bpe.word_counts(texts_of(spark, texts))
    assert bpe.train_bpe(counts, 45).tokens == by_id(library(texts, 45))


def _one_at_a_time(counts, size):
    """Plain training: the most frequent pair, ties to the smallest ids."""
    tokens = SPECIAL_TOKENS + sorted({c for w, _ in counts for c in w})
    words, merges = [([tokens.index(c) for c in w], n) for w, n in counts], []
    while len(tokens) < size:
        pairs = Counter()
        for w, n in words:
            for pair in zip(w, w[1:]):
                pairs[pair] += n
        best = min(pairs, key=lambda p: (-pairs[p], p), default=None)
        if best is None or pairs[best] < 2:
            break
        name = tokens[best[0]] + tokens[best[1]]
        if name not in tokens:
            tokens.append(name)
        merges.append((*best, tokens.index(name)))
        for w, _ in words:
            at = 0
            while at < len(w) - 1:
                if (w[at], w[at + 1]) == best:
                    w[at:at + 2] = [merges[-1][2]]
                at += 1
    return tokens, merges


@pytest.mark.parametrize("known", [0, 3, 1 << 15])
def test_passes_are_few_and_exact(spark, monkeypatch, known):
    """Proposals from few words, or none, may be wrong; the merges never are. Each pass over the words
    takes many of them: before, there was about one for eight."""
    made = random.Random(5)
    counts = {"".join(made.choices("abcdé", [9, 7, 5, 2, 1], k=made.randint(1, 9))): made.randint(1, 60)
              for _ in range(400)} | {"a" * 301: 3}
    passes, changes = [], bpe._changes
    monkeypatch.setattr(bpe, "_KNOWN", known)
    monkeypatch.setattr(bpe, "_changes", lambda *a: passes.append(a) or changes(*a))
    model = bpe.train_bpe(spark.createDataFrame(list(counts.items()), "word string, n long"), 150)
    assert (model.tokens, model.merges) == _one_at_a_time(counts.items(), 150)
    assert 2 <= len(passes) <= 3 + (20 if known < len(counts) else 0)


def test_skipped_pairs():
    # (8, 9) loses to (7, 8) and is passed over; (9, 4) would take from it in turn.
    leaders = [(7, 8, 50), (8, 9, 40), (5, 6, 30), (9, 4, 20), (1, 2, 10)]
    assert bpe._independent(leaders, 9) == ([(7, 8, 50, 0), (5, 6, 30, 1)], [(8, 9)])
    assert bpe._independent(leaders, 1) == ([(7, 8, 50, 0)], [])


def test_two_spellings_of_one_token(spark):
    """`abc` is first built as ab+c; a+bc later reuses its id."""
    counts = spark.createDataFrame(
        [("abc", 9), ("ab", 5), ("xbc", 8), ("bc", 3)], "word string, n long")
    model = bpe.train_bpe(counts, 60)
    assert len(set(model.tokens)) == len(model.tokens)
    assert [m for m in model.merges if model.tokens[m[2]] == "abc"]


def test_rounds_accept_only_certain_merges():
    leaders = [(7, 8, 100), (9, 10, 90), (8, 9, 50), (11, 12, 40)]
    assert bpe._mergeable(leaders, True, 9) == [(7, 8), (9, 10)]
    assert bpe._mergeable(leaders, True, 1) == [(7, 8)]
    assert bpe._mergeable([(7, 7, 9), (8, 9, 8)], True, 9) == [(7, 7)]
    # The next count could be that of a new pair.
    assert bpe._mergeable([(7, 8, 100), (6, 7, 95), (9, 10, 94)], True, 9) == [(7, 8)]


def test_examples_from_bpe(spark, given, trained):
    _, model, made = trained
    got = {r.conv_id: r for r in training_examples(
        given, bpe.BpeTokenizer(model), 64).collect()}
    for conv_id, row in got.items():
        said = given.filter(F.col("conv_id") == conv_id).orderBy("turn").collect()
        ids, labels = [2], [-100]
        for t in said:
            piece = made.encode(f"<{t.role}>{t.text}").ids
            ids += piece
            labels += piece if t.role == "assistant" else [-100] * len(piece)
        assert row.input_ids == (ids + [3])[-64:][:-1]
        assert row.targets == (labels + [3])[-64:][1:]
        if conv_id > 3:
            break


def test_growth(spark):
    vocab = char_vocab(spark)
    wanted = spark.createDataFrame(
        [("foo", 0), ("<user>", 1), ("bar", 2), ("foo", 3), ("", 4)], "token string, at long")
    assert bpe.expansion_count(vocab, wanted).first().added == 3
    grown = bpe.expand_vocab(vocab, wanted)
    assert {r.token: r.id for r in grown.filter("id > 262").collect()} == {"foo": 263, "bar": 264}
    assert bpe.vocab_size(grown).first()["size"] == 265
    assert bpe.vocab_size(vocab.limit(0)).first()["size"] == 0


def test_model_files(spark, trained, tmp_path):
    model = trained[1]
    vocab, merges = model.frames(spark)
    save_vocab(vocab, str(tmp_path / "m"), merges)
    assert load_model(spark, str(tmp_path / "m")) == model
    assert model.special_id("<eos>") == 3 and model.special_id("nothing") is None


def test_long_word_takes_no_quadratic_time():
    import random
    import time
    draw = random.Random(1)
    tokens = [*SPECIAL_TOKENS, *"abcd"]
    merges = []
    for _ in range(60):
        a, b = draw.randrange(7, len(tokens)), draw.randrange(7, len(tokens))
        if tokens[a] + tokens[b] not in tokens:
            merges.append((a, b, len(tokens)))
            tokens.append(tokens[a] + tokens[b])
    encoder = bpe._Encoder(tokens, merges)

    def slow(symbols):
        ids = [encoder.ids[s] for s in symbols]
        while True:
            ranked = [(encoder.ranks[p], at) for at, p in enumerate(zip(ids, ids[1:]))
                      if p in encoder.ranks]
            if not ranked:
                return ids
            (_, new), at = min(ranked)
            ids[at:at + 2] = [new]
    for n in (0, 1, 2, 3, 10, 200):
        for _ in range(20):
            word = [draw.choice("abcd") for _ in range(n)]
            assert encoder._merge(word) == slow(word)
    start = time.time()
    encoder._merge([draw.choice("abcd") for _ in range(100_000)])
    assert time.time() - start < 2


def test_all_bytes_alphabet_and_special_ids(spark):
    counts = spark.createDataFrame([("ab", 3), ("abc", 2)], "word string, n long")
    model = bpe.train_bpe(counts, 265, all_bytes=True)
    assert len(model.tokens) == 265 and model.tokens[7:263] == sorted(bpe.BYTE_ALPHABET)
    assert model.tokens[263:] == ["ab", "abc"]
    names = spark.createDataFrame([("<eos>",), ("ab",), (None,), ("<pad>",)], "name string")
    assert [r[0] for r in names.select(bpe.special_id(F.col("name"), model)).collect()] == [
        3, None, None, 0]
