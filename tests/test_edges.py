"""Edge rows per operator, against small brute-force answers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import chars, templates
from corpusprep.functions.vectors import rms_normalize
from corpusprep.operators import batching, candidates, context, examples, metrics, problems, vectors
from corpusprep.plans import skew
from corpusprep.sources.tables import read_instructions, read_jsonl, write_jsonl
from corpusprep.sources.vocab import load_vocab, save_vocab


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").select(
        "y").collect()]


def test_user_content(spark):
    got = column(spark, [None, "", " ", "c"], "string",
                 lambda x: templates.user_content(x, F.lit("q")))
    assert got == ["q", "q", " \n\nq", "c\n\nq"]


def test_clean_response(spark):
    given = ["\n\t a b  \n", "<user>x", "a<eos>b<user>c", "plain", "   "]
    assert column(spark, given, "string", lambda x: templates.clean_response(x, F.lit(3))) == [
        "a b", "", "a", "plain", ""]
    assert column(spark, ["a"], "string", lambda x: templates.clean_response(x, F.lit(0))) == ["..."]


def test_truncate_at_stop(spark):
    given = [[3, 1], [1, 2], [1, 3, 3], [1, 4, 3], list(range(10, 20)), []]
    got = column(spark, given, "array<int>", lambda x: templates.truncate_at_stop(x, (3, 4), 5))
    assert got == [[], [1, 2], [1], [1], [10, 11, 12, 13, 14], []]


def test_defaults_ignore_unknown_names():
    assert templates.override_defaults(top_k=3, colour=1)["top_k"] == 3
    assert "colour" not in templates.override_defaults(colour=1)


def test_chars(spark):
    texts = ["", "é", "ÿ", "Ā", "漢", "😀a", "<user>", "a\x00b"]
    want = [[ord(c) + 7 if ord(c) < 256 else 1 for c in t] for t in texts]
    assert column(spark, texts, "string", chars.char_encode) == want
    back = column(spark, want, "array<int>", chars.char_decode)
    assert back == ["".join(c if ord(c) < 256 else "<unk>" for c in t) for t in texts]
    assert column(spark, [[999, -1, 4]], "array<int>", chars.char_decode) == ["<user>"]
    assert column(spark, ["<eos>", "x"], "string", chars.special_id) == [3, 1]
    assert chars.char_vocab(spark).count() == 263


def brute_example(said, limit):
    ids, labels = [2], [-100]
    for role, text in said:
        piece = [ord(c) + 7 for c in f"<{role}>{text}"]
        ids += piece
        labels += piece if role == "assistant" else [-100] * len(piece)
    ids, labels = (ids + [3])[-limit:], (labels + [3])[-limit:]
    return ids[:-1], labels[1:]


@pytest.mark.parametrize("limit", [1, 2, 3, 21, 22, 23, 40, 1000])
def test_examples(turns, limit):
    said = {1: [("user", "hi"), ("assistant", "yes")], 2: [("system", "s"), ("user", "")],
            3: [("user", "q")], 4: [("assistant", "a" * 50)], 5: [("user", "q" * 500)] * 3}
    got = {r.conv_id: (r.input_ids, r.targets) for r in examples.training_examples(
        turns(said), chars.CharTokenizer(), limit).collect()}
    assert got == {c: brute_example(s, limit) for c, s in said.items()}


def test_batches(spark):
    df = spark.createDataFrame([(i, [1] * n, [2] * n) for i, n in enumerate([3, 1, 2, 5, 4])],
                               "conv_id long, input_ids array<int>, targets array<int>")
    got = {r.conv_id: r for r in batching.batch_and_pad(df, 2).collect()}
    assert [got[i].batch_id for i in range(5)] == [0, 0, 1, 1, 2]
    assert [len(got[i].input_ids) for i in range(5)] == [3, 3, 5, 5, 4]
    assert got[1].input_ids == [1, 0, 0] and got[1].targets == [2, -100, -100]
    assert len(batching.batch_and_pad(df, 100).filter(F.size("targets") == 5).collect()) == 5


def brute_contexts(said, limit):
    history, out = [], {}
    for t, (role, text) in enumerate(said):
        if role != "user":
            continue
        now = f"<user>{text}<assistant>"
        while history and len("".join(history) + now) > limit:
            history.pop(0)
        out[t] = "".join(history) + now
        if t + 1 < len(said) and said[t + 1][0] == "assistant":
            history.append(now + said[t + 1][1])
    return out


def test_trim_history(turns):
    rng = random.Random(4)
    said = {c: [(role, "x" * rng.choice([0, 3, 10, 40])) for _ in range(rng.randint(1, 9))
                for role in ("user", "assistant")] for c in range(30)}
    said[100] = [("user", "a" * 300), ("assistant", "b"), ("user", "c"), ("assistant", "d"),
                 ("user", "e")]
    # Exactly at the budget: 17 characters of tags per exchange.
    said[101] = [("user", "a" * 20), ("assistant", "b" * 26), ("user", "c" * 20)]
    got = context.trim_history(turns(said), chars.CharTokenizer(), 100).collect()
    want = {(c, t): text for c, s in said.items() for t, text in brute_contexts(s, 100).items()}
    assert {(r.conv_id, r.turn): r.context for r in got} == want
    assert all(r.n_tokens == len(r.context) for r in got)


def test_render_history(turns):
    said = {1: [("system", "s"), ("user", "a"), ("assistant", "b"), ("user", "c")],
            2: [("user", "a"), ("user", "b"), ("assistant", "c")]}
    got = context.render_history(turns(said)).orderBy("conv_id", "turn").collect()
    assert [(r.conv_id, r.piece, r.start_char, r.is_current) for r in got] == [
        (1, "<user>a<assistant>b", 0, False), (1, "<user>c<assistant>", 19, True),
        (2, "<user>b<assistant>c", 0, False)]


def test_perplexity(spark):
    log = spark.createDataFrame([(1, 2.0, 3), (1, 9.9, 0), (2, 1.0, 0), (3, 800.0, 1)],
                                "run long, loss double, n_tokens long")
    got = {r.run: r.ppl for r in metrics.perplexity(log).collect()}
    assert got[1] == pytest.approx(math.exp(2)) and got[2] == math.inf and got[3] == math.inf


def test_cross_entropy(spark):
    rng = random.Random(1)
    grid = {(r, 0): [rng.uniform(-300, 300) for _ in range(7)] for r in range(4)}
    grid[4, 0] = [1e4, -1e4, 0.0, 0.0, 0.0, 0.0, 9.9e3]
    logits = spark.createDataFrame([(r, p, i, s) for (r, p), v in grid.items()
                                    for i, s in enumerate(v)],
                                   "row_id long, position int, item_id long, score double")
    targets = {0: 3, 1: -100, 2: 0, 3: 6, 4: 6}
    table = spark.createDataFrame([(r, 0, t) for r, t in targets.items()],
                                  "row_id long, position int, target int")
    def loss(v, t):
        top = max(v)
        return top + math.log(sum(math.exp(x - top) for x in v)) - v[t]
    want = [loss(grid[r, 0], t) for r, t in targets.items() if t != -100]
    got = metrics.token_cross_entropy(logits, table).first()
    assert got.cross_entropy == pytest.approx(sum(want) / len(want)) and got.positions == 4
    none = metrics.token_cross_entropy(logits, table.withColumn("target", F.lit(-100))).first()
    assert math.isnan(none.cross_entropy)


def brute_gate(ppls, thresholds=(50.0, 25.0, 15.0)):
    stage, out = 0, []
    for at, ppl in enumerate(ppls):
        if stage == 3:
            break
        passed = ppl <= thresholds[stage]
        out.append((at, stage + 1, passed))
        stage += passed
    return out


def test_gate(spark):
    runs = {1: [60.0] * 3, 2: [50.0, 25.0, 15.0, 1.0], 3: [math.inf, math.nan, 1.0, 30.0, 2.0],
            4: [1.0, 1.0, 1.0, 1.0]}
    df = spark.createDataFrame([(r, a, p) for r, ps in runs.items() for a, p in enumerate(ps)],
                               "run long, attempt long, ppl double")
    got = metrics.curriculum_gate(df).collect()
    for run, ppls in runs.items():
        assert sorted((r.attempt, r.stage, r.passed) for r in got if r.run == run) == \
            brute_gate(ppls)


@pytest.fixture
def scored(spark):
    values = {0: [3.0, 1.0, 1.0, 1.0, 0.0], 1: [-1.0], 2: [0.0, -2.0, 5.0]}
    return spark.createDataFrame([(g, i, s) for g, v in values.items() for i, s in enumerate(v)],
                                 "group_id long, item_id long, score double")


def kept(df):
    return sorted((r.group_id, r.item_id) for r in df.collect())


def test_filters(scored):
    everything = kept(scored)
    assert kept(candidates.top_k_filter(scored, 2)) == [
        (0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (2, 0), (2, 2)]
    assert kept(candidates.top_k_filter(scored, 0)) == everything
    assert kept(candidates.top_k_filter(scored, 99)) == everything
    assert kept(candidates.top_p_filter(scored, 0.0)) == [(0, 0), (1, 0), (2, 2)]
    assert kept(candidates.top_p_filter(scored, 1.0)) == everything
    # e^3, e, e, e, 1 over their sum: 0.69, 0.09, 0.09, 0.09, 0.03.
    assert kept(candidates.top_p_filter(scored, 0.75)) == [(0, 0), (0, 1), (1, 0), (2, 2)]


def test_penalty(spark, scored):
    seen = spark.createDataFrame([(2, 0), (2, 1), (2, 1), (2, 2)], "group_id long, item_id long")
    got = {r.item_id: r.score for r in candidates.repetition_penalty(scored, seen, 2.0).filter(
        "group_id = 2").collect()}
    assert got == {0: 0.0, 1: -4.0, 2: 2.5}
    assert kept(candidates.repetition_penalty(scored, seen, 1.0)) == kept(scored)


def test_sampling_frequencies(spark):
    df = spark.range(4000).select(F.col("id").alias("group_id"), F.explode(F.array(
        *[F.struct(F.lit(i).alias("item_id"), F.lit(math.log(w)).alias("score"))
          for i, w in enumerate([1.0, 2.0, 5.0])])).alias("s")).select("group_id", "s.*")
    got = {r.item_id: r["count"] / 4000 for r in candidates.sample_one(df, 1).groupBy(
        "item_id").count().collect()}
    assert got[0] == pytest.approx(1 / 8, abs=0.02) and got[2] == pytest.approx(5 / 8, abs=0.03)


def test_vectors(spark):
    assert column(spark, [[0.0, 0.0]], "array<double>", rms_normalize) == [[0.0, 0.0]]
    got = column(spark, [[3.0, 4.0]], "array<double>", lambda x: rms_normalize(
        x, F.array(F.lit(1.0), F.lit(2.0)), 0.0))
    assert got[0] == pytest.approx([3 / math.sqrt(12.5), 8 / math.sqrt(12.5)])


@pytest.mark.parametrize("block", [4096, 2])
def test_assignment_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    vecs = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])],
                                 "vec_id long, vec array<float>")
    cents = spark.createDataFrame([(5, [1.0, 0.0]), (3, [1.0, 0.0]), (9, [0.0, 2.0]),
                                   (1, [-1.0, -1.0]), (2, [0.0, 0.5])],
                                  "expert_id long, vec array<double>")
    got = {(r.vec_id, r["rank"]): r.expert_id for r in vectors.top_k_assign(
        vecs, cents, 2).collect()}
    assert got == {(0, 1): 3, (0, 2): 5, (1, 1): 9, (1, 2): 2, (2, 1): 9, (2, 2): 3}
    assert vectors.top_k_assign(vecs, cents, 9).count() == 15
    scores = vectors.score_experts(vecs, cents)
    assert scores.count() == 15
    want = vectors.assignment_balance(scores).first()
    assert vectors.vector_balance(vecs, cents).first() == pytest.approx(want)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_lookup_and_combine(spark, monkeypatch, limit):
    """The broadcast and the spread join give the same; tokens without a vector keep a null."""
    monkeypatch.setattr(vectors, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(skew, "TASK_ROWS", 2)
    table = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "token long, vec array<double>")
    tokens = spark.createDataFrame([(0, [1, 2, 1, 9]), (1, []), (2, [1, 1])],
                                   "row_id long, ids array<long>")
    got = vectors.embedding_lookup(tokens, table).orderBy("row_id", "pos").collect()
    assert [(r.row_id, r.pos, r.vec and r.vec[0]) for r in got] == [
        (0, 0, 1.0), (0, 1, 2.0), (0, 2, 1.0), (0, 3, None), (2, 0, 1.0), (2, 1, 1.0)]
    chosen = spark.createDataFrame([(0, 1, 0.25), (0, 2, 0.75), (1, 1, 1.0), (2, 1, 1.0)],
                                   "vec_id long, expert_id long, weight double")
    shared = spark.createDataFrame([(0, [10.0]), (1, [20.0])], "vec_id long, vec array<float>")
    combined = vectors.weighted_combine(chosen, table.withColumnRenamed("token", "expert_id"),
                                        shared)
    assert {r.vec_id: r.vec for r in combined.collect()} == {0: [11.75], 1: [21.0], 2: [1.0]}
    missing = spark.createDataFrame([(0, 77, 1.0)], chosen.schema)
    with pytest.raises(Exception, match="no vector for expert 77"):
        vectors.weighted_combine(missing, table.withColumnRenamed("token", "expert_id")).collect()


@pytest.mark.parametrize("window, block", [(2, 3), (3, 4), (128, 1024), (1, 1)])
def test_causal_window(spark, window, block):
    import numpy as np
    rng = np.random.default_rng(0)
    data = {s: rng.normal(size=(n, 4)) for s, n in ((1, 1), (2, 11))}
    df = spark.createDataFrame([(s, p, v[p].tolist()) for s, v in data.items()
                                for p in range(len(v))], "seq_id long, pos long, vec array<double>")
    for r in vectors.causal_window_average(df, window, block=block).collect():
        near = data[r.seq_id][max(0, r.pos - window):r.pos + 1]
        w = np.exp(near @ data[r.seq_id][r.pos] / 2.0)
        assert np.allclose(r.vec, w @ near / w.sum())
    assert vectors.causal_window_average(df, window, block=block).count() == 12


def test_grow_table(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "token long, vec array<float>")
    got = {r.token: r.vec for r in vectors.grow_table(table, 5, 2, 1).collect()}
    assert got[1] == [3.0, 4.0] and sorted(got) == [0, 1, 2, 3, 4]
    draws = [x for r in vectors.grow_table(table, 2000, 2, 1).collect() if r.token > 1
             for x in r.vec]
    assert abs(sum(draws) / len(draws)) < 0.002
    assert math.sqrt(sum(x * x for x in draws) / len(draws)) == pytest.approx(0.02, rel=0.1)


def test_problems(spark):
    made = problems.generate_n_problems(spark, 300, 2)
    assert problems.verify_completions(made).filter("NOT valid").isEmpty()
    assert made.select("prompt").distinct().count() > 200
    bad = spark.createDataFrame([
        ("has 1 and 2 and 3", "1 + 2 = 4; 4 - 3 = 1"), ("has 1 and 2 and 3", "1 + 2 = 3; 4 - 3 = 1"),
        ("has 1 and 9 and 3", "1 + 2 = 3; 3 - 3 = 0"), ("has 1 and 2 and 3", "1 + 2 = 3; 3 -3 = 0"),
        ("has 1 and 2 and 3", "1 + 2 = 3; 3 - 3 = 0")], "prompt string, completion string")
    got = [tuple(r) for r in problems.verify_completions(bad).select(
        "well_formed", "arithmetic_ok", "chain_ok", "operands_ok", "valid", "answer").collect()]
    assert got == [(True, False, True, True, False, 1), (True, True, False, True, False, 1),
                   (True, True, True, False, False, 0), (False, False, False, False, False, None),
                   (True, True, True, True, True, 0)]


def test_files(spark, tmp_path):
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    (deep / "x.jsonl").write_text('{"instruction":"i","context":null,"response":"é"}\n')
    (tmp_path / "y.jsonl").write_text('{"instruction":"j","response":"k","extra":1}\n')
    (tmp_path / "z.txt").write_text("no")
    got = read_instructions(spark, str(tmp_path)).orderBy("instruction").collect()
    assert [(r.instruction, r.context, r.response) for r in got] == [
        ("i", None, "é"), ("j", None, "k")]
    assert len({r.rec_id for r in got}) == 2
    (deep / "w.jsonl").write_text('{"instruction":"j","response":"k"}\n' * 3)
    again = read_instructions(spark, str(tmp_path), "[wxy].jsonl").collect()
    assert len({r.rec_id for r in again}) == len(again) == 5
    assert {r.rec_id for r in got} < {r.rec_id for r in again}
    rows = spark.createDataFrame([("p\n\"é\"", "c")], "prompt string, completion string")
    write_jsonl(rows, str(tmp_path / "out"))
    assert read_jsonl(spark, str(tmp_path / "out")).collect() == rows.collect()
    (tmp_path / "broken.jsonl").write_text("{oops\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        read_jsonl(spark, str(tmp_path / "broken.jsonl")).collect()
    marked = read_jsonl(spark, str(tmp_path / "broken.jsonl"), corrupt_column="_bad").collect()
    assert marked[0]._bad == "{oops"


def test_vocab_files(spark, tmp_path):
    vocab = spark.createDataFrame([("a", 0, 0), ("b", 1, 1), ("c", 0, 2)],
                                  "token string, id int, at int")
    save_vocab(vocab, str(tmp_path / "v"))
    assert {r.id: r.token for r in load_vocab(spark, str(tmp_path / "v")).collect()} == {
        0: "c", 1: "b"}
    with pytest.raises(FileNotFoundError):
        load_vocab(spark, str(tmp_path / "none"))


def test_keys_of_long_conversations_do_not_collide(spark, tmp_path):
    """Turn 4,096 of one conversation is not the first turn of the next."""
    from corpusprep.queries import QUERIES
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"m{c} {t}")
            for c in (0, 1) for t in range(4100)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    got = QUERIES["to_conversation"](spark, str(tmp_path)).groupBy("conv_id").count()
    assert {r["count"] for r in got.collect()} == {2} and got.count() == 4100


def test_shared_storage_has_to_be_named_off_a_local_master():
    from types import SimpleNamespace

    from corpusprep.plans.lineage import checkpoint_dir
    unset = SimpleNamespace(get=lambda *_: None)
    for master in ("spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(getConf=lambda: unset, getCheckpointDir=lambda: None,
                                  master=master)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(SimpleNamespace(conf=unset, sparkContext=context))
