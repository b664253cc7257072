"""Line classes, the n-gram join and components against brute force."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import line_dedup, ngram_join
from corpusprep.llm.common import components

SCHEMA = "doc_id long, text string, node int, n int, token string, line string"


def docs(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, 1, 2, "t", "l") for i, t in rows], SCHEMA)


def closure(ids, linked):
    """Smallest id of each id's component."""
    of = {i: i for i in ids}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i
    for a, b in linked:
        x, y = sorted((root(a), root(b)))
        of[y] = x
    return {i: root(i) for i in ids}


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 300), (300, 100), (7, 7)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    want = closure({x for e in chain for x in e}, chain)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_verification_is_the_edit_distance(spark, edits):
    draw = random.Random(edits)
    pairs = [tuple("".join(draw.choice("abé") for _ in range(draw.randint(0, 10))) for _ in "ab")
             for _ in range(500)] + [("", ""), ("", "ab"), ("abc", "abc"), ("a" * 300, "a" * 299)]
    df = spark.createDataFrame([(k, k, a, b) for k, (a, b) in enumerate(pairs)],
                               "a long, b long, ta string, tb string")
    got = {r.a for r in line_dedup.verified(df, edits).collect()}
    assert got == {k for k, (a, b) in enumerate(pairs) if levenshtein(a, b) <= edits}


def brute_lines(rows, edits, exact, near):
    found = []
    for i, t in rows:
        if t is not None:
            found += [(i, k, line) for k, line in enumerate(t.split("\n")) if len(line) >= exact]
    lines = {line for _, _, line in found}
    linked = [(a, b) for a, b in itertools.combinations(sorted(lines), 2)
              if min(len(a), len(b)) >= near and levenshtein(a, b) <= edits]
    group = closure(lines, linked)
    first = {}
    for i, k, line in sorted(found):
        first.setdefault(group[line], (i, k))
    return sorted((i, k, *first[group[line]]) for i, k, line in found)


def test_lines_beside_brute_force(spark):
    base = ["the quick brown fox jumps over", "a second line that stands here now",
            "something short", "x", "le renard brun saute où il veut"]
    rows, n = [], 0
    for i, line in enumerate(base * 3):
        changed = [line, line[:5] + "#" + line[6:], line + "!!", line[3:], line[:-1] + "z",
                   line[:9] + line[11:], "q" + line]
        rows.append((n, "\n".join(changed[i % 7:] + [line.upper()])))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "\n\n"), (n + 3, "w" * 700),
             (n + 4, "w" * 699 + "v")]
    for edits, near in ((1, 12), (2, 24)):
        got = line_dedup.line_classes(docs(spark, rows), edits, 10, near)
        assert sorted((r.doc_id, r.line_no, r.class_doc_id, r.class_line_no)
                      for r in got.collect()) == brute_lines(rows, edits, 10, near)


@pytest.mark.parametrize("percent", [3, 5, 10])
def test_bound_grows_with_the_line(spark, percent):
    draw = random.Random(percent)
    lines = []
    for size in (30, 61, 75, 99, 100, 134, 160, 300, 700):
        base = "".join(draw.choice("abcdé fg") for _ in range(size))
        for edits in (0, 1, 2, 3, size * percent // 100, size * percent // 100 + 1):
            copy = list(base)
            for at in sorted(draw.sample(range(size), edits), reverse=True):
                copy[at:at + 1] = draw.choice(["", "X", copy[at] + "Y"])
            lines.append("".join(copy))
    draw.shuffle(lines)
    rows = list(enumerate(lines))
    links = [(a, b) for (a, s), (b, t) in itertools.combinations(rows, 2) if levenshtein(s, t) <= max(
        2, max(len(s), len(t)) * percent // 100)]
    got = line_dedup.line_classes(docs(spark, rows), percent=percent)
    assert {r.doc_id: r.class_doc_id for r in got.collect()} == closure(range(len(rows)), links)


@pytest.mark.parametrize("edits, percent", [(2, 3), (2, 5), (1, 7), (2, 10)])
def test_shared_piece(edits, percent):
    piece = line_dedup.shared_piece(edits, percent)
    for n in range(line_dedup.wide_from(edits, percent), 30_000):
        most = n * percent // 100
        assert most > edits and (n - most) > (piece - 1) * (most + 1)


def test_word_bound_grows_with_the_line(spark):
    draw = random.Random(4)
    lines = []
    for size in (5, 18, 19, 20, 21, 38, 39, 40, 57, 60, 78, 80, 81, 130):
        base = [draw.choice(["lorem", "ipsum", "été", "a", "consectetur", ""]) + str(draw.randint(0, 30))
                for _ in range(size)]
        for edits in (0, 1, 2, 3, 4, 5):
            copy = list(base)
            for at in sorted(draw.sample(range(size), edits), reverse=True):
                copy[at:at + 1] = draw.choice([[], ["replaced"], [copy[at], "putin"]])
            lines.append(" ".join(copy))
    draw.shuffle(lines)
    rows = list(enumerate(lines))

    def near(s, t):
        if min(len(s), len(t)) < 24:
            return False
        a, b = s.split(" "), t.split(" ")
        return levenshtein(a, b) <= min(4, max(len(a), len(b)) * 5 // 100) or levenshtein(s, t) <= 2

    links = [(a, b) for (a, s), (b, t) in itertools.combinations(rows, 2) if near(s, t)]
    got = line_dedup.line_classes(docs(spark, rows), word_percent=5)
    first = {}
    for i, s in rows:
        first.setdefault(s, i)
    links += [(first[s], i) for i, s in rows if first[s] != i]
    assert {r.doc_id: r.class_doc_id for r in got.collect()} == closure(range(len(rows)), links)


def test_lines_of_odd_rows(spark):
    line = "one line that is long enough to be a copy of another"
    rows = [(None, line), (None, line), (1, line), (1, None), (2, ""), (3, "kept apart\n" + line), (3, "x")]
    df = spark.createDataFrame([(i, t, 7, "k", 1, "g") for i, t in rows],
                               "doc_id long, text string, gone int, row string, n_chars int, node string")
    out = line_dedup.dedup_lines(df, word_percent=5)
    assert out.columns == df.columns
    # Both rows without an id hold the first copy; of document 3 the other line stays.
    assert sorted((str(r.doc_id), str(r.text), r.gone, r.row) for r in out.collect()) == sorted(
        (str(i), str(t), 7, "k") for i, t in [(None, line), (None, line), (1, None), (2, ""), (3, "kept apart"), (3, "x")])
    assert line_dedup.dedup_lines(df.limit(0), word_percent=5).count() == 0


def test_pipeline_drops_a_paragraph_with_one_word_changed(spark):
    import corpus_pipeline
    words = [f"word{k}" for k in range(30)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:12], "changedw", *words[13:]]))]
    out = corpus_pipeline.without_repeated_lines(spark, docs(spark, rows), None)
    assert [r.doc_id for r in out.collect()] == [1]


def test_very_long_line(spark):
    rows = [(1, "w" * 200_000), (2, "w" * 199_999 + "v"), (3, "w" * 199_990)]
    got = line_dedup.line_classes(docs(spark, rows)).collect()
    assert {r.doc_id: r.class_doc_id for r in got} == {1: 1, 2: 1, 3: 3}


def test_hot_line_publishes_once(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_COPIES", 5)
    rows = [(i, "one line that everybody repeats") for i in range(30)] + [
        (99, "one line that everybody repeated")]
    got = line_dedup.line_classes(docs(spark, rows)).collect()
    assert {(r.class_doc_id, r.class_line_no) for r in got} == {(0, 0)}
    assert sum(r.kept for r in got) == 1


def test_documents_without_repeated_lines(spark):
    a, b = "this line is long enough to count", "and another one that is long enough"
    rows = [(1, f"{a}\nhi\n{b}"), (2, f"{b}!\nhi\nnew line of the second document"), (3, a),
            (4, None), (5, ""), (6, "hi"), (None, "a line without any document id")]
    out = line_dedup.dedup_lines(docs(spark, rows))
    assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(
        " int", "").split(", ")
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: rows[0][1], 2: "hi\nnew line of the second document", 4: None, 5: "", 6: "hi",
                   None: "a line without any document id"}
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def brute_join(rows, n, percent):
    sets = {}
    for i, t in rows:
        words = (t or "").translate({c: c + 32 for c in range(65, 91)})
        for c in "\t\n\x0b\x0c\r":
            words = words.replace(c, " ")
        words = [w for w in words.split(" ") if w]
        sets[i] = {tuple(words[k:k + n]) for k in range(max(len(words) - n + 1, 1))} if words else \
            set()
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and
              100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    group = closure(sorted(sets), linked)
    return {i: (len(s), group[i]) for i, s in sets.items()}


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_join_beside_brute_force(spark, n, percent):
    draw = random.Random(n)
    vocabulary = [f"w{k}" for k in range(60)]
    rows, i = [], 0
    for _ in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(1, 80))]
        for _ in range(8):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            rows.append((i, " ".join(copy)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, " \t "), (i + 3, "One two"), (i + 4, "one TWO"),
             (i + 5, "long " * 30_000), (i + 6, "é\xa0É x y"), (i + 7, rows[0][1])]
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in ngram_join.ngram_join(docs(spark, rows), n, percent, 16).collect()}
    assert got == brute_join(rows, n, percent)


def test_join_does_not_depend_on_the_sketch(spark):
    rows = [(i, " ".join(f"w{(i // 3) * 40 + k}" for k in range(40)) + f" tail{i}")
            for i in range(30)]
    found = [sorted(map(tuple, ngram_join.ngram_join(docs(spark, rows), 3, 80, bits, parts)
                        .collect())) for bits, parts in ((16, 1), (18, 8))]
    assert found[0] == found[1]
    assert {c for _, _, c in found[0]} == set(range(0, 30, 3))


def test_sketch_of_a_task_is_as_large_as_its_shingles():
    bits, tasks = 18, []
    for k, (words, copies) in enumerate(((40, 1), (40, 300), (3, 70_000), (150_000, 1))):
        text = " ".join(f"w{i}" for i in range(words))
        batch = pa.RecordBatch.from_arrays([pa.array(range(copies)), pa.array([text] * copies)],
                                           ["doc_id", "text"])
        blocks = [b for b in ngram_join._keyed(3, bits)([batch]) if b.column(0).null_count == 0]
        if k < 3:
            # A place and its count, however many counters the sketch has.
            assert sum(len(v) for b in blocks for column in b.columns
                       if pa.types.is_binary(column.type) for v in column.to_pylist() if v
                       ) <= 6 * words
        tasks.append([b.select(["block", "places", "counts"]) for b in blocks])
    assert {b.column(1).null_count for task in tasks for b in task} == {0, 1}
    brute = np.zeros(1 << bits, np.int64)
    for words, copies in ((40, 1), (40, 300), (3, 70_000), (150_000, 1)):
        value, _ = ngram_join.shingles(*ngram_join.hashed_words(*ngram_join.texts(
            pa.array([" ".join(f"w{i}" for i in range(words))]))), 3)
        np.add.at(brute, (value & np.uint64((1 << bits) - 1)).astype(np.int64), copies)
    got = np.zeros(1 << bits, np.int64)
    for b in ngram_join._summed(bits)([b for task in tasks for b in task]):
        counts = np.frombuffer(b.column(1)[0].as_py(), "<u4")
        got[b.column(0)[0].as_py():][:len(counts)] = counts
    assert (got == brute).all()


def test_join_edges(spark):
    assert ngram_join.ngram_join(docs(spark, [])).count() == 0
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (2, "z z z z z"), (None, None)]
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in
                 ngram_join.ngram_join(docs(spark, rows)).collect())
    assert got == [(-1, -1), (-1, 4), (2, 2), (4, 4), (4, 4)]


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(3, text), (1, text + " end"), (2, "other words here"), (8, None), (None, "x y z")]
    kept = ngram_join.keep_one(docs(spark, rows))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 8]
    assert kept.columns == docs(spark, []).columns


def test_join_through_rows_without_an_id(spark):
    words = [f"w{k}" for k in range(60)]
    chain = [" ".join(words + [f"more{k}" for k in range(n)]) for n in range(3)]
    other = " ".join(f"v{k}" for k in range(40))
    rows = [(5, chain[0]), (None, chain[1]), (2, chain[2]), (None, other), (None, other + " end"), (9, None), (None, "")]
    got = ngram_join.ngram_join(docs(spark, rows), 3, 97).collect()
    by = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    # 5 and 2 are linked through a row without an id only.
    assert by == {5: 2, 2: 2, 9: 9}
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["2", "None", "None", "None"]


def test_one_automaton_for_all_word_bounds(spark):
    """`most` may differ from row to row; the result is that of the plain distance."""
    made = random.Random(11)
    rows = []
    for _ in range(400):
        a = made.choices("abc", k=made.randint(0, 9))
        b = [x for w in a for x in (made.choice([[w], [w], [w], [], ["d"], [w, "e"]]))]
        rows.append((a, b, made.randint(1, 4)))

    def distance(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
            last = now
        return last[-1]

    df = spark.createDataFrame(rows, "a array<string>, b array<string>, most int")
    got = df.select("a", "b", "most", line_dedup.within_edits(
        F.col("a"), F.col("b"), 4, F.col("most")).alias("near")).collect()
    assert [r.near for r in got] == [distance(r.a, r.b) <= r.most for r in got]
    assert len({r.near for r in got}) == 2


def test_unlike_lines_of_a_group_do_not_leave_the_join(spark, monkeypatch):
    """Lines that share half of their words meet in a signature, but their word groups tell that they
    are too far apart; before, each was compared with a line of the group, by four branches."""
    made = random.Random(3)
    common = [f"same{i}" for i in range(30)]
    lines = [" ".join(common + ["".join(made.choices("etaoinsrhldu", k=made.randint(2, 8)))
                              for _ in range(30)]) for _ in range(80)]
    lines.append(lines[0].replace("same3 ", "other "))
    compared, stored = [], line_dedup.stored

    def watched(df, label, *rest):
        out = stored(df, label, *rest)
        if label == "line-compared":
            compared.append((out.count(), df))
        return out

    monkeypatch.setattr(line_dedup, "stored", watched)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = line_dedup.line_classes(docs, word_percent=5).collect()
    assert [r.doc_id for r in got if not r.kept] == [80]
    assert sum(n for n, _ in compared) < 20
