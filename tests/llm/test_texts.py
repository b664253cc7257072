"""Fingerprints, page extraction, toxicity and personal data on small inputs."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusprep.llm import host_paths, sanitise, spotsigs, toxicity, words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB é\t\n.,", max_size=30), max_size=8), st.integers(1, 40))
def test_word_hashes(found, piece):
    old, words.PIECE = words.PIECE, piece
    try:
        value, heads = words.hashed_words(*words.texts(pa.array(found, pa.string())))
    finally:
        words.PIECE = old
    want = [[w for w in re.split("[ \t\n]+", t.replace("B", "b")) if w] for t in found]
    assert np.diff(heads).tolist() == [len(w) for w in want]
    flat = [w for row in want for w in row]
    assert len({(w, h) for w, h in zip(flat, value.tolist())}) == len(set(flat)) == len(
        set(value.tolist()))


def test_likeness_is_the_multiset_jaccard():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (np.sort(rng.integers(0, 9, rng.integers(1, 15))).astype(np.uint32) for _ in "ab")
        x, y = Counter(a.tolist()), Counter(b.tolist())
        assert spotsigs.likeness(a, b) == pytest.approx(
            sum((x & y).values()) / sum((x | y).values()))
    assert spotsigs.likeness(a[:1], np.sort(np.concatenate([a, b, a])), 0.9) == 0.0


def test_edited_texts(spark):
    prose = "the cat sat on a mat and the dog ran to the house with some bones for it. "
    rows = [(10, prose * 3), (9, None), (8, "é" * 7), (3, prose * 3), (2, "short"), (1, ""),
            (None, "the last one"), (3, "tie")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int")
    got = spotsigs.against_edited(df).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    want = {}
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        t, after = t or "", after or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        want.setdefault(i, []).append((len(t), hashlib.sha256(edited.encode()).hexdigest()))
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.n_chars, r.edited_sha256))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    prints = {r.doc_id: r.fingerprint for r in got if r.n_chars == len(prose) * 3}
    assert prints[10] == prints[3]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert spotsigs.against_edited(df.limit(0)).count() == 0
    alone = spotsigs.against_edited(df.filter("doc_id = 10")).first()
    assert alone.near_next == 1.0


def test_similar_texts_are_classed(spark):
    prose = " ".join(f"the w{k} word{k} x{k} of y{k}" for k in range(40))
    other = " ".join(f"the q{k} r{k} s{k} of t{k}" for k in range(40))
    rows = [(5, prose), (4, prose + " more"), (9, prose), (1, other), (2, None), (3, ""), (6, "hm")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in spotsigs.similar(df).collect()}
    assert got == {5: 4, 4: 4, 9: 4, 1: 1, 2: 2, 3: 2, 6: 6}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<nav><ul><li><a href="/a">Menu one</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="{box}"><h1>Head &amp; line</h1><p>First <b>para,<br>graph</b>
 one.<p>Second &lt;one&gt;&nbsp;here<script>var x = "</p>";</script>
<div class="ad">Buy now</div><ul><li>item</ul><div id="comments"><p>I disagree</p></div></div>
<form><p>Your name</p></form><footer>&copy; us</footer></body></html>"""
WANT = "Head & line\n\nFirst para, graph one.\n\nSecond <one> here\n\nitem"


def test_pages(spark):
    rows = [(k, f"http://h.example/{k}", PAGE.format(box=f"content box{k}"), "p")
            for k in range(6)]
    rows += [(20, None, None, "p"), (21, "::", "", "p"), (22, "http://h.example/x", "plain text", "p"),
             (23, "http://o.example/", "<p>" + "word " * 50_000, "p"),
             (24, "http://o.example/", "<nav>only a menu</nav><scr", "p")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, paths string")
    got = {r.page_id: r for r in host_paths.extract_pages(df).collect()}
    assert len(got) == len(rows)
    for k in range(6):
        assert got[k].text == WANT
    assert [got[k].text for k in (20, 21, 22, 24)] == ["", "", "plain text", ""]
    assert got[23].n_chars == 249_999
    assert host_paths.extract_pages(df.limit(0)).count() == 0
    paths = host_paths.winning_paths(df).collect()
    assert {r.host: r.paths[0] for r in paths}["h.example"] == "html>html>body>div.box.content" or \
        "div.box.content" in {r.host: r.paths[0] for r in paths}["h.example"]


def test_pages_keep_leads_and_rarer_templates(spark):
    split = '<body><div class="page"><div class="lead"><p>{a}</p></div><div class="text"><p>{b}</p>' \
        '</div></div><footer>us</footer></body>'
    lead, text = "lead words " * 27, "text words " * 64
    rows = [(k, f"http://h.example/{k}", split.format(a=lead, b=text)) for k in range(8)]
    # Another template: a teaser of a few words stands in the popular container.
    rows.append((20, "http://h.example/x", '<body><div class="page"><p>Read on</p></div>'
                 f'<div class="story"><p>{text}</p></div></body>'))
    # A long quotation in its article.
    rows.append((30, "http://q.example/", f'<body><div class="post"><p>{lead}</p><blockquote><p>'
                 f'{text}</p></blockquote></div></body>'))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in host_paths.extract_pages(df).collect()}
    assert all(got[k] == f"{lead.strip()}\n\n{text.strip()}" for k in (*range(8), 30))
    assert text.strip() in got[20]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ARTICLE = "Some long article text, with words. " * 30


@pytest.mark.parametrize("page, want", [
    (f'<body><div class="layout with-sidebar"><article><p>{ARTICLE}</p></article></div></body>', ARTICLE),
    (f'<body><div class="page no-comments"><p>{ARTICLE}</p></div></body>', ARTICLE),
    (f'<body><section id="related-work"><p>{ARTICLE}</p></section></body>', ARTICLE),
    (f'<div class="with-sidebar"><main><p>{ARTICLE}</p></main><div class="sidebar"><p>Side</p></div></div>', ARTICLE),
    (f'<article><p>Short.</p></article><div class="ad"><p>{ARTICLE}</p></div>', "Short."),
    ('<p>Real <span class="sponsored-ad">Buy <span>now</span></span>words <b hidden>not</b>stay.</p>', "Real words stay."),
    ('<p>kept <span class="ad">gone</p><p>after</p>', "kept\n\nafter"),
    ('<p>a < b and <i>c</i></p>', "a < b and c"), ('<p>x <a "</p>', "x"), ("", "")])
def test_theme_classes_and_inline_adverts(page, want):
    assert host_paths.Page(page).extract([]) == want.strip()


@pytest.mark.parametrize("broken", ["<a ", '<a "', "<script ", "<a '\"", "<", "</a ", "<!-", "<p x='", "<div "])
def test_broken_tags_take_linear_time(broken):
    import time
    start = time.time()
    host_paths.Page(broken * (200_000 // len(broken))).extract([])
    assert time.time() - start < 3


def plain_spans(text):
    """The base patterns as they are given, by the regular expression engine alone."""
    found = []
    for m in EMAIL.finditer(text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        total = sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["1", "25", "256", ".", "..", "-", " ", "+", "(", ")", "a", "x@", "@b.c", "_", "é", "4111111111111111",
                                 "10.0.0.1", "a.b@c-d.e", "\n", "00", "+49 30 "]), max_size=25))
def test_base_spans_are_the_patterns(parts):
    text = "".join(parts)
    got = [(k, a, b) for k, v in sanitise.base_spans(text).items() for a, b in v]
    assert got == plain_spans(text)


def test_base_spans_of_the_whole_table(spark):
    from corpusprep.llm.queries import QUERIES
    from tests.conftest import SF
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_sanitise"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_spans(texts[r.doc_id] or "")
        counts = Counter(k for k, _, _ in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in ("email", "ip", "card", "phone"))
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


@pytest.mark.parametrize("text", ["7" * 1_000_000, "1.2." * 250_000, "x@" * 300_000, " @a.b" * 200_000, "+1(" * 300_000])
def test_long_runs_take_linear_time(text):
    import time
    start = time.time()
    sanitise.base_spans(text)
    assert time.time() - start < 5


def test_toxicity_of_unseen_spellings(spark):
    rng = np.random.default_rng(5)
    plain = ["".join(rng.choice(list("lmnrstaeiou"), 6)) for _ in range(60)]
    bad = ["blorkish", "grubface", "snivelbag"]
    rows, labels = [], []
    for i in range(400):
        text = list(rng.choice(plain, 30))
        if i % 4 == 0:
            text[3], text[17] = rng.choice(bad, 2)
        rows.append((i, " ".join(text), "x"))
        labels.append((i, int(i % 4 == 0)))
    rows += [(1000, " ".join([*plain[:27], "blorkishly", "grubfaces", "snivelbags"]), "x"), (1001, " ".join(plain[:30]), "x"),
             (1002, None, "x"), (1003, "", "x"), (1004, "?? !!", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    known = spark.createDataFrame(labels + [(5000, 1), (2, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(df, known).collect()}
    assert len(got) == len(rows)
    assert got[1000].predicted == 1 and got[1001].predicted == 0
    held = [r for i, r in got.items() if r.held_out and i < 400]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= got[i].score <= 1 for i in (1002, 1003, 1004))
    clean = toxicity.drop_toxic(df, known)
    assert clean.columns == df.columns
    assert {1001, 1002, 1003, 1004} <= {r.doc_id for r in clean.collect()}
    assert toxicity.toxicity(df.limit(0), known).count() == 0
    assert {r.predicted for r in toxicity.toxicity(df, known.limit(0)).collect()} == {0}


@pytest.mark.parametrize("half", [2, 10])
def test_texts_without_words_are_clean(spark, half):
    rows = [(i, f"plain talk {i}" if i % half else f"grubface talk {i}", i, "w", "r", 0.5, 9) for i in range(200)]
    rows += [(1000, None, 1, None, "r", None, 9), (1001, "", 2, "w", None, 0.9, 9), (1001, "", 2, "w", None, 0.9, 9),
             (None, " .. ", 3, "w", "r", 0.1, None)]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, words int, label string, row string, score double, _score int")
    known = spark.createDataFrame([(i, int(i % half == 0)) for i in range(200)], "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.toxicity(df, known).collect()}
    assert max(scores[k] for k in (1000, 1001, None)) < 0.5
    clean = toxicity.drop_toxic(df, known)
    assert clean.columns == df.columns
    got = sorted(map(str, clean.collect()))
    want = [r for r in df.collect() if r.doc_id is None or r.doc_id >= 200 or r.doc_id % half]
    assert got == sorted(map(str, want))


def test_training_reads_a_bounded_part(spark):
    rows = [(i, ("bad " if i % 2 else "good ") * 50) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    for limit in (1, 600, 1 << 20):
        table, intercept = toxicity.train(df, known, limit=limit)
        scores, _ = toxicity.Scorer(table, intercept).scores(["bad " * 50, "good " * 50])
        assert scores[0] > 0.5 > scores[1]


@settings(max_examples=500, deadline=None)
@given(st.text("ab.@-_1 é", max_size=30))
def test_emails_are_the_pattern_s(text):
    assert list(sanitise._emails(text)) == [m.span() for m in EMAIL.finditer(text)]


def test_base_kinds():
    text = "x 1.2.3.4 999.1.1.1 or 4111 1111 1111 1111 +49 (30) 1234-567 é a.b@c.de 4111111111111112"
    spans = sanitise.base_spans(text)
    assert [text[a:b] for k in sanitise.KINDS for a, b in spans[k]] == [
        "a.b@c.de", "1.2.3.4", "4111 1111 1111 1111", "+49 (30) 1234-567"]
    assert sanitise.base_spans("") == {k: [] for k in sanitise.KINDS}


def test_disclosing_terms(spark):
    rows = [(i, f"write to helpdesk me{i}@site.org about thing", "k") for i in range(20)]
    rows += [(100 + i, "a text about some other thing", "k") for i in range(60)]
    rows += [(500, None, "k"), (501, "helpdesk without address", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, term string")
    terms = {r.term: r.disclosed for r in sanitise.disclosing_terms(df).collect()}
    assert set(terms) >= {"write", "helpdesk"} and not {"about", "thing"} & set(terms)
    assert terms["write"] == pytest.approx(1.0)
    got = {r.doc_id: r for r in sanitise.find_personal_data(df).collect()}
    assert got[3].n_email == 1 and got[3].spans.startswith("email:18:30,term:0:5")
    assert got[501].spans == "" and got[500].n_email == 0
    assert got[500].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = sanitise.sanitise(df)
    assert clean.columns == df.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert "[EMAIL]" in texts[3] and "write" not in texts[3] and texts[500] is None
    assert sanitise.find_personal_data(df.limit(0)).count() == 0


def test_rare_disclosing_terms_count_in_large_tables(spark, monkeypatch):
    rows = [(i, f"mail u{i}@site.org" + (" zorblatt" if i < 5 else "")) for i in range(6000)]
    rows += [(6000 + i, "plain text of no interest") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(r.doc_id, r.spans) for r in sanitise.find_personal_data(df).collect()}
    assert (3, "email:5:16,term:0:4,term:17:25") in want
    # The same by the join that replaces the broadcast.
    monkeypatch.setattr(sanitise, "KNOWN", 0)
    assert {(r.doc_id, r.spans) for r in sanitise.find_personal_data(df).collect()} == want
    assert {r.text for r in sanitise.sanitise(df.filter("doc_id < 5 or doc_id >= 6000")).collect()
            } == {" [EMAIL] ", "plain text of no interest"}


def test_terms_of_a_single_value(spark):
    """A term that half of the time stands beside other addresses tells little about the kind."""
    rows = [(i, f"note{'' if i % 2 else ' Jane.Roe@Site.org'} quillon words") for i in range(20)]
    rows += [(20 + i, f"note x{i}@site.org words") for i in range(480)]
    rows += [(500 + i, "note words") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.kind, r.term): r.disclosed for r in sanitise.disclosing_terms(df).collect()}
    # Words that stand in the addresses alone are terms too.
    assert {k for k in found if k[1] not in ("jane", "roe", "site", "org")} == {
        ("email:jane.roe@site.org", "quillon")}
    assert found["email:jane.roe@site.org", "quillon"] == pytest.approx(np.log(50) / np.log(100))
    got = {r.doc_id: r.n_term for r in sanitise.find_personal_data(df).collect()}
    assert got[2] == 1 and got[1] == got[30] == 0


def test_subwords_take_bounded_memory():
    import tracemalloc
    words = [f"{k:07d}word" for k in range(120_000)]
    whole = [toxicity.subwords(words[at:at + 1000]) for at in range(0, len(words), 1000)]
    tracemalloc.start()
    rows, heads = toxicity.subwords(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (rows == np.concatenate([r for r, _ in whole])).all()
    assert (np.diff(heads) == np.concatenate([np.diff(h) for _, h in whole])).all()
    # The rows twice while they are joined, and what one run of words needs.
    assert peak < 3 * rows.nbytes + (60 << 20)
    assert [len(a) for a in toxicity.subwords([])] == [0, 1]


def test_new_words_are_scored_in_bounded_memory():
    import tracemalloc
    table = np.random.default_rng(1).normal(size=toxicity.BUCKETS).astype(np.float32)
    texts = [" ".join(f"{k:07d}word" for k in range(at, at + 1000)) for at in range(0, 120_000, 1000)]
    scorer = toxicity.Scorer(table, -0.5)
    tracemalloc.start()
    scores, words = scorer.scores(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (words == 1000).all()
    assert (scores == [toxicity.Scorer(table, -0.5).scores([t])[0][0] for t in texts]).all()
    # Words and their numbers, and the n-grams of one run of words.
    assert peak < 50 << 20


def test_batches_are_worked_on_in_parts(spark):
    import pyarrow as pa
    from corpusprep.llm.common import parts
    column = pa.array(["ab", None, "", "abcdef", "é", "x"])
    assert list(parts(column, 1)) == [(0, 1), (1, 3), (4, 1), (5, 1)]
    assert list(parts(column, 4)) == [(0, 4), (4, 2)]
    assert list(parts(column.slice(3), 100)) == [(0, 3)] and list(parts(column.slice(6))) == []
    big = "write to a.b@c.de " + "filler " * 90_000
    batch = pa.RecordBatch.from_arrays([pa.array([big, None, big, big])], ["text"])
    assert [b.num_rows for b in sanitise._entity_terms([batch])] == [4, 2]
