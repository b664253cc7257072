"""Registered queries of the subpackage beside their SQL, or beside brute force."""

import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusprep.llm.queries import ORACLES, QUERIES
from tests.conftest import SF
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == ""


@pytest.fixture(scope="module")
def ids(con):
    """Token ids of every document by the library itself, by doc_id."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = con.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY 1").fetchall()
    return {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in rows}


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_token_file(spark, ids):
    want, start = {}, 0
    for doc, found in ids.items():
        want[doc] = (start, len(found) + 1, crc([*found, 2]))
        start += len(found) + 1
    got = QUERIES["op2_token_file"](spark, SF).collect()
    assert {r[0]: tuple(r[1:4]) for r in got} == want and len(got) == len(want)


def test_packing(spark, ids):
    want, total = {}, 0
    for doc, found in ids.items():
        whole = [*found, 0]
        total += len(whole)
        for k, at in enumerate(range(0, len(whole), 2048)):
            part = whole[at:at + 2048]
            want[doc, k] = (at, len(part), crc(part))
    got = QUERIES["op3_pack_documents"](spark, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 1


def test_mix(spark, con):
    rows = QUERIES["op1_mix_sources"](spark, SF).collect()
    sizes = dict(con.execute(
        r"SELECT doc_id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) FROM documents"
    ).fetchall())
    assert {r.doc_id: r["size"] for r in rows} == sizes
    per, target, taken, largest = {}, {}, {}, {}
    for r in rows:
        per[r.source] = per.get(r.source, 0) + r["size"]
        target[r.source] = r.target
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r["size"])
        assert r.taken % max(r["size"], 1) == 0 and r.taken <= 3 * r["size"]
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(per))}
    left, capped = dict(weights), {}
    while True:
        level = (sum(per.values()) - sum(capped.values())) / sum(left.values())
        over = [s for s in left if level * left[s] > 3 * per[s]]
        if not over:
            break
        for s in over:
            capped[s] = 3 * per[s]
            del left[s]
    for s in per:
        assert target[s] == pytest.approx(capped.get(s, level * weights[s]))
        assert abs(taken[s] - target[s]) <= largest[s]
    again = QUERIES["op1_mix_sources"](spark, SF).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_personal_data(spark, con):
    import re
    text = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rows = QUERIES["op8_sanitise"](spark, SF).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = [m.span() for m in email.finditer(text[r.doc_id])]
        assert r.n_email == len(want)
        assert [s for s in r.spans.split(",") if s.startswith("email")] == [
            f"email:{a}:{b}" for a, b in want]


def test_toxicity(spark):
    # The smaller tables have too few toxic texts to learn from.
    rows = QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = rows.join(labels, "doc_id").collect()
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.92 * len(held)
    toxic = [r for r in held if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic)


def test_rows_of_the_others(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert QUERIES["op4_spot_signatures"](spark, SF).count() == documents
    assert QUERIES["op6_host_paths"](spark, SF).count() == spark.read.parquet(
        f"{SF}/pages.parquet").count()
