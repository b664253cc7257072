"""Personal data, and information-theoretic sanitisation of the terms that reveal it.

Four kinds of personal data are found by their patterns. The corpus then tells which words give such
an entity away: with the document frequencies of a term, of a kind, and of both together, their
pointwise mutual information over the kind's information content is the share of it that the term
discloses (1: the term never appears without the kind). The same is worked out for each single value
(an address, a number) that enough documents hold. In documents that hold the kind or the value, terms
above one threshold are generalised to a label, and those above a higher one removed.
"""

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusprep.llm.common import attach, parts, stored

KINDS = ("email", "ip", "card", "phone")
#: Disclosed shares from which a term is generalised and removed.
GENERALISE, REMOVE = 0.7, 0.9
#: A term counts with at least this many documents of the kind or value.
SUPPORT = 5
#: Disclosing terms that are broadcast at most; more are joined to the documents.
KNOWN = 200_000
#: Terms a task counts before it hands its counts on.
HELD = 300_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits matches from its start or not at all, so each is looked at once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[^0-9]+")
_TERM = re.compile(r"[^\W\d_]{3,}")


def _emails(text):
    """The pattern's local part is a run of characters that ends at the at sign, so the leftmost
    match starts where the run does, or where the match before it ended."""
    end = 0
    for m in _TAIL.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            end = m.end()


def _luhn(digits):
    double = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in double)) % 10 == 0


def base_spans(text):
    """`{kind: [(start, end), ...]}` in code points: leftmost, not overlapping within a kind; a
    match that fails its kind's test is dropped."""
    found = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found["ip"].append(m.span())
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.sub("", m[0])) <= 15:
                found["phone"].append(m.span())
    return found


def entities(text, spans):
    """What a text holds: its kinds, and its values as "kind:value" without case or separators."""
    found = {k for k in KINDS if spans[k]}
    for kind in list(found):
        for a, b in spans[kind]:
            value = text[a:b].lower()
            found.add(f"{kind}:{_DIGITS.sub('', value) if kind in ('card', 'phone') else value}")
    return found


def _texts(batches):
    """The texts of a first column, null as empty, a part of a batch at a time."""
    for batch in batches:
        for first, many in parts(batch.column(0)):
            for text in batch.column(0).slice(first, many).to_pylist():
                yield text or ""


def _counts(batches):
    """Partial document frequencies `(term, n, email, ip, card, phone)`; the null term counts
    documents, and terms with a colon are values."""
    names = ["term", "n", *KINDS]
    held = {}

    def handed():
        rows = list(held.values())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()),
             *[pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]], names)
        held.clear()
        return batch

    for text in _texts(batches):
        spans = base_spans(text)
        has = [k + 1 for k, kind in enumerate(KINDS) if spans[kind]]
        terms = set(_TERM.findall(text.lower()))
        terms.add(None)
        if has:
            terms |= entities(text, spans).difference(KINDS)
        for t in terms:
            row = held.get(t)
            if row is None:
                row = held[t] = [0] * 5
            row[0] += 1
            for k in has:
                row[k] += 1
        if len(held) >= HELD:
            yield handed()
    if held:
        yield handed()


def _entity_terms(batches):
    """`(kind, terms, key)` for each kind and value of a text, `key` naming the text."""
    kinds = [pa.string(), pa.list_(pa.string()), pa.string()]
    for batch in batches:
        for first, many in parts(batch.column(0)):
            rows = []
            for text in batch.column(0).slice(first, many).to_pylist():
                spans = base_spans(text or "")
                if any(spans.values()):
                    terms = list(set(_TERM.findall(text.lower())))
                    key = hashlib.sha256(text.encode()).hexdigest()
                    rows += [(e, terms, key) for e in entities(text, spans)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["kind", "terms", "key"])


def entity_terms(docs):
    return docs.select("text").mapInArrow(
        _entity_terms, "kind string, terms array<string>, key string")


def disclosing_terms(docs, generalise=GENERALISE, support=SUPPORT):
    """`(term, kind, disclosed)` from the co-occurrence counts of all documents; `kind` is a kind
    or a value as "kind:value"."""
    rows = ", ".join(["term string", "n long", *[f"{k} long" for k in KINDS]])
    counted = stored(docs.select("text").mapInArrow(_counts, rows).groupBy("term").agg(
        *[F.sum(c).alias(c) for c in ("n", *KINDS)]), "term-counts")
    totals = counted.filter("term is null").first()
    if totals is None:
        return counted.select("term", F.lit("").alias("kind"), F.lit(0.0).alias("disclosed")).limit(0)
    n = totals["n"]
    words = counted.filter("term is not null and not contains(term, ':')")
    # A value in every document can't be disclosed.
    values = stored(counted.filter((F.col("n") >= support) & (F.col("n") < n) & F.contains(
        "term", F.lit(":"))).select(F.col("term").alias("kind"), F.col("n").alias("of")), "values")
    held = attach(entity_terms(docs), values, "kind").select(
        "kind", "of", F.explode("terms").alias("term")).groupBy("kind", "term").agg(
        F.first("of").alias("of"), F.count(F.lit(1)).alias("both")).filter(F.col("both") >= support)
    mutual = F.log(F.col("both") * F.lit(float(n)) / (F.col("n") * F.col("of")))
    found = held.join(words.select("term", "n"), "term").select(
        "term", "kind", (mutual / F.log(F.lit(float(n)) / F.col("of"))).alias("disclosed")).filter(
        F.col("disclosed") >= generalise)
    for kind in KINDS:
        docs_of = totals[kind]
        if docs_of == 0 or docs_of == n:
            # A kind in no document, or in every one, can't be disclosed.
            continue
        mutual = F.log(F.col(kind) * F.lit(float(n)) / (F.col("n") * F.lit(float(docs_of))))
        found = found.union(words.filter(F.col(kind) >= support).select(
            "term", F.lit(kind).alias("kind"),
            (mutual / float(np.log(n / docs_of))).alias("disclosed")).filter(
            F.col("disclosed") >= generalise))
    return stored(found, "terms")


def term_spans(text, spans, shares):
    """`[(start, end, disclosed), ...]` of disclosing terms outside the base spans; `shares` has
    the disclosed share of each term for what the text holds."""
    if not shares:
        return []
    taken = sorted(s for k in KINDS for s in spans[k])
    ends = np.maximum.accumulate([e for _, e in taken]).tolist()
    found = []
    for m in _TERM.finditer(text):
        share = shares.get(m[0].lower(), 0.0)
        if share:
            start, end = m.span()
            before = bisect_left(taken, (end, 0))
            if not before or ends[before - 1] <= start:
                found.append((start, end, share))
    return found


def _with_terms(docs):
    """`docs` with a last column `_shares`, and a function of a text, its spans and that column that
    gives the shares of `term_spans`. Few terms are broadcast and the column is null; more are
    joined to the texts that hold their kind or value."""
    terms = disclosing_terms(docs)
    if terms.count() <= KNOWN:
        known = {}
        for r in terms.collect():
            known.setdefault(r["kind"], {})[r["term"]] = r["disclosed"]
        shared = docs.sparkSession.sparkContext.broadcast(known)

        def looked_up(text, spans, _):
            if not any(spans.values()):
                return {}
            active = [terms for e in entities(text, spans) if (terms := shared.value.get(e))]
            return {t: max(terms.get(t, 0.0) for terms in active)
                    for t in set(_TERM.findall(text.lower()))} if active else {}
        return docs.withColumn("_shares", F.lit(None).cast("map<string,double>")), looked_up
    held = entity_terms(docs).select("key", "kind", F.explode("terms").alias("term")).distinct()
    shares = held.join(terms, ["kind", "term"]).groupBy("key", "term").agg(
        F.max("disclosed").alias("disclosed")).groupBy("key").agg(F.map_from_entries(
            F.collect_list(F.struct("term", "disclosed"))).alias("_shares"))
    # A null text has a key of its own, so that no task gets all of them.
    keyed = docs.withColumn("_key", F.coalesce(
        F.sha2("text", 256), F.monotonically_increasing_id().cast("string")))
    joined = keyed.join(shares.withColumnRenamed("key", "_key"), "_key", "left")
    return joined.select(*docs.columns, "_shares"), lambda text, spans, row: dict(row or ())


def _mark(spans):
    return ",".join(f"{k}:{a}:{b}" for k in spans for a, b in sorted(spans[k]))


FOUND = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         "spans string, n_term long")


def find_personal_data(docs):
    """Spans of every whole text of `docs(doc_id, text)`: base kinds, then disclosing terms as kind
    "term". Null texts are empty and have none; repeated rows count as documents of their own."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    rows, shares = _with_terms(rows)

    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
    names = [f.split()[0] for f in FOUND.split(", ")]

    def run(batches):
        for batch in batches:
            for first, many in parts(batch.column(1)):
                out = []
                for doc, text, row in zip(*(c.to_pylist() for c in batch.slice(first, many).columns)):
                    text = text or ""
                    spans = base_spans(text)
                    base = _mark(spans)
                    terms = [s[:2] for s in term_spans(text, spans, shares(text, spans, row))]
                    out.append((doc, *[len(spans[k]) for k in KINDS],
                                hashlib.sha256(base.encode()).hexdigest(),
                                _mark(spans | {"term": terms}), len(terms)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
    return rows.mapInArrow(run, FOUND)


def cleaned(text, shares, row=None, remove=REMOVE):
    """The text with personal data as `[KIND]`, disclosing terms as `[TERM]` or taken out."""
    spans = base_spans(text)
    cuts = sorted([(a, b, f"[{k.upper()}]") for k in KINDS for a, b in spans[k]] + [
        (a, b, "" if share >= remove else "[TERM]") for a, b, share in
        term_spans(text, spans, shares(text, spans, row))])
    out, at = [], 0
    for a, b, label in cuts:
        if a >= at:
            out += [text[at:a], label]
        elif b > at:
            # Kinds may overlap; what one began the other ends.
            out.append(label)
        at = max(at, b)
    return "".join(out) + text[at:]


def sanitise(docs):
    """`docs` with its texts cleaned, other columns unchanged."""
    rows, shares = _with_terms(docs)
    at = docs.columns.index("text")

    def run(batches):
        for whole in batches:
            for first, many in parts(whole.column(at)):
                batch = whole.slice(first, many)
                text = pa.array([None if t is None else cleaned(t, shares, row) for t, row in zip(
                    batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())],
                    pa.string())
                yield batch.set_column(at, batch.schema.names[at], text).select(
                    batch.schema.names[:-1])
    return rows.mapInArrow(run, docs.schema)
