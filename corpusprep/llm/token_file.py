"""Token ids in a compact binary table: static range asymmetric numeral systems.

Format. A folder with two Parquet tables. `table` holds the shared frequencies, one row per token
id that occurs, scaled to sum to 2**18 over all documents. `blocks` holds self-contained blocks of
whole documents in ascending doc_id order: `part` and `block` (their order), `doc_ids` and
`lengths` (the documents inside), `n_tokens`, and `payload`. A payload is little-endian:

    magic b"RANS", version u32, lanes u32, sections u32, crc32 of what follows u32
    per section: tokens u32, words u32, crc32 of its ids u32
    per section: 64-bit state of each lane (the checkpoint), then its 32-bit words

Token t of a section is coded by lane t modulo `lanes`, all lanes sharing one stream of words, so
coder and decoder are plain numpy over lanes. Every section starts from its own states and can be
decoded alone; every block needs nothing but the shared table.
"""

import os
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusprep.llm.common import discard, stored
from corpusprep.llm.token_ids import word_ids

BITS = 18
LANES = 1024
SECTION = 1 << 18
BLOCK = 1 << 20
_LOW = np.uint64(1 << 31)
_HEAD, _PART = "<4sIIII", "<III"


def scaled(counts, bits=BITS):
    """Frequencies of sum 2**bits, at least one wherever `counts` is positive."""
    counts = np.asarray(counts, dtype=np.float64)
    out = np.zeros(len(counts), dtype=np.int64)
    used = np.flatnonzero(counts)
    if len(used) > 1 << bits:
        raise ValueError("more symbols than frequency slots")
    if len(used):
        out[used] = np.maximum(1, np.floor(counts[used] / counts.sum() * (1 << bits)))
        # The remainder goes to, or comes from, the largest, one pass after another.
        order = used[np.argsort(-counts[used], kind="stable")]
        off = (1 << bits) - int(out.sum())
        while off > 0:
            take = order[:off]
            out[take] += 1
            off -= len(take)
        while off < 0:
            take = order[out[order] > 1][:-off]
            out[take] -= 1
            off += len(take)
    return out


class Coder:
    """Coder and decoder of one frequency table, `freq[id]` summing to 2**bits."""

    def __init__(self, freq, bits=BITS, lanes=LANES):
        self.bits, self.lanes = np.uint64(bits), lanes
        self.freq = np.asarray(freq, dtype=np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - bits)
        self.symbol = np.repeat(np.arange(len(freq)), np.asarray(freq, dtype=np.int64))

    def encode(self, ids):
        """States of all lanes and the words of a section."""
        lanes, bits = self.lanes, self.bits
        x = np.full(lanes, _LOW, dtype=np.uint64)
        words = []
        for at in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
            s = ids[at:at + lanes]
            live = x[:len(s)]
            full = live >= self.limit[s]
            if full.any():
                words.append(live[full].astype("<u4"))
                live = np.where(full, live >> np.uint64(32), live)
            whole, rest = np.divmod(live, self.freq[s])
            x[:len(s)] = (whole << bits) + rest + self.start[s]
        return x, np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")

    def decode(self, x, words, n):
        lanes, bits = self.lanes, self.bits
        x, words = x.copy(), words.astype(np.uint64)
        mask, out, read = np.uint64((1 << int(bits)) - 1), np.empty(n, dtype="<u4"), 0
        for at in range(0, n, lanes):
            live = x[:min(lanes, n - at)]
            slot = live & mask
            s = self.symbol[slot]
            out[at:at + len(live)] = s
            live[:] = self.freq[s] * (live >> bits) + slot - self.start[s]
            low = np.flatnonzero(live < _LOW)
            if len(low):
                live[low] = (live[low] << np.uint64(32)) | words[read:read + len(low)]
                read += len(low)
        return out

    def pack(self, ids):
        heads, bodies = [], []
        for at in range(0, len(ids), SECTION):
            part = ids[at:at + SECTION]
            x, words = self.encode(part)
            heads.append(struct.pack(_PART, len(part), len(words), zlib.crc32(part.astype("<u4"))))
            bodies += [x.astype("<u8").tobytes(), words.tobytes()]
        rest = b"".join(heads + bodies)
        return struct.pack(_HEAD, b"RANS", 1, self.lanes, len(heads), zlib.crc32(rest)) + rest

    def unpack(self, payload):
        magic, version, lanes, parts, crc = struct.unpack_from(_HEAD, payload)
        if (magic, version, lanes) != (b"RANS", 1, self.lanes) or zlib.crc32(
                memoryview(payload)[struct.calcsize(_HEAD):]) != crc:
            raise ValueError("damaged token block")
        heads = [struct.unpack_from(_PART, payload, struct.calcsize(_HEAD) + k * struct.calcsize(_PART)) for k in range(parts)]
        at, found = struct.calcsize(_HEAD) + parts * struct.calcsize(_PART), []
        for n, w, check in heads:
            x = np.frombuffer(payload, "<u8", lanes, at)
            words = np.frombuffer(payload, "<u4", w, at + 8 * lanes)
            at += 8 * lanes + 4 * w
            found.append(self.decode(x, words, n))
            if zlib.crc32(found[-1]) != check:
                raise ValueError("damaged token section")
        return np.concatenate(found) if found else np.zeros(0, "<u4")


RAW = "part long, block long, doc_ids array<long>, lengths array<long>, n_tokens long, ids binary"
BLOCKS = RAW.replace("ids binary", "payload binary")
DOCS = "part long, block long, doc_id long, inside long, n_tokens long, ids_crc32 long"


def _row_batch(schema, **columns):
    return pa.RecordBatch.from_pydict(columns, schema=schema)


def _arrow(raw_name):
    many = pa.list_(pa.int64())
    return pa.schema([("part", pa.int64()), ("block", pa.int64()), ("doc_ids", many),
                      ("lengths", many), ("n_tokens", pa.int64()), (raw_name, pa.binary())])


def _raw_blocks(tokenizer, end_id):
    schema = _arrow("ids")

    def run(batches):
        from pyspark import TaskContext
        encode, part = word_ids(tokenizer).encode_all, TaskContext.get().partitionId()
        end, block = np.array([end_id], "<u2").tobytes(), 0
        docs, sizes, pieces, n = [], [], [], 0

        def row():
            return _row_batch(schema, part=[part], block=[block], doc_ids=[docs],
                              lengths=[sizes], n_tokens=[n], ids=[b"".join(pieces)])

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                ids += end
                docs.append(doc)
                sizes.append(len(ids) // 2)
                pieces.append(ids)
                n += len(ids) // 2
                if n >= BLOCK:
                    yield row()
                    block += 1
                    docs, sizes, pieces, n = [], [], [], 0
        if docs:
            yield row()
    return run


def _counted(vocab):
    def run(batches):
        total = np.zeros(vocab, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), "<u2"), minlength=vocab)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])
    return run


def write_token_file(docs, path, tokenizer, end_id):
    """Encode every whole text of `docs(doc_id, text)`, each followed by `end_id`.

    A null text is empty, so its document is the end id alone; null doc_ids come first; rows that
    share a doc_id stay separate documents in text order. An empty table gives an empty file.
    """
    spark = docs.sparkSession
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(
        "doc_id").sortWithinPartitions("doc_id", "text")
    raw = stored(ordered.mapInArrow(_raw_blocks(tokenizer, end_id), RAW), "token-ids")
    # The counts of all documents: one row per token id and task, summed; bounded by the ids.
    counts = raw.select("ids").mapInArrow(_counted(1 << 16), "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")).collect()
    full = np.zeros(max((r["id"] for r in counts), default=0) + 1, dtype=np.int64)
    for r in counts:
        full[r["id"]] = r["n"]
    freq = scaled(full)
    schema = _arrow("payload")

    def encoded(batches):
        coder = Coder(freq)
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                ids = np.frombuffer(one.column(5)[0].as_buffer(), "<u2")
                yield pa.RecordBatch.from_arrays(
                    [*one.columns[:5], pa.array([coder.pack(ids)], pa.binary())], schema=schema)

    spark.createDataFrame(pd.DataFrame({"id": np.arange(len(freq)), "freq": freq})).coalesce(
        1).write.parquet(os.path.join(path, "table"))
    raw.mapInArrow(encoded, BLOCKS).write.option("compression", "uncompressed").parquet(
        os.path.join(path, "blocks"))
    discard(raw)


def _blocks(spark, path):
    return spark.read.schema(BLOCKS).parquet(os.path.join(path, "blocks"))


def _decoded(spark, path, per_doc, schema):
    table = spark.read.schema("id long, freq long").parquet(
        os.path.join(path, "table")).orderBy("id").collect()
    freq = np.array([r["freq"] for r in table], dtype=np.int64)

    def run(batches):
        coder = Coder(freq)
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, docs, sizes, _, payload = (c[row].as_py() for c in batch.columns)
                ids = coder.unpack(payload)
                at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                columns = [[part] * len(docs), [block] * len(docs), docs, at[:-1], sizes,
                           [per_doc(ids[a:b]) for a, b in zip(at[:-1], at[1:])]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names)
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    names, types = [f[0] for f in fields], [kinds[f[1]] for f in fields]
    found = _blocks(spark, path).mapInArrow(run, schema)
    # Ids before a block: totals of the parts before it, and of the blocks before it in its part.
    sizes = _blocks(spark, path).select("part", "block", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("part", "block", F.coalesce(
        F.sum("n_tokens").over(inner), F.lit(0)).alias("more")).join(parts, "part")
    return found.join(starts, ["part", "block"]).withColumn(
        "start", F.col("base") + F.col("more") + F.col("inside"))


def read_token_digests(spark, path):
    """Per document: doc_id, start, n_tokens, ids_crc32, all from the decoded blocks."""
    return _decoded(spark, path, zlib.crc32, DOCS).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def read_token_file(spark, path):
    """Per document: doc_id, start, n_tokens and the decoded ids."""
    return _decoded(spark, path, lambda ids: ids.tolist(), DOCS.replace(
        "ids_crc32 long", "ids array<long>")).select("doc_id", "start", "n_tokens", "ids")
