"""Operators over tables of vectors (V2-V6)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.constants import BALANCE_WEIGHT, Z_WEIGHT
from corpusprep.functions.hashing import draw_normal
from corpusprep.functions.vectors import doubles
from corpusprep.plans.scan import position
from corpusprep.plans.skew import join_per_key

# Centroids are compared in blocks of this many; one block is what a task holds in memory.
BLOCK = 4096
# A table of vectors is broadcast up to this size.
BROADCAST_BYTES = 64 << 20
_SCORES = "vec_id bigint, expert_id bigint, score double"


def _matrix(column, dtype="float64"):
    """Arrow list column of equal lengths as a 2-d array."""
    import numpy as np
    import pyarrow as pa
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype)


def _blocks(centroids):
    """Centroids in id order, at most BLOCK per list; a single list in the usual case."""
    rows = centroids.select("expert_id", doubles("vec").alias("vec"))
    head = rows.orderBy("expert_id").limit(BLOCK + 1).collect()
    if len(head) <= BLOCK:
        yield head
        return
    placed = position(rows, [], F.col("expert_id"), "_at")
    count = placed.count()
    for first in range(0, count, BLOCK):
        yield placed.filter(F.col("_at").between(first, first + BLOCK - 1)).orderBy("_at").drop(
            "_at").collect()


def _score_block(vectors, block, keep):
    """Dot products with one block of centroids, the best `keep` per vector."""
    ids = [r["expert_id"] for r in block]
    shared = vectors.sparkSession.sparkContext.broadcast((ids, [r["vec"] for r in block]))

    def score(batches):
        import numpy as np
        import pyarrow as pa
        names, rows = shared.value
        names, table = np.array(names, dtype="int64"), np.array(rows, dtype="float64")
        width = min(keep, len(names))
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = _matrix(batch.column("vec")) @ table.T
            # Stable, so equal scores keep ascending expert id.
            best = np.argsort(-scores, axis=1, kind="stable")[:, :width]
            yield pa.record_batch({
                "vec_id": np.repeat(batch.column("vec_id").to_numpy(), width),
                "expert_id": names[best].ravel(),
                "score": np.take_along_axis(scores, best, 1).ravel()})

    return vectors.select("vec_id", "vec").mapInArrow(score, _SCORES)


def score_experts(vectors, centroids):
    """Every dot product: `vec_id, expert_id, score`."""
    parts = [_score_block(vectors, b, len(b)) for b in _blocks(centroids) if b]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_ASSIGNED = "vec_id bigint, rank int, expert_id bigint, score double, weight double"


def _assign_block(vectors, block, keep):
    """Ranks and weights straight from one block that holds every centroid."""
    ids = [r["expert_id"] for r in block]
    shared = vectors.sparkSession.sparkContext.broadcast((ids, [r["vec"] for r in block]))

    def assign(batches):
        import numpy as np
        import pyarrow as pa
        names, rows = shared.value
        names, table = np.array(names, dtype="int64"), np.array(rows, dtype="float64")
        width = min(keep, len(names))
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = _matrix(batch.column("vec")) @ table.T
            best = np.argsort(-scores, axis=1, kind="stable")[:, :width]
            kept = np.take_along_axis(scores, best, 1)
            share = np.exp(kept - kept[:, :1])
            yield pa.record_batch({
                "vec_id": np.repeat(batch.column("vec_id").to_numpy(), width),
                "rank": np.tile(np.arange(1, width + 1, dtype="int32"), len(best)),
                "expert_id": names[best].ravel(), "score": kept.ravel(),
                "weight": (share / share.sum(axis=1, keepdims=True)).ravel()})

    return vectors.select("vec_id", "vec").mapInArrow(assign, _ASSIGNED)


def top_k_assign(vectors, centroids, k=2):
    """The k best centroids of each vector, weighted by a softmax over those k only.

    `vec_id, rank, expert_id, score, weight`. Up to BLOCK centroids need no shuffle. Beyond, vectors
    are read once per block and only k candidates per block are shuffled.
    """
    blocks = [b for b in _blocks(centroids) if b]
    if len(blocks) == 1:
        return _assign_block(vectors, blocks[0], k)
    parts = [_score_block(vectors, b, k) for b in blocks]
    best = parts[0]
    for part in parts[1:]:
        best = best.unionByName(part)
    order = Window.partitionBy("vec_id").orderBy(F.desc("score"), "expert_id")
    every = Window.partitionBy("vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    share = F.exp(F.col("score") - F.max("score").over(every))
    return ranked.withColumn("_e", share).withColumn(
        "weight", F.col("_e") / F.sum("_e").over(every)).drop("_e")


def _with_vectors(rows, table, key, spread_by):
    """Join the vector of `key` to each row, null where there is none: broadcast up to a checked
    size, else spread."""
    count, width = table.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if count * (width or 0) * 8 <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), key, "left")
    return join_per_key(rows, table, [key], spread_by, "left")


def weighted_combine(assignments, values, shared=None):
    """Sum of weight times the assigned expert's vector, plus `shared(vec_id, vec)` when given."""
    picked = _with_vectors(assignments.select("vec_id", "expert_id", "weight"),
                           values.select("expert_id", doubles("vec").alias("vec")),
                           "expert_id", ["vec_id"])
    picked = picked.withColumn("vec", F.when(F.col("vec").isNotNull(), F.col("vec")).otherwise(
        F.raise_error(F.concat(F.lit("no vector for expert "), F.col("expert_id").cast("string")))))
    if shared is not None:
        picked = picked.unionByName(shared.select(
            "vec_id", F.lit(-1).cast("bigint").alias("expert_id"), F.lit(1.0).alias("weight"),
            doubles("vec").alias("vec")))
    # At most k + 1 vectors per id.
    parts = picked.groupBy("vec_id").agg(F.array_sort(F.collect_list(
        F.struct("expert_id", "weight", "vec"))).alias("parts"))
    scaled = F.transform("parts", lambda p: F.transform(p["vec"], lambda x: x * p["weight"]))
    total = F.aggregate(F.slice(F.col("_s"), F.lit(2), F.size("_s")), F.element_at("_s", 1),
                        lambda s, v: F.zip_with(s, v, lambda a, b: a + b))
    return parts.withColumn("_s", scaled).select("vec_id", total.alias("vec"))


def assignment_balance(scores):
    """How evenly vectors spread over experts: one row `n, balance, z_loss, total`.

    `scores(vec_id, expert_id, score)` holds one row per vector and expert, so a vector's window
    is as small as the number of experts.
    """
    vector = Window.partitionBy("vec_id")
    top = scores.withColumn("_m", F.max("score").over(vector))
    summed = top.withColumns({"_e": F.exp(F.col("score") - F.col("_m"))}).withColumns(
        {"_s": F.sum("_e").over(vector), "_n": F.count(F.lit(1)).over(vector)})
    lse = F.col("_m") + F.log("_s")
    per_expert = summed.groupBy("expert_id").agg(
        F.sum(F.col("_e") / F.col("_s")).alias("load"), F.sum(lse * lse / F.col("_n")).alias("z"),
        F.sum(1.0 / F.col("_n")).alias("vectors"))
    return _balance(per_expert)


def _balance(per_expert):
    overall = per_expert.agg(
        F.count(F.lit(1)).alias("n_experts"), F.sum("load").alias("load"),
        F.sum(F.col("load") * F.col("load")).alias("squares"), F.sum("z").alias("z"),
        F.sum("vectors").alias("vectors"))
    balance = F.col("n_experts") * F.col("squares") / (F.col("load") * F.col("load"))
    return overall.select("n_experts", balance.alias("balance"),
                          (F.col("z") / F.col("vectors")).alias("z_loss")).withColumn(
        "total", BALANCE_WEIGHT * F.col("balance") + Z_WEIGHT * F.col("z_loss"))


def vector_balance(vectors, centroids):
    """`assignment_balance` of all vectors against all centroids. Up to BLOCK centroids every task
    adds up its own vectors, and one row per centroid and task is shuffled."""
    blocks = [b for b in _blocks(centroids) if b]
    if len(blocks) != 1:
        return assignment_balance(score_experts(vectors, centroids))
    shared = vectors.sparkSession.sparkContext.broadcast([r["vec"] for r in blocks[0]])

    def added(batches):
        import numpy as np
        import pyarrow as pa
        table = np.array(shared.value, dtype="float64")
        load, z, n = np.zeros(len(table)), 0.0, 0
        for batch in batches:
            if batch.num_rows:
                scores = _matrix(batch.column("vec")) @ table.T
                top = scores.max(axis=1, keepdims=True)
                share = np.exp(scores - top)
                total = share.sum(axis=1, keepdims=True)
                load += (share / total).sum(axis=0)
                z += float(((top + np.log(total)) ** 2).sum())
                n += len(scores)
        first = np.arange(len(table)) == 0
        yield pa.record_batch({"at": np.arange(len(table)), "load": load,
                               "z": np.where(first, z, 0.0), "vectors": np.where(first, n, 0)})

    per_expert = vectors.select("vec_id", "vec").mapInArrow(
        added, "at bigint, load double, z double, vectors bigint").groupBy("at").agg(
        *[F.sum(c).alias(c) for c in ("load", "z", "vectors")])
    return _balance(per_expert)


def embedding_lookup(tokens, table):
    """`row_id, pos, token, vec` for `tokens(row_id, ids)` and `table(token, vec)`; `vec` is null
    for a token that the table lacks."""
    flat = tokens.select("row_id", F.posexplode("ids").alias("pos", "token"))
    return _with_vectors(flat, table.select("token", "vec"), "token", ["row_id", "pos"])


def grow_table(table, new_size, dim, seed, std=0.02):
    """Old rows as they are, then rows drawn from N(0, std) up to `new_size`."""
    old_size = table.agg(F.coalesce(F.max("token") + 1, F.lit(0))).scalar()
    added = table.sparkSession.range(new_size).filter(F.col("id") >= old_size)
    draws = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.lit(std) * draw_normal(
        seed, "grow", [F.col("id"), i]))
    return table.select(F.col("token").cast("bigint").alias("token"), doubles("vec").alias("vec")) \
        .unionByName(added.select(F.col("id").alias("token"), draws.alias("vec")))


def causal_window_average(seq, window=128, query="vec", key="vec", value="vec", block=1024):
    """Softmax-weighted average of the rows `pos - window .. pos` of the same sequence.

    `seq(seq_id, pos, ...)` with 0-based distinct positions. A sequence is cut into blocks of
    positions; the last `window` rows of a block are also sent to the next one. So a task sees
    `block + window` rows at most, one shuffle moves little more than the input, and no pair of
    rows ever becomes a row.
    """
    block = max(block, window)
    own = F.floor(F.col("pos") / block)
    spill = F.col("pos") % block >= block - window
    homes = F.when(spill, F.array(own, own + 1)).otherwise(F.array(own))
    spread = seq.select(
        "seq_id", F.col("pos").cast("bigint").alias("pos"), F.explode(homes).alias("block"),
        doubles(query).alias("q"), doubles(key).alias("k"), doubles(value).alias("v"))

    def average(group_key, table):
        import numpy as np
        import pyarrow as pa
        this = group_key[1].as_py()
        table = table.sort_by("pos")
        pos = table.column("pos").to_numpy()
        mine = pos // block == this
        q, k, v = (_matrix(table.column(c)) for c in ("q", "k", "v"))
        at = pos[mine]
        scores = q[mine] @ k.T / np.sqrt(k.shape[1])
        visible = (pos[None, :] <= at[:, None]) & (pos[None, :] >= at[:, None] - window)
        scores = np.where(visible, scores, -np.inf)
        out = np.zeros((0, v.shape[1]))
        if len(at):
            weights = np.exp(scores - scores.max(axis=1, keepdims=True))
            out = (weights / weights.sum(axis=1, keepdims=True)) @ v
        offsets = np.arange(len(at) + 1, dtype="int32") * v.shape[1]
        seq_id = table.column("seq_id").combine_chunks().filter(pa.array(mine))
        return pa.table({"seq_id": seq_id, "pos": at,
                         "vec": pa.ListArray.from_arrays(offsets, out.ravel())})

    kind = seq.schema["seq_id"].dataType.simpleString()
    return spread.groupBy("seq_id", "block").applyInArrow(
        average, f"seq_id {kind}, pos bigint, vec array<double>")
