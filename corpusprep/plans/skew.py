"""Telling bounded groups from hot ones, and joining one row per key back to a hot key's rows.

Both start with one counting job that reads the key columns only and combines before its
shuffle. When no key is hot, which is the usual case, the plan stays the plain one.
"""

from pyspark.sql import functions as F

from corpusprep.plans.lineage import cut

# Rows of one key that one task may sort.
TASK_ROWS = 1 << 20
# Hot keys are broadcast up to this many; a longer list is joined like any other table.
HOT_KEYS = 4096
SALTS = 256


def largest_group(df, keys):
    """Rows of the most frequent key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.max("_n")).first()[0] or 0


def hot_keys(df, keys, rows=None):
    """All keys of more than `rows` rows, or None: a local table, with a broadcast hint, of up to
    HOT_KEYS rows, else a written one."""
    rows = TASK_ROWS if rows is None else rows
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > rows).select(*keys)
    found = hot.limit(HOT_KEYS + 1).collect()
    if not found:
        return None
    if len(found) > HOT_KEYS:
        return cut(hot)
    schema = df.select(*keys).schema
    return F.broadcast(df.sparkSession.createDataFrame(
        [tuple(r[k] for k in keys) for r in found], schema))


_SEARCH = object()


def join_per_key(rows, per_key, keys, spread_by, how="inner", hot=_SEARCH, salts=SALTS):
    """Join `per_key` (one row per key) to `rows`, spreading each hot key over `salts` tasks.

    Cold keys join as usual. A hot key's single row is copied once per salt, and its rows pick a
    salt from `spread_by`, so no task receives a whole hot key.
    """
    if hot is _SEARCH:
        hot = hot_keys(rows, keys)
    if hot is None:
        return rows.join(per_key, keys, how)
    hot = hot.withColumn("_hot", F.lit(True))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(0)
    left = rows.join(hot, keys, "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0)))
    right = per_key.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
