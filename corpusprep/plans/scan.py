"""Running totals and exact positions without a one-task window.

A window over a whole key (or over no key) sorts that key in one task. Here the ordering
column, a BIGINT, is cut into cells by dropping its low bits. Rows are totalled inside their
cell, the much smaller table of cell totals is accumulated the same way one level up, and the
cell's offset is added back. With a distinct ordering value per row a cell at level i holds at
most 2**(shifts[i] - shifts[i-1]) entries, however the rows are spread over the keys.

Where every key is known to fit in one task the plain window is used instead.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.plans.skew import largest_group

# Positions inside a conversation, session or run.
WITHIN_KEY = (12, 28)
# Any 64-bit id, no key: at most 2**20 entries on the last level.
WHOLE_TABLE = (12, 28, 44)
# A uniformly hashed 60-bit key: 65,536 cells of equal size.
HASHED = (44,)
# Rows of one key that one task sorts in a plain window; rows may carry text.
PLAIN_ROWS = 1 << 16

CELL = "_cell"


def fits_in_task(df, keys):
    """Whether every key is small enough for a plain window. Runs one counting job."""
    return largest_group(df, keys) <= PLAIN_ROWS


def _exclusive_sum(value, window):
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0).cast("bigint"))


def cell_offsets(cells, keys, values, shifts, cell=CELL):
    """Sum of every earlier cell of the same key, for a table of cell totals."""
    if len(shifts) == 1:
        scope = keys or [F.lit(0)]
        window = Window.partitionBy(*scope).orderBy(cell)
        return cells.select(*keys, cell, *[_exclusive_sum(v, window).alias(v) for v in values])
    up = f"{cell}u"
    cells = cells.withColumn(up, F.shiftright(cell, shifts[1] - shifts[0]))
    parents = cells.groupBy(*keys, up).agg(*[F.sum(v).alias(v) for v in values])
    base = cell_offsets(parents, keys, values, shifts[1:], up)
    base = base.select(*keys, up, *[F.col(v).alias(f"_base_{v}") for v in values])
    window = Window.partitionBy(*keys, up).orderBy(cell)
    inner = cells.select(*keys, up, cell, *[_exclusive_sum(v, window).alias(v) for v in values])
    return inner.join(base, [*keys, up], "left").select(
        *keys, cell, *[(F.col(v) + F.coalesce(f"_base_{v}", F.lit(0))).alias(v) for v in values])


def running_total(df, keys, order, values, shifts=None, ties=(), plain=False):
    """Add, for each `{out: value}` pair, the sum of `value` over the rows before this one.

    `order` is a BIGINT Column (use `F.bitwise_not` for descending order) and has to be distinct
    within `keys` up to `ties`. Keys must not be null. `plain` says that every key fits in a task
    (see `fits_in_task`).
    """
    if plain:
        window = Window.partitionBy(*keys).orderBy(order, *ties)
        return df.withColumns({out: _exclusive_sum(v, window) for out, v in values.items()})
    shifts = shifts or WITHIN_KEY
    names = [f"_v_{out}" for out in values]
    kept = df.columns
    df = df.withColumn(CELL, F.shiftright(order, shifts[0])).withColumns(
        {f"_v_{out}": F.coalesce(value, F.lit(0)) for out, value in values.items()})
    totals = df.groupBy(*keys, CELL).agg(*[F.sum(v).alias(v) for v in names])
    offsets = cell_offsets(totals, keys, names, shifts)
    # First cells start at zero. Without them the table is small, often small enough to broadcast.
    offsets = offsets.filter(" OR ".join(f"`{v}` <> 0" for v in names)).select(
        *keys, CELL, *[F.col(v).alias(f"_off{v}") for v in names])
    window = Window.partitionBy(*keys, CELL).orderBy(order, *ties)
    inner = df.select(*kept, CELL, *[_exclusive_sum(v, window).alias(v) for v in names])
    return inner.join(offsets, [*keys, CELL], "left").select(
        *kept, *[(F.col(f"_v_{out}") + F.coalesce(f"_off_v_{out}", F.lit(0))).alias(out)
                 for out in values])


def position(df, keys, order, out="position", shifts=WHOLE_TABLE, ties=(), plain=False):
    """Exact 0-based position of each row in `order`, within `keys` (which may be empty)."""
    return running_total(df, keys, order, {out: F.lit(1).cast("bigint")}, shifts, ties, plain)
