"""ST1-ST3: the given tables as file streams of several batches, run until all is processed."""

from pyspark.sql import functions as F

from corpusprep.functions.chars import CharTokenizer
from corpusprep.plans.lineage import scratch_path
from corpusprep.queries.context_queries import TRIM_SQL
from corpusprep.queries.metric_queries import GATE_SQL, attempts, loss_log
from corpusprep.queries.registry import query, table
from corpusprep.session import SETTINGS
from corpusprep.streaming import live

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


BATCHES = 3
# Rows of a slice that one task writes.
FILE_ROWS = 1 << 20


def _stream(spark, sf_dir, name, order):
    """A table as a stream of BATCHES micro-batches, in the order of a numeric expression; rows for
    which it is null come first."""
    spark.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    rows = table(spark, sf_dir, name)
    path = scratch_path(spark, "stream")
    cuts = rows.select(F.expr(order).cast("double").alias("at")).approxQuantile(
        "at", [k / BATCHES for k in range(1, BATCHES)], 0.01)
    edges = [None, *cuts, None]
    at = F.expr(order).cast("double")
    # Every slice has as many files, which the source takes together.
    files = rows.count() // (BATCHES * FILE_ROWS) + 1
    # The source takes files by age, so the slices are written one after another.
    for low, high in zip(edges, edges[1:]):
        part = rows if low is None else rows.filter(at > low)
        part = part if high is None else part.filter((at <= high) if low is not None else (
            at.isNull() | (at <= high)))
        part = part.coalesce(1) if files == 1 else part.repartition(files)
        part.write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _run(spark, stream):
    return live.run_to_completion(stream, scratch_path(spark, "out"), scratch_path(spark, "state"))


@query("stream_session_context", TRIM_SQL)
def stream_session_context(spark, sf_dir):
    turns = _stream(spark, sf_dir, "conversations", "turn")
    return _run(spark, live.stream_session_context(turns, CharTokenizer()))


@query("stream_curriculum_gate", GATE_SQL)
def stream_curriculum_gate(spark, sf_dir):
    gated = live.stream_curriculum_gate(attempts(_stream(spark, sf_dir, "events", "event_id")))
    return _run(spark, gated).withColumn("stage", F.col("stage").cast("bigint"))


@query("stream_perplexity", """
SELECT user_id AS run, date_trunc('day', ts)::TIMESTAMP AS window_start,
       sum(event_id % 7)::BIGINT AS tokens,
       CASE WHEN sum(event_id % 7) > 0
            THEN round(exp(sum(value / 100 * (event_id % 7)) / sum(event_id % 7)), 6) + 0.0::DOUBLE
            ELSE 'infinity'::DOUBLE END AS ppl
FROM events GROUP BY 1, 2
HAVING date_trunc('day', any_value(ts)) + INTERVAL 1 DAY
       <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_perplexity(spark, sf_dir):
    """Windows the watermark has closed, which are the ones append mode emits."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    log = loss_log(_stream(spark, sf_dir, "events", "cast(ts as timestamp)"))
    return _run(spark, live.stream_perplexity(log, "1 day")).select(
        "run", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "tokens",
        F.round("ppl", 6).alias("ppl"))
