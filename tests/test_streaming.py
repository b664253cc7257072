"""Streams give what the batch operators give, over several micro-batches and a restart."""

from pyspark.sql import functions as F

from corpusprep.functions.chars import CharTokenizer
from corpusprep.operators.context import trim_history
from corpusprep.operators.metrics import curriculum_gate, perplexity
from corpusprep.queries.metric_queries import attempts, loss_log
from corpusprep.streaming import live
from tests.conftest import SF


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()))


def feed(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_sessions(spark, given, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    def run():
        stream = live.stream_session_context(feed(spark, given.schema, src), CharTokenizer(), 600)
        return live.run_to_completion(stream, out, state)
    # Two interleaved parts, then a restart from the checkpoint with the rest.
    given.filter("turn < 1").coalesce(1).write.parquet(src)
    given.filter("turn between 1 and 2").coalesce(1).write.mode("append").parquet(src)
    run()
    given.filter("turn > 2").coalesce(1).write.mode("append").parquet(src)
    assert rows(run()) == rows(trim_history(given, CharTokenizer(), 600))


def test_clear_forgets(spark, turns, tmp_path):
    said = turns({1: [("user", "a"), ("assistant", "b"), ("command", "clear"), ("user", "c"),
                      ("assistant", "d"), ("user", "e")]})
    src = str(tmp_path / "src")
    said.coalesce(1).write.parquet(src)
    stream = live.stream_session_context(feed(spark, said.schema, src), CharTokenizer())
    got = live.run_to_completion(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    assert [r.context for r in got.orderBy("turn").collect()] == [
        "<user>a<assistant>", "<user>c<assistant>", "<user>c<assistant>d<user>e<assistant>"]


def test_gate(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    def run():
        return live.run_to_completion(
            live.stream_curriculum_gate(attempts(feed(spark, events.schema, src))), out, state)
    events.filter("event_id < 300").coalesce(1).write.parquet(src)
    run()
    events.filter("event_id >= 300").coalesce(1).write.mode("append").parquet(src)
    assert rows(run()) == rows(curriculum_gate(attempts(events)))


def test_gate_states_travel_with_rows(spark, tmp_path):
    """A run's state comes in the batch of its rows: one stateful step without a server for state
    calls, which took most of the time where runs are many. Stages go on across batches."""
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    schema = "run long, attempt long, ppl double"
    first = [(r, a, 60.0 if a else 40.0) for r in range(300) for a in range(3)]
    later = [(r, a, p) for r in range(300) for a, p in ((3, 24.0), (4, 99.0), (5, 14.0), (6, 1.0))]
    for part in (first, later):
        given = spark.createDataFrame(part, schema)
        given.coalesce(1).write.mode("append").parquet(src)
        gated = live.stream_curriculum_gate(feed(spark, given.schema, src))
        plan = gated._jdf.queryExecution().analyzed().toString()
        assert "FlatMapGroupsInPandasWithState" in plan and "TransformWithState" not in plan
        got = live.run_to_completion(gated, out, state)
    assert rows(got) == rows(curriculum_gate(spark.createDataFrame(first + later, schema)))


def test_windows(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    log = loss_log(events)
    src = str(tmp_path / "src")
    events.coalesce(1).write.parquet(src)
    got = live.run_to_completion(live.stream_perplexity(loss_log(feed(
        spark, events.schema, src)), "1 day"),
        str(tmp_path / "out"), str(tmp_path / "state"))
    timed = log.withColumn("window_start", F.date_trunc("day", "ts").cast("timestamp"))
    want = perplexity(timed, ("run", "window_start"))
    closed = log.agg(F.max("ts").cast("timestamp") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    want = want.filter(F.col("window_start") + F.expr("INTERVAL 1 DAY") <= F.lit(closed))
    keys = ["run", "window_start", "tokens"]
    ppl = F.round("ppl", 9).alias("ppl")
    assert rows(got.select(*keys, ppl)) == rows(want.select(*keys, ppl))
