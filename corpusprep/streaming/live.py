"""Structured Streaming forms of context trimming, the curriculum gate and perplexity (ST1-ST3).

State is kept per session or run and bounded: a session holds at most the token budget plus one
exchange, a run one number. Rows of a micro-batch are put in order inside their key, so the size
of a micro-batch (`maxFilesPerTrigger`, `maxBytesPerTrigger`) bounds what a task holds.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from corpusprep.constants import MAX_HISTORY_TOKENS, STAGES
from corpusprep.functions.templates import render_message
from corpusprep.operators.metrics import perplexity

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

CONTEXT = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("context", T.StringType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("n_exchanges", T.LongType())])

GATED = T.StructType([
    T.StructField("run", T.LongType()), T.StructField("attempt", T.LongType()),
    T.StructField("ppl", T.DoubleType()), T.StructField("stage", T.IntegerType()),
    T.StructField("passed", T.BooleanType())])


def _in_order(frames, column):
    parts = [f for f in frames if len(f)]
    return pd.concat(parts).sort_values(column) if parts else None


class SessionContext(StatefulProcessor):
    """Emits the trimmed context of each user message; keeps the exchanges that still fit."""

    def __init__(self, max_tokens, tag_tokens, ttl_ms):
        self.max_tokens, self.tag_tokens, self.ttl_ms = max_tokens, tag_tokens, ttl_ms

    def init(self, handle):
        piece = T.StructType([T.StructField("text", T.StringType()),
                              T.StructField("n", T.LongType())])
        waiting = T.StructType([T.StructField("turn", T.LongType()), *piece.fields])
        self.history = handle.getListState("history", piece, self.ttl_ms)
        self.waiting = handle.getValueState("waiting", waiting, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        ordered = _in_order(rows, "turn")
        if ordered is None:
            return
        history = [tuple(p) for p in self.history.get()] if self.history.exists() else []
        waiting = self.waiting.get() if self.waiting.exists() else None
        used, out = sum(n for _, n in history), []
        for turn, role, text, n in zip(ordered["turn"], ordered["role"], ordered["text"],
                                       ordered["n_tokens"]):
            turn, n = int(turn), int(n)
            if role == "command" and text == "clear":
                history, used, waiting = [], 0, None
            elif role == "user":
                current, size = f"<user>{text}<assistant>", n + self.tag_tokens
                while history and used + size > self.max_tokens:
                    used -= history.pop(0)[1]
                out.append((key[0], turn, "".join(t for t, _ in history) + current, used + size,
                            len(history)))
                waiting = (turn, f"<user>{text}", n)
            else:
                if role == "assistant" and waiting is not None and waiting[0] == turn - 1:
                    history.append((f"{waiting[1]}<assistant>{text}", waiting[2] + n))
                    used += history[-1][1]
                waiting = None
        self.history.put(history) if history else self.history.clear()
        self.waiting.update(waiting) if waiting else self.waiting.clear()
        yield pd.DataFrame(out, columns=CONTEXT.fieldNames())

    def close(self):
        pass


def _gate(thresholds):
    """Places each attempt in its stage; the state is the stage a run has reached."""
    def run(key, frames, state):
        stage, parts = state.get[0] if state.exists else 1, []
        # A frame costs more to make than most runs have rows, so sorting is done on arrays.
        frames = [f for f in frames if len(f)]
        attempt = np.concatenate([f["attempt"].to_numpy() for f in frames])
        ppl = np.concatenate([f["ppl"].to_numpy(dtype="float64") for f in frames])
        order = np.argsort(attempt)
        attempt, ppl, at = attempt[order], ppl[order], 0
        while stage <= len(thresholds) and at < len(ppl):
            good = ppl[at:] <= thresholds[stage - 1]
            end = at + int(good.argmax()) + 1 if good.any() else len(ppl)
            passed = np.zeros(end - at, dtype=bool)
            passed[-1] = good[end - at - 1]
            parts.append((attempt[at:end], ppl[at:end], stage, passed))
            stage += int(passed[-1])
            at = end
        state.update((stage,))
        if parts:
            attempts, values, stages, passed = zip(*parts)
            yield pd.DataFrame({
                "run": [key[0]] * at, "attempt": np.concatenate(attempts).astype("int64"),
                "ppl": np.concatenate(values), "stage": np.repeat(stages, [len(p) for p in passed]),
                "passed": np.concatenate(passed)})
    return run


def _need_keyed_state(spark):
    if spark.conf.get(_STATE_STORE, None) != _ROCKSDB:
        raise ValueError(f"set {_STATE_STORE} to {_ROCKSDB}, as build_session does")


def stream_session_context(events, tokenizer, max_tokens=MAX_HISTORY_TOKENS, ttl_ms=None):
    """ST1 over `(conv_id, turn, role, text)`; role `command` with text `clear` empties a session.

    Turns of a session have to arrive in order across micro-batches. `ttl_ms` drops idle sessions.
    """
    _need_keyed_state(events.sparkSession)
    sized = tokenizer.prepare(events, render_message(F.col("role"), F.col("text"))).drop("payload")
    return sized.groupBy("conv_id").transformWithStateInPandas(
        SessionContext(max_tokens, tokenizer.tag_tokens, ttl_ms), CONTEXT, "Append",
        "ProcessingTime" if ttl_ms else "None")


def stream_curriculum_gate(attempts, stages=None):
    """ST2 over `(run, attempt, ppl)`."""
    _need_keyed_state(attempts.sparkSession)
    thresholds = [float(s[2]) for s in (stages or STAGES)]
    # The state travels with the rows, many runs to an Arrow batch; a StatefulProcessor asks for
    # each run's over a socket.
    return attempts.select("run", "attempt", "ppl").groupBy("run").applyInPandasWithState(
        _gate(thresholds), GATED, "stage int", "append", "NoTimeout")


def stream_perplexity(log, window="1 hour", delay="10 minutes"):
    """ST3 over `(run, ts, loss, n_tokens)`: perplexity per run and tumbling window.

    In append mode a window comes out once the watermark has passed its end, so the last windows
    wait for later rows; a row of a later time, with no tokens, brings them out.
    """
    timed = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    scored = perplexity(timed, (F.window("ts", window).alias("window"), F.col("run")))
    return scored.select("run", F.col("window.start").alias("window_start"),
                         F.col("window.end").alias("window_end"), "tokens", "ppl")


def run_to_completion(stream, path, checkpoint):
    """Process everything that is there into Parquet files at `path`, then stop."""
    query = (stream.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
