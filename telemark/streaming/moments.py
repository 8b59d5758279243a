"""Running mean and variance per series, kept as state of a stream.

Each task first reduces its Arrow batches to one partial per series, so a hot series sends
few rows; the state merges partials. However the rows are split into micro-batches, the
state equals `flatline.running_moments` over all of them.

Defined cases: NULL values do not count (a series of NULLs has n = 0 and no mean), NaN makes
a series' moments NaN, NULL keys form a series of their own, rows without a time are counted
but do not move the clock, and an empty stream has no state. Rows older than the watermark
are dropped, and a series idle for longer than `idle` starts anew.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from telemark.operators.flatline import SERIES

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "n bigint, mean double, m2 double, last_ms bigint"


def merge(a: tuple, b: tuple) -> tuple:
    """Two (n, mean, m2, last_ms) as if their values had been read as one."""
    last = max((t for t in (a[3], b[3]) if t is not None), default=None)
    if not a[0] or not b[0]:
        kept = a if a[0] else b
        return kept[0], kept[1], kept[2], last
    n, delta = a[0] + b[0], b[1] - a[1]
    return n, a[1] + delta * b[0] / n, a[2] + b[2] + delta * delta * a[0] * b[0] / n, last


def partials(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """One row per series of each batch: count, mean, squared deviations, latest time."""
    for batch in batches:
        grouped = pa.Table.from_batches([batch]).group_by(keys).aggregate(
            [("x", "count"), ("x", "mean"), ("x", "variance"), ("ts", "max")])
        squares = pc.multiply(grouped["x_variance"], pc.cast(grouped["x_count"], pa.float64()))
        table = pa.table({
            **{k: grouped[k] for k in keys}, "n": grouped["x_count"], "mean": grouped["x_mean"],
            "m2": pc.fill_null(squares, 0.0), "last_ts": grouped["ts_max"]})
        yield from table.to_batches()


class Moments(StatefulProcessor):
    def __init__(self, keys: list[str], idle_ms: int) -> None:
        self.changed, self.idle_ms = Row(*keys, "n", "mean", "m2", "last_ms"), idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("moments", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.state.get() or (0, None, 0.0, None)
        found = before
        for row in rows:
            found = merge(found, (row["n"], row["mean"] if row["n"] else None, row["m2"], row["last_ms"]))
        self.state.update(found)
        # One timer per series, set once: when it fires, it is moved to where it is due by then.
        if before[3] is None and found[3] is not None:
            self.handle.registerTimer(found[3] + self.idle_ms)
        yield self.changed(*key, *found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        found = self.state.get()
        due = found[3] + self.idle_ms if found else 0
        if due > expiredTimerInfo.getExpiryTimeInMs() and due >= timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(due)
        else:
            self.state.clear()
        return iter(())


def moments_stream(
    silver: DataFrame, keys=SERIES, value: str = "effective_util_in", ts: str = "device_ts",
    watermark: str = "10 minutes", idle_days: int = 30,
) -> DataFrame:
    """The changed series of each micro-batch with their moments so far."""
    keys = list(keys)
    named = silver.select(*keys, F.col(value).cast("double").alias("x"), F.col(ts).alias("ts"))
    kinds = ", ".join(f"`{k}` {silver.schema[k].dataType.simpleString()}" for k in keys)
    reduced = named.mapInArrow(
        lambda batches: partials(batches, keys),
        f"{kinds}, n bigint, mean double, m2 double, last_ts timestamp")
    timed = reduced.withWatermark("last_ts", watermark).withColumn("last_ms", F.unix_millis("last_ts"))
    return timed.groupBy(*keys).transformWithState(
        Moments(keys, idle_days * 86_400_000), f"{kinds}, {STATE}", "Update", "EventTime")


def start_moments(changes: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Run the stream for its state alone; `read_moments` reads it from the checkpoint.

    State of this kind needs the RocksDB store. A query keeps the store it starts with, so
    the session's own setting is put back for its other streams."""
    conf = changes.sparkSession.conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, ROCKSDB)
    try:
        writer = changes.writeStream.outputMode("update").format("noop").option(
            "checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        if before is None:
            conf.unset(PROVIDER)
        else:
            conf.set(PROVIDER, before)


def read_moments(spark: SparkSession, checkpoint: str, keys=SERIES) -> DataFrame:
    """The state after the last finished micro-batch, in the columns of `running_moments`."""
    state = (spark.read.format("statestore").option("path", checkpoint)
             .option("stateVarName", "moments").load())
    n, m2 = F.col("value.n"), F.col("value.m2")
    variance = F.when(n < 2, 0.0).otherwise(m2 / (n - 1))
    return state.select(
        *[F.col(f"key.{k}").alias(k) for k in keys], n.alias("n"),
        F.col("value.mean").alias("mean"), m2.alias("m2"), variance.alias("variance"),
        F.sqrt(variance).alias("std"))


def flat_from_moments(moments: DataFrame, min_points: int = 30, eps: float = 0.01) -> DataFrame:
    """`flatline.flat_series`, from kept state over up readings instead of from rows."""
    return moments.filter((F.col("n") >= min_points) & (F.col("variance") <= eps)).select(
        *[c for c in moments.columns if c not in ("n", "mean", "m2", "variance", "std")],
        F.col("n").alias("points"), "variance", F.col("mean").alias("mean_util_in"))
