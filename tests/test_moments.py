"""Moments kept as stream state equal the batch aggregate; idle series start anew."""
import math
from datetime import datetime, timedelta
from types import SimpleNamespace

from pyspark.sql import functions as F

from telemark.operators.flatline import SERIES, running_moments
from telemark.operators.score import empty_baseline
from telemark.plans.reports import batch_p99
from telemark.session import scratch
from telemark.streaming import moments as M
from telemark.streaming.silver import SilverJob

START = datetime(2024, 1, 1)
LAYOUT = "device_id string, interface_name string, device_ts timestamp, effective_util_in double, extra int"


def feed(spark, path, rows):
    spark.createDataFrame(rows, LAYOUT).coalesce(1).write.mode("append").parquet(path)


def drain(spark, path, checkpoint, **options):
    stream = spark.readStream.schema(LAYOUT).parquet(path)
    M.start_moments(M.moments_stream(stream, **options), checkpoint, once=True).awaitTermination()


def as_dict(df):
    return {(r["device_id"], r["interface_name"]): r for r in df.collect()}


def same(a, b):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def test_state_equals_batch_over_any_split(spark):
    rows = [("hot" if i % 3 else f"d{i % 7}", None if i % 11 == 0 else "e0",
             START + timedelta(minutes=i), None if i % 5 == 0 else float(i * i % 97) + 1e6, i)
            for i in range(300)]
    rows += [("null", "e0", START + timedelta(minutes=i), None, i) for i in range(3)]
    rows += [("untimed", "e0", None, 2.0, 0)]
    path, checkpoint = scratch(spark, "moments"), scratch(spark, "moments-checkpoint")
    for piece in (rows[:1], rows[1:40] + rows[300:303], rows[40:300] + rows[303:]):
        feed(spark, path, piece)
        drain(spark, path, checkpoint, watermark="1 day")
    got = as_dict(M.read_moments(spark, checkpoint))
    want = as_dict(running_moments(spark.createDataFrame(rows, LAYOUT), SERIES))
    assert set(got) == set(want)
    for key, row in want.items():
        for column in ("n", "mean", "m2", "variance", "std"):
            assert same(got[key][column], row[column]), (key, column, got[key], row)


def test_idle_series_start_anew(spark):
    path, checkpoint = scratch(spark, "moments"), scratch(spark, "moments-checkpoint")
    feed(spark, path, [("a", "e0", START, 1.0, 0), ("b", "e0", START, 5.0, 0)])
    drain(spark, path, checkpoint, idle_days=1)
    feed(spark, path, [("b", "e0", START + timedelta(days=3), 7.0, 0)])
    drain(spark, path, checkpoint, idle_days=1)
    feed(spark, path, [("a", "e0", START + timedelta(days=3), 9.0, 0)])
    drain(spark, path, checkpoint, idle_days=1)
    got = as_dict(M.read_moments(spark, checkpoint))
    assert got["a", "e0"]["n"] == 1 and got["a", "e0"]["mean"] == 9.0


def test_flat_series_from_state(spark):
    frame = spark.createDataFrame(
        [("a", "e0", 30, 4.0, 0.0, 0.0, 0.0), ("b", "e0", 30, 4.0, 90.0, 3.1, 1.8), ("c", "e0", 2, 4.0, 0.0, 0.0, 0.0)],
        "device_id string, interface_name string, n bigint, mean double, m2 double, variance double, std double")
    flat = M.flat_from_moments(frame).select("device_id", "points", F.col("mean_util_in")).collect()
    assert [tuple(r) for r in flat] == [("a", 30, 4.0)]


def test_ingest_marks_flat_series_by_kept_state(spark):
    """A micro-batch of one reading per series is flat by the state of earlier ones only."""
    job = SilverJob(root=scratch(spark, "job"), inventory=lambda: None, params=lambda: empty_baseline(spark), flat_points=3)
    rows = spark.createDataFrame(
        [("a", "e0", START, 4.0, 4.0, 1), ("b", "e0", START, 4.0, 4.0, 1)],
        "device_id string, interface_name string, device_ts timestamp, effective_util_in double, "
        "effective_util_out double, oper_status int")
    state = spark.createDataFrame(
        [("a", "e0", 30, 4.0, 0.0, 0.0, 0.0), ("b", "e0", 30, 4.0, 90.0, 3.1, 1.8)],
        "device_id string, interface_name string, n bigint, mean double, m2 double, variance double, std double")

    def flat():
        return {r[0] for r in job._score(rows).filter(F.array_contains("ingest_flags", "FLATLINE")).select("device_id").collect()}

    assert flat() == set()
    job.moments = lambda: state
    assert flat() == {"a"}


def test_every_micro_batch_is_logged(spark):
    job = SilverJob(root=scratch(spark, "job"), inventory=lambda: None, params=lambda: None)
    run = job._timed("syslogs", lambda batch, batch_id: None)
    frame = spark.range(1)
    for batch_id in (*range(110), 109):
        run(frame, batch_id)
    report = {r["stage"]: r["batches"] for r in batch_p99(job.batch_log(spark)).collect()}
    assert report == {"syslogs": 110}


class Kept:
    """A state handle that notes its calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], []

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.calls.append("registerTimer")
        self.timers.append(at)


def test_a_series_costs_two_state_calls_and_keeps_one_timer():
    handle, series = Kept(), M.Moments(["d"], idle_ms=100)
    series.init(handle)

    def read(at):
        handle.calls.clear()
        row = {"n": 1, "mean": 2.0, "m2": 0.0, "last_ms": at}
        assert len(list(series.handleInputRows(("a",), iter([row]), None))) == 1
        return handle.calls

    def fire(at, watermark):
        handle.timers.remove(at)
        list(series.handleExpiredTimer(("a",), SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark),
                                       SimpleNamespace(getExpiryTimeInMs=lambda: at)))

    assert read(None) == ["get", "update"] and handle.timers == []
    assert read(1000) == ["get", "update", "registerTimer"] and handle.timers == [1100]
    assert read(1050) == ["get", "update"] and handle.timers == [1100]
    fire(1100, watermark=1101)
    assert handle.value[0] == 3 and handle.timers == [1150]
    fire(1150, watermark=1151)
    assert handle.value is None and handle.timers == []
    read(1000), read(1050), fire(1100, watermark=2000)
    assert handle.value is None and handle.timers == []
