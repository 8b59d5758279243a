"""As-of parameters and sliding windows against plain re-computations."""
import random
import statistics
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from telemark.operators import flatline as FL
from telemark.operators import joins as J

R = random.Random(4)
T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)


def at(hours):
    return T0 + timedelta(hours=hours)


@pytest.mark.parametrize("slice_hours", [1, 24, 24 * 7])
def test_asof_takes_the_newest_valid_version(spark, slice_hours):
    versions = [(k, float(i), at(b), at(b + R.choice([0, 1, 5, 40, 9000])))
                for i, (k, b) in enumerate((k, b) for k in "ab" for b in R.sample(range(60), 12))]
    versions += [(None, 9.0, at(1), at(99)), ("a", 8.0, None, at(99)), ("c", 7.0, at(5), at(2))]
    rows = [(R.choice(["a", "b", "c", None]), at(R.randrange(80)) if R.random() < 0.95 else None, i) for i in range(400)]
    stats = spark.createDataFrame(rows, "device_id string, device_ts timestamp, n int")
    params = spark.createDataFrame(versions, "device_id string, baseline_mean double, valid_from timestamp, valid_until timestamp").withColumns(
        {"baseline_std": F.lit(1.0), "iqr_k": F.lit(1.5)})
    out = J.attach_baseline_asof(stats, params, ("device_id",), slice_hours=slice_hours)
    assert out.columns == [*stats.columns, "baseline_mean", "baseline_std", "iqr_k"]
    got = {r.n: r.baseline_mean for r in out.collect()}
    assert len(got) == len(rows)
    for k, ts, n in rows:
        valid = [(b, m) for d, m, b, e in versions if k and ts and d == k and b and b <= ts <= e]
        assert got[n] == (max(valid)[1] if valid else None)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_sliding_windows_from_two_parts(spark):
    rows = [("d", "s", k, at(0) + timedelta(minutes=m), float(v)) for k, gap in (("dense", 3), ("sparse", 170)) for m, v in
            ((i * gap, R.choice([5, 5, 6])) for i in range(200))]
    rows += [("d", "s", "flat", at(0) + timedelta(minutes=7 * i), 4.0) for i in range(90)]
    frame = spark.createDataFrame(rows, "device_id string, site_id string, interface_name string, device_ts timestamp, effective_util_in double").withColumn(
        "oper_status", F.lit(1))
    got = {(r.interface_name, r.window_start.replace(tzinfo=timezone.utc).timestamp()): (r.points, round(r.variance, 9), round(r.mean_util_in, 9), r.anomaly_type)
           for r in FL.flat_windows_sliding(frame, near_eps=0.2).collect()}
    want = {}
    for k in ("dense", "sparse", "flat"):
        seen = [(r[3].timestamp(), r[4]) for r in rows if r[2] == k]
        first, last = int(min(seen)[0]) // 300 * 300, int(max(seen)[0]) // 300 * 300
        for start in range(first - 235 * 60, last + 1, 300):
            values = [v for ts, v in seen if start <= ts < start + 240 * 60]
            if len(values) < 2:
                continue
            spread = statistics.variance(values)
            kind = "FLATLINE" if min(values) == max(values) else "NEAR_FLATLINE" if spread < 0.2 else None
            if kind:
                want[k, float(start)] = (len(values), round(spread, 9), round(statistics.fmean(values), 9), kind)
    local = {k: v for k, v in got.items()}
    assert local == want


def test_a_pane_goes_to_two_blocks(spark):
    frame = spark.range(2000).select(
        F.lit("d").alias("device_id"), F.lit("s").alias("site_id"), F.lit("i").alias("interface_name"), F.lit(1).alias("oper_status"),
        F.timestamp_seconds(F.col("id") * 300).alias("device_ts"), F.lit(1.0).alias("effective_util_in"))
    out = FL.flat_windows_sliding(frame)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # Two homes for a pane; the 48 starts of windows are made per block, not per pane.
    assert plan.count("Generate explode(_home") <= plan.count("Generate explode") <= 3
    assert "Generate explode([0,1,2" in plan or plan.count("explode(sequence(") <= 1
    assert out.count() == 2000 + 47 - 2     # windows of fewer than two points are left out


def test_sliding_windows_sort_neither_starts_nor_lone_points(spark):
    lone = spark.range(50).select(
        F.col("id").cast("string").alias("device_id"), F.lit("s").alias("site_id"), F.lit("i").alias("interface_name"),
        F.lit(1).alias("oper_status"), F.timestamp_seconds(F.col("id") * 300).alias("device_ts"), F.lit(1.0).alias("effective_util_in"))
    out = FL.flat_windows_sliding(lone.unionByName(lone.filter("id < 2")))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" not in plan and "Union" not in plan.split("Aggregate")[0]
    assert out.count() == 2 * 48
