"""Cells of equal counts split a group of close values; cut points stay exact."""
import numpy as np
from pyspark.sql import functions as F

from telemark.plans.baseline import psi_cuts, value_cells

LAYOUT = "device_id string, value double, n_base bigint, n_cur bigint"
KEYS = ["device_id"]


def counts(spark):
    rng = np.random.default_rng(5)
    close = np.unique(10 + rng.random(6000) / 2)            # all within half a unit
    rows = [("hot", float(v), int(n), 1) for v, n in zip(close, rng.integers(1, 9, len(close)))]
    rows += [("small", 1.0, 3, 0), ("small", 4.0, 1, 2), ("flat", 7.0, 50, 0), ("new", 2.0, 0, 9)]
    rows += [("spike", 0.0, 10**9, 0)] + [("spike", float(i), 1, 0) for i in range(1, 300)]
    return spark.createDataFrame(rows, LAYOUT), rows


def test_close_values_fill_many_cells(spark):
    frame, _ = counts(spark)
    cells = value_cells(frame, KEYS, whole=200).groupBy("device_id", "_cell").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
    hot = sorted((r["_cell"], r["low"], r["high"], r["n"]) for r in cells if r["device_id"] == "hot")
    assert len(hot) > 200 and max(r[3] for r in hot) < 4 * 6000 / 256
    assert all(a[2] < b[1] for a, b in zip(hot, hot[1:]))
    assert {r["_cell"] for r in cells if r["device_id"] in ("small", "flat", "new")} == {0}


def test_cut_points_do_not_depend_on_cells(spark):
    frame, rows = counts(spark)
    want = {}
    for name in ("hot", "small", "flat"):
        sample = np.repeat([r[1] for r in rows if r[0] == name], [r[2] for r in rows if r[0] == name])
        want[name] = np.unique(np.quantile(sample, np.linspace(0, 1, 11)))
    for whole in (10, 200, 10**6):
        got = {r["device_id"]: r["cuts"] for r in psi_cuts(frame, KEYS, whole=whole).collect()}
        assert set(got) == {"hot", "small", "flat", "spike"}
        for name, cuts in want.items():
            np.testing.assert_allclose(got[name], cuts, rtol=1e-12)
        assert got["spike"] == [0.0, 299.0]
