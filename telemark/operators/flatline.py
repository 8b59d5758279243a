"""Flat series: mergeable variance over groups, tumbling and sliding windows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SERIES = ("device_id", "interface_name")
PLACED = ("device_id", "site_id", "interface_name")


def variance(value: str) -> Column:
    """Sample variance, 0 for fewer than two points."""
    return F.coalesce(F.var_samp(value), F.lit(0.0))


def running_moments(df: DataFrame, keys, value: str = "effective_util_in") -> DataFrame:
    """Count, mean, sum of squared deviations, variance and spread per group.

    Spark merges central moments across partitions, which is the same state a
    one-pass update keeps.
    """
    n = F.count(value)
    var = variance(value)
    return df.groupBy(*keys).agg(
        n.alias("n"),
        F.avg(value).alias("mean"),
        (F.coalesce(F.var_pop(value), F.lit(0.0)) * n).alias("m2"),
        var.alias("variance"),
        F.sqrt(var).alias("std"),
    )


def up_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("oper_status") == 1)


def flat_series(
    df: DataFrame, keys=SERIES, value: str = "effective_util_in",
    min_points: int = 30, eps: float = 0.01,
) -> DataFrame:
    """Series of at least `min_points` up readings whose variance is at most `eps`."""
    return (
        up_only(df).groupBy(*keys)
        .agg(
            F.count(value).alias("points"),
            variance(value).alias("variance"),
            F.avg(value).alias("mean_util_in"),
        )
        .filter((F.col("points") >= min_points) & (F.col("variance") <= eps))
    )


def flat_windows(
    df: DataFrame, keys=PLACED, value: str = "effective_util_in", ts: str = "device_ts",
    width: str = "4 hours", threshold: float = 0.0, min_points: int = 2,
) -> DataFrame:
    """Flat tumbling windows; the same plan serves batch and a watermarked stream."""
    return (
        up_only(df).groupBy(*keys, F.window(ts, width).alias("w"))
        .agg(
            variance(value).alias("variance"),
            F.avg(value).alias("mean_util_in"),
            F.count(value).alias("points"),
            F.max("oper_status").alias("oper_status"),
        )
        .filter((F.col("variance") <= threshold) & (F.col("points") >= min_points))
    )


def flat_windows_sliding(
    df: DataFrame, keys=PLACED, value: str = "effective_util_in", ts: str = "device_ts",
    width_minutes: int = 240, slide_minutes: int = 5, near_eps: float = 0.01,
    min_points: int = 2,
) -> DataFrame:
    """Flat and nearly flat sliding windows.

    Rows are first folded into panes of one slide each, and the panes of a series into
    blocks as long as a window. A window is the end of one block and the beginning of the
    next, so each pane goes to two blocks only. A block and its next are one short array,
    from which all windows that begin in the block are merged: neither window starts nor
    blocks of too few points are sorted. A series of any length spreads over its blocks.
    A window with equal minimum and maximum has variance exactly 0.
    """
    slide, per = slide_minutes * 60, width_minutes // slide_minutes
    if per * slide_minutes != width_minutes:
        raise ValueError("the width must be a multiple of the slide")
    panes = (
        up_only(df).groupBy(*keys, F.floor(F.unix_timestamp(ts) / slide).alias("_pane"))
        .agg(
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            (F.coalesce(F.var_pop(value), F.lit(0.0)) * F.count(value)).alias("m2"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
        )
    )
    block = F.floor(F.col("_pane") / per)
    at = (F.col("_pane") - block * per).cast("int") + F.when(F.col("_next"), per).otherwise(0)
    # At most twice the panes of a window each, in order; blocks of too few points end here.
    blocks = (
        panes.filter("n > 0").withColumn("_next", F.explode(F.array(F.lit(False), F.lit(True))))
        .groupBy(*keys, (block - F.col("_next").cast("int")).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct(at.alias("pos"), "n", "mean", "m2", "low", "high"))).alias("_panes"),
             F.sum("n").alias("_all"))
        .filter(F.col("_all") >= min_points)
    )

    def moments(n, mean, m2, low, high, pos):
        return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"), low.alias("low"), high.alias("high"), pos.alias("pos"))

    def merge(w, p):
        n, off = w["n"] + p["n"], p["mean"] - w["mean"]
        return moments(
            n, w["mean"] + off * p["n"] / n, w["m2"] + p["m2"] + off * off * w["n"] * p["n"] / n,
            F.least(w["low"], p["low"]), F.greatest(w["high"], p["high"]), w["pos"])

    def window(pos):
        nothing = F.lit(None).cast("double")
        start = moments(F.lit(0).cast("long"), F.lit(0.0), F.lit(0.0), nothing, nothing, pos)
        return F.aggregate(F.filter("_panes", lambda p: (p["pos"] >= pos) & (p["pos"] < pos + per)), start, merge)

    windows = blocks.select(
        *keys, "block", F.explode(F.transform(F.sequence(F.lit(0), F.lit(per - 1)), window)).alias("_w"))
    merged = windows.filter(F.col("_w.n") >= min_points).select(
        *keys, F.col("_w.n").alias("points"), F.col("_w.mean").alias("mean_util_in"), F.col("_w.low").alias("low"),
        F.col("_w.high").alias("high"), F.col("_w.m2").alias("_m2"),
        ((F.col("block") * per + F.col("_w.pos")) * slide).alias("_start"))
    width = width_minutes * 60
    spread = F.coalesce(F.try_divide(F.col("_m2"), F.col("points") - 1), F.lit(0.0))
    return (
        merged.withColumns({
            "variance": F.when(F.col("low") == F.col("high"), 0.0).otherwise(spread),
            "window_start": F.timestamp_seconds("_start"),
            "window_end": F.timestamp_seconds(F.col("_start") + width),
        })
        .withColumn(
            "anomaly_type",
            F.when(F.col("low") == F.col("high"), "FLATLINE")
            .when(F.col("variance") < near_eps, "NEAR_FLATLINE"),
        )
        .filter(F.col("anomaly_type").isNotNull())
        .select(*keys, "window_start", "window_end", "anomaly_type", "variance",
                "mean_util_in", "points")
    )


def to_flatline_flags(windows: DataFrame, detected_at: Column | None = None) -> DataFrame:
    at = F.current_timestamp() if detected_at is None else detected_at
    return windows.select(
        "device_id", "site_id", "interface_name",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        F.lit("FLATLINE").alias("anomaly_type"),
        "variance", "mean_util_in", "oper_status",
        at.alias("detected_at"),
    )


def to_anomaly_records(windows: DataFrame) -> DataFrame:
    """Staged flatline rows in the layout of the gold anomaly table."""
    return windows.filter(F.col("anomaly_type") == "FLATLINE").select(
        "device_id", "site_id", "interface_name", "window_start", "window_end",
        "anomaly_type",
        F.lit("LOW_VARIANCE").alias("anomaly_subtype"),
        F.col("variance").alias("score"),
        "mean_util_in",
        F.lit(0.0).alias("std_util_in"),
        "detected_at",
    )
