"""Hourly, per-minute and per-batch aggregates."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemark.functions import columns as C
from telemark.operators.joins import Store, attach


def rate(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def site_hour(stats: DataFrame, width: str = "1 hour") -> DataFrame:
    """Utilisation means, saturation and down rates per site and hour."""
    return stats.groupBy("site_id", F.window("device_ts", width).alias("w")).agg(
        F.avg("effective_util_in").alias("avg_util_in"),
        F.avg("effective_util_out").alias("avg_util_out"),
        rate(C.saturated()).alias("pct_interfaces_saturated"),
        F.count("*").alias("total_interface_count"),
        rate(F.col("oper_status") != 1).alias("pct_interfaces_down"),
    )


def syslog_hour(syslogs: DataFrame, width: str = "1 hour") -> DataFrame:
    """Critical syslogs per site and hour."""
    return syslogs.groupBy("site_id", F.window("device_ts", width).alias("w")).agg(
        F.count_if(C.is_critical()).alias("critical_syslog_count")
    )


def join_hours(health: DataFrame, logs: DataFrame) -> DataFrame:
    """Two hourly aggregates on (site, window); hours without syslogs count 0."""
    return health.join(logs, ["site_id", "w"], "left").fillna(0, ["critical_syslog_count"])


def site_now(stats: DataFrame) -> DataFrame:
    """Current score per site from one batch of readings, without syslogs."""
    rates = stats.filter(F.col("site_id").isNotNull()).groupBy("site_id").agg(
        rate(C.saturated()).alias("pct_saturated"),
        rate(F.col("oper_status") != 1).alias("pct_down"),
    )
    score = C.health_score(F.col("pct_saturated"), F.lit(0), F.col("pct_down"))
    return rates.withColumn("health_score", score)


def minute_latest(stats: DataFrame, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """One point per (device, interface, minute): the row ingested last."""
    none = F.array().cast("array<string>")
    point = F.struct(
        F.col("effective_util_in"),
        F.coalesce("ingest_z_score", F.lit(0.0)).alias("ingest_z_score"),
        F.coalesce("ingest_iqr_score", F.lit(0.0)).alias("ingest_iqr_score"),
        F.coalesce("ingest_flags", none).alias("ingest_flags"),
        F.coalesce("ingest_anomaly", F.lit(False)).alias("ingest_anomaly"),
    )
    order = F.struct(
        "_ingested_at", *(tiebreak or ("device_ts", "effective_util_in", "ingest_z_score")))
    return (
        stats.filter(C.nonempty("device_id") & C.nonempty("interface_name"))
        .groupBy("device_id", "interface_name", F.date_trunc("minute", "device_ts").alias("minute_ts"))
        .agg(
            F.min("site_id").alias("site_id"),
            F.max("_ingested_at").alias("_ingested_at"),
            F.max_by(point, order).alias("_p"),
        )
        .select("device_id", "site_id", "interface_name", "minute_ts", "_ingested_at", "_p.*")
    )


def flag_counts(scored: DataFrame) -> DataFrame:
    return (
        scored.filter("ingest_anomaly")
        .select(F.explode("ingest_flags").alias("anomaly_type"))
        .groupBy("anomaly_type").agg(F.count("*").alias("n"))
    )


def group_count(df: DataFrame, *keys) -> DataFrame:
    """How many distinct groups there are."""
    return df.groupBy(*keys).agg(F.lit(1).alias("_one")).agg(F.count("*").alias("groups"))


def total_per_hour(stats: DataFrame, store: Store | None = None) -> DataFrame:
    """Each row with the number of rows of its site and hour.

    The count is an aggregate joined back rather than a window function, so
    that a hot (site, hour) is counted map-side and never gathered in one task.
    """
    keyed = stats.withColumn("window_start", F.date_trunc("hour", "device_ts"))
    totals = keyed.groupBy("site_id", "window_start").agg(F.count("*").alias("total_ifaces"))
    # Rows without site or hour have a total as well: they meet under stand-ins.
    def named(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "_site": F.coalesce(F.concat(F.lit("="), "site_id"), F.lit("")),
            "_hour": F.coalesce(F.unix_timestamp("window_start"), F.lit(-1))})

    totals = named(totals).drop("site_id", "window_start")
    return attach(named(keyed), totals, ["_site", "_hour"], "inner", store=store).drop("_site", "_hour")


def hourly_features(stats: DataFrame) -> DataFrame:
    """Ten features per (device, interface, hour)."""
    zero = F.lit(0.0)
    return (
        stats.groupBy("device_id", "interface_name", F.date_trunc("hour", "device_ts").alias("window_start"))
        .agg(
            F.avg("effective_util_in").alias("avg_in"),
            F.avg("effective_util_out").alias("avg_out"),
            F.coalesce(F.stddev_samp("effective_util_in"), zero).alias("std_in"),
            F.coalesce(F.stddev_samp("effective_util_out"), zero).alias("std_out"),
            F.max("effective_util_in").alias("max_in"),
            F.min("effective_util_in").alias("min_in"),
            F.max("effective_util_out").alias("max_out"),
            F.min("effective_util_out").alias("min_out"),
            F.count_if(F.col("oper_status") != 1).cast("double").alias("down_count"),
            F.count("*").cast("double").alias("sample_count"),
        )
    )


FEATURES = (
    "avg_in", "avg_out", "std_in", "std_out", "max_in", "min_in", "max_out", "min_out",
    "down_count", "sample_count",
)
