"""Gold layer: hourly site health and debounced anomaly windows."""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemark.functions import columns as C
from telemark.operators import aggregates as A
from telemark.operators.flatline import to_anomaly_records
from telemark.operators.joins import Store, attach
from telemark.operators.versions import latest_by_key
from telemark.schema import ANOMALY_KEYS, HEALTH_KEYS


def trailing(df: DataFrame, as_of: Column, hours: int = 25, ts: str = "device_ts") -> DataFrame:
    """Rows of the last `hours` before `as_of`."""
    return C.since(df, as_of - F.expr(f"INTERVAL {hours} HOURS"), ts)


def site_health(stats: DataFrame, syslogs: DataFrame, refreshed_at: Column | None = None) -> DataFrame:
    """Hourly health per site. Both feeds are aggregated before they are joined."""
    at = F.current_timestamp() if refreshed_at is None else refreshed_at
    hours = A.join_hours(A.site_hour(stats), A.syslog_hour(syslogs))
    return hours.select(
        "site_id",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "avg_util_in", "avg_util_out", "pct_interfaces_saturated", "critical_syslog_count",
        "total_interface_count", "pct_interfaces_down",
        at.alias("refreshed_at"),
    )


def with_score(health: DataFrame) -> DataFrame:
    """Derived on read, never stored."""
    score = C.health_score(
        F.col("pct_interfaces_saturated"), F.col("critical_syslog_count"),
        F.col("pct_interfaces_down"))
    return health.withColumn("health_score", score).withColumn("is_degraded", C.is_degraded())


def current_health(history: DataFrame) -> DataFrame:
    """Newest version per (site, hour), with the derived columns."""
    return with_score(latest_by_key(history, HEALTH_KEYS, ["refreshed_at", "total_interface_count"]))


def current_anomalies(history: DataFrame) -> DataFrame:
    return latest_by_key(history, ANOMALY_KEYS, ["detected_at", "score", "site_id"])


def touched_hours(promoted: DataFrame) -> DataFrame:
    return promoted.select(
        "site_id", F.date_trunc("hour", "device_ts").alias("_hour")).distinct()


def site_health_touched(
    stats: DataFrame, syslogs: DataFrame, promoted: DataFrame, refreshed_at: Column | None = None,
    store: Store | None = None,
) -> DataFrame:
    """Health of only those hours that received late rows. Where the tables are partitioned by
    site and day, the join is on these too, so that only directories with touched hours are read."""
    hours = touched_hours(promoted).withColumn("_partition_date", F.to_date("_hour"))
    hours = store(hours) if store else hours
    # The span of days prunes at once; that the small side is filtered by it lets the join
    # prune the single directories when it runs.
    first, last = hours.agg(F.min("_partition_date"), F.max("_partition_date")).first()
    within = F.col("_partition_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    hours = hours.filter(within)

    def part(df: DataFrame) -> DataFrame:
        keyed = df.withColumn("_hour", F.date_trunc("hour", "device_ts"))
        day = ["_partition_date"] if "_partition_date" in df.columns else []
        keyed = keyed.filter(within) if day else keyed
        return attach(keyed, hours, ["site_id", *day, "_hour"], "left_semi").drop("_hour")

    return site_health(part(stats), part(syslogs), refreshed_at)


def site_health_recent(
    stats: DataFrame, syslogs: DataFrame, promoted: DataFrame, as_of: Column,
    store: Store | None = None, hours: int = 25,
) -> DataFrame:
    """Health of the last `hours` hours, from a whole hour on, and of older hours that
    received late rows."""
    begin = F.date_trunc("hour", as_of - F.expr(f"INTERVAL {hours} HOURS"))
    older = promoted.filter(F.col("device_ts") < begin)

    def since(df: DataFrame) -> DataFrame:
        return C.since(df, begin, "device_ts")

    def before(df: DataFrame) -> DataFrame:
        older = F.col("device_ts") < begin
        if "_partition_date" in df.columns:
            older = older & (F.col("_partition_date") <= F.to_date(begin))
        return df.filter(older)

    late = site_health_touched(before(stats), before(syslogs), older, as_of, store)
    return site_health(since(stats), since(syslogs), as_of).unionByName(late)


def closed_windows(stats: DataFrame, as_of: datetime, hours: int = 25, width: int = 4) -> DataFrame:
    """Rows of the windows of `width` hours that end within the last `hours` hours: each
    whole, none still open."""
    span = width * 3600
    end = int(as_of.timestamp()) // span * span
    begin = -(-(int(as_of.timestamp()) - hours * 3600) // span) * span
    at = [F.timestamp_seconds(F.lit(x)) for x in (begin, end)]
    return C.since(stats, at[0], "device_ts").filter(F.col("device_ts") < at[1])


def anomaly_windows(
    stats: DataFrame, width: str = "5 minutes", min_count: int = 3,
    tiebreak: tuple[str, ...] = (),
) -> DataFrame:
    """Ingest flags debounced to windows with at least `min_count` flagged minutes."""
    flagged = (
        A.minute_latest(stats, tiebreak)
        .filter("ingest_anomaly")
        .select("*", F.explode("ingest_flags").alias("anomaly_type"))
    )
    return (
        flagged.withColumn("raw_score", C.raw_score())
        .groupBy("device_id", "interface_name", "anomaly_type", F.window("minute_ts", width).alias("w"))
        .agg(
            F.min("site_id").alias("site_id"),
            F.max("raw_score").alias("score"),
            F.avg("effective_util_in").alias("mean_util_in"),
            F.stddev_pop("effective_util_in").alias("std_util_in"),
            F.max("_ingested_at").alias("detected_at"),
            F.count("*").alias("_n"),
        )
        .filter(F.col("_n") >= min_count)
        .select(
            "device_id", "site_id", "interface_name",
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "anomaly_type", C.anomaly_subtype().alias("anomaly_subtype"),
            "score", "mean_util_in", "std_util_in", "detected_at",
        )
    )


def syslog_bursts(
    syslogs: DataFrame, width: str = "5 minutes", min_count: int = 3,
    keys: tuple[str, ...] = ("device_id",),
) -> DataFrame:
    """Windows in which a device wrote at least `min_count` critical syslogs."""
    device = F.col("device_id") if "device_id" in keys else F.lit("")
    counted = (
        syslogs.filter(F.col("is_critical") & C.nonempty("device_id"))
        .groupBy(*keys, F.window("device_ts", width).alias("w"))
        .agg(
            F.count("*").alias("_n"),
            F.max("_ingested_at").alias("detected_at"),
            F.min("site_id").alias("_site"),
        )
        .filter(F.col("_n") >= min_count)
    )
    site = F.col("site_id") if "site_id" in keys else F.col("_site")
    return counted.select(
        device.alias("device_id"), site.alias("site_id"), F.lit("").alias("interface_name"),
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        F.lit("CRITICAL_SYSLOG_BURST").alias("anomaly_type"),
        F.lit("SEVERITY_LT3_RATE").alias("anomaly_subtype"),
        F.col("_n").cast("double").alias("score"),
        F.lit(0.0).alias("mean_util_in"), F.lit(0.0).alias("std_util_in"),
        "detected_at",
    )


def all_anomalies(flags: DataFrame, flatlines: DataFrame, bursts: DataFrame) -> DataFrame:
    """Ingest windows, staged flatlines and syslog bursts in one table."""
    return flags.unionByName(to_anomaly_records(flatlines)).unionByName(bursts)
