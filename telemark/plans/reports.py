"""Reporting queries over the gold, quarantine and validation tables.

Each takes the frames it reads and, where it looks back from "now", an `as_of`.
`health` is `gold.current_health`, `anomalies` is `gold.current_anomalies`.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemark.functions import columns as C
from telemark.functions.columns import DEGRADED_BELOW

TYPES = (
    "THRESHOLD_SATURATED", "HIGH_Z_SCORE", "IQR_OUTLIER", "FLATLINE", "CRITICAL_SYSLOG_BURST",
    "MODEL",
)


def since(df: DataFrame, ts: str, as_of: Column, span: str) -> DataFrame:
    return C.since(df, as_of - F.expr(f"INTERVAL {span}"), ts)


def percent(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.greatest(whole.cast("double"), F.lit(1.0)) * 100


def anomalies_5m(anomalies: DataFrame, as_of: Column) -> DataFrame:
    recent = since(anomalies, "detected_at", as_of, "7 DAYS")
    return recent.groupBy(
        F.window("detected_at", "5 minutes").alias("w"), F.col("site_id").alias("metric")
    ).agg(F.count("*").alias("value")).select(F.col("w.start").alias("time"), "metric", "value")


def health_series(health: DataFrame, as_of: Column, value: Column, span: str) -> DataFrame:
    recent = since(health, "window_start", as_of, span)
    return recent.groupBy(
        F.col("window_start").alias("time"), F.col("site_id").alias("metric")
    ).agg(value.alias("value"))


def health_trend(health: DataFrame, as_of: Column, span: str = "7 DAYS") -> DataFrame:
    return health_series(health, as_of, F.avg("health_score"), span)


def saturation_pct(health: DataFrame, as_of: Column, span: str = "48 HOURS") -> DataFrame:
    return health_series(health, as_of, F.avg("pct_interfaces_saturated") * 100, span)


def down_pct(health: DataFrame, as_of: Column, span: str = "48 HOURS") -> DataFrame:
    return health_series(health, as_of, F.avg("pct_interfaces_down") * 100, span)


def critical_logs(health: DataFrame, as_of: Column, span: str = "48 HOURS") -> DataFrame:
    return health_series(health, as_of, F.sum("critical_syslog_count"), span)


def health_latest(health: DataFrame, as_of: Column, span: str = "48 HOURS") -> DataFrame:
    recent = since(health, "window_start", as_of, span)
    return recent.groupBy("site_id").agg(
        F.max_by("health_score", "window_start").alias("health_score"))


def health_current_avg(health: DataFrame, as_of: Column) -> DataFrame:
    return health_latest(health, as_of).agg(F.avg("health_score").alias("avg_health_score"))


def degraded(health: DataFrame, as_of: Column, span: str = "48 HOURS") -> DataFrame:
    return since(health, "window_start", as_of, span).filter("is_degraded").select(
        "site_id", "window_start", "health_score", "pct_interfaces_saturated",
        "pct_interfaces_down", "critical_syslog_count",
    ).orderBy(F.desc("window_start"), "site_id")


def recent_anomalies(anomalies: DataFrame, top: int = 50) -> DataFrame:
    """Newest flags; ties are broken so that the answer does not depend on file order."""
    return anomalies.select(
        "device_id", "site_id", "interface_name", "anomaly_type", "anomaly_subtype", "score",
        "detected_at",
    ).orderBy(
        F.desc("detected_at"), "device_id", "interface_name", "anomaly_type", "anomaly_subtype",
    ).limit(top)


def reason_counts(dlq: DataFrame) -> DataFrame:
    return dlq.groupBy("quarantine_reason").agg(F.count("*").alias("cnt")).orderBy(
        F.desc("cnt"), "quarantine_reason")


def dlq_reasons(dlq: DataFrame, as_of: Column) -> DataFrame:
    """Counts by reason of the last day, with a row that says so when there are none."""
    counts = since(dlq, "quarantined_at", as_of, "24 HOURS").groupBy(
        F.coalesce("quarantine_reason", F.lit("UNKNOWN")).alias("reason")
    ).agg(F.count("*").alias("cnt"))
    return with_default(counts, reason=F.lit("NO_DQ_EVENTS"), cnt=F.lit(0).cast("bigint")).orderBy(
        F.desc("cnt"), "reason")


def with_default(df: DataFrame, **constants: Column) -> DataFrame:
    row = df.sparkSession.range(1).select(*[c.alias(n) for n, c in constants.items()])
    return df.unionByName(row)


def orphan_rate(dlq: DataFrame, as_of: Column) -> DataFrame:
    hits = F.count_if(F.col("quarantine_reason") == "ORPHANED_DEVICE")
    return since(dlq, "quarantined_at", as_of, "24 HOURS").agg(
        percent(hits, F.count("*")).alias("orphan_rate_pct"))


def agreement_pct(validation: DataFrame, as_of: Column) -> DataFrame:
    hourly = since(validation, "validated_at", as_of, "24 HOURS").groupBy(
        F.date_trunc("hour", "validated_at").alias("time")
    ).agg(percent(F.count_if(F.col("agreement") == "CONFIRMED"), F.count("*")).alias("agreement_pct"))
    return with_default(
        hourly, time=F.date_trunc("hour", as_of), agreement_pct=F.lit(0.0)).orderBy("time")


def reprocess_rate(dlq: DataFrame) -> DataFrame:
    promoted = F.count_if(F.col("quarantine_resolution") == "PROMOTED_TO_SILVER")
    return dlq.agg(percent(promoted, F.count_if("reprocessed")).alias("reprocess_success_pct"))


def false_positive_pct(validation: DataFrame, as_of: Column) -> DataFrame:
    hits = F.count_if(F.col("agreement") == "FALSE_POSITIVE")
    return since(validation, "validated_at", as_of, "24 HOURS").agg(
        percent(hits, F.count("*")).alias("false_positive_pct"))


def site_summary(health: DataFrame) -> DataFrame:
    return health.groupBy("site_id").agg(
        F.count("*").alias("records"),
        F.min("health_score").alias("min_score"),
        F.max("health_score").alias("max_score"),
        F.round(F.avg("health_score"), 2).alias("avg_score"),
    ).orderBy("site_id")


def type_pivot(anomalies: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("anomaly_type") == t).alias(t.lower()) for t in TYPES]
    return anomalies.agg(*counts, F.count("*").alias("total"))


def degraded_sites(health: DataFrame) -> DataFrame:
    """Scores to one decimal, a hair upwards: a mean that ends exactly between two
    decimals does not hang on the order of its sum."""
    hair = F.lit(1e-9)
    return health.filter("is_degraded").groupBy("site_id").agg(
        F.count("*").alias("degraded_windows"),
        F.round(F.min("health_score") + hair, 1).alias("min_score"),
        F.round(F.avg("health_score") + hair, 1).alias("avg_score"),
    ).orderBy("min_score", "site_id")


def layer_counts(**tables: DataFrame) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


def dlq_rate_alert(routed: DataFrame, ts: str, width: str = "5 minutes", limit: float = 0.05) -> DataFrame:
    """Windows in which more than `limit` of the ingested records were quarantined."""
    share = F.col("quarantined") / (F.col("validated") + 1)
    return (
        routed.groupBy(F.window(ts, width).alias("w"))
        .agg(
            F.count_if(F.col("route") == "INVALID").alias("quarantined"),
            F.count_if(F.col("route") != "INVALID").alias("validated"),
        )
        .withColumn("dlq_share", share)
        .filter(F.col("dlq_share") > limit)
        .select(F.col("w.start").alias("window_start"), "quarantined", "validated", "dlq_share")
    )


def health_alert(health: DataFrame) -> DataFrame:
    """Sites whose newest score is below the limit."""
    newest = health.groupBy("site_id").agg(
        F.max("window_start").alias("window_start"),
        F.max_by("health_score", "window_start").alias("health_score"))
    return newest.filter(F.col("health_score") < DEGRADED_BELOW)


def ingest_stall(records: DataFrame, ts: str, width_seconds: int = 300) -> DataFrame:
    """Gaps between the first and last record: from the first bucket in which nothing
    arrived to the next in which something did, with the number of empty buckets.

    Neighbours are sought among the buckets of a day; only a day's last bucket looks to the
    first of the next day that has any. So no list of all buckets is ever built.
    """
    day = 86400
    seen = records.select(
        (F.floor(F.unix_timestamp(ts) / width_seconds) * width_seconds).alias("bucket")
    ).filter(F.col("bucket").isNotNull()).distinct().withColumn("day", F.floor(F.col("bucket") / day))
    within = seen.withColumn("next", F.lead("bucket").over(Window.partitionBy("day").orderBy("bucket")))
    days = seen.groupBy("day").agg(F.min("bucket").alias("first"), F.max("bucket").alias("last"))
    # One row per day that has any record.
    across = days.select(F.col("last").alias("bucket"), F.lead("first").over(Window.orderBy("day")).alias("next"))
    gaps = within.select("bucket", "next").unionByName(across).filter(F.col("next") > F.col("bucket") + width_seconds)
    return gaps.select(
        F.timestamp_seconds(F.col("bucket") + width_seconds).alias("window_start"),
        F.timestamp_seconds("next").alias("window_end"),
        (F.floor((F.col("next") - F.col("bucket")) / width_seconds) - 1).cast("long").alias("missing"))


def rate_by_status(routed: DataFrame, ts: str, topic: str = "_source_topic") -> DataFrame:
    status = F.when(F.col("route") == "INVALID", "invalid").otherwise("valid")
    return routed.groupBy(
        F.date_trunc("minute", ts).alias("minute"), F.col(topic).alias("topic"),
        status.alias("status"),
    ).agg(F.count("*").alias("records"))


def anomaly_rate(scored: DataFrame) -> DataFrame:
    return (
        scored.filter("ingest_anomaly")
        .select(F.date_trunc("minute", "device_ts").alias("minute"),
                F.explode("ingest_flags").alias("anomaly_type"))
        .groupBy("minute", "anomaly_type").agg(F.count("*").alias("anomalies"))
    )


def batch_p99(progress: DataFrame) -> DataFrame:
    """99th percentile of micro-batch seconds per stage, from the progress log."""
    return progress.groupBy("stage").agg(
        F.percentile_approx("seconds", 0.99, 10000).alias("p99_seconds"),
        F.count("*").alias("batches"))
