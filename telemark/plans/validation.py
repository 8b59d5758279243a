"""Agreement between ingest-time and batch anomaly decisions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("device_id", "interface_name", "window_start")


def agreement(ingest: str = "ingest_flagged", batch: str = "batch_flagged") -> Column:
    i, b = F.col(ingest) == 1, F.col(batch) == 1
    return (
        F.when(i & b, "CONFIRMED").when(i, "FALSE_POSITIVE").when(b, "MISSED")
        .otherwise("BOTH_CLEAN")
    )


def ingest_hours(silver: DataFrame) -> DataFrame:
    """Whether any reading of the hour was flagged at ingest."""
    return silver.groupBy(
        "device_id", "interface_name", F.date_trunc("hour", "device_ts").alias("window_start")
    ).agg(F.max(F.col("ingest_anomaly").cast("int")).alias("ingest_flagged"))


def validate_decisions(ingest: DataFrame, batch: DataFrame, at: Column | None = None) -> DataFrame:
    """Both decisions per (device, interface, hour); a side without a row counts as clean."""
    at = F.current_timestamp() if at is None else at
    joined = ingest.select(*KEYS, "ingest_flagged").join(
        batch.select(*KEYS, "batch_flagged"), list(KEYS), "full_outer")
    return joined.fillna(0, ["ingest_flagged", "batch_flagged"]).select(
        *KEYS, "ingest_flagged", "batch_flagged", agreement().alias("agreement"),
        at.alias("validated_at"))
