"""Batch collection of a topic: contract check, last record per key wins, counts."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemark.operators import parse as P
from telemark.operators.route import contract_failure
from telemark.operators.versions import dedup_last_wins

FIELDS = {
    "interface_stats": P.STATS_FIELDS,
    "syslogs": P.SYSLOG_FIELDS,
    "inventory": P.INVENTORY_FIELDS,
}
# Fixed default dedup keys. Interfaces sampled together share time and device.
DEDUP_KEYS = {
    "interface_stats": ("ts", "device_id", "interface_name"),
    "syslogs": ("ts", "device_id"),
    "inventory": ("device_id", "site_id"),
}


@dataclass
class Collected:
    kept: DataFrame
    rejected: DataFrame
    counts: DataFrame


def collect_topic(
    messages: DataFrame, feed: str, arrival: str, keys: tuple[str, ...] | None = None,
) -> Collected:
    """`messages` hold `payload`, `source_topic` and their order of arrival."""
    keys = keys or DEDUP_KEYS[feed]
    text = P.unpack(messages, FIELDS[feed], "payload").withColumn(
        "validation_reason", contract_failure(feed))
    good = F.col("validation_reason").isNull()
    # One aggregate for all counts; what fails the contract forms a single group.
    parts = [
        F.when(good, F.coalesce(F.col(k), F.lit(""))).alias(f"_k{i}") for i, k in enumerate(keys)]
    groups = text.groupBy(good.alias("_good"), *parts).agg(F.count("*").alias("_n"))
    ok = F.col("_good")
    counts = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("consumed"),
        F.count_if(ok).alias("written"),
        F.coalesce(F.sum(F.when(ok, F.col("_n") - 1)), F.lit(0)).alias("duplicates_dropped"),
        F.coalesce(F.sum(F.when(~ok, F.col("_n"))), F.lit(0)).alias("parse_errors"),
    )
    return Collected(
        kept=dedup_last_wins(text.filter(good), keys, arrival).drop("validation_reason"),
        rejected=text.filter(~good),
        counts=counts,
    )
