"""Validation and routing: every row gets exactly one route."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemark.functions import rules as R
from telemark.functions.columns import as_number, as_whole
from telemark.operators.joins import attach, salts_for

INVALID, PENDING, ENRICHED = "INVALID", "PENDING", "ENRICHED"


def validate_stats(df: DataFrame, extra: list[R.Rule] | None = None) -> DataFrame:
    return df.withColumn("validation_reason", R.first_failure(R.stats_rules() + (extra or [])))


def validate_syslogs(df: DataFrame, extra: list[R.Rule] | None = None) -> DataFrame:
    return df.withColumn("validation_reason", R.first_failure(R.syslog_rules() + (extra or [])))


def _with_route(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "route": F.when(F.col("validation_reason").isNotNull(), INVALID)
        .when(F.col("site_id").isNull(), PENDING)
        .otherwise(ENRICHED),
        "pending_reason": F.when(
            F.col("validation_reason").isNull() & F.col("site_id").isNull(),
            F.when(F.col("_known").isNull(), "UNKNOWN_DEVICE").otherwise("NO_SITE"),
        ),
    }).drop("_known")


def _enrich_known(df: DataFrame, inventory: DataFrame) -> DataFrame:
    known = inventory.select("device_id", "site_id", "vendor", "role", F.lit(True).alias("_known"))
    return attach(df, known, "device_id", salts=salts_for(known))


def route_stats(
    stats: DataFrame, inventory: DataFrame, extra: list[R.Rule] | None = None,
) -> DataFrame:
    """Rows with `validation_reason`, `route` and `pending_reason`.

    One plan and one `route` column instead of three filtered copies; callers
    filter on `route`, and the counts per route come from one aggregate.
    `inventory` must hold one row per device.
    """
    return _with_route(validate_stats(_enrich_known(stats, inventory), extra))


def route_syslogs(
    syslogs: DataFrame, inventory: DataFrame, drop_unknown: bool = False,
) -> DataFrame:
    """Same for syslogs. Valid rows of unknown devices are parked, or dropped on request."""
    routed = _with_route(validate_syslogs(_enrich_known(syslogs, inventory)))
    return routed.filter(F.col("route") != PENDING) if drop_unknown else routed


def only(routed: DataFrame, route: str) -> DataFrame:
    return routed.filter(F.col("route") == route)


def route_counts(routed: DataFrame, topic: str = "_source_topic") -> DataFrame:
    return routed.groupBy(topic, "route").agg(F.count("*").alias("n"))


# Fixed contract of the batch collector: keys that must be present per feed, and
# optional fields that must be readable as a number when given.
REQUIRED = {
    "interface_stats": ("ts", "device_id"),
    "syslogs": ("ts", "device_id"),
    "inventory": ("device_id", "site_id"),
}
NUMBERS = {"interface_stats": ("util_in", "util_out"), "syslogs": (), "inventory": ()}
WHOLES = {
    "interface_stats": ("admin_status", "oper_status"), "syslogs": ("severity",), "inventory": (),
}


def contract_failure(feed: str):
    """NULL when the text fields of a record meet the collector's contract."""
    rules = [("MISSING_KEY", R.any_null(*REQUIRED[feed]))]
    for name in NUMBERS[feed]:
        col = F.col(name)
        rules.append(("BAD_NUMBER", col.isNotNull() & as_number(col).isNull()))
    for name in WHOLES[feed]:
        col = F.col(name)
        whole = as_number(col) == as_whole(col)
        rules.append(("BAD_NUMBER", col.isNotNull() & ~F.coalesce(whole, F.lit(False))))
    return R.first_failure(rules)


