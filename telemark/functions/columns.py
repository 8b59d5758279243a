"""Column expressions: casts, derivations, scores. All run inside codegen."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values the results depend on.
SATURATION_LIMIT = 80.0
Z_LIMIT = 2.0
IQR_LIMIT = 1.0
EPSILON = 1e-8
DOWN_STATES = (2, 3)
CRITICAL_BELOW = 3
CRITICAL_CAP = 4
DEGRADED_BELOW = 40.0
SCORE_PLACES = 9
SUBTYPES = {
    "HIGH_Z_SCORE": "Z_SCORE_SPIKE",
    "IQR_OUTLIER": "IQR_FENCE_BREACH",
    "THRESHOLD_SATURATED": "SATURATION",
    "FLATLINE": "LOW_VARIANCE",
}


def as_time(col: Column) -> Column:
    """ISO-8601 text to timestamp; NULL, never an error, on bad text."""
    return F.try_to_timestamp(col)


def once(col: Column) -> Column:
    """A generator of exactly this one value.

    Filters on a generated column stay above it, whereas filters on a projected
    column are pushed down with a copy of its expression each. For an expensive
    expression (a JSON parse) that would mean one more evaluation per filter.
    """
    return F.explode(F.array(col))


def as_number(col: Column) -> Column:
    return col.try_cast("double")


def as_whole(col: Column) -> Column:
    """Text to int by way of double, so "3.0" and "9999.9" keep their whole part."""
    return col.try_cast("double").try_cast("int")


def effective_util(util: str | Column, status: str | Column = "oper_status") -> Column:
    """Zero while the interface is down, the raw reading otherwise."""
    util = F.col(util) if isinstance(util, str) else util
    status = F.col(status) if isinstance(status, str) else status
    return F.when(status.isin(*DOWN_STATES), F.lit(0.0)).otherwise(util)


def is_critical(severity: str = "severity") -> Column:
    return F.col(severity) < CRITICAL_BELOW


def saturated(util_in: str = "effective_util_in", util_out: str = "effective_util_out") -> Column:
    return (F.col(util_in) > SATURATION_LIMIT) | (F.col(util_out) > SATURATION_LIMIT)


def hour_of_day(ts: str = "device_ts") -> Column:
    return F.hour(ts).cast("int")


def day_of_week(ts: str = "device_ts") -> Column:
    """0 = Monday."""
    return F.weekday(ts).cast("int")


def health_score(saturation: Column, critical: Column, down: Column) -> Column:
    """To `SCORE_PLACES` decimals: the rates are fractions of counts, so a score at a limit
    is met exactly and does not hang on the last bit of the sums."""
    penalty = saturation * 40 + F.least(critical, F.lit(CRITICAL_CAP)) * 10 + down * 20
    score = F.round(F.lit(100.0) - penalty, SCORE_PLACES)
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))


def is_degraded(score: str = "health_score") -> Column:
    return F.col(score) < DEGRADED_BELOW


def anomaly_subtype(kind: str = "anomaly_type") -> Column:
    pairs = [F.lit(x) for item in SUBTYPES.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[F.col(kind)], F.lit("INGEST_FLAG"))


def raw_score(kind: str = "anomaly_type") -> Column:
    return (
        F.when(F.col(kind) == "HIGH_Z_SCORE", F.col("ingest_z_score"))
        .when(F.col(kind) == "IQR_OUTLIER", F.col("ingest_iqr_score"))
        .otherwise(F.lit(0.0))
    )


def z_score(value: str, mean: str, std: str) -> Column:
    z = F.abs(F.col(value) - F.col(mean)) / (F.col(std) + F.lit(EPSILON))
    return F.coalesce(z, F.lit(0.0))


def iqr_score(value: str, mean: str, std: str, k: str) -> Column:
    fence = F.abs(F.col(value) - F.col(mean)) / (F.col(k) * F.col(std) + F.lit(EPSILON))
    return F.coalesce(fence, F.lit(0.0))


def ingest_flags(threshold: Column, z: Column, iqr: Column) -> Column:
    return F.array_compact(
        F.array(
            F.when(threshold, F.lit("THRESHOLD_SATURATED")),
            F.when(z > Z_LIMIT, F.lit("HIGH_Z_SCORE")),
            F.when(iqr > IQR_LIMIT, F.lit("IQR_OUTLIER")),
        )
    )


def rules_json(**fields) -> Column:
    """Provenance text for a parameter row."""
    cols = [(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()]
    return F.to_json(F.struct(*cols))


def nonempty(name: str) -> Column:
    return F.length(F.coalesce(F.col(name), F.lit(""))) > 0


# Fixed: the times whose day is the `_partition_date` of the table that holds them.
PARTITIONED_TIMES = ("device_ts", "quarantined_at")


def since(df: DataFrame, start: Column, ts: str = "device_ts") -> DataFrame:
    """Rows from `start` on. Where the table is partitioned by the day of `ts`, the
    day is compared too, so that older partitions are not listed or read."""
    keep = F.col(ts) >= start
    if ts in PARTITIONED_TIMES and "_partition_date" in df.columns:
        keep = keep & (F.col("_partition_date") >= F.to_date(start))
    return df.filter(keep)
