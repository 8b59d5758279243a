"""Payload text to typed columns, and the derive / projection steps."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemark.functions import columns as C

# Fixed field lists of the three feeds.
STATS_FIELDS = (
    "ts", "device_id", "interface_name", "util_in", "util_out", "admin_status", "oper_status",
)
SYSLOG_FIELDS = ("ts", "device_id", "severity", "message")
INVENTORY_FIELDS = ("device_id", "site_id", "vendor", "role")


def payload_map(raw: str | Column) -> Column:
    """Every top-level JSON key as text; NULL when the text is not a JSON object."""
    return F.from_json(raw, "map<string,string>")


def extra_cols(mapped: Column, known: tuple[str, ...]) -> Column:
    return F.map_filter(mapped, lambda k, _: ~k.isin(*known))


def json_field(raw: str, name: str) -> Column:
    return F.get_json_object(F.col(raw), f"$.{name}")


def unpack(df: DataFrame, fields: tuple[str, ...], raw: str) -> DataFrame:
    """Known fields as text plus the rest as `_extra_cols`, from one JSON parse."""
    return (
        df.withColumn("_all", C.once(payload_map(raw)))
        .withColumns({f: F.col("_all")[f] for f in fields})
        .withColumn("_extra_cols", extra_cols(F.col("_all"), fields))
        .drop("_all")
    )


def with_ingest_meta(df: DataFrame, topic: str | Column, at: Column | None = None) -> DataFrame:
    at = F.current_timestamp() if at is None else at
    return df.withColumns({
        "_ingested_at": at,
        "_source_topic": F.lit(topic) if isinstance(topic, str) else topic,
        "_partition_date": F.to_date(at),
    })


def derive_stats(df: DataFrame) -> DataFrame:
    """Event time, effective utilisation and event day; keeps a given ingest time."""
    cols = {
        "device_ts": C.as_time(F.col("ts")),
        "effective_util_in": C.effective_util("util_in"),
        "effective_util_out": C.effective_util("util_out"),
        "_partition_date": F.to_date(C.as_time(F.col("ts"))),
    }
    if "_ingested_at" not in df.columns:
        cols["_ingested_at"] = F.current_timestamp()
    return df.withColumns(cols)


def derive_syslogs(df: DataFrame) -> DataFrame:
    cols = {
        "device_ts": C.as_time(F.col("ts")),
        "is_critical": C.is_critical(),
        "_partition_date": F.to_date(C.as_time(F.col("ts"))),
    }
    if "_ingested_at" not in df.columns:
        cols["_ingested_at"] = F.current_timestamp()
    return df.withColumns(cols)


def type_stats(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "util_in": C.as_number(F.col("util_in")),
        "util_out": C.as_number(F.col("util_out")),
        "admin_status": C.as_whole(F.col("admin_status")),
        "oper_status": C.as_whole(F.col("oper_status")),
    })


def parse_stats(df: DataFrame, raw: str = "payload") -> DataFrame:
    return derive_stats(type_stats(unpack(df, STATS_FIELDS, raw)))


def parse_syslogs(df: DataFrame, raw: str = "payload") -> DataFrame:
    text = unpack(df, SYSLOG_FIELDS, raw)
    return derive_syslogs(text.withColumn("severity", C.as_whole(F.col("severity"))))


def parse_inventory(df: DataFrame, raw: str = "payload") -> DataFrame:
    return unpack(df, INVENTORY_FIELDS, raw)


def season_keys(df: DataFrame, ts: str = "device_ts") -> DataFrame:
    return df.withColumns({"hour_of_day": C.hour_of_day(ts), "day_of_week": C.day_of_week(ts)})


def to_silver_stats(df: DataFrame) -> DataFrame:
    extras = (
        F.col("_extra_cols")
        if "_extra_cols" in df.columns
        else F.lit(None).cast("map<string,string>")
    )
    return df.select(
        "device_id", "site_id", "interface_name", "vendor", "role", "device_ts",
        "util_in", "util_out", "effective_util_in", "effective_util_out",
        "admin_status", "oper_status",
        "ingest_z_score", "ingest_iqr_score", "ingest_anomaly", "ingest_flags",
        extras.alias("_extra_cols"), "_ingested_at",
        F.to_date("device_ts").alias("_partition_date"),
    )


def to_silver_syslogs(df: DataFrame) -> DataFrame:
    return df.select(
        "device_id", "site_id", "vendor", "role", "device_ts", "severity", "is_critical",
        "message", "_ingested_at", F.to_date("device_ts").alias("_partition_date"),
    )


def to_silver_dlq(
    df: DataFrame, raw: str = "payload", reason: str = "validation_reason",
    topic: str = "source_topic", at: Column | None = None,
) -> DataFrame:
    at = F.current_timestamp() if at is None else at
    return df.select(
        F.col(raw).alias("raw_payload"),
        F.col(reason).alias("quarantine_reason"),
        F.col(topic).alias("source_topic"),
        at.alias("quarantined_at"),
        F.lit(False).alias("reprocessed"),
        F.lit(None).cast("timestamp").alias("reprocessed_at"),
        F.lit(None).cast("string").alias("quarantine_resolution"),
        F.to_date(at).alias("_partition_date"),
    )


def to_silver_pending(
    df: DataFrame, raw: str = "payload", topic: str = "source_topic", at: Column | None = None,
    retries: Column | None = None,
) -> DataFrame:
    at = F.current_timestamp() if at is None else at
    retries = F.lit(0) if retries is None else retries
    return df.select(
        F.col(raw).alias("raw_payload"),
        F.col(topic).alias("source_topic"),
        at.alias("parked_at"),
        "device_id",
        F.lit(False).alias("enriched"),
        F.lit(None).cast("timestamp").alias("enriched_at"),
        retries.cast("int").alias("retry_count"),
        F.to_date(at).alias("_partition_date"),
    )
