"""Column layouts of every table, as DDL strings and StructTypes."""
from __future__ import annotations

from pyspark.sql.types import StructType

# Fixed layouts: names, order and types that readers of the tables rely on.
TABLES: dict[str, str] = {
    "bronze_interface_stats": """
        _raw_payload string, ts string, device_id string, interface_name string,
        util_in double, util_out double, admin_status int, oper_status int,
        _extra_cols map<string,string>, _ingested_at timestamp,
        _source_topic string, _partition_date date""",
    "bronze_syslogs": """
        _raw_payload string, ts string, device_id string, severity int, message string,
        _extra_cols map<string,string>, _ingested_at timestamp,
        _source_topic string, _partition_date date""",
    "bronze_inventory": """
        device_id string, site_id string, vendor string, role string,
        _ingested_at timestamp, _source_topic string, _partition_date date""",
    "silver_interface_stats": """
        device_id string, site_id string, interface_name string, vendor string, role string,
        device_ts timestamp, util_in double, util_out double,
        effective_util_in double, effective_util_out double,
        admin_status int, oper_status int,
        ingest_z_score double, ingest_iqr_score double, ingest_anomaly boolean,
        ingest_flags array<string>, _extra_cols map<string,string>,
        _ingested_at timestamp, _partition_date date""",
    "silver_syslogs": """
        device_id string, site_id string, vendor string, role string, device_ts timestamp,
        severity int, is_critical boolean, message string,
        _ingested_at timestamp, _partition_date date""",
    "silver_dlq_quarantine": """
        raw_payload string, quarantine_reason string, source_topic string,
        quarantined_at timestamp, reprocessed boolean, reprocessed_at timestamp,
        quarantine_resolution string, _partition_date date""",
    "silver_pending_enrichment": """
        raw_payload string, source_topic string, parked_at timestamp, device_id string,
        enriched boolean, enriched_at timestamp, retry_count int, _partition_date date""",
    "silver_flatline_flags": """
        device_id string, site_id string, interface_name string,
        window_start timestamp, window_end timestamp, anomaly_type string,
        variance double, mean_util_in double, oper_status int, detected_at timestamp""",
    "gold_site_health_hourly": """
        site_id string, window_start timestamp, window_end timestamp,
        avg_util_in float, avg_util_out float, pct_interfaces_saturated float,
        critical_syslog_count bigint, total_interface_count bigint,
        pct_interfaces_down float, refreshed_at timestamp""",
    "gold_anomaly_flags": """
        device_id string, site_id string, interface_name string,
        window_start timestamp, window_end timestamp,
        anomaly_type string, anomaly_subtype string, score float,
        mean_util_in float, std_util_in float, detected_at timestamp""",
    "device_baseline_params": """
        device_id string, interface_name string, hour_of_day int, day_of_week int,
        baseline_mean float, baseline_std float, iqr_k float,
        isolation_score_threshold float, distilled_rules string,
        valid_from timestamp, valid_until timestamp""",
    "anomaly_validation": """
        device_id string, interface_name string, window_start timestamp,
        ingest_flagged int, batch_flagged int, agreement string, validated_at timestamp""",
}

# Fixed keys: what makes a row of a versioned table "the same" row.
SEASON_KEYS = ("device_id", "interface_name", "hour_of_day", "day_of_week")
HEALTH_KEYS = ("site_id", "window_start")
ANOMALY_KEYS = ("device_id", "interface_name", "anomaly_type", "anomaly_subtype", "window_start")

# Fixed partition columns per layer.
PARTITIONS: dict[str, tuple[str, ...]] = {
    "bronze_interface_stats": ("_source_topic", "_partition_date"),
    "bronze_syslogs": ("_source_topic", "_partition_date"),
    "bronze_inventory": ("_partition_date",),
    "silver_interface_stats": ("site_id", "_partition_date"),
    "silver_syslogs": ("site_id", "_partition_date"),
    "silver_dlq_quarantine": ("_partition_date",),
    "silver_pending_enrichment": ("_partition_date",),
}

# Fixed file order inside a partition, so row groups can be skipped by min/max.
SORT_ORDER: dict[str, tuple[str, ...]] = {
    "silver_interface_stats": ("device_id", "interface_name", "device_ts"),
    "silver_syslogs": ("device_id", "device_ts"),
}


def ddl(table: str) -> str:
    return " ".join(TABLES[table].split())


def struct(table: str) -> StructType:
    return StructType.fromDDL(ddl(table))
