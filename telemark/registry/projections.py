"""Projections, derivations and JSON (inventory section 2.3)."""
from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.functions import columns as C
from telemark.operators import flatline as FL
from telemark.operators import parse as P
from telemark.plans import baseline as B
from telemark.registry.base import query



@query("proj_parse_stats", """
    SELECT event_id, ts, device_id, interface_name, CAST(util_in AS VARCHAR) = 'nan' AS util_in_nan,
           CASE WHEN k <> 95 THEN round(util_in, 6) END AS util_in, util_out, admin_status, oper_status,
           device_ts, CASE WHEN k <> 95 THEN round(effective_util_in, 6) END AS effective_util_in,
           CAST(device_ts AS DATE) AS partition_date
    FROM derived""")
def _(t):
    def finite(name):
        return F.when(~F.isnan(name), F.col(name)).alias(name)

    return P.parse_stats(t.payloads).select(
        "event_id", "ts", "device_id", "interface_name", F.when(
            F.col("util_in").isNotNull(), F.isnan("util_in")).alias("util_in_nan"),
        finite("util_in"), "util_out", "admin_status", "oper_status", "device_ts",
        finite("effective_util_in"), F.col("_partition_date").alias("partition_date"))


@query("proj_parse_syslogs", """
    SELECT event_id, ts, device_id, severity, message, device_ts, severity < 3 AS is_critical FROM logs""")
def _(t):
    return P.parse_syslogs(X.syslog_payloads(t.events)).select(
        "event_id", "ts", "device_id", "severity", "message", "device_ts", "is_critical")


@query("proj_parse_inventory", "SELECT device_id, site_id, vendor, role FROM devices")
def _(t):
    text = t.devices.select(
        F.to_json(F.struct("device_id", "site_id", "vendor", "role", "balance")).alias("payload"))
    return P.parse_inventory(text).select(*P.INVENTORY_FIELDS)


@query("proj_extra_cols", """
    SELECT event_id, CASE WHEN k <> 93 THEN event_id END AS seq,
           CASE WHEN k <> 93 THEN 1 END AS n_extra FROM ev""")
def _(t):
    mapped = t.payloads.withColumn("_all", P.payload_map("payload"))
    return mapped.withColumn("_extra_cols", P.extra_cols(F.col("_all"), P.STATS_FIELDS)).select(
        "event_id", X.seq(),
        F.when(F.col("_extra_cols").isNotNull(), F.size("_extra_cols")).alias("n_extra"))


@query("proj_json_field", """
    SELECT event_id, CASE WHEN k <> 93 AND k <> 97 THEN user_key END AS device_id,
           CASE WHEN k <> 93 THEN event_type END AS interface_name FROM ev""")
def _(t):
    return t.payloads.select(
        "event_id", P.json_field("payload", "device_id").alias("device_id"),
        P.json_field("payload", "interface_name").alias("interface_name"))


@query("proj_ingest_meta", """
    SELECT event_id, event_ts AS ingested_at, 'raw.interface-stats' AS source_topic,
           CAST(event_ts AS DATE) AS partition_date FROM ev""")
def _(t):
    tagged = P.with_ingest_meta(X.event_base(t.events), X.STATS_TOPIC, F.col("event_ts"))
    return tagged.select(
        "event_id", F.col("_ingested_at").alias("ingested_at"),
        F.col("_source_topic").alias("source_topic"),
        F.col("_partition_date").alias("partition_date"))


@query("proj_effective_util", """
    SELECT event_id, CASE WHEN oper_status IN (2, 3) THEN 0.0 ELSE util_in END AS effective_util_in,
           CASE WHEN oper_status IN (2, 3) THEN 0.0 ELSE util_out END AS effective_util_out
    FROM stats""")
def _(t):
    return t.stats.select(
        "event_id", C.effective_util("util_in").alias("effective_util_in"),
        C.effective_util("util_out").alias("effective_util_out"))


@query("proj_is_critical", "SELECT event_id, severity, severity < 3 AS is_critical FROM logs")
def _(t):
    return t.syslogs.select("event_id", "severity", C.is_critical().alias("is_critical"))


@query("proj_stats_derived", """
    SELECT event_id, device_ts, effective_util_out, ingested AS ingested_at,
           CAST(device_ts AS DATE) AS partition_date FROM derived""")
def _(t):
    return t.derived.select(
        "event_id", "device_ts", "effective_util_out", F.col("_ingested_at").alias("ingested_at"),
        F.col("_partition_date").alias("partition_date"))


@query("proj_syslog_derived", """
    SELECT event_id, device_ts, severity < 3 AS is_critical, CAST(device_ts AS DATE) AS partition_date
    FROM logs""")
def _(t):
    return P.derive_syslogs(t.syslogs).select(
        "event_id", "device_ts", "is_critical", F.col("_partition_date").alias("partition_date"))


@query("proj_season_keys", """
    SELECT event_id, CAST(hour(event_ts) AS INTEGER) AS hour_of_day,
           CAST(isodow(event_ts) - 1 AS INTEGER) AS day_of_week FROM ev""")
def _(t):
    keyed = P.season_keys(X.event_base(t.events), "event_ts")
    return keyed.select("event_id", "hour_of_day", "day_of_week")


@query("proj_silver_stats", """
    SELECT device_id, site_id, interface_name, vendor, role, device_ts, round(util_in, 6) AS util_in,
           util_out, round(effective_util_in, 6) AS effective_util_in, effective_util_out,
           admin_status, oper_status, round(z, 6) AS ingest_z_score, round(iqr, 6) AS ingest_iqr_score,
           ingest_anomaly,
           concat_ws(',', CASE WHEN sat THEN 'THRESHOLD_SATURATED' END,
                     CASE WHEN z > 2 THEN 'HIGH_Z_SCORE' END,
                     CASE WHEN iqr > 1 THEN 'IQR_OUTLIER' END) AS ingest_flags,
           event_id AS seq, ingested AS ingested_at, CAST(device_ts AS DATE) AS partition_date
    FROM scored""")
def _(t):
    s = P.to_silver_stats(t.scored)
    return s.select(
        *[c for c in s.columns if c not in ("ingest_flags", "_extra_cols", "_ingested_at", "_partition_date")],
        F.array_join("ingest_flags", ",").alias("ingest_flags"), X.seq(),
        F.col("_ingested_at").alias("ingested_at"), F.col("_partition_date").alias("partition_date"))


@query("proj_silver_dlq", """
    SELECT event_id AS seq, quarantine_reason, 'raw.interface-stats' AS source_topic, quarantined_at,
           false AS reprocessed, CAST(quarantined_at AS DATE) AS partition_date
    FROM dlq WHERE quarantine_reason <> 'NULL_FIELD'
    UNION ALL BY NAME
    SELECT CASE WHEN k <> 93 THEN event_id END AS seq, 'NULL_FIELD' AS quarantine_reason,
           'raw.interface-stats' AS source_topic, ingested AS quarantined_at, false AS reprocessed,
           CAST(ingested AS DATE) AS partition_date
    FROM routed WHERE validation_reason = 'NULL_FIELD'""")
def _(t):
    return t.dlq.select(
        X.payload_seq(), "quarantine_reason",
        "source_topic", "quarantined_at", "reprocessed",
        F.col("_partition_date").alias("partition_date"))


@query("proj_silver_pending", """
    SELECT event_id AS seq, 'raw.interface-stats' AS source_topic, ingested AS parked_at, device_id,
           false AS enriched, CAST(retry_count AS INTEGER) AS retry_count,
           CAST(ingested AS DATE) AS partition_date FROM pending""")
def _(t):
    return t.pending.select(
        X.payload_seq(), "source_topic",
        "parked_at", "device_id", "enriched", "retry_count",
        F.col("_partition_date").alias("partition_date"))


@query("proj_silver_syslogs", """
    SELECT device_id, site_id, vendor, role, device_ts, severity, is_critical, message,
           ingested AS ingested_at, CAST(device_ts AS DATE) AS partition_date FROM clean_logs""")
def _(t):
    s = P.to_silver_syslogs(t.silver_syslogs)
    return s.withColumnsRenamed({"_ingested_at": "ingested_at", "_partition_date": "partition_date"})


@query("proj_health_score", """
    SELECT site_id, window_start, round(health_score, 6) AS health_score FROM health""")
def _(t):
    return t.health.select("site_id", "window_start", "health_score")


@query("proj_is_degraded", "SELECT site_id, window_start, is_degraded FROM health")
def _(t):
    return t.health.select("site_id", "window_start", "is_degraded")


@query("proj_subtype", """
    SELECT event_id, anomaly_type, CASE anomaly_type WHEN 'HIGH_Z_SCORE' THEN 'Z_SCORE_SPIKE'
           WHEN 'IQR_OUTLIER' THEN 'IQR_FENCE_BREACH' ELSE 'SATURATION' END AS anomaly_subtype
    FROM flagged""")
def _(t):
    kinds = t.scored.select("event_id", F.explode("ingest_flags").alias("anomaly_type"))
    return kinds.withColumn("anomaly_subtype", C.anomaly_subtype())


@query("proj_raw_score", """
    SELECT event_id, anomaly_type, round(raw_score, 6) AS raw_score FROM flagged""")
def _(t):
    kinds = t.scored.select("*", F.explode("ingest_flags").alias("anomaly_type"))
    return kinds.select("event_id", "anomaly_type", C.raw_score().alias("raw_score"))


@query("proj_flatline", """
    SELECT device_id, site_id, interface_name, window_start, window_end, anomaly_type,
           round(score, 6) AS variance, round(mean_util_in, 6) AS mean_util_in,
           1 AS oper_status, detected_at FROM flat_flags""")
def _(t):
    return flat_flags(t)


def flat_flags(t):
    """Staged 4-hour windows; the sparse test series need a wide threshold."""
    windows = FL.flat_windows(t.enriched, threshold=25.0)
    return FL.to_flatline_flags(windows, F.col("w.end"))


@query("proj_anomaly_record", """
    SELECT device_id, site_id, interface_name, window_start, window_end, anomaly_type,
           anomaly_subtype, round(score, 6) AS score, round(mean_util_in, 6) AS mean_util_in,
           CAST(std_util_in AS DOUBLE) AS std_util_in, detected_at FROM flat_flags""")
def _(t):
    return FL.to_anomaly_records(flat_flags(t))


@query("proj_rules_json", """
    SELECT site_id, interface_name, day_of_week::INTEGER AS day_of_week,
           '{"source":"weekly_baseline_refresh","lookback_days":30,"sample_count":' || count(*) || '}'
               AS distilled_rules
    FROM normal GROUP BY ALL""")
def _(t):
    normal = B.confirmed_normal(t.scored, t.as_of)
    params = B.refresh_params(normal, t.as_of, X.DENSE_KEYS)
    return params.select(*X.DENSE_KEYS, "distilled_rules")
