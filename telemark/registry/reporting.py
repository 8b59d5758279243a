"""Reporting queries (section 2.11)."""
from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.plans import reports as R
from telemark.plans import reprocess as RP
from telemark.plans import validation as VA
from telemark.registry.aggregates import anomalies
from telemark.registry.base import query

# The time of the latest event, as `Tables.as_of`.
AS_OF = "(SELECT now FROM latest)"


@query("rpt_anomalies_5m", f"""
    SELECT time_bucket(INTERVAL 5 MINUTE, detected_at) AS time, site_id AS metric, count(*) AS value
    FROM flag_windows WHERE detected_at >= {AS_OF} - INTERVAL 7 DAY GROUP BY 1, 2""")
def _(t):
    return R.anomalies_5m(t.flag_windows, t.as_of)


@query("rpt_health_trend", f"""
    SELECT window_start AS time, site_id AS metric, round(avg(health_score), 6) AS value
    FROM health WHERE window_start >= {AS_OF} - INTERVAL 7 DAY GROUP BY 1, 2""")
def _(t):
    return R.health_trend(t.health, t.as_of)


@query("rpt_health_latest", f"""
    SELECT site_id, round(arg_max(health_score, window_start), 6) AS health_score
    FROM health WHERE window_start >= {AS_OF} - INTERVAL 48 HOUR GROUP BY 1""")
def _(t):
    return R.health_latest(t.health, t.as_of)


@query("rpt_health_current_avg", f"""
    SELECT round(avg(s), 6) AS avg_health_score FROM (
        SELECT site_id, arg_max(health_score, window_start) AS s FROM health
        WHERE window_start >= {AS_OF} - INTERVAL 48 HOUR GROUP BY 1)""")
def _(t):
    return R.health_current_avg(t.health, t.as_of)


@query("rpt_degraded", f"""
    SELECT site_id, window_start, round(health_score, 6) AS health_score,
           round(pct_interfaces_saturated, 6) AS pct_interfaces_saturated,
           round(pct_interfaces_down, 6) AS pct_interfaces_down, critical_syslog_count
    FROM health WHERE window_start >= {AS_OF} - INTERVAL 7 DAY AND is_degraded""")
def _(t):
    return R.degraded(t.health, t.as_of, "7 DAYS")


@query("rpt_saturation_pct", f"""
    SELECT window_start AS time, site_id AS metric,
           round(avg(pct_interfaces_saturated) * 100, 6) AS value
    FROM health WHERE window_start >= {AS_OF} - INTERVAL 48 HOUR GROUP BY 1, 2""")
def _(t):
    return R.saturation_pct(t.health, t.as_of)


@query("rpt_down_pct", f"""
    SELECT window_start AS time, site_id AS metric, round(avg(pct_interfaces_down) * 100, 6) AS value
    FROM health WHERE window_start >= {AS_OF} - INTERVAL 48 HOUR GROUP BY 1, 2""")
def _(t):
    return R.down_pct(t.health, t.as_of)


@query("rpt_critical_logs", f"""
    SELECT window_start AS time, site_id AS metric, CAST(sum(critical_syslog_count) AS BIGINT) AS value
    FROM health WHERE window_start >= {AS_OF} - INTERVAL 48 HOUR GROUP BY 1, 2""")
def _(t):
    return R.critical_logs(t.health, t.as_of)


@query("rpt_dlq_reasons", f"""
    SELECT quarantine_reason AS reason, count(*) AS cnt FROM dlq
    WHERE quarantined_at >= {AS_OF} - INTERVAL 24 HOUR GROUP BY 1
    UNION ALL SELECT 'NO_DQ_EVENTS', 0""")
def _(t):
    return R.dlq_reasons(t.dlq, t.as_of)


@query("rpt_orphan_rate", f"""
    SELECT round(CAST(count(*) FILTER (WHERE quarantine_reason = 'ORPHANED_DEVICE') AS DOUBLE)
                 / greatest(count(*), 1) * 100, 6) AS orphan_rate_pct
    FROM dlq WHERE quarantined_at >= {AS_OF} - INTERVAL 24 HOUR""")
def _(t):
    return R.orphan_rate(t.dlq, t.as_of)


# The fixture's batch verdict: a busy hour, judged on effective utilisation alone.
VALIDATION_CTES = """
    WITH hours AS (
        SELECT device_id, interface_name, date_trunc('hour', device_ts) AS window_start,
               max(CAST(ingest_anomaly AS INTEGER)) AS ingest_flagged,
               CASE WHEN max(effective_util_in) > 60 THEN 1 ELSE 0 END AS batch_flagged
        FROM scored GROUP BY ALL),
    checked AS (
        SELECT *, CASE WHEN ingest_flagged = 1 AND batch_flagged = 1 THEN 'CONFIRMED'
                       WHEN ingest_flagged = 1 THEN 'FALSE_POSITIVE'
                       WHEN batch_flagged = 1 THEN 'MISSED' ELSE 'BOTH_CLEAN' END AS agreement,
               window_start + INTERVAL 1 HOUR AS validated_at FROM hours)
"""


def checked(t):
    batch = t.scored.groupBy(
        "device_id", "interface_name", F.date_trunc("hour", "device_ts").alias("window_start")
    ).agg(F.when(F.max("effective_util_in") > 60, 1).otherwise(0).alias("batch_flagged"))
    return VA.validate_decisions(
        VA.ingest_hours(t.scored), batch, F.col("window_start") + F.expr("INTERVAL 1 HOUR"))


@query("job_validation", VALIDATION_CTES + """
    SELECT device_id, interface_name, window_start, ingest_flagged, batch_flagged, agreement FROM checked""")
def _(t):
    return checked(t).drop("validated_at")


@query("rpt_agreement", VALIDATION_CTES + f"""
    SELECT date_trunc('hour', validated_at) AS time,
           round(CAST(count(*) FILTER (WHERE agreement = 'CONFIRMED') AS DOUBLE)
                 / greatest(count(*), 1) * 100, 6) AS agreement_pct
    FROM checked WHERE validated_at >= {AS_OF} - INTERVAL 24 HOUR GROUP BY 1
    UNION ALL SELECT date_trunc('hour', {AS_OF}), 0.0""")
def _(t):
    return R.agreement_pct(checked(t), t.as_of)


@query("rpt_reprocess_rate", """
    SELECT round(CAST(count(*) FILTER (WHERE quarantine_reason = 'ORPHANED_DEVICE' AND d.site_id IS NOT NULL)
                      AS DOUBLE) / greatest(count(*), 1) * 100, 6) AS reprocess_success_pct
    FROM dlq q LEFT JOIN devices d ON q.device_id = d.device_id""")
def _(t):
    decided = RP.decide_dlq(t.dlq, t.late_inventory)
    return R.reprocess_rate(RP.dlq_state(t.dlq, RP.resolution_log(decided, t.as_of)))


@query("rpt_false_positive", VALIDATION_CTES + f"""
    SELECT round(CAST(count(*) FILTER (WHERE agreement = 'FALSE_POSITIVE') AS DOUBLE)
                 / greatest(count(*), 1) * 100, 6) AS false_positive_pct
    FROM checked WHERE validated_at >= {AS_OF} - INTERVAL 24 HOUR""")
def _(t):
    return R.false_positive_pct(checked(t), t.as_of)


@query("rpt_site_summary", """
    SELECT site_id, count(*) AS records, round(min(health_score), 6) AS min_score,
           round(max(health_score), 6) AS max_score, round(avg(health_score), 2) AS avg_score
    FROM health GROUP BY 1""")
def _(t):
    return R.site_summary(t.health)


@query("rpt_type_pivot", """
    SELECT count(*) FILTER (WHERE anomaly_type = 'THRESHOLD_SATURATED') AS threshold_saturated,
           count(*) FILTER (WHERE anomaly_type = 'HIGH_Z_SCORE') AS high_z_score,
           count(*) FILTER (WHERE anomaly_type = 'IQR_OUTLIER') AS iqr_outlier,
           count(*) FILTER (WHERE anomaly_type = 'FLATLINE') AS flatline,
           count(*) FILTER (WHERE anomaly_type = 'CRITICAL_SYSLOG_BURST') AS critical_syslog_burst,
           count(*) FILTER (WHERE anomaly_type = 'MODEL') AS model,
           count(*) AS total FROM anomalies""")
def _(t):
    return R.type_pivot(anomalies(t))


@query("rpt_degraded_sites", """
    SELECT site_id, count(*) AS degraded_windows, round(min(health_score) + 1e-9, 1) AS min_score,
           round(avg(health_score) + 1e-9, 1) AS avg_score FROM health WHERE is_degraded GROUP BY 1""")
def _(t):
    return R.degraded_sites(t.health)


@query("rpt_layer_counts", """
    SELECT 'silver_interface_stats' AS table_name, count(*) AS row_count FROM enriched
    UNION ALL SELECT 'silver_syslogs', count(*) FROM clean_logs
    UNION ALL SELECT 'silver_dlq_quarantine', count(*) FROM dlq
    UNION ALL SELECT 'gold_site_health_hourly', count(*) FROM health
    UNION ALL SELECT 'gold_anomaly_flags', count(*) FROM flag_windows""")
def _(t):
    return R.layer_counts(
        silver_interface_stats=t.enriched, silver_syslogs=t.silver_syslogs,
        silver_dlq_quarantine=t.dlq, gold_site_health_hourly=t.health,
        gold_anomaly_flags=t.flag_windows)


@query("rpt_dlq_rate_alert", """
    SELECT window_start, quarantined, validated, round(quarantined / (validated + 1), 6) AS dlq_share
    FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ingested) AS window_start,
                 count(*) FILTER (WHERE route = 'INVALID') AS quarantined,
                 count(*) FILTER (WHERE route <> 'INVALID') AS validated
          FROM routed GROUP BY 1)
    WHERE quarantined / (validated + 1) > 0.05""")
def _(t):
    return R.dlq_rate_alert(t.routed, "_ingested_at")


@query("rpt_health_alert", """
    SELECT * FROM (SELECT site_id, max(window_start) AS window_start,
                          round(arg_max(health_score, window_start), 6) AS health_score
                   FROM health GROUP BY 1) WHERE health_score < 40""")
def _(t):
    return R.health_alert(t.health)


@query("rpt_ingest_stall", """
    WITH seen AS (SELECT DISTINCT time_bucket(INTERVAL 5 MINUTE, ingested) AS b FROM stats)
    SELECT b + INTERVAL 5 MINUTE AS window_start, next AS window_end,
           CAST(date_diff('minute', b, next) // 5 - 1 AS BIGINT) AS missing
    FROM (SELECT b, lead(b) OVER (ORDER BY b) AS next FROM seen) WHERE next > b + INTERVAL 5 MINUTE""")
def _(t):
    return R.ingest_stall(t.stats, "_ingested_at")


@query("rpt_rate_by_status", """
    SELECT date_trunc('minute', ingested) AS minute, 'raw.interface-stats' AS topic,
           CASE WHEN route = 'INVALID' THEN 'invalid' ELSE 'valid' END AS status, count(*) AS records
    FROM routed GROUP BY 1, 2, 3""")
def _(t):
    return R.rate_by_status(t.routed, "_ingested_at")


@query("rpt_anomaly_rate", """
    SELECT date_trunc('minute', device_ts) AS minute, anomaly_type, count(*) AS anomalies
    FROM flagged GROUP BY 1, 2""")
def _(t):
    return R.anomaly_rate(t.scored)
