"""DuckDB forms of the fixture frames, as CTE bodies in order of dependency."""

CTES: dict[str, str] = {
    "latest": "SELECT max(ts) AS now FROM events",
    "ev": """
        SELECT event_id, ts AS event_ts, CAST(user_id AS VARCHAR) AS user_key, event_type, value,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "stats": """
        SELECT event_id, event_ts, k,
               CASE WHEN k = 93 THEN NULL WHEN k = 94 THEN 'x'
                    ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS ts,
               CASE WHEN k IN (93, 97) THEN NULL ELSE user_key END AS device_id,
               CASE WHEN k <> 93 THEN event_type END AS interface_name,
               CASE WHEN k = 93 THEN NULL WHEN k = 98 THEN CAST(-1 AS DOUBLE)
                    WHEN k = 95 THEN CAST('NaN' AS DOUBLE) ELSE value END AS util_in,
               CASE WHEN k <> 93 THEN CAST(k AS DOUBLE) END AS util_out,
               CASE WHEN k <> 93 THEN CAST(1 + k % 2 AS INTEGER) END AS admin_status,
               CASE WHEN k = 93 THEN NULL WHEN k = 92 THEN 9999 WHEN k = 99 THEN 9
                    WHEN k < 10 THEN 2 WHEN k < 20 THEN 3 ELSE 1 END AS oper_status,
               event_ts + INTERVAL 30 SECOND AS ingested
        FROM ev""",
    "derived": """
        SELECT *, TRY_CAST(ts AS TIMESTAMP) AS device_ts,
               CASE WHEN oper_status IN (2, 3) THEN 0.0 ELSE util_in END AS effective_util_in,
               CASE WHEN oper_status IN (2, 3) THEN 0.0 ELSE util_out END AS effective_util_out
        FROM stats""",
    "logs": """
        SELECT event_id, event_ts,
               CASE WHEN k = 94 THEN 'x' ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS ts,
               CASE WHEN k <> 97 THEN user_key END AS device_id,
               CAST(k % 9 AS INTEGER) AS severity, 'code ' || k AS message,
               CASE WHEN k <> 94 THEN event_ts END AS device_ts,
               event_ts + INTERVAL 30 SECOND AS ingested
        FROM ev WHERE event_type = 'error'""",
    "devices": """
        SELECT CAST(c_custkey AS VARCHAR) AS device_id,
               CASE WHEN NOT (c_mktsegment = 'MACHINERY' AND c_acctbal > 8000) THEN n_name END AS site_id,
               c_mktsegment AS vendor,
               CASE WHEN c_acctbal > 5000 THEN 'core' ELSE 'edge' END AS role,
               c_acctbal AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "inventory": """
        SELECT device_id, site_id, vendor, role FROM devices WHERE balance >= 0""",
    "validated": """
        SELECT *, CASE
            WHEN ts IS NULL OR device_id IS NULL OR interface_name IS NULL OR util_in IS NULL
                 OR util_out IS NULL OR oper_status IS NULL THEN 'NULL_FIELD'
            WHEN util_in < 0 OR util_out < 0 THEN 'NEGATIVE_UTIL'
            WHEN util_in > 100 OR util_out > 100 THEN 'EXCEEDS_MAX'
            WHEN oper_status NOT IN (1, 2, 3) THEN 'INVALID_STATUS'
            WHEN device_ts IS NULL THEN 'INVALID_TIMESTAMP' END AS validation_reason
        FROM derived""",
    "routed": """
        SELECT v.*, i.site_id, i.vendor, i.role, i.device_id IS NOT NULL AS known,
               CASE WHEN validation_reason IS NOT NULL THEN 'INVALID'
                    WHEN i.site_id IS NULL THEN 'PENDING' ELSE 'ENRICHED' END AS route
        FROM validated v LEFT JOIN inventory i ON v.device_id = i.device_id""",
    "enriched": "SELECT * FROM routed WHERE route = 'ENRICHED'",
    "validated_logs": """
        SELECT *, CASE
            WHEN ts IS NULL OR device_id IS NULL THEN 'NULL_FIELD'
            WHEN device_ts IS NULL THEN 'INVALID_TIMESTAMP'
            WHEN severity IS NULL OR severity < 0 OR severity > 7 THEN 'INVALID_SEVERITY'
            END AS validation_reason
        FROM logs""",
    "routed_logs": """
        SELECT v.*, i.site_id, i.vendor, i.role, severity < 3 AS is_critical,
               CASE WHEN validation_reason IS NOT NULL THEN 'INVALID'
                    WHEN i.site_id IS NULL THEN 'PENDING' ELSE 'ENRICHED' END AS route
        FROM validated_logs v LEFT JOIN inventory i ON v.device_id = i.device_id""",
    "clean_logs": "SELECT * FROM routed_logs WHERE route = 'ENRICHED'",
    "params": """
        SELECT site_id, interface_name, isodow(device_ts) - 1 AS day_of_week,
               avg(effective_util_in) AS baseline_mean,
               coalesce(stddev_samp(effective_util_in), 0) AS baseline_std, 1.5 AS iqr_k
        FROM enriched
        WHERE NOT (effective_util_in > 80 OR effective_util_out > 80)
        GROUP BY ALL""",
    "scores": """
        SELECT e.*,
               coalesce(abs(effective_util_in - baseline_mean) / (baseline_std + 1e-8), 0) AS z,
               coalesce(abs(effective_util_in - baseline_mean) / (1.5 * baseline_std + 1e-8), 0) AS iqr,
               effective_util_in > 80 OR effective_util_out > 80 AS sat
        FROM enriched e LEFT JOIN params p
          ON e.site_id = p.site_id AND e.interface_name = p.interface_name
         AND isodow(e.device_ts) - 1 = p.day_of_week""",
    "scored": """
        SELECT *, sat OR z > 2 OR iqr > 1 AS ingest_anomaly FROM scores""",
    "flagged": """
        SELECT *, 'THRESHOLD_SATURATED' AS anomaly_type, 0.0 AS raw_score FROM scored WHERE sat
        UNION ALL SELECT *, 'HIGH_Z_SCORE', z FROM scored WHERE z > 2
        UNION ALL SELECT *, 'IQR_OUTLIER', iqr FROM scored WHERE iqr > 1""",
    "health_stats": """
        SELECT site_id, date_trunc('hour', device_ts) AS window_start,
               avg(effective_util_in) AS avg_util_in, avg(effective_util_out) AS avg_util_out,
               count(*) FILTER (WHERE effective_util_in > 80 OR effective_util_out > 80)
                   / count(*) AS pct_interfaces_saturated,
               count(*) AS total_interface_count,
               count(*) FILTER (WHERE oper_status <> 1) / count(*) AS pct_interfaces_down
        FROM enriched GROUP BY 1, 2""",
    "health_logs": """
        SELECT site_id, date_trunc('hour', device_ts) AS window_start,
               count(*) FILTER (WHERE severity < 3) AS critical_syslog_count
        FROM clean_logs GROUP BY 1, 2""",
    "health": """
        SELECT *, health_score < 40 AS is_degraded FROM (
            SELECT s.*, s.window_start + INTERVAL 1 HOUR AS window_end,
                   CAST(coalesce(l.critical_syslog_count, 0) AS BIGINT) AS critical_syslog_count,
                   greatest(0.0, least(100.0, round(100.0 - pct_interfaces_saturated * 40
                       - least(coalesce(l.critical_syslog_count, 0), 4) * 10
                       - pct_interfaces_down * 20, 9))) AS health_score
            FROM health_stats s LEFT JOIN health_logs l USING (site_id, window_start))""",
    "minutes": """
        SELECT device_id, interface_name, date_trunc('minute', device_ts) AS minute_ts,
               max(event_id) AS event_id, min(site_id) AS site_id, max(ingested) AS ingested
        FROM scored WHERE length(device_id) > 0 AND length(interface_name) > 0
        GROUP BY 1, 2, 3""",
    "flag_windows": """
        SELECT f.device_id, min(m.site_id) AS site_id, f.interface_name,
               date_trunc('day', minute_ts) AS window_start,
               date_trunc('day', minute_ts) + INTERVAL 1 DAY AS window_end, anomaly_type,
               CASE anomaly_type WHEN 'HIGH_Z_SCORE' THEN 'Z_SCORE_SPIKE'
                    WHEN 'IQR_OUTLIER' THEN 'IQR_FENCE_BREACH' ELSE 'SATURATION' END AS anomaly_subtype,
               max(raw_score) AS score, avg(effective_util_in) AS mean_util_in,
               stddev_pop(effective_util_in) AS std_util_in, max(m.ingested) AS detected_at,
               count(*) AS n
        FROM flagged f JOIN minutes m ON f.event_id = m.event_id
        GROUP BY ALL""",
    "flat_up": """
        SELECT device_id, site_id, interface_name,
               time_bucket(INTERVAL 4 HOUR, device_ts, TIMESTAMP '1970-01-01') AS window_start,
               coalesce(var_samp(effective_util_in), 0) AS variance,
               avg(effective_util_in) AS mean_util_in, count(*) AS points
        FROM enriched WHERE oper_status = 1 GROUP BY ALL""",
    "bursts": """
        SELECT '' AS device_id, site_id, '' AS interface_name,
               date_trunc('day', device_ts) AS window_start,
               date_trunc('day', device_ts) + INTERVAL 1 DAY AS window_end,
               'CRITICAL_SYSLOG_BURST' AS anomaly_type, 'SEVERITY_LT3_RATE' AS anomaly_subtype,
               CAST(count(*) AS DOUBLE) AS score, 0.0 AS mean_util_in, 0.0 AS std_util_in,
               max(ingested) AS detected_at
        FROM clean_logs WHERE is_critical AND length(device_id) > 0
        GROUP BY ALL HAVING count(*) >= 3""",
    "flat_flags": """
        SELECT device_id, site_id, interface_name, window_start,
               window_start + INTERVAL 4 HOUR AS window_end, 'FLATLINE' AS anomaly_type,
               'LOW_VARIANCE' AS anomaly_subtype, variance AS score, mean_util_in,
               0.0 AS std_util_in, window_start + INTERVAL 4 HOUR AS detected_at
        FROM flat_up WHERE variance <= 25.0 AND points >= 2""",
    "anomalies": """
        SELECT * EXCLUDE (n) FROM flag_windows
        UNION ALL BY NAME SELECT * FROM flat_flags
        UNION ALL BY NAME SELECT * FROM bursts""",
    "dlq": """
        SELECT event_id, device_id, ingested AS quarantined_at,
               CASE WHEN route = 'INVALID' THEN validation_reason ELSE 'ORPHANED_DEVICE' END
                   AS quarantine_reason
        FROM routed WHERE route = 'INVALID' OR (route = 'PENDING' AND util_out >= 50)""",
    "pending": """
        SELECT *, k % 4 AS retry_count FROM routed WHERE route = 'PENDING'""",
    "normal": """
        SELECT *, isodow(device_ts) - 1 AS day_of_week, hour(device_ts) AS hour_of_day
        FROM scored
        WHERE NOT ingest_anomaly AND device_ts >= (SELECT now FROM latest) - INTERVAL 30 DAY""",
}
