"""Aggregations, windows, sorts and set operations (sections 2.6 to 2.9)."""
from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.operators import aggregates as A
from telemark.operators import flatline as FL
from telemark.operators import parse as P
from telemark.operators import route as RT
from telemark.operators import versions as V
from telemark.plans import baseline as B
from telemark.plans import gold as G
from telemark.plans import reports as R
from telemark.registry.base import query
from telemark.registry.joins import param_history
from telemark.registry.projections import flat_flags
from telemark.session import scratch
from telemark.sinks import tables as SK

HEALTH_SQL = """
    SELECT site_id, window_start, window_end, round(avg_util_in, 6) AS avg_util_in,
           round(avg_util_out, 6) AS avg_util_out,
           round(pct_interfaces_saturated, 6) AS pct_interfaces_saturated, critical_syslog_count,
           total_interface_count, round(pct_interfaces_down, 6) AS pct_interfaces_down,
           round(health_score, 6) AS health_score, is_degraded FROM health"""


@query("agg_site_hour", """
    SELECT site_id, window_start, round(avg_util_in, 6) AS avg_util_in,
           round(avg_util_out, 6) AS avg_util_out, round(pct_interfaces_saturated, 6) AS pct_saturated,
           total_interface_count, round(pct_interfaces_down, 6) AS pct_down FROM health_stats""")
def _(t):
    return A.site_hour(t.enriched).select(
        "site_id", F.col("w.start").alias("window_start"), "avg_util_in", "avg_util_out",
        F.col("pct_interfaces_saturated").alias("pct_saturated"), "total_interface_count",
        F.col("pct_interfaces_down").alias("pct_down"))


@query("agg_syslog_hour", "SELECT site_id, window_start, critical_syslog_count FROM health_logs")
def _(t):
    return A.syslog_hour(t.silver_syslogs).select(
        "site_id", F.col("w.start").alias("window_start"), "critical_syslog_count")


@query("gold_site_health", HEALTH_SQL)
def gold_site_health(t):
    return t.health.drop("refreshed_at")


@query("agg_minute_latest", """
    SELECT m.device_id, m.site_id, m.interface_name, m.minute_ts, m.ingested AS ingested_at,
           round(s.effective_util_in, 6) AS effective_util_in, round(s.z, 6) AS ingest_z_score,
           s.ingest_anomaly
    FROM minutes m JOIN scored s ON s.event_id = m.event_id""")
def _(t):
    return A.minute_latest(t.scored, ("event_id",)).select(
        "device_id", "site_id", "interface_name", "minute_ts",
        F.col("_ingested_at").alias("ingested_at"), "effective_util_in", "ingest_z_score",
        "ingest_anomaly")


@query("gold_anomaly_windows", """
    SELECT device_id, site_id, interface_name, window_start, window_end, anomaly_type,
           anomaly_subtype, round(score, 6) AS score, round(mean_util_in, 6) AS mean_util_in,
           round(std_util_in, 6) AS std_util_in, detected_at
    FROM flag_windows WHERE n >= 2""")
def _(t):
    return G.anomaly_windows(t.scored, "1 day", 2, ("event_id",))


@query("gold_syslog_burst", """
    SELECT device_id, site_id, interface_name, window_start, window_end, anomaly_type,
           anomaly_subtype, score, detected_at FROM bursts""")
def _(t):
    return G.syslog_bursts(t.silver_syslogs, "1 day", 3, ("site_id",)).drop(
        "mean_util_in", "std_util_in")


@query("gold_flatline_promote", """
    SELECT device_id, interface_name, window_start, anomaly_type, anomaly_subtype,
           round(score, 6) AS score, round(mean_util_in, 6) AS mean_util_in FROM flat_flags
    WHERE detected_at >= (SELECT now FROM latest) - INTERVAL 30 DAY""")
def _(t):
    staged = G.trailing(flat_flags(t), t.as_of, 720, "detected_at")
    return FL.to_anomaly_records(staged).select(
        "device_id", "interface_name", "window_start", "anomaly_type", "anomaly_subtype", "score",
        "mean_util_in")


@query("agg_flatline_window", """
    SELECT device_id, site_id, interface_name, window_start,
           round(variance, 6) AS variance, round(mean_util_in, 6) AS mean_util_in
    FROM flat_up WHERE variance <= 0""")
def _(t):
    windows = FL.flat_windows(t.enriched, min_points=1)
    return windows.select(
        "device_id", "site_id", "interface_name", F.col("w.start").alias("window_start"),
        "variance", "mean_util_in")


@query("agg_flatline_batch", """
    SELECT device_id, interface_name, count(*) AS points,
           round(coalesce(var_samp(effective_util_in), 0), 6) AS variance,
           round(avg(effective_util_in), 6) AS mean_util_in
    FROM enriched WHERE oper_status = 1 GROUP BY 1, 2
    HAVING count(*) >= 3 AND coalesce(var_samp(effective_util_in), 0) <= 400""")
def _(t):
    return FL.flat_series(t.enriched, min_points=3, eps=400.0)


@query("agg_welford_state", """
    SELECT device_id, interface_name, count(*) AS n, round(avg(effective_util_in), 6) AS mean,
           round(var_pop(effective_util_in) * count(*), 6) AS m2,
           round(coalesce(var_samp(effective_util_in), 0), 6) AS variance,
           round(sqrt(coalesce(var_samp(effective_util_in), 0)), 6) AS std
    FROM enriched GROUP BY 1, 2""")
def _(t):
    return FL.running_moments(t.enriched, FL.SERIES)


@query("agg_baseline", """
    SELECT device_id, interface_name, CAST(hour_of_day AS INTEGER) AS hour_of_day,
           CAST(day_of_week AS INTEGER) AS day_of_week,
           round(avg(effective_util_in), 6) AS baseline_mean,
           round(coalesce(stddev_samp(effective_util_in), 0), 6) AS baseline_std,
           count(*) AS sample_count, CAST(1.5 AS DOUBLE) AS iqr_k,
           CAST(0.65 AS DOUBLE) AS isolation_score_threshold
    FROM normal GROUP BY ALL""")
def _(t):
    return B.baselines(B.confirmed_normal(t.scored, t.as_of))


@query("agg_group_count", """
    SELECT count(*) AS groups FROM (
        SELECT DISTINCT device_id, interface_name, hour_of_day, day_of_week FROM normal)""")
def _(t):
    normal = P.season_keys(B.confirmed_normal(t.scored, t.as_of))
    return A.group_count(normal, "device_id", "interface_name", "hour_of_day", "day_of_week")


@query("agg_if_features", """
    SELECT device_id, interface_name, date_trunc('hour', device_ts) AS window_start,
           round(avg(effective_util_in), 6) AS avg_in, round(avg(effective_util_out), 6) AS avg_out,
           round(coalesce(stddev_samp(effective_util_in), 0), 6) AS std_in,
           round(coalesce(stddev_samp(effective_util_out), 0), 6) AS std_out,
           max(effective_util_in) AS max_in, min(effective_util_in) AS min_in,
           max(effective_util_out) AS max_out, min(effective_util_out) AS min_out,
           CAST(count(*) FILTER (WHERE oper_status <> 1) AS DOUBLE) AS down_count,
           CAST(count(*) AS DOUBLE) AS sample_count
    FROM normal GROUP BY ALL""")
def _(t):
    return A.hourly_features(B.confirmed_normal(t.scored, t.as_of))


@query("agg_latest_params", """
    SELECT site_id, interface_name, CAST(day_of_week AS INTEGER) AS day_of_week,
           round(baseline_mean, 6) AS baseline_mean, round(baseline_std, 6) AS baseline_std FROM params""")
def _(t):
    return B.latest_params(param_history(t), X.DENSE_KEYS).select(
        *X.DENSE_KEYS, "baseline_mean", "baseline_std")


@query("op_latest_by_key", "SELECT device_id, site_id, vendor, role FROM devices")
def _(t):
    return V.latest_inventory(t.inventory_history).drop("_ingested_at")


@query("agg_flag_counts", "SELECT anomaly_type, count(*) AS n FROM flagged GROUP BY 1")
def _(t):
    return A.flag_counts(t.scored)


@query("agg_site_now", """
    SELECT site_id, round(sat, 6) AS pct_saturated, round(down, 6) AS pct_down,
           round(greatest(0.0, least(100.0, 100.0 - sat * 40 - down * 20)), 6) AS health_score
    FROM (SELECT site_id,
                 count(*) FILTER (WHERE effective_util_in > 80 OR effective_util_out > 80) / count(*) AS sat,
                 count(*) FILTER (WHERE oper_status <> 1) / count(*) AS down
          FROM enriched GROUP BY 1)""")
def _(t):
    return A.site_now(t.enriched)


@query("agg_route_counts", """
    SELECT 'raw.interface-stats' AS topic, route, count(*) AS n FROM routed GROUP BY 2
    UNION ALL SELECT 'raw.syslogs', route, count(*) FROM routed_logs GROUP BY 2""")
def _(t):
    both = RT.route_counts(t.routed).unionByName(RT.route_counts(t.routed_syslogs))
    return both.withColumnRenamed("_source_topic", "topic")


@query("dedup_last_wins", """
    SELECT max(event_id) AS event_id, coalesce(device_id, '') AS device_key,
           coalesce(interface_name, '') AS interface_key, date_trunc('day', event_ts) AS day
    FROM stats GROUP BY 2, 3, 4""")
def _(t):
    keyed = t.stats.withColumn(
        "day", F.date_trunc("day", F.col("_ingested_at") - F.expr("INTERVAL 30 SECONDS")))
    return V.dedup_last_wins(keyed, ("device_id", "interface_name", "day"), "event_id").select(
        "event_id", F.coalesce("device_id", F.lit("")).alias("device_key"),
        F.coalesce("interface_name", F.lit("")).alias("interface_key"), "day")


@query("agg_distinct_keys", "SELECT DISTINCT device_id, interface_name FROM enriched")
def _(t):
    return V.distinct_keys(t.enriched, "device_id", "interface_name")


@query("win_total_per_hour", """
    SELECT event_id, site_id, date_trunc('hour', device_ts) AS window_start,
           count(*) OVER (PARTITION BY site_id, date_trunc('hour', device_ts)) AS total_ifaces
    FROM enriched""")
def _(t):
    return A.total_per_hour(t.enriched, t.stored).select("event_id", "site_id", "window_start", "total_ifaces")


@query("top_recent_anomalies", """
    SELECT device_id, site_id, interface_name, anomaly_type, anomaly_subtype,
           round(score, 6) AS score, detected_at
    FROM flag_windows
    ORDER BY detected_at DESC, device_id, interface_name, anomaly_type, anomaly_subtype LIMIT 50""")
def _(t):
    return R.recent_anomalies(t.flag_windows)


@query("sort_within_files", """
    SELECT site_id, CAST(device_ts AS DATE) AS partition_date, count(*) AS n,
           min(device_id) AS first_device, CAST(0 AS BIGINT) AS misplaced FROM scored GROUP BY 1, 2""")
def _(t):
    """Two micro-batches of silver; no row of any file stands behind a later one."""
    path, table = scratch(t.spark, "sorted"), "silver_interface_stats"
    for half in range(2):
        rows = P.to_silver_stats(t.scored.filter(F.col("event_id") % 2 == half))
        SK.write_micro_batch(rows, half, path, ["_partition_date"], table)
    files = t.spark.read.parquet(path)
    keys = ["site_id", "partition_date"]
    named = files.withColumnRenamed("_partition_date", "partition_date")
    groups = named.groupBy(*keys).agg(F.count("*").alias("n"), F.min("device_id").alias("first_device"))
    wrong = SK.out_of_order(files, table).withColumnRenamed("_partition_date", "partition_date").groupBy(
        *keys).agg(F.count("*").alias("misplaced"))
    return groups.join(wrong, keys, "left").fillna(0, ["misplaced"])


@query("sort_reason_counts", """
    SELECT quarantine_reason, count(*) AS cnt FROM dlq GROUP BY 1 ORDER BY 2 DESC, 1""")
def _(t):
    return R.reason_counts(t.dlq)


@query("set_union_anomalies", """
    SELECT device_id, site_id, interface_name, window_start, window_end, anomaly_type,
           anomaly_subtype, round(score, 6) AS score, round(mean_util_in, 6) AS mean_util_in,
           round(std_util_in, 6) AS std_util_in, detected_at FROM anomalies""")
def _(t):
    return anomalies(t)


def anomalies(t):
    bursts = G.syslog_bursts(t.silver_syslogs, "1 day", 3, ("site_id",))
    return G.all_anomalies(t.flag_windows, flat_flags(t), bursts)


@query("set_union_default", """
    SELECT quarantine_reason AS reason, count(*) AS cnt FROM dlq GROUP BY 1
    UNION ALL SELECT 'NO_DQ_EVENTS', 0""")
def _(t):
    counts = t.dlq.groupBy(F.col("quarantine_reason").alias("reason")).agg(F.count("*").alias("cnt"))
    return R.with_default(counts, reason=F.lit("NO_DQ_EVENTS"), cnt=F.lit(0).cast("bigint"))
