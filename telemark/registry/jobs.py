"""Scoring and batch jobs (section 2.11)."""
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.functions import columns as C
from telemark.operators import flatline as FL
from telemark.operators import parse as P
from telemark.operators import score as S
from telemark.operators import versions as V
from telemark.plans import baseline as B
from telemark.plans import gold as G
from telemark.plans import reprocess as RP
from telemark.plans.jobs import Jobs
from telemark.registry.aggregates import HEALTH_SQL
from telemark.registry.base import query
from telemark.session import scratch
from telemark.streaming import windows as SW

FLAGS_SQL = """concat_ws(',', CASE WHEN sat THEN 'THRESHOLD_SATURATED' END,
                     CASE WHEN z > 2 THEN 'HIGH_Z_SCORE' END,
                     CASE WHEN iqr > 1 THEN 'IQR_OUTLIER' END)"""
# Rows whose device only became known later, scored against the same baselines.
LATE_SCORED = """
    SELECT *, sat OR z > 2 OR iqr > 1 AS ingest_anomaly FROM (
        SELECT r.* EXCLUDE (site_id, vendor, role), d.site_id, d.vendor, d.role,
               coalesce(abs(effective_util_in - baseline_mean) / (baseline_std + 1e-8), 0) AS z,
               coalesce(abs(effective_util_in - baseline_mean) / (1.5 * baseline_std + 1e-8), 0) AS iqr,
               effective_util_in > 80 OR effective_util_out > 80 AS sat
        FROM routed r JOIN devices d ON r.device_id = d.device_id
        LEFT JOIN params p ON d.site_id = p.site_id AND r.interface_name = p.interface_name
         AND isodow(r.device_ts) - 1 = p.day_of_week
        WHERE r.route = 'PENDING' AND d.site_id IS NOT NULL)"""


@query("sc_ingest", f"""
    SELECT event_id, round(z, 6) AS ingest_z_score, round(iqr, 6) AS ingest_iqr_score,
           ingest_anomaly, {FLAGS_SQL} AS ingest_flags FROM scored""")
def _(t):
    return t.scored.select(
        "event_id", "ingest_z_score", "ingest_iqr_score", "ingest_anomaly",
        F.array_join("ingest_flags", ",").alias("ingest_flags"))


@query("sc_threshold", "SELECT event_id, sat AS saturated FROM scored")
def _(t):
    return t.enriched.select("event_id", C.saturated().alias("saturated"))


@query("sc_zscore", "SELECT event_id, z > 2 AS high_z FROM scored")
def _(t):
    return t.scored.select("event_id", (F.col("ingest_z_score") > C.Z_LIMIT).alias("high_z"))


@query("sc_iqr", "SELECT event_id, iqr > 1 AS iqr_outlier FROM scored")
def _(t):
    return t.scored.select("event_id", (F.col("ingest_iqr_score") > C.IQR_LIMIT).alias("iqr_outlier"))


@query("sc_flatline_merge", f"""
    WITH flat AS (SELECT device_id, interface_name FROM scored WHERE oper_status = 1
                  GROUP BY 1, 2 HAVING count(*) >= 3 AND coalesce(var_samp(effective_util_in), 0) <= 400)
    SELECT s.event_id, ingest_anomaly OR f.device_id IS NOT NULL AS ingest_anomaly,
           concat_ws(',', nullif({FLAGS_SQL}, ''),
                     CASE WHEN f.device_id IS NOT NULL THEN 'FLATLINE' END) AS ingest_flags
    FROM scored s LEFT JOIN flat f ON s.device_id = f.device_id AND s.interface_name = f.interface_name""")
def _(t):
    flat = FL.flat_series(t.scored, min_points=3, eps=400.0)
    return S.merge_flatline(t.scored, flat, t.stored).select(
        "event_id", "ingest_anomaly", F.array_join("ingest_flags", ",").alias("ingest_flags"))


@query("sc_empty_baseline", """
    SELECT event_id, CAST(0 AS DOUBLE) AS ingest_z_score, sat AS ingest_anomaly FROM scored""")
def _(t):
    scored = S.score_ingest(t.enriched, S.empty_baseline(t.spark))
    return scored.select("event_id", "ingest_z_score", "ingest_anomaly")


@query("job_backfill", f"""
    SELECT device_id, site_id, interface_name, device_ts, round(effective_util_in, 6) AS effective_util_in,
           round(z, 6) AS ingest_z_score, ingest_anomaly, {FLAGS_SQL} AS ingest_flags, event_id AS seq
    FROM scored""")
def _(t):
    silver = RP.silver_batch(t.stats, t.inventory, t.params, X.DENSE_KEYS)
    return silver.select(
        "device_id", "site_id", "interface_name", "device_ts", "effective_util_in",
        "ingest_z_score", "ingest_anomaly", F.array_join("ingest_flags", ",").alias("ingest_flags"), X.seq())


@query("job_dlq", f"""
    SELECT event_id AS seq, site_id, role, round(z, 6) AS ingest_z_score, ingest_anomaly
    FROM ({LATE_SCORED}) WHERE util_out >= 50""")
def _(t):
    replay = RP.replay_dlq(t.dlq, t.late_inventory, t.params, keys=X.DENSE_KEYS, at=t.as_of)
    return replay.silver.select(X.seq(), "site_id", "role", "ingest_z_score", "ingest_anomaly")


@query("job_dlq_log", """
    SELECT q.quarantine_reason,
           CASE WHEN q.quarantine_reason = 'ORPHANED_DEVICE' AND d.site_id IS NOT NULL
                THEN 'PROMOTED_TO_SILVER' ELSE 'PERMANENT' END AS resolution, count(*) AS n
    FROM dlq q LEFT JOIN devices d ON q.device_id = d.device_id GROUP BY ALL""")
def _(t):
    decided = RP.decide_dlq(t.dlq, t.late_inventory)
    return decided.groupBy("quarantine_reason", "resolution").agg(F.count("*").alias("n"))


@query("job_pending", f"""
    SELECT event_id AS seq, site_id, role, round(z, 6) AS ingest_z_score, ingest_anomaly
    FROM ({LATE_SCORED})""")
def _(t):
    replay = RP.replay_pending(t.pending, t.late_inventory, t.params, X.DENSE_KEYS, at=t.as_of)
    return replay.silver.select(X.seq(), "site_id", "role", "ingest_z_score", "ingest_anomaly")


@query("job_gold", HEALTH_SQL)
def _(t):
    """From the silver table of the backfill, scored and read back by version."""
    silver = RP.silver_batch(t.stats, t.inventory, t.params, X.DENSE_KEYS)
    history = G.site_health(silver, P.to_silver_syslogs(t.silver_syslogs), t.as_of)
    return G.current_health(history).drop("refreshed_at")


@query("job_baseline", """
    SELECT device_id, interface_name, CAST(hour_of_day AS INTEGER) AS hour_of_day,
           CAST(day_of_week AS INTEGER) AS day_of_week,
           round(avg(effective_util_in), 6) AS baseline_mean,
           round(coalesce(stddev_samp(effective_util_in), 0), 6) AS baseline_std,
           CAST(1.5 AS DOUBLE) AS iqr_k, CAST(0.65 AS DOUBLE) AS isolation_score_threshold,
           '{"source":"weekly_baseline_refresh","lookback_days":30,"sample_count":' || count(*) || '}'
               AS distilled_rules,
           (SELECT now FROM latest) AS valid_from, TIMESTAMP '2099-12-31 23:59:59' AS valid_until
    FROM normal GROUP BY ALL""")
def _(t):
    return B.refresh_params(B.confirmed_normal(t.scored, t.as_of), t.as_of)


@query("st_inventory_state", "SELECT device_id, site_id, vendor, role FROM devices")
def _(t):
    return V.latest_inventory(t.inventory_history).select("device_id", "site_id", "vendor", "role")


@query("st_flatline_backfill", """
    SELECT device_id, site_id, interface_name, window_start,
           round(variance, 6) AS variance, round(mean_util_in, 6) AS mean_util_in
    FROM (SELECT device_id, site_id, interface_name,
                 time_bucket(INTERVAL 4 HOUR, device_ts, TIMESTAMP '1970-01-01') AS window_start,
                 coalesce(var_samp(effective_util_in), 0) AS variance,
                 avg(effective_util_in) AS mean_util_in, count(*) AS points
          FROM enriched WHERE oper_status = 1
            AND device_ts >= (SELECT now FROM latest) - INTERVAL 168 HOUR GROUP BY ALL)
    WHERE variance <= 25 AND points >= 2""")
def _(t):
    flags = SW.flatline_backfill(
        t.enriched, t.as_of, detected_at=F.col("w.end"), threshold=25.0)
    return flags.select(
        "device_id", "site_id", "interface_name", "window_start", "variance", "mean_util_in")


def stored_jobs(t, *tables):
    """Jobs over tables of their own, filled from the fixture by an earlier run."""
    root = scratch(t.spark, "stored-jobs")
    fill = Jobs(t.spark, root, t.latest - timedelta(days=365), partitions={})
    day = F.to_date("_ingested_at")
    frames = {
        "bronze_interface_stats": lambda: t.stats.withColumn("_partition_date", day),
        "bronze_inventory": lambda: t.inventory.withColumn("_ingested_at", F.lit("2024-01-01").cast("timestamp")),
        "silver_interface_stats": lambda: P.to_silver_stats(t.scored),
        "silver_syslogs": lambda: P.to_silver_syslogs(t.silver_syslogs),
        "silver_dlq_quarantine": lambda: t.dlq,
        "silver_pending_enrichment": lambda: t.pending,
    }
    for name in tables:
        fill.write(frames[name](), name)
    return Jobs(t.spark, root, t.latest, partitions={})


@query("job_backfill_stored", """
    SELECT 'silver_interface_stats' AS name, count(*) AS n FROM routed WHERE route = 'ENRICHED'
    UNION ALL SELECT 'silver_dlq_quarantine', count(*) FROM routed WHERE route = 'INVALID'
    UNION ALL SELECT 'silver_pending_enrichment', count(*) FROM routed WHERE route = 'PENDING'""")
def _(t):
    """Bronze through the stored-table backfill, run twice; every row is in one of three tables."""
    jobs = stored_jobs(t, "bronze_interface_stats", "bronze_inventory")
    for _ in range(2):
        jobs.backfill(datetime(2000, 1, 1), datetime(2100, 1, 1))
    parts = [jobs.read(name).agg(F.lit(name).alias("name"), F.count("*").alias("n"))
             for name in ("silver_interface_stats", "silver_dlq_quarantine", "silver_pending_enrichment")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("job_backfill_spans", """
    SELECT 'silver_interface_stats' AS name, event_id AS seq, 1 AS n FROM routed WHERE route = 'ENRICHED'
    UNION ALL SELECT 'silver_dlq_quarantine', NULL, count(*) FROM routed WHERE route = 'INVALID'
    UNION ALL SELECT 'silver_pending_enrichment', NULL, count(*) FROM routed WHERE route = 'PENDING'""")
def _(t):
    """Two spans on one day of running, one of them again on a later day, then some sites
    of everything: every reading is there exactly once."""
    jobs = stored_jobs(t, "bronze_interface_stats", "bronze_inventory")
    first, last = t.stats.agg(F.min("_ingested_at"), F.max("_ingested_at")).first()
    middle = first + (last - first) / 2
    jobs.backfill(first, middle)
    jobs.backfill(middle + timedelta(days=1), last)
    later = Jobs(t.spark, jobs.root, t.latest + timedelta(days=3), partitions={})
    later.backfill(first, middle)
    some = [r[0] for r in t.inventory.select("site_id").distinct().orderBy("site_id").limit(3).collect()]
    later.backfill(first, last, sites=some)
    silver = later.read("silver_interface_stats").groupBy(X.seq()).agg(F.count("*").alias("n")).select(
        F.lit("silver_interface_stats").alias("name"), "seq", "n")
    rest = [later.read(name).agg(F.lit(name).alias("name"), F.lit(None).cast("long").alias("seq"), F.count("*").alias("n"))
            for name in ("silver_dlq_quarantine", "silver_pending_enrichment")]
    return silver.unionByName(rest[0]).unionByName(rest[1])


@query("job_nightly_health", """
    SELECT site_id, window_start, critical_syslog_count, total_interface_count
    FROM health WHERE window_start >= date_trunc('hour', (SELECT now FROM latest) - INTERVAL 25 HOUR)""")
def _(t):
    """Hours that a nightly run without replays writes: the last 25 whole ones."""
    jobs = stored_jobs(t, "silver_interface_stats", "silver_syslogs")
    jobs.refresh_gold()
    return jobs.read("gold_site_health_hourly").select(
        "site_id", "window_start", "critical_syslog_count", "total_interface_count")
