"""Operators the design documents describe (section 2.12)."""
from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.functions import rules as RU
from telemark.operators import flatline as FL
from telemark.operators import route as RT
from telemark.operators import score as S
from telemark.operators.aggregates import hourly_features
from telemark.plans import forest as IF
from telemark.plans import gold as G
from telemark.plans import reprocess as RP
from telemark.registry.base import query
from telemark.registry.learning import features


@query("doc_validate_time", """
    SELECT event_id, coalesce(validation_reason,
        CASE WHEN device_ts < late - INTERVAL 24 HOUR THEN 'STALE_TIMESTAMP'
             WHEN device_ts > late + INTERVAL 24 HOUR THEN 'FUTURE_TIMESTAMP' END) AS validation_reason
    FROM (SELECT *, CASE WHEN util_out < 30 THEN event_ts + INTERVAL 3 DAY
                         WHEN util_out > 70 THEN event_ts - INTERVAL 3 DAY ELSE event_ts END AS late
          FROM validated)""")
def _(t):
    shift = F.when(F.col("util_out") < 30, F.expr("INTERVAL 3 DAYS")).when(
        F.col("util_out") > 70, F.expr("INTERVAL -3 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    moved = t.derived.withColumn(
        "_ingested_at", F.col("_ingested_at") - F.expr("INTERVAL 30 SECONDS") + shift)
    return RT.validate_stats(moved, RU.time_rules()).select("event_id", "validation_reason")


@query("doc_validate_admin", """
    SELECT event_id, coalesce(validation_reason,
        CASE WHEN k % 4 NOT IN (1, 2) THEN 'INVALID_ADMIN_STATUS' END) AS validation_reason
    FROM validated""")
def _(t):
    odd = t.derived.withColumn("admin_status", F.col("util_out").cast("int") % 4)
    return RT.validate_stats(odd, RU.admin_rules()).select("event_id", "validation_reason")


@query("doc_orphan", """
    SELECT p.event_id AS seq, 'ORPHANED_DEVICE' AS quarantine_reason
    FROM pending p JOIN devices d ON p.device_id = d.device_id
    WHERE d.site_id IS NULL AND retry_count + 1 >= 3""")
def _(t):
    replay = RP.replay_pending(t.pending, t.late_inventory, t.params, X.DENSE_KEYS, at=t.as_of)
    return replay.quarantine.select(
        X.payload_seq(), "quarantine_reason")


@query("doc_dlq_rules", """
    SELECT quarantine_reason, CASE WHEN quarantine_reason = 'ORPHANED_DEVICE' THEN 'RECHECK'
           ELSE 'PERMANENT' END AS action, count(*) AS n FROM dlq GROUP BY 1, 2""")
def _(t):
    return t.dlq.groupBy("quarantine_reason", RP.action_for().alias("action")).agg(
        F.count("*").alias("n"))


SLIDING_SQL = """
    WITH starts AS (
        SELECT e.*, unnest(generate_series(
            time_bucket(INTERVAL 5 MINUTE, device_ts) - INTERVAL 235 MINUTE,
            time_bucket(INTERVAL 5 MINUTE, device_ts), INTERVAL 5 MINUTE)) AS window_start
        FROM enriched e WHERE oper_status = 1),
    spans AS (
        SELECT device_id, site_id, interface_name, window_start, count(*) AS points,
               var_samp(effective_util_in) AS variance, avg(effective_util_in) AS mean_util_in,
               min(effective_util_in) AS lo, max(effective_util_in) AS hi
        FROM starts GROUP BY ALL)
"""


@query("doc_flatline_sliding", SLIDING_SQL + """
    SELECT device_id, site_id, interface_name, window_start, points,
           round(variance, 6) AS variance, round(mean_util_in, 6) AS mean_util_in
    FROM spans WHERE points >= 2 AND (lo = hi OR variance < 4)""")
def _(t):
    return FL.flat_windows_sliding(t.enriched, near_eps=4.0).select(
        "device_id", "site_id", "interface_name", "window_start", "points", "variance",
        "mean_util_in")


@query("doc_near_flatline", SLIDING_SQL + """
    SELECT CASE WHEN lo = hi THEN 'FLATLINE' ELSE 'NEAR_FLATLINE' END AS anomaly_type, count(*) AS n
    FROM spans WHERE points >= 2 AND (lo = hi OR variance < 4) GROUP BY 1""")
def _(t):
    windows = FL.flat_windows_sliding(t.enriched, near_eps=4.0)
    return windows.groupBy("anomaly_type").agg(F.count("*").alias("n"))


@query("doc_rolling_iqr", """
    SELECT event_id, round(quantile_cont(effective_util_in, 0.25) OVER w, 6) AS q1,
           round(quantile_cont(effective_util_in, 0.75) OVER w, 6) AS q3
    FROM enriched WINDOW w AS (PARTITION BY site_id, interface_name ORDER BY device_ts
                               RANGE BETWEEN INTERVAL 4 HOUR PRECEDING AND CURRENT ROW)""")
def _(t):
    """Per site, so that the sparse test series overlap."""
    rows = t.enriched.select("event_id", "site_id", "interface_name", "device_ts", "effective_util_in")
    return S.rolling_iqr(rows, keys=("site_id", "interface_name")).select("event_id", "q1", "q3")


@query("doc_rules_at_ingest")
def _(t):
    """Distilled rules as a CASE over the features of all rows, flagged ones included."""
    rows = features(t)
    forest = IF.train(rows)
    rules = IF.distill(IF.label(IF.score(rows, forest), forest))
    every = hourly_features(t.scored)
    return every.select(*IF.ROW_KEYS, IF.rules_case(rules).alias("rule_flag"))


@query("if_gate")
def _(t):
    """A retrained model against the current one on the last seven days."""
    rows = features(t)
    week = t.as_of - F.expr("INTERVAL 7 DAYS")
    current = IF.train(rows.filter(F.col("window_start") < week), seed=7)
    candidate = IF.train(rows.filter(F.col("window_start") < week), seed=IF.SEED)
    recent = t.scored.filter(F.col("device_ts") >= week)
    truth = recent.groupBy(
        "device_id", "interface_name", F.date_trunc("hour", "device_ts").alias("window_start")
    ).agg(F.max(F.col("ingest_anomaly").cast("int")).alias("truth"))
    held_out = hourly_features(recent).join(truth, list(IF.ROW_KEYS))
    return IF.gate(held_out, candidate, current)


TOUCHED = """
    SELECT DISTINCT d.site_id, date_trunc('hour', r.device_ts) AS window_start
    FROM routed r JOIN devices d ON r.device_id = d.device_id
    WHERE r.route = 'PENDING' AND d.site_id IS NOT NULL"""


@query("doc_touched_windows", f"""
    SELECT site_id, window_start, count(*) AS total_interface_count,
           round(avg(effective_util_in), 6) AS avg_util_in
    FROM (SELECT site_id, date_trunc('hour', device_ts) AS window_start, effective_util_in FROM enriched
          UNION ALL
          SELECT d.site_id, date_trunc('hour', r.device_ts), effective_util_in
          FROM routed r JOIN devices d ON r.device_id = d.device_id
          WHERE r.route = 'PENDING' AND d.site_id IS NOT NULL)
    WHERE (site_id, window_start) IN ({TOUCHED}) GROUP BY 1, 2""")
def _(t):
    promoted = RP.replay_pending(
        t.pending, t.late_inventory, t.params, X.DENSE_KEYS, at=t.as_of).silver
    cols = ("site_id", "device_ts", "effective_util_in", "effective_util_out", "oper_status")
    every = t.enriched.select(*cols).unionByName(promoted.select(*cols))
    health = G.site_health_touched(every, t.silver_syslogs, promoted, t.as_of, t.stored)
    return health.select("site_id", "window_start", "total_interface_count", "avg_util_in")
