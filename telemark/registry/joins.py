"""Joins (inventory section 2.5)."""
from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.operators import aggregates as A
from telemark.operators import flatline as FL
from telemark.operators import joins as J
from telemark.operators import parse as P
from telemark.plans import baseline as B
from telemark.plans import reprocess as RP
from telemark.registry.base import query


@query("join_enrich", """
    SELECT event_id, s.device_id, site_id, vendor, role
    FROM stats s LEFT JOIN inventory i ON s.device_id = i.device_id""")
def _(t):
    return J.enrich(t.stats, t.inventory).select("event_id", "device_id", "site_id", "vendor", "role")


@query("join_baseline", """
    SELECT event_id, round(baseline_mean, 6) AS baseline_mean, round(baseline_std, 6) AS baseline_std,
           CAST(p.iqr_k AS DOUBLE) AS iqr_k
    FROM enriched e LEFT JOIN params p ON e.site_id = p.site_id
     AND e.interface_name = p.interface_name AND isodow(device_ts) - 1 = p.day_of_week""")
def _(t):
    joined = J.attach_baseline(P.season_keys(t.enriched), t.params, X.DENSE_KEYS)
    return joined.select("event_id", "baseline_mean", "baseline_std", "iqr_k")


def weekly_versions(t):
    """Parameters as refreshed at the end of each week that has rows, from the rows of that week."""
    seen = P.season_keys(t.enriched).filter("device_ts IS NOT NULL").withColumn(
        "valid_from", (F.date_trunc("week", "device_ts") + F.expr("INTERVAL 7 DAYS")).cast("timestamp"))
    keys = ("site_id", "interface_name")
    return keys, seen.groupBy(*keys, "valid_from").agg(
        F.avg("effective_util_in").alias("baseline_mean"),
        F.coalesce(F.stddev_samp("effective_util_in"), F.lit(0.0)).alias("baseline_std"),
    ).withColumns({
        "iqr_k": F.lit(B.IQR_K), "valid_until": F.lit(B.FAR_FUTURE).cast("timestamp")})


@query("join_baseline_asof", """
    WITH versions AS (
        SELECT site_id, interface_name, date_trunc('week', device_ts) + INTERVAL 7 DAY AS valid_from,
               avg(effective_util_in) AS m, coalesce(stddev_samp(effective_util_in), 0) AS s
        FROM enriched WHERE device_ts IS NOT NULL GROUP BY ALL)
    SELECT e.event_id, round(v.m, 6) AS baseline_mean, round(v.s, 6) AS baseline_std
    FROM enriched e ASOF LEFT JOIN versions v
      ON e.site_id = v.site_id AND e.interface_name = v.interface_name
     AND e.device_ts >= v.valid_from""")
def _(t):
    keys, history = weekly_versions(t)
    joined = J.attach_baseline_asof(t.enriched, history, keys, store=t.stored)
    return joined.select("event_id", "baseline_mean", "baseline_std")


@query("join_flags_broadcast", """
    WITH flat AS (SELECT device_id, interface_name FROM enriched WHERE oper_status = 1
                  GROUP BY 1, 2 HAVING count(*) >= 3 AND coalesce(var_samp(effective_util_in), 0) <= 400)
    SELECT event_id, f.device_id IS NOT NULL AS is_flat
    FROM enriched e LEFT JOIN flat f ON e.device_id = f.device_id AND e.interface_name = f.interface_name""")
def _(t):
    flat = FL.flat_series(t.enriched, min_points=3, eps=400.0)
    marks = flat.select("device_id", "interface_name", F.lit(True).alias("_flat"))
    keys = ["device_id", "interface_name"]
    return J.attach(t.enriched, marks, keys, store=t.stored).select(
        "event_id", F.coalesce("_flat", F.lit(False)).alias("is_flat"))


@query("join_promote", """
    SELECT event_id AS seq, p.device_id, d.site_id, d.role
    FROM pending p JOIN devices d ON p.device_id = d.device_id WHERE d.site_id IS NOT NULL""")
def _(t):
    return RP.promote_pending(t.pending, t.late_inventory).select(
        X.seq(), "device_id", "site_id", "role")


@query("join_dlq_fixable", """
    SELECT quarantine_reason, device_id, count(*) AS n FROM dlq
    WHERE device_id IN (SELECT device_id FROM devices) GROUP BY ALL""")
def _(t):
    return RP.dlq_fixable(t.dlq, t.late_inventory).groupBy("quarantine_reason", "device_id").agg(
        F.count("*").alias("n"))


@query("join_dlq_permanent", """
    SELECT quarantine_reason, device_id, count(*) AS n FROM dlq d
    WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE i.device_id = d.device_id) GROUP BY ALL""")
def _(t):
    return RP.dlq_permanent(t.dlq, t.inventory).groupBy("quarantine_reason", "device_id").agg(
        F.count("*").alias("n"))


@query("join_window_struct", """
    SELECT site_id, window_start, round(avg_util_in, 6) AS avg_util_in, critical_syslog_count FROM health""")
def _(t):
    joined = A.join_hours(A.site_hour(t.enriched), A.syslog_hour(t.silver_syslogs))
    return joined.select(
        "site_id", F.col("w.start").alias("window_start"), "avg_util_in", "critical_syslog_count")


@query("join_preagg", """
    SELECT e.event_id, e.site_id, coalesce(l.critical_syslog_count, 0) AS critical_count
    FROM enriched e LEFT JOIN health_logs l
      ON l.site_id = e.site_id AND l.window_start = date_trunc('hour', e.device_ts)""")
def _(t):
    logs = A.syslog_hour(t.silver_syslogs).select(
        "site_id", F.col("w.start").alias("_hour"),
        F.col("critical_syslog_count").alias("critical_count"))
    keyed = t.enriched.withColumn("_hour", F.date_trunc("hour", "device_ts"))
    return J.attach(keyed, logs, ["site_id", "_hour"], store=t.stored).fillna(0, ["critical_count"]).select(
        "event_id", "site_id", "critical_count")


@query("join_param_lookup", """
    SELECT n.site_id, n.interface_name, CAST(n.day_of_week AS INTEGER) AS day_of_week,
           count(*) AS rows_seen, round(any_value(p.baseline_mean), 6) AS baseline_mean
    FROM normal n LEFT JOIN params p ON n.site_id = p.site_id
     AND n.interface_name = p.interface_name AND n.day_of_week = p.day_of_week
    GROUP BY n.site_id, n.interface_name, n.day_of_week""")
def _(t):
    seen = P.season_keys(B.confirmed_normal(t.scored, t.as_of)).groupBy(*X.DENSE_KEYS).agg(
        F.count("*").alias("rows_seen"))
    latest = B.latest_params(param_history(t), X.DENSE_KEYS)
    return J.attach(seen, latest.select(*X.DENSE_KEYS, "baseline_mean"), list(X.DENSE_KEYS))


def param_history(t):
    """Two versions of every parameter row: an outdated one and the current one."""
    now = t.params.withColumn("valid_from", t.as_of)
    old = t.params.withColumns({
        "baseline_mean": F.col("baseline_mean") / 2,
        "baseline_std": F.col("baseline_std") / 2,
        "valid_from": t.as_of - F.expr("INTERVAL 7 DAYS"),
    })
    return old.unionByName(now)


@query("join_salted_enrich", """
    SELECT event_id, s.device_id, site_id, vendor, role
    FROM stats s LEFT JOIN inventory i ON s.device_id = i.device_id""")
def _(t):
    """The same join beyond the broadcast bound: (key, salt) shuffle."""
    return J.attach(t.stats, t.inventory, "device_id", limit=0).select(
        "event_id", "device_id", "site_id", "vendor", "role")


@query("join_stream_static", "SELECT site_id, vendor, count(*) AS n FROM scored GROUP BY 1, 2")
def _(t):
    from telemark.registry.streams import run_interface

    return run_interface(t)["silver"].groupBy("site_id", "vendor").agg(F.count("*").alias("n"))


