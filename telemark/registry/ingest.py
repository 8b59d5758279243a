"""Batch sources and sinks (sections 2.1 and 2.2)."""
from datetime import timedelta

from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.operators import parse as P
from telemark.operators import versions as V
from telemark.plans import baseline as B
from telemark.plans import reprocess as RP
from telemark.plans.collect import collect_topic
from telemark.registry.base import query
from telemark.schema import ddl, struct
from telemark.session import scratch
from telemark.sinks import compact as CO
from telemark.sinks import tables as SK
from telemark.sources import files as SF

# The test tables hold a few rows per site and day.
DAILY = ("_partition_date",)
# Coarser than the default, so that the test table has records to drop.
COLLECT_KEYS = ("device_id", "interface_name")


@query("src_table", "SELECT event_id, ts, user_id, event_type, value FROM events")
def _(t):
    return SF.read_table(t.spark, t.path("events")).select(
        "event_id", "ts", "user_id", "event_type", "value")


@query("src_batch_collect", """
    SELECT max(event_id) AS event_id, device_id, interface_name FROM stats
    WHERE k NOT IN (92, 93, 97) GROUP BY 2, 3""")
def _(t):
    """Read, keep what meets the contract, last record per key wins, append."""
    got = collect_topic(t.payloads, "interface_stats", "event_id", COLLECT_KEYS)
    path = scratch(t.spark, "collected")
    SK.write(got.kept.select("event_id", "device_id", "interface_name"), path)
    return t.spark.read.parquet(path)


@query("src_batch_collect_counts", """
    SELECT count(*) AS consumed,
           count(DISTINCT CASE WHEN k NOT IN (92, 93, 97) THEN device_id || '/' || interface_name END)
               AS written,
           count(*) FILTER (WHERE k NOT IN (92, 93, 97))
               - count(DISTINCT CASE WHEN k NOT IN (92, 93, 97) THEN device_id || '/' || interface_name END)
               AS duplicates_dropped,
           count(*) FILTER (WHERE k IN (92, 93, 97)) AS parse_errors
    FROM stats""")
def _(t):
    return collect_topic(t.payloads, "interface_stats", "event_id", COLLECT_KEYS).counts


@query("src_csv", "SELECT device_id, site_id, vendor, role FROM devices")
def _(t):
    path = scratch(t.spark, "inventory-csv")
    t.devices.drop("balance").write.option("header", True).csv(path)
    return SF.read_csv(t.spark, path)


@query("src_jsonl", "SELECT ts, device_id, severity, message FROM logs")
def _(t):
    path = scratch(t.spark, "syslog-jsonl")
    X.syslog_payloads(t.events).select(F.col("payload").alias("value")).write.text(path)
    return P.parse_syslogs(SF.read_jsonl(t.spark, path, X.SYSLOG_TOPIC)).select(
        "ts", "device_id", "severity", "message")


@query("src_parquet_view", """
    SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def _(t):
    SF.register_view(t.spark, "telemark_events", t.path("events"))
    return SF.run_sql(t.spark, """
        SELECT event_type, count(*) AS n, round(sum(value), 4) AS total
        FROM telemark_events GROUP BY event_type""")


@query("src_sql", """
    SELECT device_id, count(*) AS n, round(avg(effective_util_in), 6) AS mean_in
    FROM enriched GROUP BY 1""")
def _(t):
    rows, _ = SF.run_sql_counted(t.spark, """
        SELECT device_id, count(*) AS n, avg(effective_util_in) AS mean_in
        FROM {silver} GROUP BY device_id""", silver=t.enriched)
    return rows


@query("src_sample")
def _(t):
    return SF.sample_rows(t.stats, 0.1).select("event_id", "device_id", "util_in")


@query("src_cap")
def _(t):
    return SF.cap_rows(t.stats, 100).select("event_id", "device_id", "util_in")


@query("sink_append", """
    SELECT site_id, CAST(device_ts AS DATE) AS partition_date, count(*) AS n,
           round(sum(effective_util_in), 4) AS total FROM scored GROUP BY 1, 2""")
def _(t):
    path = scratch(t.spark, "silver")
    SK.append(P.to_silver_stats(t.scored), path, "silver_interface_stats")
    return t.spark.read.parquet(path).groupBy(
        F.col("site_id").cast("string").alias("site_id"),
        F.col("_partition_date").alias("partition_date"),
    ).agg(F.count("*").alias("n"), F.round(F.sum("effective_util_in"), 4).alias("total"))


@query("sink_compact", """
    SELECT site_id, CAST(device_ts AS DATE) AS partition_date, count(*) AS n,
           round(sum(effective_util_in), 4) AS total FROM scored GROUP BY 1, 2""")
def _(t):
    """Four micro-batches, the last two with late rows for closed days, and two compactions."""
    path, table = scratch(t.spark, "silver"), "silver_interface_stats"
    silver = t.stored(P.to_silver_stats(t.scored))
    batch = F.pmod(F.xxhash64("device_id", "device_ts"), F.lit(4))
    for i in range(4):
        SK.write_micro_batch(silver.filter(batch == i), i, path, DAILY, table)
        if i % 2:
            closed = t.latest.date() - timedelta(days=20 - 6 * i)
            CO.compact(t.spark, path, ddl(table), DAILY, closed, table)
    return CO.read_compacted(t.spark, path, ddl(table), DAILY).groupBy(
        "site_id", F.col("_partition_date").alias("partition_date"),
    ).agg(F.count("*").alias("n"), F.round(F.sum("effective_util_in"), 4).alias("total"))


@query("sink_overwrite_parts", """
    SELECT event_type, CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS version,
           count(*) AS n FROM events GROUP BY 1, 2""")
def _(t):
    """All partitions written once, then one of them replaced."""
    path = scratch(t.spark, "parts")
    rows = t.events.select("event_id", "value", "event_type")
    SK.write(rows.withColumn("version", F.lit(1)), path, "overwrite", ["event_type"])
    touched = rows.filter("event_type = 'error'").withColumn("version", F.lit(2))
    SK.overwrite_touched(touched, path, ["event_type"])
    return t.spark.read.parquet(path).groupBy("event_type", "version").agg(F.count("*").alias("n"))


@query("sink_align", """
    SELECT device_id, ts, round(util_in, 6) AS util_in, oper_status, ingested AS ingested_at
    FROM stats""")
def _(t):
    """Old column names and missing columns are brought to the table's layout."""
    old = t.stats.withColumnsRenamed(
        {"util_in": "raw_util_in", "_ingested_at": "ingested_ts"}).drop("admin_status")
    aligned = SK.align(old, struct("bronze_interface_stats"))
    return aligned.select(
        "device_id", "ts", "util_in", "oper_status", F.col("_ingested_at").alias("ingested_at"))


@query("sink_evolve", """
    SELECT event_id, device_id, CAST(NULL AS DOUBLE) AS packet_loss FROM stats
    UNION ALL SELECT event_id, device_id, util_out FROM stats""")
def _(t):
    path = scratch(t.spark, "evolved")
    base = t.stats.select("event_id", "device_id")
    SK.write(base, path)
    SK.write(t.stats.select("event_id", "device_id", F.col("util_out").alias("packet_loss")), path)
    return SK.read_evolved(t.spark, path).select("event_id", "device_id", "packet_loss")


@query("sink_rows", """
    SELECT device_id, interface_name, CAST(hour_of_day AS INTEGER) AS hour_of_day,
           CAST(day_of_week AS INTEGER) AS day_of_week,
           round(CAST(avg(effective_util_in) AS FLOAT)::DOUBLE, 3) AS baseline_mean
    FROM normal GROUP BY ALL
    UNION ALL SELECT 'manual', 'error', 3, 2, 41.5""")
def _(t):
    """Refreshed parameters plus one row entered by hand."""
    path = scratch(t.spark, "params")
    now = t.as_of
    SK.upsert(B.refresh_params(B.confirmed_normal(t.scored, now), now), path, "device_baseline_params")
    SK.append_rows(t.spark, [{
        "device_id": "manual", "interface_name": "error", "hour_of_day": 3, "day_of_week": 2,
        "baseline_mean": 41.5, "baseline_std": 1.0}], path, "device_baseline_params")
    return t.spark.read.parquet(path).select(
        "device_id", "interface_name", "hour_of_day", "day_of_week",
        F.round(F.col("baseline_mean").cast("double"), 3).alias("baseline_mean"))


@query("sink_upsert_latest", """
    SELECT site_id, window_start, total_interface_count FROM health""")
def _(t):
    """Two refreshes appended; readers see the newer one."""
    path = scratch(t.spark, "health")
    now = t.health_history
    old = now.withColumns({
        "total_interface_count": F.lit(0).cast("bigint"),
        "refreshed_at": F.col("refreshed_at") - F.expr("INTERVAL 1 MINUTE")})
    SK.upsert(now, path, "gold_site_health_hourly")
    SK.upsert(old, path, "gold_site_health_hourly")
    latest = V.latest_by_key(
        t.spark.read.parquet(path), ["site_id", "window_start"], ["refreshed_at"])
    return latest.select("site_id", "window_start", "total_interface_count")


@query("sink_delete_matched", """
    SELECT event_id AS seq, device_id FROM pending
    WHERE device_id NOT IN (SELECT device_id FROM devices WHERE site_id IS NOT NULL)""")
def _(t):
    promoted = RP.promote_pending(t.pending, t.late_inventory).select("raw_payload", "device_id")
    left = SK.delete_matched(RP.open_pending(t.pending), promoted, ["raw_payload", "device_id"])
    return left.select(
        X.payload_seq(), "device_id")
