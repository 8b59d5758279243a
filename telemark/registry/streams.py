"""Streaming sources and jobs, run over everything available and then stopped."""
from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.operators import parse as P
from telemark.operators import route as RT
from telemark.plans import reports as R
from telemark.plans.baseline import latest_params
from telemark.plans import reprocess as RP
from telemark.registry.base import query
from telemark.schema import struct
from telemark.session import scratch
from telemark.sinks import tables as SK
from telemark.sinks.layouts import read_evolving
from telemark.sources import streams as SS
from telemark.streaming import bronze as BR
from telemark.streaming import moments as MO
from telemark.streaming import silver as SV
from telemark.streaming import windows as SW
from telemark.streaming.inventory import CURRENT, current_inventory

# Micro-batches of a run in pieces, and the least number of files of a topic.
FILES = 2
FILE_ROWS = 200_000


def files_per_batch(rows: int, batches: int) -> int:
    """So many files that none holds more than about `FILE_ROWS` rows."""
    return max(FILES // batches, -(-rows // (batches * FILE_ROWS)))


def land(t, messages, batches=1, time="_ingested_at"):
    """A stream of messages from files of a topic, which are in order of their time, in so
    many micro-batches. Rows of one time are dealt by their text."""
    path = scratch(t.spark, "topic")
    rows = messages.select(
        F.col("payload").alias("value"), F.col(time).alias("timestamp"),
        F.col("source_topic").alias("topic"))
    per = files_per_batch(messages.count(), batches)
    rows.repartitionByRange(batches * per, "timestamp", F.xxhash64("value")).write.parquet(path)
    return SS.file_raw(t.spark, path, per if batches > 1 else None)


def drain(stream, path, checkpoint) -> None:
    """Append everything available to a Parquet sink, then stop."""
    query_ = (stream.writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query_.awaitTermination()


def drained(t, stream):
    path = scratch(t.spark, "drained")
    drain(stream, path, f"{path}-checkpoint")
    return t.spark.read.parquet(path)


def inventory_messages(t, devices, at):
    """Inventory rows as message text."""
    return devices.select(
        F.to_json(F.struct(*P.INVENTORY_FIELDS)).alias("payload"),
        F.lit(X.INVENTORY_TOPIC).alias("source_topic"), at.alias("_ingested_at"))


def silver_job(t, inventory=None) -> SV.SilverJob:
    params = scratch(t.spark, "params")
    t.params.write.parquet(params)
    known = inventory if inventory is not None else t.inventory
    return SV.SilverJob(
        root=scratch(t.spark, "silver-job"), inventory=lambda: known,
        params=SV.Refreshing(lambda: t.spark.read.parquet(params)), keys=X.DENSE_KEYS,
        flat_points=3, flat_eps=0.01, ingest_time=F.col("kafka_ts"),
        # The test tables hold a few rows per site and day.
        partitions={"silver_interface_stats": ("_partition_date",)})


def run_interface(t, job=None, batches=1):
    """All stats messages through the micro-batch job; the tables it wrote."""
    job = job or silver_job(t)
    running = job.start(land(t, t.payloads, batches), "interface_stats", once=True)
    running.awaitTermination()

    def read(table):
        return t.spark.read.parquet(job.path(table))

    return {
        "job": job, "query": running,
        "silver": read("silver_interface_stats"), "dlq": read("silver_dlq_quarantine"),
        "pending": read("silver_pending_enrichment"),
        "routes": read("metrics_routes"), "flags": read("metrics_flags"),
        "sites": read("metrics_sites"),
    }


@query("src_stream_raw", """
    SELECT 'raw.interface-stats' AS source_topic, date_trunc('day', ingested) AS day, count(*) AS n
    FROM stats GROUP BY 2""")
def _(t):
    messages = drained(t, land(t, t.payloads))
    return messages.groupBy("source_topic", F.date_trunc("day", "kafka_ts").alias("day")).agg(
        F.count("*").alias("n"))


@query("src_stream_limited", "SELECT count(*) AS n, 'raw.interface-stats' AS source_topic FROM stats")
def _(t):
    messages = drained(t, land(t, t.payloads, FILES))
    return messages.groupBy("source_topic").agg(F.count("*").alias("n"))


@query("src_stream_table", "SELECT event_id, user_id, event_type FROM events")
def _(t):
    stream = SS.table_stream(t.spark, t.dir, t.events.schema, glob="events.parquet")
    return drained(t, stream.select("event_id", "user_id", "event_type"))


@query("sink_micro_batch", "SELECT count(*) AS n, count(DISTINCT event_id) AS events FROM events")
def _(t):
    """The second delivery of a batch replaces the first one."""
    path = scratch(t.spark, "micro")
    sink = SK.micro_batch_sink(path)
    rows = t.events.select("event_id", "event_type")
    sink(rows, 0)
    sink(rows, 0)
    return t.spark.read.parquet(path).agg(
        F.count("*").alias("n"), F.count_distinct("event_id").alias("events"))


@query("sink_evolve_stream", """
    SELECT CASE WHEN k <> 93 THEN event_id END AS seq,
           CASE WHEN k <> 93 AND event_id % 2 = 0 THEN CAST(event_id AS DOUBLE) END AS packet_loss
    FROM stats""")
def _(t):
    """A stream table whose second run brings a column; earlier rows have none of it."""
    path, checkpoint = scratch(t.spark, "evolving"), scratch(t.spark, "evolving-checkpoint")
    seq = F.col("event_id")
    wide = F.concat(F.regexp_replace("payload", r"}\s*$", ""), F.lit(', "packet_loss": '), seq.cast("string"), F.lit("}"))
    feed = scratch(t.spark, "topic")
    for odd, text, extra in ((1, F.col("payload"), {}), (0, wide, {"packet_loss": "double"})):
        half = t.payloads.filter(seq % 2 == odd).select(
            text.alias("value"), F.col("_ingested_at").alias("timestamp"), F.col("source_topic").alias("topic"))
        half.write.mode("append").parquet(feed)
        BR.start_bronze(SS.file_raw(t.spark, feed), "bronze_interface_stats", path, checkpoint, F.col("kafka_ts"),
                        once=True, extra=extra).awaitTermination()
    return read_evolving(t.spark, path).select(
        P.json_field("_raw_payload", "seq").cast("bigint").alias("seq"), "packet_loss")


@query("st_bronze_ingest", """
    SELECT 'stats' AS feed, count(*) AS n, count(ts) AS with_ts, count(device_id) AS with_device FROM stats
    UNION ALL SELECT 'syslogs', count(*), count(ts), count(device_id) FROM logs
    UNION ALL SELECT 'inventory', count(*), NULL, count(device_id) FROM devices""")
def _(t):
    at = F.col("kafka_ts")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    feeds = {
        "stats": ("bronze_interface_stats", t.payloads),
        "syslogs": ("bronze_syslogs", X.syslog_payloads(t.events)),
        "inventory": ("bronze_inventory", inventory_messages(t, t.devices, start)),
    }
    out, started = None, []
    for feed, (table, messages) in feeds.items():
        path = scratch(t.spark, table)
        source = land(t, messages)
        started.append((feed, table, path, BR.start_bronze(
            source, table, path, f"{path}-checkpoint", at, once=True)))
    for feed, table, path, running in started:
        running.awaitTermination()
        rows = t.spark.read.parquet(path)
        ts = F.count("ts") if "ts" in rows.columns else F.lit(None).cast("bigint")
        counts = rows.agg(F.count("*").alias("n"), ts.alias("with_ts"),
                          F.count("device_id").alias("with_device"))
        part = counts.select(F.lit(feed).alias("feed"), "n", "with_ts", "with_device")
        out = part if out is None else out.unionByName(part)
    return out


@query("st_interface", """
    SELECT event_id AS seq, site_id, round(z, 6) AS ingest_z_score, round(iqr, 6) AS ingest_iqr_score
    FROM scored""")
def _(t):
    return run_interface(t)["silver"].select(
        X.seq(),
        "site_id", "ingest_z_score", "ingest_iqr_score")


@query("st_interface_routes", "SELECT route, count(*) AS n FROM routed GROUP BY 1")
def _(t):
    """Counts of the micro-batches, written by the job rather than collected."""
    return run_interface(t, batches=FILES)["routes"].groupBy("route").agg(F.sum("n").alias("n"))


@query("st_syslogs", """
    SELECT device_id, site_id, device_ts, severity, is_critical, message FROM clean_logs""")
def _(t):
    job = silver_job(t)
    source = land(t, X.syslog_payloads(t.events))
    job.start(source, "syslogs", once=True).awaitTermination()
    return t.spark.read.parquet(job.path("silver_syslogs")).select(
        "device_id", "site_id", "device_ts", "severity",
        "is_critical", "message")


@query("st_inventory_replay", """
    SELECT r.event_id AS seq, d.site_id, d.role FROM routed r
    JOIN devices d ON r.device_id = d.device_id WHERE r.route = 'PENDING' AND d.site_id IS NOT NULL""")
def _(t):
    """Stats first, then the late inventory, whose micro-batch replays parked rows."""
    job = run_interface(t)["job"]
    at = F.lit("2024-01-30 00:00:00").cast("timestamp")
    source = land(t, inventory_messages(t, t.devices, at))
    job.start(source, "inventory", once=True).awaitTermination()
    silver = t.spark.read.parquet(job.path("silver_interface_stats"))
    return silver.filter(F.col("batch_id") >= RP.REPLAY_BATCH).select(X.seq(), "site_id", "role")


@query("st_inventory_snapshot", "SELECT device_id, site_id, vendor, role FROM devices")
def _(t):
    """The inventory that the micro-batches carry forward, after first listings and corrections."""
    job = silver_job(t)
    messages = inventory_messages(t, t.inventory_history, F.col("_ingested_at"))
    source = land(t, messages, FILES)
    job.start(source, "inventory", once=True).awaitTermination()
    return current_inventory(t.spark, job.path(CURRENT)).select("device_id", "site_id", "vendor", "role")


@query("st_baseline_ttl", """
    SELECT site_id, interface_name, CAST(day_of_week AS INTEGER) AS day_of_week,
           round(baseline_mean, 6) AS baseline_mean FROM params""")
def _(t):
    """Parameters refreshed between two reads are picked up once the copy is too old."""
    path = scratch(t.spark, "params")
    hours = iter([0.0, 1000.0, 2000.0])
    old = t.params.withColumns({
        "baseline_mean": F.lit(0.0), "valid_from": t.as_of - F.expr("INTERVAL 7 DAYS")})
    old.write.parquet(path)
    cached = SV.Refreshing(
        lambda: latest_params(t.spark.read.parquet(path), X.DENSE_KEYS), clock=lambda: next(hours))
    cached()
    t.params.withColumn("valid_from", t.as_of).write.mode("append").parquet(path)
    cached()
    return cached().select(*X.DENSE_KEYS, "baseline_mean")


def silver_table(t):
    """The scored table as files, to be streamed from."""
    path = scratch(t.spark, "silver-table")
    SK.write(P.to_silver_stats(t.scored), path)
    return path


FLAT_STREAM_SQL = """
    SELECT device_id, site_id, interface_name, window_start, round(variance, 6) AS variance,
           round(mean_util_in, 6) AS mean_util_in
    FROM flat_up WHERE variance <= 25 AND points >= 2
      AND window_start + INTERVAL 4 HOUR
          <= (SELECT max(device_ts) FROM enriched WHERE oper_status = 1) - INTERVAL 10 MINUTE"""


def run_flatline(t):
    path = scratch(t.spark, "flatline")
    silver = SS.table_stream(t.spark, silver_table(t), struct("silver_interface_stats"))
    flags = SW.flatline_stream(silver, detected_at=F.col("w.end"), threshold=25.0)
    SW.start_flatline(flags, path, f"{path}-checkpoint", f"{path}-alerts", once=True).awaitTermination()
    return path


@query("st_flatline", FLAT_STREAM_SQL)
def _(t):
    return t.spark.read.parquet(run_flatline(t)).select(
        "device_id", "site_id", "interface_name", "window_start", "variance", "mean_util_in")


@query("doc_alert_topic", f"""
    SELECT device_id AS key, site_id, interface_name, 'output.anomaly-alerts' AS topic
    FROM ({FLAT_STREAM_SQL})""")
def _(t):
    alerts = t.spark.read.parquet(f"{run_flatline(t)}-alerts")
    return alerts.select(
        "key", F.get_json_object("value", "$.site_id").alias("site_id"),
        F.get_json_object("value", "$.interface_name").alias("interface_name"), "topic")


@query("doc_health_stream", """
    SELECT site_id, window_start, round(avg_util_in, 6) AS avg_util_in,
           round(pct_interfaces_saturated, 6) AS pct_interfaces_saturated, critical_syslog_count,
           total_interface_count
    FROM health WHERE window_end <= (SELECT max(device_ts) FROM enriched) - INTERVAL 30 SECOND""")
def _(t):
    """Both feeds as streams of the event file, one watermarked aggregate."""
    events = SS.table_stream(t.spark, t.dir, t.events.schema, glob="events.parquet")
    stats = P.derive_stats(X.stats_from_events(events))
    logs = P.derive_syslogs(X.syslogs_from_events(events))
    clean = RT.only(RT.route_stats(stats, t.inventory), RT.ENRICHED)
    clean_logs = RT.only(RT.route_syslogs(logs, t.inventory), RT.ENRICHED)
    hours = drained(t, SW.health_stream(SW.health_feed(clean, clean_logs)))
    return hours.select(
        "site_id", "window_start", "avg_util_in", "pct_interfaces_saturated",
        "critical_syslog_count", "total_interface_count")


@query("rpt_batch_p99")
def _(t):
    """Micro-batch durations of a run over all messages, from the table the batches write."""
    return R.batch_p99(run_interface(t, batches=FILES)["job"].batch_log(t.spark))


@query("rpt_batch_log", """
    SELECT 'interface_stats' AS stage, count(*) AS messages, true AS covered FROM stats""")
def _(t):
    """Each message was routed in a micro-batch that the log holds, and the report covers
    the whole log."""
    run = run_interface(t, batches=FILES)
    log = run["job"].batch_log(t.spark)
    routed = run["routes"].join(log, "batch_id").groupBy("stage").agg(F.sum("n").alias("messages"))
    whole = log.groupBy("stage").agg(F.max("seconds").alias("slowest"), F.count("*").alias("logged"))
    covered = ((F.col("batches") == F.col("logged")) & (F.col("p99_seconds") > 0)
               & (F.col("p99_seconds") <= F.col("slowest")))
    return routed.join(whole, "stage").join(R.batch_p99(log), "stage").select(
        "stage", "messages", covered.alias("covered"))


@query("agg_welford_stream", """
    SELECT device_id, interface_name, count(*) AS n, round(avg(effective_util_in), 6) AS mean,
           round(var_pop(effective_util_in) * count(*), 6) AS m2,
           round(coalesce(var_samp(effective_util_in), 0), 6) AS variance,
           round(sqrt(coalesce(var_samp(effective_util_in), 0)), 6) AS std
    FROM enriched GROUP BY 1, 2""")
def _(t):
    """Moments of every series as stream state, after two micro-batches of silver files."""
    path, checkpoint = scratch(t.spark, "silver-table"), scratch(t.spark, "moments-checkpoint")
    per = files_per_batch(t.events.count(), FILES)
    P.to_silver_stats(t.scored).repartitionByRange(
        FILES * per, "device_ts", F.xxhash64("device_id", "interface_name")).write.parquet(path)
    silver = SS.table_stream(t.spark, path, struct("silver_interface_stats"), max_files=per)
    # Files may come in any order: all of the data counts as in time.
    changes = MO.moments_stream(silver, watermark="400 days", idle_days=400)
    MO.start_moments(changes, checkpoint, once=True).awaitTermination()
    return MO.read_moments(t.spark, checkpoint)
