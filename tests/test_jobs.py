"""The nightly chain over stored tables: replay, gold, and the same again on a rerun."""
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.operators import parse as P
from telemark.plans.jobs import Jobs
from telemark.plans import reprocess as RP
from telemark.session import scratch

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def jobs(spark):
    t = X.Tables(spark, SF)
    out = Jobs(spark, scratch(spark, "jobs"), AS_OF, partitions={})
    start = Jobs(spark, out.root, datetime(2024, 1, 1, tzinfo=timezone.utc), partitions={})
    start.write(P.to_silver_stats(t.scored), "silver_interface_stats")
    start.write(P.to_silver_syslogs(t.silver_syslogs), "silver_syslogs")
    start.write(t.dlq, "silver_dlq_quarantine")
    start.write(t.pending, "silver_pending_enrichment")
    start.write(t.inventory_history, "bronze_inventory")
    return out


def test_weekly_then_nightly(spark, jobs):
    model = f"{jobs.root}/model"
    jobs.weekly(model)
    slots = jobs.read("device_baseline_params")
    assert slots.filter(F.col("distilled_rules").contains("isolation_forest")).count() > 0
    before = jobs.read("silver_interface_stats").count()
    jobs.nightly(model)
    added = jobs.read("silver_interface_stats").count() - before
    assert added == jobs.promoted().count() > 0
    begin = F.lit(AS_OF).cast("timestamp") - F.expr("INTERVAL 25 HOURS")
    hour = F.date_trunc("hour", "device_ts").alias("h")
    recent = jobs.read("silver_interface_stats").filter(F.col("device_ts") >= begin).select("site_id", hour)
    touched = jobs.promoted().select("site_id", hour)
    assert recent.count() > 0
    assert jobs.read("gold_site_health_hourly").count() == recent.union(touched).distinct().count()
    assert jobs.read("anomaly_validation").count() > 0

    jobs.nightly(model)  # the same day again replaces, it does not add
    assert jobs.read("silver_interface_stats").count() - before == added

    later = Jobs(spark, jobs.root, datetime(2024, 2, 1, tzinfo=timezone.utc), partitions={})
    later.nightly()
    assert later.promoted().count() == 0
    tries = later.read("pending_log").filter(F.col("resolution") == RP.RETRY)
    assert tries.groupBy("record_key").count().agg(F.max("count")).first()[0] in (1, 2, None)


def test_drift_wins_over_the_baseline_of_the_same_run(spark):
    """A downward drift is what readers get, though the refreshed mean is greater."""
    jobs = Jobs(spark, scratch(spark, "versions"), AS_OF, partitions={})
    row = "struct('d' AS device_id, 'e' AS interface_name, 1 AS hour_of_day, 1 AS day_of_week)"
    for step, mean in ((2, 20.0), (0, 50.0), (1, 50.0)):
        slot = spark.range(1).selectExpr(f"{row} AS r").select("r.*").withColumns({
            "baseline_mean": F.lit(mean), "baseline_std": F.lit(float(step)), "valid_from": jobs.version(step)})
        jobs.write(slot, "device_baseline_params", step + 1)
    got = jobs.params().collect()
    assert len(got) == 1 and got[0]["baseline_mean"] == 20.0


def test_replay_closes_null_payloads_and_keeps_repeated_texts_apart(spark):
    rows = [(None, "NULL_FIELD", "a", datetime(2024, 1, 1)), ("x", "NULL_FIELD", "a", datetime(2024, 1, 1)),
            ("x", "NULL_FIELD", "b", datetime(2024, 1, 1)), ("x", "NULL_FIELD", "a", datetime(2024, 1, 2))]
    dlq = spark.createDataFrame(rows, "raw_payload string, quarantine_reason string, source_topic string, quarantined_at timestamp").withColumns(
        {"reprocessed": F.lit(False), "reprocessed_at": F.lit(None).cast("timestamp"),
         "quarantine_resolution": F.lit(None).cast("string"), "_partition_date": F.lit(None).cast("date")})
    log = RP.resolution_log(dlq.filter("raw_payload IS NULL OR (source_topic = 'a' AND quarantined_at < '2024-01-02')").withColumn(
        "resolution", F.lit(RP.PERMANENT)))
    left = RP.open_dlq(RP.dlq_state(dlq, log)).select("source_topic", F.dayofmonth("quarantined_at").alias("d")).collect()
    assert sorted(tuple(r) for r in left) == [("a", 2), ("b", 1)]


def test_backfill_keeps_every_row(spark):
    t = X.Tables(spark, SF)
    jobs = Jobs(spark, scratch(spark, "backfill"), AS_OF, partitions={})
    start = Jobs(spark, jobs.root, datetime(2024, 1, 1, tzinfo=timezone.utc), partitions={})
    start.write(t.stats.withColumn("_partition_date", F.to_date("_ingested_at")), "bronze_interface_stats")
    start.write(t.inventory.withColumn("_ingested_at", F.lit("2024-01-01").cast("timestamp")), "bronze_inventory")
    jobs.backfill(datetime(2000, 1, 1), datetime(2100, 1, 1))
    parts = [jobs.read(n).count() for n in ("silver_interface_stats", "silver_dlq_quarantine", "silver_pending_enrichment")]
    assert sum(parts) == t.stats.count() and min(parts) > 0


def test_backfill_drops_what_a_day_no_longer_has(spark):
    t = X.Tables(spark, SF)
    parts = {"silver_interface_stats": ("site_id",)}
    jobs = Jobs(spark, scratch(spark, "backfill-again"), AS_OF, partitions=parts)
    start = Jobs(spark, jobs.root, datetime(2024, 1, 1, tzinfo=timezone.utc), partitions=parts)
    bronze = t.stats.withColumn("_partition_date", F.to_date("_ingested_at"))
    start.write(bronze, "bronze_interface_stats")
    start.write(t.inventory.withColumn("_ingested_at", F.lit("2024-01-01").cast("timestamp")), "bronze_inventory")
    day = bronze.agg(F.min("_partition_date")).first()[0]
    for _ in range(2):
        jobs.backfill(datetime.combine(day, datetime.min.time()), datetime.combine(day, datetime.min.time()))
    names = ("silver_interface_stats", "silver_dlq_quarantine", "silver_pending_enrichment")
    assert sum(jobs.read(n).count() for n in names) == bronze.filter(F.col("_partition_date") == F.lit(day)).count() > 0
    start.write(bronze.filter(F.col("_partition_date") > F.lit(day)), "bronze_interface_stats")
    jobs.backfill(datetime(2000, 1, 1), datetime(2100, 1, 1))
    assert sum(jobs.read(n).count() for n in names) == bronze.filter(F.col("_partition_date") > F.lit(day)).count()


def test_a_replay_that_lands_during_the_refresh_is_left_for_the_next_run(spark, monkeypatch):
    from telemark.plans import gold as G
    from telemark.sinks.tables import write_micro_batch

    t = X.Tables(spark, SF)
    jobs = Jobs(spark, scratch(spark, "replays"), AS_OF, partitions={})
    start = Jobs(spark, jobs.root, datetime(2024, 1, 1, tzinfo=timezone.utc), partitions={})
    silver = P.to_silver_stats(t.scored)
    start.write(silver, "silver_interface_stats")
    late = silver.orderBy("device_ts").limit(2)

    def land(batch):
        write_micro_batch(late, RP.REPLAY_BATCH + batch, f"{jobs.root}/silver_interface_stats")

    land(1)
    whole = G.site_health_recent

    def meanwhile(*args, **kwargs):
        out = whole(*args, **kwargs)
        land(2)
        return out

    monkeypatch.setattr(G, "site_health_recent", meanwhile)
    jobs.refresh_gold()
    assert jobs.read("replays_seen").agg(F.max("upto")).first()[0] == RP.REPLAY_BATCH + 1
    later = Jobs(spark, jobs.root, datetime(2024, 2, 1, tzinfo=timezone.utc), partitions={})
    assert later.promoted().count() == 2


def test_a_worse_model_does_not_go_live(spark, jobs, monkeypatch):
    from telemark.plans import forest as IF

    model = f"{jobs.root}/gated"
    assert jobs.train_forest(model)
    first, slots = IF.live_version(spark, model), jobs.read("device_baseline_params").count()
    later = Jobs(spark, jobs.root, datetime(2024, 2, 1, tzinfo=timezone.utc), partitions={})
    train = IF.train

    def blind(features):
        found = train(features)
        found.threshold = float("inf") if found.threshold == float("-inf") else float("-inf")
        return found

    monkeypatch.setattr(IF, "train", blind)      # flags nothing: finds none of the known hours
    promoted = later.train_forest(model)
    gate = later.read("model_gates").filter(F.col("version") == "version=20240201").first()
    assert gate["promoted"] == promoted and gate["candidate_recall"] == 0.0
    if gate["current_recall"] > 0:
        assert not promoted
        assert IF.live_version(spark, model) == first
        assert later.read("device_baseline_params").count() == slots
    assert IF.live(spark, model).sample_size > 0


def test_a_cluster_must_name_a_shared_folder(spark):
    from types import SimpleNamespace

    from telemark.session import shared_folder

    conf = {"spark.master": "spark://somewhere:7077"}
    with pytest.raises(RuntimeError):
        shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d))))


def test_a_backfill_writes_its_rows_once_and_asks_for_devices_only_where_needed(spark):
    t = X.Tables(spark, SF)
    jobs = Jobs(spark, scratch(spark, "backfill-once"), AS_OF, partitions={})
    start = Jobs(spark, jobs.root, datetime(2024, 1, 1, tzinfo=timezone.utc), partitions={})
    start.write(t.stats.withColumn("_partition_date", F.to_date("_ingested_at")), "bronze_interface_stats")
    start.write(t.inventory.withColumn("_ingested_at", F.lit("2024-01-01").cast("timestamp")), "bronze_inventory")
    stored, keep = {}, jobs.keep

    def spy(label):
        def store(df, part="all"):
            out = keep(label)(df, part)
            stored[part] = stored.get(part, 0) + out.count()
            return out
        return store

    jobs.keep = spy
    whole = (datetime(2000, 1, 1), datetime(2100, 1, 1))
    jobs.backfill(*whole)
    devices = t.inventory.count()
    assert stored.pop("inventory") == devices and sum(stored.values()) == 0
    jobs.backfill(*whole)
    tables = ("silver_interface_stats", "silver_dlq_quarantine", "silver_pending_enrichment")
    assert sum(stored.values()) - devices == sum(len(jobs.read(n).inputFiles()) - 1 for n in tables)
    assert sum(jobs.read(n).count() for n in tables) == t.stats.count()
    quarantine = RP.silver_routes(jobs.read("bronze_interface_stats"), t.inventory, t.params, X.DENSE_KEYS)[1]
    assert "Join" not in quarantine._jdf.queryExecution().optimizedPlan().toString()


def test_a_large_inventory_is_copied_fewer_times(spark, monkeypatch):
    from telemark.operators import joins as J
    from telemark.operators import route as RT

    t = X.Tables(spark, SF)
    count = lambda df: sorted(map(tuple, RT.route_counts(df).collect()))
    routed = count(RT.route_stats(t.derived, t.inventory))
    for size, salts in ((J.BROADCAST_BYTES + 1, 15), (64 * 2**20, 2), (2**40, 1)):
        monkeypatch.setattr(J, "estimated_bytes", lambda df, size=size: size)
        again = RT.route_stats(t.derived, t.inventory)
        plan = again._jdf.queryExecution().analyzed().toString()
        assert ("_salt" in plan) == (salts > 1) and J.salts_for(t.inventory) == salts
        assert count(again) == routed
