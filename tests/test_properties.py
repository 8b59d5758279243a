"""Properties that must hold on any input: whole results, one row per key, replay once."""
import math
import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.operators import aggregates as A
from telemark.operators import joins as J
from telemark.operators import score as S
from telemark.operators import versions as V
from telemark.plans import reprocess as RP
from telemark.schema import TABLES, struct
from telemark.session import scratch
from telemark.sinks import tables as SK
from telemark.streaming import silver as SV
from telemark.streaming import windows as SW

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 3, 4, 10, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def t(spark):
    return X.Tables(spark, SF)


def rows(df):
    return sorted(map(str, df.collect()))


def skewed(spark, n=3000):
    """A third of the rows on one key, a third on NULL."""
    rnd = random.Random(1)
    keys = [["hot"], [None], [f"k{rnd.randrange(50)}"]]
    data = [(keys[i % 3][0] if i % 3 < 2 else f"k{rnd.randrange(50)}", i) for i in range(n)]
    return spark.createDataFrame(data, "device_id string, n int")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join(spark, how):
    fact = skewed(spark)
    small = spark.createDataFrame(
        [("hot", "S0")] + [(f"k{i}", f"S{i}") for i in range(40)], "device_id string, site_id string")
    assert rows(J.attach(fact, small, "device_id", how, limit=0)) == rows(
        J.attach(fact, small, "device_id", how))


def test_salt_spreads_a_hot_key(spark):
    fact = skewed(spark)
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64("device_id", "n"), F.lit(J.SALTS)))
    per_salt = salted.filter("device_id = 'hot'").groupBy("_salt").count().collect()
    assert len(per_salt) == J.SALTS and max(r["count"] for r in per_salt) < 200


def test_large_side_is_not_broadcast(spark):
    fact, small = skewed(spark), spark.range(10).select(F.col("id").cast("string").alias("device_id"))
    plan = J.attach(fact, small, "device_id", limit=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "broadcast" not in plan.lower()


@pytest.mark.parametrize("how", ["left", "left_semi"])
def test_copies_per_salt_are_not_broadcast_by_the_planner(spark, how):
    fact, small = skewed(spark), spark.range(10).select(F.col("id").cast("string").alias("device_id"))
    plan = J.attach(fact, small, "device_id", how, limit=0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_routes_partition_the_input(t):
    counts = {r["route"]: r["n"] for r in t.routed.groupBy("route").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == t.events.count() and set(counts) == {"INVALID", "PENDING", "ENRICHED"}


def test_scores_stay_in_range(t):
    low, high = t.health.agg(F.min("health_score"), F.max("health_score")).first()
    assert 0 <= low <= high <= 100


def test_latest_by_key_is_unique_and_newest(spark):
    rnd = random.Random(7)
    data = [("hot" if i % 3 == 0 else f"k{rnd.randrange(9)}", rnd.randrange(100), i) for i in range(900)]
    df = spark.createDataFrame(data, "k string, version int, payload int")
    want = {}
    for k, v, p in data:
        want[k] = max(want.get(k, (-1, -1)), (v, p))
    got = {r["k"]: (r["version"], r["payload"]) for r in V.latest_by_key(df, ["k"], ["version", "payload"]).collect()}
    assert got == want


def test_dedup_counts_null_key_parts_as_empty(spark):
    df = spark.createDataFrame(
        [(None, "a", 1), ("", "a", 2), ("x", "a", 3), ("x", "a", 4)], "d string, i string, n int")
    assert sorted(r["n"] for r in V.dedup_last_wins(df, ["d", "i"], "n").collect()) == [2, 4]


def test_total_per_hour_counts_hot_groups(spark):
    data = [("S1" if i % 3 else "S2", T0 + timedelta(minutes=i % 90), i) for i in range(600)]
    df = spark.createDataFrame(data, "site_id string, device_ts timestamp, n int")
    out = A.total_per_hour(df)
    assert out.count() == 600
    groups = out.groupBy("site_id", "window_start", "total_ifaces").count()
    assert groups.filter("count <> total_ifaces").count() == 0


@pytest.mark.parametrize("keys", [("device_id", "interface_name"), ("interface_name",)])
def test_rolling_iqr_equals_percentile_over_ranges(spark, keys):
    """Peers, windows' borders, repeated rows, NULLs, NaN and rows without time or key."""
    rng = random.Random(5)
    hours = [timedelta(hours=rng.choice((0, 1, 2, 4, 6, 8)), seconds=rng.choice((0, 1))) for _ in range(400)]
    values = (None, math.nan, math.inf, -1.5, 0.0, 2.0, 7.25)
    data = [(rng.choice((None, "a", "b")), "e", None if i % 17 == 0 else T0 + h, rng.choice(values), i)
            for i, h in enumerate(hours)]
    df = spark.createDataFrame(
        data, "device_id string, interface_name string, device_ts timestamp, v double, n bigint")
    over = (f"OVER (PARTITION BY {', '.join(keys)} ORDER BY device_ts "
            "RANGE BETWEEN INTERVAL 4 HOURS PRECEDING AND CURRENT ROW)")
    want = df.selectExpr("n", f"percentile(v, 0.25D) {over} AS q1", f"percentile(v, 0.75D) {over} AS q3")
    got = S.rolling_iqr(df, "v", keys=keys).select("n", "q1", "q3")
    assert rows(got.selectExpr("n", "string(q1)", "string(q3)")) == rows(
        want.selectExpr("n", "string(q1)", "string(q3)"))


def test_rolling_iqr_against_brute_force(spark):
    rng = np.random.default_rng(2)
    data = [("hot" if i % 3 == 0 else f"d{i % 5}", "e",
             T0 + timedelta(seconds=int(rng.integers(0, 60000))), float(rng.uniform(0, 100)), i)
            for i in range(300)]
    df = spark.createDataFrame(
        data, "device_id string, interface_name string, device_ts timestamp, "
        "effective_util_in double, n int")
    got = {r["n"]: (r["q1"], r["q3"]) for r in S.rolling_iqr(df).collect()}
    assert len(got) == 300
    for d, _, ts, _, n in data:
        past = [r[3] for r in data if r[0] == d and ts - timedelta(hours=4) <= r[2] <= ts]
        assert got[n] == pytest.approx(tuple(np.quantile(past, [0.25, 0.75])))


def test_baseline_as_of_respects_validity(spark):
    stats = spark.createDataFrame(
        [("d", T0 + timedelta(days=i)) for i in range(4)], "device_id string, device_ts timestamp")
    params = spark.createDataFrame(
        [("d", 1.0, T0, T0 + timedelta(days=9)), ("d", 2.0, T0 + timedelta(days=2), T0 + timedelta(days=2, hours=1))],
        "device_id string, baseline_mean double, valid_from timestamp, valid_until timestamp",
    ).withColumns({"baseline_std": F.lit(1.0), "iqr_k": F.lit(1.5)})
    out = J.attach_baseline_asof(stats, params, ("device_id",)).orderBy("device_ts").collect()
    assert [r["baseline_mean"] for r in out] == [1.0, 1.0, 2.0, 1.0]


def test_dlq_replay_closes_every_row_once(t):
    replay = RP.replay_dlq(t.dlq, t.late_inventory, t.params, keys=X.DENSE_KEYS)
    state = RP.dlq_state(t.dlq, replay.log)
    assert state.count() == t.dlq.count()
    assert RP.open_dlq(state).count() == 0
    promoted = state.filter(F.col("quarantine_resolution") == RP.PROMOTED).count()
    assert promoted == replay.silver.count() > 0
    again = RP.replay_dlq(state, t.late_inventory, t.params, keys=X.DENSE_KEYS)
    assert again.silver.count() == 0 and again.log.count() == 0


def test_pending_replay_is_idempotent_and_loses_nothing(t):
    first = RP.replay_pending(t.pending, t.late_inventory, t.params, X.DENSE_KEYS)
    parts = first.silver.count() + first.quarantine.count() + first.retry.count()
    assert parts == t.pending.count()
    left = RP.still_open(t.pending, first.log)
    assert left.count() == first.retry.count()
    assert RP.replay_pending(left, t.late_inventory, t.params, X.DENSE_KEYS).silver.count() == 0


def test_align_resolves_aliases_fills_nulls_and_orders(spark):
    df = spark.createDataFrame([("d", 1.5, "oops")], "device_id string, raw_util_in double, oper_status string")
    out = SK.align(df, struct("bronze_interface_stats"))
    assert out.schema.simpleString() == struct("bronze_interface_stats").simpleString()
    row = out.first()
    assert row["util_in"] == 1.5 and row["oper_status"] is None and row["ts"] is None


def test_every_layout_parses():
    for name in TABLES:
        assert struct(name).fields


def test_micro_batch_retry_replaces_itself(spark):
    path = scratch(spark, "retry")
    sink = SK.micro_batch_sink(path)
    df = spark.range(10)
    for batch_id in (0, 1, 1):
        sink(df, batch_id)
    sink(df.filter("id < 0"), 2)
    assert spark.read.parquet(path).count() == 20


def test_parameters_are_read_again_after_ttl(spark):
    now = [0.0]
    cached = SV.Refreshing(lambda: spark.range(1), ttl=10, clock=lambda: now[0])
    first = cached()
    now[0] = 9.0
    assert cached() is first and cached.reads == 1
    now[0] = 10.0
    assert cached() is not first and cached.reads == 2


def test_replay_batch_can_be_retried(spark, t):
    """A retried inventory micro-batch writes the same rows, not more."""
    from telemark.registry.streams import inventory_messages, run_interface

    job = run_interface(t)["job"]
    messages = inventory_messages(t, t.devices, F.lit(T0)).withColumnRenamed(
        "_ingested_at", "kafka_ts")
    job.inventory_batch(messages, 0)
    once = spark.read.parquet(job.path("silver_interface_stats")).count()
    job.inventory_batch(messages, 0)
    spark.catalog.refreshByPath(job.path("silver_interface_stats"))
    assert spark.read.parquet(job.path("silver_interface_stats")).count() == once > 0
    job.inventory_batch(messages, 1)
    assert spark.read.parquet(job.path("silver_interface_stats")).count() == once


def test_health_stream_plan_equals_batch_plan(t):
    feed = SW.health_feed(t.enriched, t.silver_syslogs)
    stream_form = X.present(SW.health_stream(feed, None).drop("window_end"))
    batch_form = X.present(t.health_history.select(*stream_form.columns))
    assert rows(stream_form) == rows(batch_form)


def test_backfill_only_into_an_empty_target(spark):
    flags = spark.createDataFrame([], struct("silver_flatline_flags"))
    assert SW.needs_backfill(flags)
    assert not SW.needs_backfill(spark.createDataFrame([("FLATLINE",)], "anomaly_type string"))


def test_trailing_reads_only_recent_partitions(spark, t):
    from telemark.operators import parse as P
    from telemark.plans import gold as G

    path = scratch(spark, "pruned")
    SK.append(P.to_silver_stats(t.scored), path, "silver_interface_stats", ["_partition_date"])
    recent = G.trailing(spark.read.parquet(path), t.as_of)
    assert recent.count() == G.trailing(t.enriched, t.as_of).count() > 0
    files = recent.select("_metadata.file_path").distinct().count()
    assert files <= 2
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_partition_date" in plan


def test_touched_hours_prune_by_site_and_day(spark, t):
    from telemark.operators import parse as P
    from telemark.plans import gold as G

    path = scratch(spark, "touched")
    silver = P.to_silver_stats(t.scored)
    SK.append(silver, path, "silver_interface_stats", ["site_id", "_partition_date"])
    late = t.stored(silver.orderBy("device_ts", "device_id").limit(3))
    logs = P.to_silver_syslogs(t.silver_syslogs)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    out = G.site_health_touched(spark.read.parquet(path), logs, late, t.as_of, t.stored)
    plan = out._jdf.queryExecution().executedPlan().toString()
    filters = [x.split("PartitionFilters: ")[1] for x in plan.split("FileScan") if "dynamicpruning" in x]
    assert filters and all(f"dynamicpruningexpression({c}#" in filters[0] for c in ("site_id", "_partition_date")), filters
    hours = G.touched_hours(late)
    whole = G.site_health(silver, logs, t.as_of)
    want = whole.join(hours.withColumnRenamed("_hour", "window_start"), ["site_id", "window_start"], "left_semi")
    keys = ["site_id", "window_start", "total_interface_count"]
    assert rows(out.select(keys)) == rows(want.select(keys)) != []


def test_no_local_checkpoint_and_no_cross_join():
    import pathlib

    root = pathlib.Path(X.__file__).parent
    text = "\n".join(p.read_text() for p in root.rglob("*.py"))
    assert "localCheckpoint" not in text and "crossJoin" not in text
