"""Hand-built rows with known outcomes."""
import json
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemark.functions import columns as C
from telemark.operators import flatline as FL
from telemark.operators import parse as P
from telemark.operators import route as RT
from telemark.operators import score as S
from telemark.plans import baseline as B
from telemark.plans import gold as G
from telemark.plans import validation as VA
from telemark.plans.reports import degraded_sites

T0 = datetime(2024, 3, 4, 10, 0, tzinfo=timezone.utc)  # a Monday
INVENTORY = [("d1", "S1", "v", "edge"), ("d2", None, "v", "edge")]
INV_DDL = "device_id string, site_id string, vendor string, role string"


def iso(t):
    return t.strftime("%Y-%m-%dT%H:%M:%SZ")


def payload(**change):
    body = dict(ts=iso(T0), device_id="d1", interface_name="eth0", util_in=10.0, util_out=20.0,
                admin_status=1, oper_status=1)
    body.update(change)
    return json.dumps({k: v for k, v in body.items() if v != "ABSENT"})


def route(spark, texts):
    rows = [(i, t, "topic") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "n int, payload string, source_topic string")
    return RT.route_stats(P.parse_stats(df), spark.createDataFrame(INVENTORY, INV_DDL))


FAULTS = [
    (payload(), None),
    (payload(ts="ABSENT"), "NULL_FIELD"),
    (payload(device_id=None), "NULL_FIELD"),
    (payload(interface_name="ABSENT"), "NULL_FIELD"),
    (payload(util_in=None), "NULL_FIELD"),
    (payload(util_out="ABSENT"), "NULL_FIELD"),
    (payload(oper_status="ABSENT", operational_status=1), "NULL_FIELD"),
    (payload(admin_status="ABSENT"), None),
    (payload(admin_status=7), None),
    (payload(packet_loss=3), None),
    (payload(util_in="58.3"), None),
    (payload(util_in="NaN"), "EXCEEDS_MAX"),
    (payload(oper_status="NaN"), "NULL_FIELD"),
    (payload(util_in=-1), "NEGATIVE_UTIL"),
    (payload(util_out=999), "EXCEEDS_MAX"),
    (payload(util_in=-1, util_out=999), "NEGATIVE_UTIL"),
    (payload(oper_status=9999.9), "INVALID_STATUS"),
    (payload(ts="x"), "INVALID_TIMESTAMP"),
    (payload(ts="x", oper_status=9), "INVALID_STATUS"),
    ("not json", "NULL_FIELD"),
    ("", "NULL_FIELD"),
]


def test_faults_and_reasons(spark):
    got = route(spark, [p for p, _ in FAULTS]).orderBy("n").collect()
    assert [r["validation_reason"] for r in got] == [reason for _, reason in FAULTS]
    assert [r["payload"] for r in got] == [p for p, _ in FAULTS]


def test_quoted_number_extra_key_and_down_interface(spark):
    rows = route(spark, [
        payload(util_in="58.3", packet_loss=3), payload(util_in=95, oper_status=2),
        payload(util_in=95, oper_status=3), payload(oper_status="3.0"),
    ]).orderBy("n").collect()
    assert rows[0]["util_in"] == 58.3 and rows[0]["_extra_cols"] == {"packet_loss": "3"}
    assert [r["effective_util_in"] for r in rows[1:3]] == [0.0, 0.0]
    assert rows[3]["oper_status"] == 3


def test_routes_and_pending_reasons(spark):
    rows = route(spark, [payload(), payload(device_id="d2"), payload(device_id="zz"),
                         payload(device_id="zz", util_in=-3)]).orderBy("n").collect()
    assert [(r["route"], r["pending_reason"]) for r in rows] == [
        ("ENRICHED", None), ("PENDING", "NO_SITE"), ("PENDING", "UNKNOWN_DEVICE"), ("INVALID", None)]


@pytest.mark.parametrize("severity,ts,reason", [
    (3, iso(T0), None), ("3", iso(T0), None), (8, iso(T0), "INVALID_SEVERITY"),
    (-1, iso(T0), "INVALID_SEVERITY"), (None, iso(T0), "INVALID_SEVERITY"),
    (9, "x", "INVALID_TIMESTAMP"), (3, None, "NULL_FIELD"),
])
def test_syslog_reasons(spark, severity, ts, reason):
    text = json.dumps({"ts": ts, "device_id": "d1", "severity": severity})
    df = spark.createDataFrame([(text, "t")], "payload string, source_topic string")
    row = RT.validate_syslogs(P.parse_syslogs(df)).first()
    assert row["validation_reason"] == reason


PROFILES = {
    # name: util_in, util_out, mean, std, k, z, iqr, flags
    "flatline": (42.0, 17.5, 42.0, 10.0, 20.0, 0.0, 0.0, ["FLATLINE"]),
    "zscore": (62.0, 58.0, 55.0, 2.0, 20.0, 3.49999998, 0.175, ["HIGH_Z_SCORE", "FLATLINE"]),
    "iqr": (74.0, 36.0, 55.0, 10.0, 1.5, 1.9, 1.26666667, ["IQR_OUTLIER", "FLATLINE"]),
}


def test_scenario_profiles(spark):
    samples, params = [], []
    for name, (util_in, util_out, mean, std, k, *_rest) in PROFILES.items():
        for i in range(240):
            samples.append((name, "S1", "gi0/1", T0 + timedelta(seconds=i), util_in, util_out, 1))
        params.append((name, "gi0/1", 10, 0, mean, std, k, 0.65))
    stats = spark.createDataFrame(
        samples, "device_id string, site_id string, interface_name string, device_ts timestamp, "
        "effective_util_in double, effective_util_out double, oper_status int")
    scored = S.score_ingest(stats, spark.createDataFrame(params, S.BASELINE_DDL))
    merged = S.merge_flatline(scored, FL.flat_series(scored))
    rows = merged.groupBy("device_id").agg(
        F.count("*").alias("n"), F.max("ingest_z_score").alias("z"),
        F.max("ingest_iqr_score").alias("iqr"),
        F.collect_set("ingest_flags").alias("flags")).collect()
    assert len(rows) == 3
    for r in rows:
        *_, z, iqr, flags = PROFILES[r["device_id"]]
        assert r["n"] == 240
        assert r["z"] == pytest.approx(z, abs=1e-7) and r["iqr"] == pytest.approx(iqr, abs=1e-7)
        assert [list(f) for f in r["flags"]] == [flags]


@pytest.mark.parametrize("sat,crit,down,score", [
    (0.0, 0, 0.0, 100.0), (1.0, 4, 1.0, 0.0), (0.0, 9, 0.0, 60.0), (0.5, 4, 0.0, 40.0),
    (0.51, 4, 0.0, 39.6),
])
def test_health_score(spark, sat, crit, down, score):
    df = spark.range(1).select(
        C.health_score(F.lit(sat), F.lit(crit), F.lit(down)).alias("health_score"))
    row = df.withColumn("low", C.is_degraded()).first()
    assert row["health_score"] == pytest.approx(score) and row["low"] == (score < 40)


def test_score_at_the_limit_is_not_degraded(spark):
    """All fractions of counts up to 60 that give a score of 40, and the nearest ones below it."""
    parts = [(sat, down, n) for n in range(1, 61) for sat in range(n + 1)
             for down in range(n + 1) if 40 * sat + 20 * down in (20 * n, 20 * n + 20)]
    df = spark.createDataFrame(parts, "sat int, down int, n int").select(
        "*", C.health_score(F.col("sat") / F.col("n"), F.lit(4), F.col("down") / F.col("n")).alias("health_score"))
    wrong = df.filter(C.is_degraded() != (F.col("sat") * 40 + F.col("down") * 20 > F.col("n") * 20))
    assert wrong.count() == 0


def test_mean_between_two_decimals_rounds_up(spark):
    """The sum of three scores of 30.15 ends below 90.45."""
    df = spark.createDataFrame(
        [("S", 30.15, True)] * 3, "site_id string, health_score double, is_degraded boolean")
    row = degraded_sites(df).first()
    assert row["min_score"] == row["avg_score"] == 30.2


def numpy_psi(base, cur, bins=10):
    """The index by its definition, for comparison."""
    cuts = np.unique(np.quantile(base, np.linspace(0, 1, bins + 1)))
    if len(cuts) < 2:
        return 0.0
    b, c = np.histogram(base, cuts)[0], np.histogram(cur, cuts)[0]
    rb = np.maximum(b / max(1, b.sum()), 1e-8)
    rc = np.maximum(c / max(1, c.sum()), 1e-8)
    return float(((rc - rb) * np.log(rc / rb)).sum())


def test_psi_against_definition(spark):
    rng = np.random.default_rng(3)
    groups = {
        "drift": (rng.normal(40, 10, 300).clip(0, 100), rng.normal(55, 10, 200).clip(0, 100)),
        "same": (rng.uniform(0, 100, 157), None),
        "constant": (np.full(20, 5.0), rng.uniform(0, 9, 20)),
        "apart": (rng.uniform(0, 10, 50), rng.uniform(50, 60, 50)),
        "ties": (rng.integers(0, 6, 400).astype(float), rng.integers(2, 8, 300).astype(float)),
        "small": (np.array([1.0, 2.0, 4.0]), np.array([2.0, 9.0])),
        "one": (np.array([1.0]), np.array([1.0])),
    }
    rows, want = [], {}
    for name, (base, cur) in groups.items():
        cur = base if cur is None else cur
        want[name] = numpy_psi(base, cur)
        rows += [(name, float(v), False) for v in base] + [(name, float(v), True) for v in cur]
    df = spark.createDataFrame(rows, "g string, metric double, is_current boolean")
    got = {r["g"]: r["psi"] for r in B.psi(B.value_counts(df, ["g"]), ["g"]).collect()}
    assert got.keys() == want.keys()
    for name in want:
        assert got[name] == pytest.approx(want[name], abs=1e-9), name
    assert got["same"] == 0 and got["constant"] == 0 and got["apart"] > 5


def test_drift_needs_ten_points_and_keeps_previous_factor(spark):
    rng = np.random.default_rng(5)
    rows = []
    for name, n in (("many", 40), ("few", 9)):
        for v in rng.uniform(0, 10, n):
            rows.append((name, "e", 1, 2, float(v), False))
        for v in rng.uniform(50, 60, n):
            rows.append((name, "e", 1, 2, float(v), True))
    rows.append(("single", "e", 1, 2, 4.0, True))
    df = spark.createDataFrame(
        rows, "device_id string, interface_name string, hour_of_day int, day_of_week int, "
        "metric double, is_current boolean")
    keys = ("device_id", "interface_name", "hour_of_day", "day_of_week")
    history = spark.createDataFrame(
        [("many", "e", 1, 2, 1.0, 1.0, 3.0, 0.5, T0 - timedelta(days=9)),
         ("many", "e", 1, 2, 1.0, 1.0, 2.5, 0.6, T0)],
        S.BASELINE_DDL + ", valid_from timestamp")
    out = B.drift_params(B.value_counts(df, keys), history, F.lit(T0), keys).collect()
    current = [r[4] for r in rows if r[0] == "many" and r[5]]
    assert [r["device_id"] for r in out] == ["many"]
    assert out[0]["iqr_k"] == 2.5 and out[0]["isolation_score_threshold"] == 0.6
    assert out[0]["baseline_mean"] == pytest.approx(np.mean(current))
    assert out[0]["baseline_std"] == pytest.approx(np.std(current, ddof=1))


def test_single_sample_window_is_flat_only_on_request(spark):
    df = spark.createDataFrame(
        [("d", "S", "e", T0, 5.0, 1)], "device_id string, site_id string, interface_name string, "
        "device_ts timestamp, effective_util_in double, oper_status int")
    assert FL.flat_windows(df).count() == 0
    assert FL.flat_windows(df, min_points=1).count() == 1


def test_sliding_windows_against_brute_force(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(60):
        t = T0 + timedelta(seconds=int(rng.integers(0, 6 * 3600)))
        rows.append(("d", "S", "e", t, float(rng.choice([5.0, 5.001, 40.0], p=[.6, .3, .1])), 1))
    df = spark.createDataFrame(
        rows, "device_id string, site_id string, interface_name string, device_ts timestamp, "
        "effective_util_in double, oper_status int")
    want = {}
    step = timedelta(minutes=5)
    for k in range(-60, 90):
        start = T0 + k * step
        vals = [r[4] for r in rows if start <= r[3] < start + timedelta(hours=4)]
        if len(vals) >= 2:
            var = np.var(vals, ddof=1)
            if min(vals) == max(vals):
                want[start] = "FLATLINE"
            elif var < 0.01:
                want[start] = "NEAR_FLATLINE"
    got = {r["window_start"].astimezone(timezone.utc): r["anomaly_type"]
           for r in FL.flat_windows_sliding(df).collect()}
    assert got == want and len(want) > 10


def test_debounce_counts_minutes_once_and_keeps_last(spark):
    def reading(second, util, z, flags, ingested):
        return ("d", "S", "e", T0 + timedelta(seconds=second), util, z, 0.0, flags, bool(flags),
                T0 + timedelta(seconds=ingested))

    rows = [
        reading(0, 90.0, 0.0, ["THRESHOLD_SATURATED"], 1),
        reading(10, 91.0, 3.0, ["THRESHOLD_SATURATED", "HIGH_Z_SCORE"], 12),  # replaces the first
        reading(60, 92.0, 0.0, ["THRESHOLD_SATURATED"], 61),
        reading(120, 93.0, 0.0, ["THRESHOLD_SATURATED"], 121),
        reading(180, 10.0, 0.0, [], 181),
    ]
    df = spark.createDataFrame(
        rows, "device_id string, site_id string, interface_name string, device_ts timestamp, "
        "effective_util_in double, ingest_z_score double, ingest_iqr_score double, "
        "ingest_flags array<string>, ingest_anomaly boolean, _ingested_at timestamp")
    out = G.anomaly_windows(df).collect()
    assert [(r["anomaly_type"], r["anomaly_subtype"]) for r in out] == [
        ("THRESHOLD_SATURATED", "SATURATION")]
    assert out[0]["mean_util_in"] == pytest.approx(92.0)
    assert out[0]["std_util_in"] == pytest.approx(np.std([91, 92, 93]))


def test_agreement_labels(spark):
    ddl = "device_id string, interface_name string, window_start timestamp, {} int"
    hour = [T0 + timedelta(hours=i) for i in range(4)]
    ingest = spark.createDataFrame(
        [("d", "e", hour[0], 1), ("d", "e", hour[1], 1), ("d", "e", hour[3], 0)],
        ddl.format("ingest_flagged"))
    batch = spark.createDataFrame(
        [("d", "e", hour[0], 1), ("d", "e", hour[2], 1), ("d", "e", hour[3], 0)],
        ddl.format("batch_flagged"))
    rows = VA.validate_decisions(ingest, batch).orderBy("window_start").collect()
    assert [r["agreement"] for r in rows] == ["CONFIRMED", "FALSE_POSITIVE", "MISSED", "BOTH_CLEAN"]
