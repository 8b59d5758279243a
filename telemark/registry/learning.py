"""Drift (PSI) and isolation forest (section 2.11)."""
from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.operators import aggregates as A
from telemark.plans import baseline as B
from telemark.plans import forest as IF
from telemark.registry.base import query
from telemark.session import scratch

# Groups with enough rows in both periods on the test tables.
DRIFT_KEYS = ("interface_name", "day_of_week")

# Ranks by position in the sorted sample, independent of the engine's percentile.
PSI_SQL = """
    WITH split AS (
        SELECT interface_name, CAST(day_of_week AS INTEGER) AS day_of_week, effective_util_in AS m,
               device_ts >= (SELECT now FROM latest) - INTERVAL 7 DAY AS cur FROM normal),
    sorted AS (
        SELECT interface_name, day_of_week, list_sort(list(m)) AS v, count(*) AS n
        FROM split WHERE NOT cur GROUP BY 1, 2),
    points AS (
        SELECT interface_name, day_of_week, v, n, i, (i * (n - 1)) // 10 AS lo, (i * (n - 1)) % 10 AS part
        FROM sorted, range(11) r(i)),
    cuts AS (
        SELECT interface_name, day_of_week, list_sort(list_distinct(list(
                   v[lo + 1] + (v[least(lo + 2, n)] - v[lo + 1]) * (part / 10.0)))) AS cuts
        FROM points GROUP BY 1, 2),
    binned AS (
        SELECT s.interface_name, s.day_of_week, cur, m, len(cuts) AS nc, cuts,
               least(len(list_filter(cuts, lambda c: c <= m)), len(cuts) - 1) - 1 AS bin
        FROM split s JOIN cuts USING (interface_name, day_of_week)),
    hist AS (
        SELECT interface_name, day_of_week, CAST(bin AS INTEGER) AS bin,
               count(*) FILTER (WHERE NOT cur) AS n_base, count(*) FILTER (WHERE cur) AS n_cur
        FROM binned WHERE nc >= 2 AND m >= cuts[1] AND m <= cuts[nc] GROUP BY 1, 2, 3),
    sizes AS (
        SELECT interface_name, day_of_week, count(*) FILTER (WHERE NOT cur) AS base_points,
               count(*) FILTER (WHERE cur) AS cur_points,
               avg(m) FILTER (WHERE cur) AS mean_cur, stddev_samp(m) FILTER (WHERE cur) AS std_cur
        FROM split GROUP BY 1, 2),
    terms AS (
        SELECT interface_name, day_of_week,
               greatest(n_base / greatest(1, sum(n_base) OVER w), 1e-8) AS b,
               greatest(n_cur / greatest(1, sum(n_cur) OVER w), 1e-8) AS c
        FROM hist WINDOW w AS (PARTITION BY interface_name, day_of_week)),
    psi AS (
        SELECT interface_name, day_of_week, base_points, cur_points, mean_cur, std_cur,
               coalesce((SELECT sum((c - b) * ln(c / b)) FROM terms t
                         WHERE t.interface_name = s.interface_name AND t.day_of_week = s.day_of_week),
                        0) AS psi
        FROM sizes s WHERE base_points > 0 AND cur_points > 0)
"""


def counts(t):
    split = B.split_periods(B.confirmed_normal(t.scored, t.as_of), t.as_of)
    return t.stored(B.value_counts(split, DRIFT_KEYS), "value-counts")


@query("psi_bins", PSI_SQL + """
    SELECT interface_name, day_of_week, i - 1 AS edge, round(cuts[i], 6) AS cut
    FROM cuts, range(1, 12) r(i) WHERE i <= len(cuts)""")
def _(t):
    cuts = B.psi_cuts(counts(t), DRIFT_KEYS, store=t.stored)
    return cuts.select(*DRIFT_KEYS, F.posexplode("cuts").alias("edge", "cut")).withColumn(
        "edge", F.col("edge").cast("bigint"))


@query("psi_hist", PSI_SQL + "SELECT * FROM hist")
def _(t):
    values = counts(t)
    return B.psi_hist(values, t.stored(B.psi_cuts(values, DRIFT_KEYS, store=t.stored)), DRIFT_KEYS)


@query("psi_score", PSI_SQL + """
    SELECT interface_name, day_of_week, base_points, cur_points, round(psi, 6) AS psi,
           psi > 0.25 AS is_significant FROM psi""")
def _(t):
    return B.psi(counts(t), DRIFT_KEYS, store=t.stored)


@query("psi_updates", PSI_SQL + """
    SELECT interface_name, day_of_week, CAST(1.5 AS DOUBLE) AS iqr_k, round(psi, 6) AS psi
    FROM psi WHERE psi > 0.25""")
def _(t):
    return B.psi_updates(B.psi(counts(t), DRIFT_KEYS, store=t.stored), DRIFT_KEYS)


@query("job_psi", PSI_SQL + """
    SELECT interface_name, day_of_week, round(mean_cur, 6) AS baseline_mean,
           round(coalesce(std_cur, 0), 6) AS baseline_std, CAST(1.5 AS DOUBLE) AS iqr_k,
           CAST(0.65 AS DOUBLE) AS isolation_score_threshold, (SELECT now FROM latest) AS valid_from,
           round(psi, 6) AS psi
    FROM psi WHERE psi > 0.25 AND base_points >= 10 AND cur_points >= 10""")
def _(t):
    quiet = B.baselines(B.confirmed_normal(t.scored, t.as_of), DRIFT_KEYS)
    history = quiet.withColumn("valid_from", t.as_of)
    return B.drift_params(
        counts(t), history, t.as_of, DRIFT_KEYS, store=t.stored).drop(
        "distilled_rules", "valid_until")


def features(t):
    """Hourly features as a stored table: training and scoring pass over it several times."""
    return t.stored(A.hourly_features(B.confirmed_normal(
        t.scored, t.as_of,
        present=("device_id", "interface_name", "effective_util_in", "effective_util_out"))),
        "features")


@query("if_scale", """
    WITH f AS (
        SELECT device_id, interface_name, date_trunc('hour', device_ts) AS window_start,
               avg(effective_util_in) AS avg_in, max(effective_util_out) AS max_out,
               CAST(count(*) FILTER (WHERE oper_status <> 1) AS DOUBLE) AS down_count
        FROM normal GROUP BY ALL)
    SELECT device_id, interface_name, window_start,
           round((avg_in - avg(avg_in) OVER ()) / (stddev_pop(avg_in) OVER ()), 6) AS avg_in,
           round((max_out - avg(max_out) OVER ()) / (stddev_pop(max_out) OVER ()), 6) AS max_out,
           round((down_count - avg(down_count) OVER ()) / (stddev_pop(down_count) OVER ()), 6) AS down_count
    FROM f""")
def _(t):
    rows = features(t)
    return IF.scale(rows, IF.fit_scaler(rows)).select(
        *IF.ROW_KEYS, "avg_in", "max_out", "down_count")


@query("if_train")
def _(t):
    forest = IF.train(features(t))
    return t.spark.createDataFrame(forest.nodes, IF.NODE_DDL)


@query("if_score")
def _(t):
    rows = features(t)
    return IF.detect(rows, IF.train(rows))


@query("if_distill")
def _(t):
    """How the rules' verdict agrees with the forest's."""
    rows = features(t)
    forest = IF.train(rows)
    labelled = IF.label(IF.score(rows, forest), forest)
    rules = IF.distill(labelled)
    return labelled.groupBy("label", IF.rules_case(rules).alias("rule_says")).agg(
        F.count("*").alias("n"))


@query("if_persist")
def _(t):
    rows = features(t)
    path = scratch(t.spark, "forest")
    IF.train(rows).save(t.spark, path)
    return IF.score(rows, IF.Forest.load(t.spark, path)).select(*IF.ROW_KEYS, "score")


@query("if_fanout", """
    SELECT s.device_id, s.interface_name, CAST(h AS INTEGER) AS hour_of_day,
           CAST(d AS INTEGER) AS day_of_week, round(baseline_mean, 6) AS baseline_mean,
           round(baseline_std, 6) AS baseline_std, 'rules' AS distilled_rules
    FROM (SELECT DISTINCT device_id, interface_name FROM normal) s, range(24) a(h), range(7) b(d)
    LEFT JOIN (
        SELECT device_id, interface_name, hour_of_day, day_of_week,
               avg(effective_util_in) AS baseline_mean,
               coalesce(stddev_samp(effective_util_in), 0) AS baseline_std
        FROM normal GROUP BY ALL) p
      ON p.device_id = s.device_id AND p.interface_name = s.interface_name
     AND p.hour_of_day = h AND p.day_of_week = d""")
def _(t):
    normal = B.confirmed_normal(t.scored, t.as_of)
    return IF.fan_out(normal, B.baselines(normal), "rules", t.as_of).select(
        "device_id", "interface_name", "hour_of_day", "day_of_week", "baseline_mean",
        "baseline_std", "distilled_rules")


@query("job_if_train")
def _(t):
    """Features, training, distillation, saving and publishing, in one job."""
    normal = B.confirmed_normal(t.scored, t.as_of)
    rows = features(t)
    forest = IF.train(rows)
    forest.save(t.spark, scratch(t.spark, "forest"))
    rules = IF.rules_text(IF.distill(IF.label(IF.score(rows, forest), forest)))
    return IF.fan_out(normal, B.baselines(normal), rules, t.as_of)
