"""Seasonal baselines and drift of their distributions (PSI)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemark.functions import columns as C
from telemark.operators.joins import Store, attach
from telemark.operators.parse import season_keys
from telemark.operators.versions import latest_by_key
from telemark.schema import SEASON_KEYS

# Fixed parameters of the weekly jobs.
LOOKBACK_DAYS = 30
CURRENT_DAYS = 7
IQR_K = 1.5
ISOLATION_THRESHOLD = 0.65
PSI_LIMIT = 0.25
PSI_BINS = 10
PSI_MIN_POINTS = 10
RATIO_FLOOR = 1e-8
# A group of more distinct values than this is ranked in cells of about equal counts.
WHOLE_GROUP = 100_000
CELLS = 256
FAR_FUTURE = "2099-12-31 23:59:59"


def confirmed_normal(
    stats: DataFrame, as_of: Column, days: int = LOOKBACK_DAYS,
    present: tuple[str, ...] = ("device_id", "interface_name", "effective_util_in"),
) -> DataFrame:
    """Unflagged rows of the lookback period whose keys and metric are given."""
    recent = C.since(stats, as_of - F.expr(f"INTERVAL {days} DAYS"))
    quiet = ~F.coalesce(F.col("ingest_anomaly"), F.lit(False))
    return recent.filter(quiet).dropna(subset=list(present))


def baselines(
    normal: DataFrame, keys: tuple[str, ...] = SEASON_KEYS, metric: str = "effective_util_in",
) -> DataFrame:
    """Mean, sample deviation (0 for one point) and count per season slot."""
    return season_keys(normal).groupBy(*keys).agg(
        F.avg(metric).alias("baseline_mean"),
        F.coalesce(F.stddev_samp(metric), F.lit(0.0)).alias("baseline_std"),
        F.count("*").alias("sample_count"),
    ).withColumns({
        "iqr_k": F.lit(IQR_K),
        "isolation_score_threshold": F.lit(ISOLATION_THRESHOLD),
    })


def refresh_params(
    normal: DataFrame, as_of: Column, keys: tuple[str, ...] = SEASON_KEYS,
    days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Parameter rows to append: baselines with provenance and validity."""
    rules = C.rules_json(
        source="weekly_baseline_refresh", lookback_days=days, sample_count=F.col("sample_count"))
    return baselines(normal, keys).withColumns({
        "distilled_rules": rules,
        "valid_from": as_of,
        "valid_until": F.lit(FAR_FUTURE).cast("timestamp"),
    }).drop("sample_count")


def latest_params(history: DataFrame, keys: tuple[str, ...] = SEASON_KEYS) -> DataFrame:
    return latest_by_key(history, keys, ["valid_from", "baseline_mean", "baseline_std"])


# -- population stability index -------------------------------------------------


def split_periods(
    normal: DataFrame, as_of: Column, days: int = CURRENT_DAYS, metric: str = "effective_util_in",
) -> DataFrame:
    current = F.col("device_ts") >= as_of - F.expr(f"INTERVAL {days} DAYS")
    return season_keys(normal).withColumns({
        "metric": F.col(metric), "is_current": current})


def value_counts(split: DataFrame, keys) -> DataFrame:
    """Distinct values per group with their count in each period.

    The only pass over the rows: equal readings combine before the shuffle, and
    everything later works on distinct values.
    """
    return split.groupBy(*keys, F.col("metric").alias("value")).agg(
        F.count_if(~F.col("is_current")).alias("n_base"),
        F.count_if(F.col("is_current")).alias("n_cur"),
    )


def value_cells(
    base: DataFrame, keys, whole: int = WHOLE_GROUP, cells: int = CELLS, store: Store | None = None,
) -> DataFrame:
    """`base` with a `_cell` that rises with the value, for ranking a group in pieces.

    The bounds between cells are approximate quantiles of the group's distinct values, so
    cells hold about equally many of them however closely the readings lie together. Any
    bounds give the same ranks. Groups of up to `whole` values are one cell and carry no
    bounds, which keeps the table of bounds small: one row per `whole` values at most.
    """
    at = [i / cells for i in range(1, cells)]
    bounds = base.groupBy(*keys).agg(
        F.percentile_approx("value", at, 8 * cells).alias("_bounds"), F.count("*").alias("_values"),
    ).filter(F.col("_values") > whole).drop("_values")
    cell = F.size(F.filter("_bounds", lambda b: b < F.col("value")))
    split = F.when(F.col("_bounds").isNotNull() & F.col("value").isNotNull(), cell).otherwise(F.lit(0))
    return attach(base, bounds, list(keys), store=store).withColumn("_cell", split).drop("_bounds")


def psi_cuts(
    counts: DataFrame, keys, bins: int = PSI_BINS, whole: int = WHOLE_GROUP, store: Store | None = None,
) -> DataFrame:
    """Distinct quantile cut points of the baseline sample, linearly interpolated.

    Exact ranks without gathering a large group: values are ranked inside their
    cell (`value_cells`), and shifted by the rows of the cells before. Ranks are
    whole-number arithmetic.
    """
    keys = list(keys)
    base = value_cells(counts.filter("n_base > 0"), keys, whole, store=store)
    cells = base.groupBy(*keys, "_cell").agg(F.sum("n_base").alias("_in_cell"))
    up_to = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    offsets = cells.select(
        *keys, "_cell",
        (F.sum("_in_cell").over(up_to) - F.col("_in_cell")).alias("_before"),
        F.sum("_in_cell").over(Window.partitionBy(*keys)).alias("_total"),
    )
    inside = Window.partitionBy(*keys, "_cell").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = (
        base.withColumn("_up_to", F.sum("n_base").over(inside))
        .join(offsets, [*keys, "_cell"])
        .withColumn("_last", F.col("_before") + F.col("_up_to") - 1)
        .withColumn("_first", F.col("_last") - F.col("n_base") + 1)
    )
    picks = []
    for i in range(bins + 1):
        at = F.lit(i) * (F.col("_total") - 1)
        low = F.floor(at / bins)
        high = F.ceil(at / bins)
        picks += [
            F.max(F.when(low.between(F.col("_first"), F.col("_last")), F.col("value"))).alias(f"_lo{i}"),
            F.max(F.when(high.between(F.col("_first"), F.col("_last")), F.col("value"))).alias(f"_hi{i}"),
        ]
    quantiles = ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)
    points = []
    for i in range(bins + 1):
        part = F.pmod(F.lit(i) * (F.col("_total") - 1), F.lit(bins)) / bins
        points.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * part)
    return quantiles.select(*keys, F.array_sort(F.array_distinct(F.array(*points))).alias("cuts"))


def psi_hist(counts: DataFrame, cuts: DataFrame, keys, open_ended: bool = False) -> DataFrame:
    """Rows of each period per bin. The last bin is closed; values outside are
    dropped, or counted in the outer bins when `open_ended`."""
    keys = list(keys)
    joined = attach(counts, cuts.filter(F.size("cuts") >= 2), keys, "inner")
    last = F.size("cuts") - 1
    at = F.size(F.filter("cuts", lambda c: c <= F.col("value")))
    slot = F.greatest(F.least(at, last), F.lit(1))
    if not open_ended:
        inside = F.col("value").between(F.try_element_at("cuts", F.lit(1)), F.try_element_at("cuts", F.lit(-1)))
        joined = joined.filter(inside)
    return joined.withColumn("bin", slot - 1).groupBy(*keys, "bin").agg(
        F.sum("n_base").alias("n_base"), F.sum("n_cur").alias("n_cur"))


def psi_scores(counts: DataFrame, hist: DataFrame, keys) -> DataFrame:
    """PSI per group that has points in both periods; 0 when there are no bins."""
    keys = list(keys)
    groups = counts.groupBy(*keys).agg(
        F.sum("n_base").alias("base_points"), F.sum("n_cur").alias("cur_points"))
    # At most `bins` rows per group.
    whole = Window.partitionBy(*keys)

    def ratio(name: str) -> Column:
        total = F.greatest(F.sum(name).over(whole), F.lit(1))
        return F.greatest(F.col(name) / total, F.lit(RATIO_FLOOR))

    terms = hist.select(*keys, ratio("n_base").alias("_b"), ratio("n_cur").alias("_c"))
    psi = terms.groupBy(*keys).agg(
        F.sum((F.col("_c") - F.col("_b")) * F.ln(F.col("_c") / F.col("_b"))).alias("psi"))
    both = groups.filter("base_points > 0 AND cur_points > 0")
    scored = both.join(psi, keys, "left").withColumn("psi", F.coalesce("psi", F.lit(0.0)))
    return scored.withColumn("is_significant", F.col("psi") > PSI_LIMIT)


def psi(
    counts: DataFrame, keys, bins: int = PSI_BINS, open_ended: bool = False,
    store: Store | None = None,
) -> DataFrame:
    """PSI per group from `value_counts`, best stored first as it is read three times.
    `store` also keeps the cell bounds and cut points, so that their true size picks the join."""
    cuts = psi_cuts(counts, keys, bins, store=store)
    cuts = store(cuts) if store else cuts
    return psi_scores(counts, psi_hist(counts, cuts, keys, open_ended), keys)


def psi_updates(scores: DataFrame, keys) -> DataFrame:
    """Groups whose drift is significant, with the fence factor to use."""
    return scores.filter("is_significant").select(*keys, F.lit(IQR_K).alias("iqr_k"), "psi")


def drift_params(
    counts: DataFrame, history: DataFrame, as_of: Column, keys: tuple[str, ...] = SEASON_KEYS,
    min_points: int = PSI_MIN_POINTS, bins: int = PSI_BINS, store: Store | None = None,
) -> DataFrame:
    """New parameters for drifted groups with enough points in both periods.

    Mean and deviation of the current period also come from the value counts:
    first the weighted mean, then the squared distances from it.
    """
    keys = list(keys)
    drifted = psi(counts, keys, bins, store=store).filter(
        F.col("is_significant")
        & (F.col("base_points") >= min_points) & (F.col("cur_points") >= min_points))
    totals = counts.filter("n_cur > 0").groupBy(*keys).agg(
        (F.sum(F.col("value") * F.col("n_cur")) / F.sum("n_cur")).alias("baseline_mean"))
    totals = store(totals) if store else totals
    distance = F.col("value") - F.col("baseline_mean")
    moments = attach(counts.filter("n_cur > 0"), totals, keys, "inner").groupBy(*keys).agg(
        F.max("baseline_mean").alias("baseline_mean"),
        F.coalesce(
            F.sqrt(F.try_divide(F.sum(distance * distance * F.col("n_cur")), F.sum("n_cur") - 1)),
            F.lit(0.0),
        ).alias("baseline_std"))
    previous = latest_params(history, tuple(keys)).select(*keys, "iqr_k", "isolation_score_threshold")
    rules = C.rules_json(source="psi_drift_detector", psi=F.round("psi", 6))
    return (
        drifted.join(moments, keys).join(previous, keys, "left")
        .select(
            *keys, "baseline_mean", "baseline_std",
            F.coalesce("iqr_k", F.lit(IQR_K)).alias("iqr_k"),
            F.coalesce("isolation_score_threshold", F.lit(ISOLATION_THRESHOLD))
            .alias("isolation_score_threshold"),
            rules.alias("distilled_rules"),
            as_of.alias("valid_from"),
            F.lit(FAR_FUTURE).cast("timestamp").alias("valid_until"),
            "psi",
        )
    )
