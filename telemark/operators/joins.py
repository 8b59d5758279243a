"""Joins of large facts with smaller tables, safe against hot keys."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

# A side is broadcast only when Catalyst's size estimate is below this bound. For
# stored tables the estimate is the size of their compressed files, several times
# less than the rows take in memory, so the bound is well below what would fit.
BROADCAST_BYTES = 8 * 1024 * 1024
# Above the bound the fact side is spread over this many salts per key.
SALTS = 16
# All copies of a side of known size, one per salt, may take this much together.
COPIED_BYTES = SALTS * BROADCAST_BYTES

Store = Callable[[DataFrame], DataFrame]


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (upper bound for scans and projections)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return estimated_bytes(df) <= limit


def salts_for(small: DataFrame) -> int:
    """The fewer salts the larger a stored side is, so that its copies do not grow with it;
    with a single one adaptive execution splits a hot partition of the fact."""
    return max(1, min(SALTS, COPIED_BYTES // max(1, estimated_bytes(small))))


def planner_limit(df: DataFrame) -> int:
    """Up to which estimate Spark's planner broadcasts a side by itself."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def attach(
    fact: DataFrame, small: DataFrame, on: str | list[str], how: str = "left",
    limit: int = BROADCAST_BYTES, salts: int = SALTS, store: Store | None = None,
) -> DataFrame:
    """Join `small` (unique or few rows per key) to `fact`.

    Small side within the checked bound: broadcast, no shuffle of the fact.
    Otherwise a shuffle join on (key, salt): the salt is a hash of the fact
    row, so one hot key, NULL included, is spread over `salts` tasks, and the
    same row gets the same salt when a lost task is run again. Catalyst's estimate
    leaves out the copies per salt, and the planner would broadcast them through
    the driver; where it could, a hint keeps the join a shuffle. What is estimated
    larger and turns out small is left to adaptive execution.

    An aggregate is estimated as large as its input. `store` writes such a side
    as a table first, so that its true size decides. For two large sides pass
    `salts=1`: copying one of them per salt would cost more than it saves, and
    adaptive execution splits a hot partition of the fact on its own.
    """
    on = [on] if isinstance(on, str) else list(on)
    if store and not fits_broadcast(small, limit):
        small = store(small)
    if fits_broadcast(small, limit):
        return fact.join(F.broadcast(small), on, how)
    if how in ("left_semi", "left_anti"):
        small = small.select(*on).distinct()
    if salts <= 1:
        return fact.join(small, on, how)
    hashed = [f.name for f in fact.schema.fields if not isinstance(f.dataType, MapType)]
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int"))
    spread = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if fits_broadcast(small, salts * planner_limit(small)):
        spread = spread.hint("merge")
    return salted.join(spread, [*on, "_salt"], how).drop("_salt")


def enrich(fact: DataFrame, inventory: DataFrame) -> DataFrame:
    """Attach site, vendor and role by device; unknown devices stay with NULLs."""
    return attach(fact, inventory.select("device_id", "site_id", "vendor", "role"), "device_id")


def attach_baseline(
    stats: DataFrame, params: DataFrame,
    keys: tuple[str, ...] = ("device_id", "interface_name", "hour_of_day", "day_of_week"),
) -> DataFrame:
    """Attach mean, spread and fence factor of the row's season slot."""
    wanted = params.select(*keys, "baseline_mean", "baseline_std", "iqr_k")
    return attach(stats, wanted, list(keys))


def attach_baseline_asof(
    stats: DataFrame, params: DataFrame, keys: tuple[str, ...], ts: str = "device_ts", slice_hours: int = 24 * 7,
    store: Store | None = None,
) -> DataFrame:
    """Parameters valid at the time of each row: of the newest `valid_from` not after it
    among those whose `valid_until` is not before it.

    A merge in time: versions become changes of what is valid, changes and rows are put in
    one order per key, and each row takes the last change before it. Time is cut into
    slices; what is valid at the beginning of a slice is carried into it, so a hot key
    spreads over its slices. Rows without key or time get nothing. `store` writes the
    versions as a table first, as they are read several times.
    """
    values = ("baseline_mean", "baseline_std", "iqr_k")
    known = params.filter(" AND ".join(f"{c} IS NOT NULL" for c in (*keys, "valid_from")))
    versions = known.groupBy(*keys, "valid_from").agg(F.max(F.struct("valid_until", *values)).alias("_p")).select(
        *keys, "valid_from", F.col("_p.valid_until").alias("valid_until"), F.struct(*[F.col("_p")[c].alias(c) for c in values]).alias("_v"))
    versions = versions.filter("valid_from <= valid_until")
    versions = store(versions) if store else versions
    begins = versions.select(*keys, F.col("valid_from").alias("_t"), F.lit(0).alias("_order"), "_v")
    # When a version ends, the newest of those still valid counts again.
    ends = versions.select(*keys, F.col("valid_until").alias("_t")).distinct()
    left = ends.join(versions, list(keys), "left").groupBy(*keys, "_t").agg(F.max_by(
        "_v", F.when((F.col("valid_from") <= F.col("_t")) & (F.col("valid_until") > F.col("_t")), F.col("valid_from"))).alias("_v"))
    nothing = F.struct(*[F.lit(None).cast(versions.schema["_v"].dataType[c].dataType).alias(c) for c in values])
    changes = begins.unionByName(left.select(*keys, "_t", F.lit(2).alias("_order"), F.coalesce("_v", nothing).alias("_v")))

    def slice_of(t: str) -> Column:
        return F.floor(F.unix_micros(F.col(t).cast("timestamp")) / (slice_hours * 3_600_000_000))

    whole = F.col(ts).isNotNull()
    for c in keys:
        whole = whole & F.col(c).isNotNull()
    rows = stats.filter(whole).withColumns({"_t": F.col(ts), "_order": F.lit(1), "_slice": slice_of(ts)})
    changes = changes.withColumn("_slice", slice_of("_t"))
    newest = changes.groupBy(*keys, "_slice").agg(F.max_by("_v", F.struct("_t", "_order")).alias("_v"))
    touched = rows.select(*keys, "_slice").distinct().withColumn("_asked", F.lit(True))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.join(touched, [*keys, "_slice"], "full").withColumn(
        "_before", F.last("_v", ignorenulls=True).over(earlier)).filter("_asked AND _before IS NOT NULL").select(
        *keys, "_slice", F.lit(-1).alias("_order"), F.col("_before").alias("_v"))
    feed = rows.unionByName(changes, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    slices = Window.partitionBy(*keys, "_slice").orderBy(F.asc_nulls_first("_t"), "_order").rowsBetween(Window.unboundedPreceding, 0)
    done = feed.withColumn("_v", F.last("_v", ignorenulls=True).over(slices)).filter("_order = 1")
    out = done.select(*stats.columns, *[F.col("_v")[c].alias(c) for c in values])
    return out.unionByName(stats.filter(F.coalesce(~whole, F.lit(True))), allowMissingColumns=True)
