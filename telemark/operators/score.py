"""Ingest-time scoring against seasonal baselines."""
from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from telemark.functions import columns as C
from telemark.operators.joins import Store, attach, attach_baseline
from telemark.operators.parse import season_keys
from telemark.operators.rolling import trailing_quantiles
from telemark.schema import SEASON_KEYS

BASELINE_DDL = (
    "device_id string, interface_name string, hour_of_day int, day_of_week int, "
    "baseline_mean double, baseline_std double, iqr_k double, isolation_score_threshold double"
)


def empty_baseline(spark: SparkSession) -> DataFrame:
    """Typed empty parameter table: only the threshold flag can fire against it."""
    return spark.createDataFrame([], BASELINE_DDL)


def add_scores(df: DataFrame) -> DataFrame:
    """Scores and flags from attached baseline columns, which are then dropped."""
    scored = df.withColumns({
        "ingest_z_score": C.z_score("effective_util_in", "baseline_mean", "baseline_std"),
        "ingest_iqr_score": C.iqr_score(
            "effective_util_in", "baseline_mean", "baseline_std", "iqr_k"),
    })
    flags = C.ingest_flags(C.saturated(), F.col("ingest_z_score"), F.col("ingest_iqr_score"))
    return (
        scored.withColumn("ingest_flags", flags)
        .withColumn("ingest_anomaly", F.size("ingest_flags") > 0)
        .drop("baseline_mean", "baseline_std", "iqr_k")
    )


def score_ingest(
    enriched: DataFrame, params: DataFrame, keys: tuple[str, ...] = SEASON_KEYS,
) -> DataFrame:
    """Annotate enriched rows; `params` must hold one row per season key."""
    keyed = season_keys(enriched)
    return add_scores(attach_baseline(keyed, params, keys)).drop("hour_of_day", "day_of_week")


def merge_flatline(
    scored: DataFrame, flat_keys: DataFrame, store: Store | None = None,
) -> DataFrame:
    """Add FLATLINE to the flags of every row of a flat (device, interface)."""
    keys = ["device_id", "interface_name"]
    marks = flat_keys.select(*keys).distinct().withColumn("_flat", F.lit(True))
    flat = F.coalesce(F.col("_flat"), F.lit(False))
    none = F.array().cast("array<string>")
    flags = F.coalesce(F.col("ingest_flags"), none)
    return (
        attach(scored, marks, keys, store=store)
        .withColumns({
            "ingest_flags": F.when(flat, F.array_union(flags, F.array(F.lit("FLATLINE"))))
            .otherwise(F.col("ingest_flags")),
            "ingest_anomaly": F.coalesce(F.col("ingest_anomaly"), F.lit(False)) | flat,
        })
        .drop("_flat")
    )


def rolling_iqr(
    stats: DataFrame, value: str = "effective_util_in", hours: int = 4,
    keys: tuple[str, ...] = ("device_id", "interface_name"), ts: str = "device_ts",
    buckets: int = 32,
) -> DataFrame:
    """First and third quartile of each row's trailing `hours`, exact.

    A row is owned by its own time slice and copied once into the next slice,
    where it can only serve as history. A window then needs (key, slice) rows
    only, so a hot series is spread over as many tasks as it has slices. The series
    of a slice go through Python in `buckets` groups, each in one pass; all columns
    travel with their rows, so select those that are needed.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    width = hours * 3_600_000_000
    # Rows without a time have no next slice: they would meet their own copies.
    copies = F.when(micros.isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    spread = stats.withColumns({
        "_t": micros, "_v": F.col(value).cast("double"), "_ahead": F.explode(copies),
    }).withColumns({
        "_slice": F.floor(F.col("_t") / F.lit(width)) + F.col("_ahead"),
        "_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)),
    })
    add = trailing_quantiles(list(keys), width, {"q1": 0.25, "q3": 0.75})
    layout = StructType([*stats.schema.fields, StructField("q1", DoubleType()), StructField("q3", DoubleType())])

    def owned(group: pa.Table) -> pa.Table:
        done = add(group)
        return done.filter(pc.equal(done["_ahead"], 0)).select(layout.names)

    return spread.groupBy("_slice", "_bucket").applyInArrow(owned, layout)
