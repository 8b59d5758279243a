"""The current inventory as a snapshot that each micro-batch carries forward.

Reading the whole inventory history in every micro-batch would cost more with every day.
The newest row per device is an associative aggregate, so the snapshot of the batch before
and the rows that arrived are enough: what a micro-batch reads grows with the number of
devices, never with the history.

Two slots take turns. A batch reads the newest snapshot of an earlier batch and writes to
the other slot, so a batch that failed half way, or is delivered again, finds the same
snapshot as the first time and replaces only what it wrote itself.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark.operators.versions import latest_inventory
from telemark.schema import ddl
from telemark.sinks.tables import write

CURRENT = "inventory_current"
LAYOUT = f"{ddl('bronze_inventory')}, slot int, as_of_batch bigint"
SLOTS = 2


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots in the slots; none as long as nothing was written."""
    write(spark.createDataFrame([], ddl("bronze_inventory")), f"{path}/slot=-1/as_of_batch=-1", "ignore")
    return spark.read.schema(LAYOUT).parquet(path)


def newest_snapshot(spark: SparkSession, path: str, before: int | None = None) -> tuple[int, int] | None:
    """(slot, batch) of the newest snapshot, of a batch below `before` if one is given.

    An aggregate of directory names: no column of the snapshots is read.
    """
    slots = _stored(spark, path).filter("slot >= 0")
    if before is not None:
        slots = slots.filter(F.col("as_of_batch") < before)
    newest = slots.agg(F.max(F.struct("as_of_batch", "slot")).alias("s")).first()["s"]
    return None if newest is None else (newest["slot"], newest["as_of_batch"])


def _snapshot(spark: SparkSession, path: str, slot: int, batch_id: int) -> DataFrame:
    return spark.read.schema(ddl("bronze_inventory")).parquet(f"{path}/slot={slot}/as_of_batch={batch_id}")


def advance(
    spark: SparkSession, path: str, arrived: DataFrame, batch_id: int,
    history: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """Merge a micro-batch's rows into the snapshot; returns the inventory after it.

    Where there is no snapshot yet, `history` gives the rows to begin with, once. Rows
    without a device stay out; if there are none but such rows, the inventory is empty.
    """
    known = newest_snapshot(spark, path, batch_id)
    if known is not None:
        arrived = _snapshot(spark, path, *known).unionByName(arrived)
    elif history is not None:
        arrived = history().unionByName(arrived)
    slot = 0 if known is None else (known[0] + 1) % SLOTS
    # Static: the slot's older snapshot, and an earlier attempt of this batch, go.
    current = latest_inventory(arrived).withColumn("as_of_batch", F.lit(batch_id).cast("bigint"))
    (current.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("as_of_batch").parquet(f"{path}/slot={slot}"))
    return current_inventory(spark, path)


def current_inventory(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot: one row per device."""
    newest = newest_snapshot(spark, path)
    if newest is None:
        return spark.createDataFrame([], ddl("bronze_inventory"))
    return _snapshot(spark, path, *newest)
