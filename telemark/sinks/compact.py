"""Compaction of closed days of a table of micro-batch directories.

Every micro-batch leaves at least one file in each partition it touches. A run rewrites the
rows of days that are over into `<path>-compacted/run=N/<partitions>`, sorted as declared,
whatever the number of batches they came in. Batch directories stay as they are; one mark,
written last, says up to which day and batch the runs hold everything. Readers take the
runs up to the mark, and from the batch directories only what it does not cover: both are
filters on partition columns with constants. A run that failed left no mark, and its
directory is written anew.

Both limits of a mark only ever grow, so a later run takes days that closed since and rows
that came late for older days, and no row twice.
"""
from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark.sinks.tables import gather, read_batches, sort_files

DAY = "_partition_date"
MARKS = "run int, before date, upto array<bigint>"
# Fixed ranges of batch ids that count up on their own: streams, and their replays. Batches
# of jobs are negative; they may be replaced by a later run and are never compacted.
RANGES = ((0, 10**12), (10**12, 2 * 10**12))


@dataclass(frozen=True)
class Mark:
    run: int
    before: date
    upto: tuple[int, ...]

    def covers(self) -> Column:
        batches = F.lit(False)
        for (low, _), upto in zip(RANGES, self.upto):
            batches = batches | F.col("batch_id").between(low, upto)
        # Rows without a day are never covered.
        return F.coalesce((F.col(DAY) < F.lit(self.before)) & batches, F.lit(False))


def _marks(spark: SparkSession, path: str) -> DataFrame:
    where = f"{path}-compacted-marks"
    spark.createDataFrame([], MARKS).write.mode("ignore").parquet(where)
    return spark.read.schema(MARKS).parquet(where)


def newest_mark(spark: SparkSession, path: str) -> Mark | None:
    row = _marks(spark, path).agg(F.max(F.struct("run", "before", "upto")).alias("m")).first()["m"]
    return None if row is None else Mark(row["run"], row["before"], tuple(row["upto"]))


def finished_batches(batches: DataFrame) -> tuple[int, ...]:
    """Per range the last batch that can no longer be delivered again: the one before the
    newest, as a stream begins a batch only after the one before is done."""
    newest = batches.agg(*[
        F.max(F.when((F.col("batch_id") >= low) & (F.col("batch_id") < high), F.col("batch_id"))) for low, high in RANGES
    ]).first()
    return tuple(low - 1 if n is None else n - 1 for (low, _), n in zip(RANGES, newest))


def compact(
    spark: SparkSession, path: str, schema: str, partitions: Iterable[str], closed_before: date, table: str = "",
) -> Mark | None:
    """Rewrite what lies before a day in finished batches and is in no run yet.

    Returns the mark now in force. Nothing is written when there is nothing new.
    """
    partitions = list(partitions)
    old = newest_mark(spark, path)
    batches = read_batches(spark, path, schema, partitions)
    upto = finished_batches(batches)
    new = Mark(0, closed_before, upto)
    if old:
        new = Mark(old.run + 1, max(old.before, closed_before), tuple(map(max, old.upto, upto)))
    fresh = batches.filter(new.covers())
    if old:
        fresh = fresh.filter(~old.covers())
    if fresh.isEmpty():
        return old
    (sort_files(gather(fresh, partitions), table, partitions).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(*partitions)
     .parquet(f"{path}-compacted/run={new.run}"))
    spark.createDataFrame([(new.run, new.before, list(new.upto))], MARKS).coalesce(1).write.mode("append").parquet(
        f"{path}-compacted-marks")
    return new


def read_compacted(spark: SparkSession, path: str, schema: str, partitions: Iterable[str]) -> DataFrame:
    """The whole table, each row once, with its `batch_id`: runs for what the mark covers,
    batch directories for the rest."""
    batches = read_batches(spark, path, schema, list(partitions))
    mark = newest_mark(spark, path)
    if mark is None:
        return batches
    runs = spark.read.schema(f"{schema}, batch_id bigint, run int").parquet(f"{path}-compacted")
    return batches.filter(~mark.covers()).unionByName(runs.filter(F.col("run") <= mark.run).drop("run"))


def covered_batches(spark: SparkSession, path: str, schema: str, partitions: Iterable[str]) -> DataFrame:
    """Batches all of whose rows are in runs; their directories may be deleted."""
    mark = newest_mark(spark, path)
    covered = F.lit(False) if mark is None else mark.covers()
    return read_batches(spark, path, schema, list(partitions)).groupBy("batch_id").agg(
        F.every(covered).alias("whole")).filter("whole").select("batch_id")
