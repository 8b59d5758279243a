"""Rows that break a table's file order are found, and written tables have none."""
from pyspark.sql import functions as F

from telemark.schema import struct
from telemark.session import scratch
from telemark.sinks import tables as SK

TABLE = "silver_interface_stats"


def silver(spark, devices):
    rows = spark.createDataFrame([(d,) for d in devices], "device_id string").coalesce(1)
    return SK.align(rows, struct(TABLE)).withColumn("_partition_date", F.lit("2024-01-01").cast("date"))


def test_misplaced_rows_are_found(spark):
    path = scratch(spark, "unsorted")
    silver(spark, ["b", "a", None, "c"]).write.parquet(path)
    wrong = SK.out_of_order(spark.read.parquet(path), TABLE).select("device_id").collect()
    assert sorted(str(r[0]) for r in wrong) == ["None", "a"]


def test_micro_batches_are_sorted(spark):
    path = scratch(spark, "sorted")
    for batch_id in (0, 1, 1):
        SK.write_micro_batch(silver(spark, ["b", "a", None, "c", "a"]), batch_id, path, ["_partition_date"], TABLE)
    stored = spark.read.parquet(path)
    assert stored.count() == 10
    assert SK.out_of_order(stored, TABLE).isEmpty()
