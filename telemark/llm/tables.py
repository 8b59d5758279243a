"""Intermediate tables in the shared folder, and joins by checked size."""
from __future__ import annotations

import os
import shutil
import site
import tempfile

from pyspark.sql import DataFrame, SparkSession

from telemark.operators.joins import attach
from telemark.session import scratch


def stored(df: DataFrame, label: str, group_rows: int | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives
    the loss of executors, and gives the planner its true size. Spark decodes up to 4096 rows
    of a row group at once: for rows with long arrays `group_rows` limits those of a group."""
    spark = df.sparkSession
    path = scratch(spark, label)
    writer = df.write.option("parquet.block.row.count.limit", group_rows) if group_rows else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def restrict(df: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Rows of a large frame whose key is (not) in a stored table of distinct keys:
    broadcast within the checked bound, else a shuffle join whose hot partitions
    adaptive execution splits."""
    return attach(df, keys.select(on), on, how, salts=1)


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers when it is run from a source folder
    that neither PYTHONPATH nor the working directory names: send it along as a zip."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd(), *site.getsitepackages()]
    if root in map(os.path.abspath, known) or spark.conf.get("spark.telemark.shipped", None):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="spark-", dir="/tmp"), "telemark")
    spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", root, "telemark"))
    spark.conf.set("spark.telemark.shipped", "true")
