"""Batch sources: Parquet tables, CSV, JSON lines, views and ad-hoc SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INVENTORY_CSV = "device_id string, site_id string, vendor string, role string"


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str = INVENTORY_CSV) -> DataFrame:
    """CSV with header; columns by explicit schema, so no second pass infers types."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def read_jsonl(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """JSON lines as raw payload text, to be parsed like any other message."""
    return spark.read.text(path).select(
        F.col("value").alias("payload"), F.lit(topic).alias("source_topic"))


def register_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Ad-hoc SQL over registered views; frames given by name are bound to this call only."""
    return spark.sql(text, **views) if views else spark.sql(text)


def run_sql_counted(spark: SparkSession, text: str, **views: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows and, as a second frame, how many there are."""
    rows = run_sql(spark, text, **views)
    return rows, rows.agg(F.count("*").alias("row_count"))


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Reproducible sample, taken where the rows are read."""
    if fraction >= 1.0:
        return df
    return df.sample(fraction=fraction, seed=seed)


def cap_rows(df: DataFrame, max_rows: int = 0) -> DataFrame:
    """At most `max_rows` rows; 0 switches the cap off."""
    return df.limit(max_rows) if max_rows > 0 else df
