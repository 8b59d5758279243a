"""Versions of a table's columns, kept beside its batch directories.

A writer whose rows have columns that the newest version lacks adds a wider version before it
writes; readers take the newest version as their schema. Older files give NULL in newer
columns, and nobody merges file footers. Versions are written by the one stream that writes
the table, so they are not raced for.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from telemark.sinks.tables import ALIASES, align, write_micro_batch

VERSIONS = "position int, column string, type string"


def _versions(spark: SparkSession, path: str) -> DataFrame:
    where = f"{path}-layouts"
    spark.createDataFrame([], VERSIONS).write.mode("ignore").parquet(f"{where}/version=-1")
    return spark.read.schema(f"{VERSIONS}, version int").parquet(where)


def newest_layout(spark: SparkSession, path: str) -> tuple[int, StructType] | None:
    """Number and columns of the newest version; None before the first. As many rows reach
    the driver as the table has columns."""
    versions = _versions(spark, path)
    newest = versions.agg(F.max("version")).first()[0]
    if newest is None:
        return None
    columns = versions.filter(F.col("version") == newest).orderBy("position").collect()
    quoted = (c["column"].replace("`", "``") for c in columns)
    return newest, StructType.fromDDL(", ".join(f"`{q}` {c['type']}" for q, c in zip(quoted, columns)))


def unknown_fields(layout: StructType, incoming: StructType) -> list[StructField]:
    """Columns the layout has neither by name, in any case, nor by the alias of an older name."""
    known, given = ({n.lower() for n in s.names} for s in (layout, incoming))

    def named(name: str) -> bool:
        alias = ALIASES.get(name)
        return name.lower() in known or (alias is not None and alias in known and alias not in given)

    return [f for f in incoming.fields if not named(f.name)]


def widen(spark: SparkSession, path: str, incoming: StructType, declared: StructType) -> StructType:
    """The table's layout after rows of `incoming`; a new version only if they bring columns.

    The first version is `declared` and whatever the first rows add. A column keeps the type
    it came with first.
    """
    newest = newest_layout(spark, path)
    number, layout = newest if newest else (-1, declared)
    new = unknown_fields(layout, incoming)
    if newest and not new:
        return layout
    wider = StructType([*layout.fields, *new])
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(wider.fields)]
    # Overwritten, as an attempt that failed may have left the same version behind.
    (spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("overwrite")
     .parquet(f"{path}-layouts/version={number + 1}"))
    return wider


def write_evolving(
    df: DataFrame, batch_id: int, path: str, declared: StructType,
    partitions: Iterable[str] = (), table: str = "",
) -> None:
    """One micro-batch in the table's newest layout, widened first by columns it lacks."""
    layout = widen(df.sparkSession, path, df.schema, declared)
    spelled = {n.lower(): n for n in layout.names}
    named = df.withColumnsRenamed({c: spelled[c.lower()] for c in df.columns if c.lower() in spelled})
    write_micro_batch(align(named, layout), batch_id, path, partitions, table)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """The table under its newest layout, with the `batch_id` of each row."""
    newest = newest_layout(spark, path)
    if newest is None:
        raise ValueError(f"no layout was ever written for {path}")
    return spark.read.schema(newest[1].add("batch_id", LongType())).parquet(path)


def evolving_sink(
    path: str, declared: StructType, shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    partitions: Iterable[str] = (),
) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function that shapes and writes every non-empty batch."""
    partitions = tuple(partitions)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_evolving(shape(batch), batch_id, path, declared, partitions)

    return sink
