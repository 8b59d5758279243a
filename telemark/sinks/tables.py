"""Parquet table sinks: align, append, overwrite, evolve, versions, deletes."""
from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from telemark.operators.joins import attach
from telemark.schema import PARTITIONS, SORT_ORDER, struct

# Fixed column aliases between revisions of the table layouts.
ALIASES = {
    "_ingested_at": "ingested_ts",
    "ingested_ts": "_ingested_at",
    "util_in": "raw_util_in",
    "util_out": "raw_util_out",
    "raw_util_in": "util_in",
    "raw_util_out": "util_out",
    "_extra_cols": "extra_cols",
    "extra_cols": "_extra_cols",
}


def align(df: DataFrame, target: StructType) -> DataFrame:
    """Exactly the target's columns, in its order and types: by name, else by
    alias, else typed NULL."""
    out = []
    for field in target.fields:
        source = next((n for n in (field.name, ALIASES.get(field.name)) if n in df.columns), None)
        if source is None:
            col = F.lit(None).cast(field.dataType)
        elif df.schema[source].dataType == field.dataType:
            col = F.col(source)
        else:
            col = F.col(source).try_cast(field.dataType)
        out.append(col.alias(field.name))
    return df.select(*out)


def gather(df: DataFrame, partitions: Iterable[str]) -> DataFrame:
    """Bring the rows of a table partition together before they are written.

    Without it every task would leave a small file in every partition. Rebalance
    lets adaptive execution split a hot partition over several tasks and merge
    small ones, so file sizes follow the advisory size.
    """
    partitions = list(partitions)
    return df.hint("rebalance", *[F.col(p) for p in partitions]) if partitions else df


def sort_files(df: DataFrame, table: str, partitions: Iterable[str]) -> DataFrame:
    """Sort inside each task's partition values, as the files will be read."""
    order = SORT_ORDER.get(table)
    return df.sortWithinPartitions(*partitions, *order) if order else df


def out_of_order(files: DataFrame, table: str) -> DataFrame:
    """Rows of a stored table that stand behind a row they should precede, by file. Each
    file is one group, of the size files have."""
    key = F.struct(*SORT_ORDER[table])
    placed = files.withColumns({"_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.row_index")})
    before = F.lag(key).over(Window.partitionBy("_file").orderBy("_at"))
    return placed.withColumn("_before", before).filter(F.col("_before") > key).drop("_file", "_at", "_before")


def write(
    df: DataFrame, path: str, mode: str = "append", partitions: Iterable[str] = (),
) -> None:
    writer = df.write.mode(mode)
    partitions = list(partitions)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)


def append(
    df: DataFrame, path: str, table: str, partitions: Iterable[str] | None = None,
) -> None:
    """Append to a canonical table in its layout, partitioning and file order.

    `partitions` replaces the table's own partition columns, for installations
    too small to fill (site, day) directories.
    """
    parts = list(PARTITIONS.get(table, ()) if partitions is None else partitions)
    aligned = gather(align(df, struct(table)), parts)
    write(sort_files(aligned, table, parts), path, "append", parts)


def overwrite_touched(df: DataFrame, path: str, partitions: Iterable[str]) -> None:
    """Replace only the partitions that occur in `df`."""
    partitions = list(partitions)
    (gather(df, partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


def evolve(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Old and new rows under the union of their columns."""
    return target.unionByName(incoming, allowMissingColumns=True)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files were written with different column sets."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def append_rows(spark: SparkSession, rows: list[dict], path: str, table: str) -> None:
    """A handful of literal rows from the caller, e.g. manual parameters."""
    if rows:
        append(spark.createDataFrame(rows, schema=struct(table)), path, table)


def write_micro_batch(
    df: DataFrame, batch_id: int, path: str, partitions: Iterable[str] = (), table: str = "",
) -> None:
    """Write one micro-batch to its own directory; a retried batch replaces itself. Files of
    a `table` with a declared order are sorted by it."""
    partitions = list(partitions)
    (sort_files(gather(df, partitions), table, partitions).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*partitions).parquet(f"{path}/batch_id={batch_id}"))


def read_batches(
    spark: SparkSession, path: str, schema: str, partitions: Iterable[str] = (),
) -> DataFrame:
    """A table of batch directories; empty as long as nothing was written to it.

    The empty batch that makes an unwritten table readable is written once and
    then left alone, as other plans may be reading it.
    """
    (spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*partitions)
     .parquet(f"{path}/batch_id=-1"))
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(path)


def micro_batch_sink(
    path: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    partitions: Iterable[str] = (),
) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function that shapes and writes every non-empty batch."""
    partitions = tuple(partitions)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_micro_batch(shape(batch), batch_id, path, partitions)

    return sink


def upsert(df: DataFrame, path: str, table: str) -> None:
    """Versioned upsert: plain append. Readers take the newest row per key."""
    append(df, path, table)


def delete_matched(table: DataFrame, matched: DataFrame, keys: Iterable[str]) -> DataFrame:
    """The table without rows that have a match (NULL keys never match)."""
    keys = list(keys)
    return attach(table, matched.select(*keys), keys, "left_anti", salts=1)
