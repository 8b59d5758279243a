"""Continuous raw-to-bronze ingest of the three feeds."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemark.functions.columns import as_whole
from telemark.operators import parse as P
from telemark.schema import PARTITIONS, struct
from telemark.sinks.layouts import evolving_sink
from telemark.sinks.tables import align, micro_batch_sink

TRIGGER = "30 seconds"


def _typed_syslogs(df: DataFrame) -> DataFrame:
    return df.withColumn("severity", as_whole(F.col("severity")))


FEEDS: dict[str, tuple[tuple[str, ...], Callable[[DataFrame], DataFrame]]] = {
    "bronze_interface_stats": (P.STATS_FIELDS, P.type_stats),
    "bronze_syslogs": (P.SYSLOG_FIELDS, _typed_syslogs),
    "bronze_inventory": (P.INVENTORY_FIELDS, lambda df: df),
}


def promote(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Keys of `_extra_cols` as columns of their own (name to type), taken out of the map.

    Text that is no value of the type gives NULL, and then stays in the map."""
    taken = {n: F.try_element_at("_extra_cols", F.lit(n)).try_cast(t) for n, t in fields.items()}
    out = df.withColumns(taken)

    def stays(key: Column, _: Column) -> Column:
        read = F.lit(False)
        for name in fields:
            read = read | ((key == F.lit(name)) & F.col(name).isNotNull())
        return ~read

    return out.withColumn("_extra_cols", F.map_filter("_extra_cols", stays)) if fields else out


def to_bronze(messages: DataFrame, table: str, at: Column | None = None) -> DataFrame:
    """Messages in a bronze table's layout: raw text, parsed fields, unknown keys."""
    fields, typed = FEEDS[table]
    parsed = typed(P.unpack(messages, fields, "payload"))
    tagged = P.with_ingest_meta(parsed, F.col("source_topic"), at)
    return align(tagged.withColumnRenamed("payload", "_raw_payload"), struct(table))


def start_bronze(
    messages: DataFrame, table: str, path: str, checkpoint: str, at: Column | None = None,
    once: bool = False, extra: dict[str, str] | None = None,
) -> StreamingQuery:
    """Every micro-batch goes to its own directory, so a retry cannot duplicate it.

    With `extra` (name to type, may be empty) the table's layout is versioned: those keys
    of the messages become columns, which widen the layout when they first appear. Such a
    table is read by `layouts.read_evolving`.
    """
    parts = PARTITIONS.get(table, ())
    if extra is None:
        sink = micro_batch_sink(path, lambda df: to_bronze(df, table, at), parts)
    else:
        sink = evolving_sink(
            path, struct(table), lambda df: promote(to_bronze(df, table, at), extra), parts)
    writer = messages.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)
    return writer.start()
