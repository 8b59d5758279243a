"""Newest-row-per-key, as an aggregate so that hot keys combine map-side."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the one greatest in `order` (columns compared in turn).

    `max_by` over a struct keeps the row's columns together and is combined
    before the shuffle; no task ever sorts all versions of a hot key.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def latest_inventory(history: DataFrame) -> DataFrame:
    """Current inventory from append-only history: last write wins per device."""
    known = history.dropna(subset=["device_id"])
    return latest_by_key(known, ["device_id"], ["_ingested_at", "site_id", "vendor", "role"])


def dedup_last_wins(df: DataFrame, keys, arrival: str | Column) -> DataFrame:
    """Last arrived record per key; a NULL key part counts as empty text."""
    keys = list(keys)
    arrival = F.col(arrival) if isinstance(arrival, str) else arrival
    names = [f"_k{i}" for i in range(len(keys))]
    norm = {n: F.coalesce(F.col(k).cast("string"), F.lit("")) for n, k in zip(names, keys)}
    newest = F.max_by(F.struct(*df.columns), arrival).alias("_row")
    return df.withColumns(norm).groupBy(*names).agg(newest).select("_row.*")


def distinct_keys(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).distinct()
