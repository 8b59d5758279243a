"""Replay of parked and quarantined records. Closing is by resolution log:
rows are never changed in place, a log row with their key closes them, and a
second run finds nothing left to do."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemark.functions import rules as R
from telemark.operators import parse as P
from telemark.operators.joins import attach, enrich
from telemark.operators.route import ENRICHED, PENDING, only, route_stats, validate_stats
from telemark.operators.score import score_ingest
from telemark.schema import SEASON_KEYS
from telemark.sinks.tables import delete_matched

PROMOTED, PERMANENT, RETRY = "PROMOTED_TO_SILVER", "PERMANENT", "RETRY"
PENDING_LOG = "record_key string, raw_payload string, device_id string, resolution string"
DLQ_LOG = (
    "record_key string, raw_payload string, source_topic string, quarantine_resolution string, "
    "reprocessed_at timestamp")

# Fixed decision per quarantine reason. Reasons not listed are permanent.
ACTIONS = {
    "ORPHANED_DEVICE": "RECHECK",
    "STALE_TIMESTAMP": "RECHECK",
    "NULL_FIELD": PERMANENT,
    "NEGATIVE_UTIL": PERMANENT,
    "EXCEEDS_MAX": PERMANENT,
    "INVALID_STATUS": PERMANENT,
    "INVALID_TIMESTAMP": PERMANENT,
    "FUTURE_TIMESTAMP": PERMANENT,
}
MAX_RETRIES = 3
# Replays of a stream write to the silver table under batch ids from here on.
REPLAY_BATCH = 10**12


def record_key(at: str) -> Column:
    """What a log row names the record it closes by: topic, payload and time of arrival,
    NULLs included. The same text sent again, or to another topic, is another record."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
             for c in ("source_topic", "raw_payload", at)]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def parked(pending: DataFrame) -> DataFrame:
    return pending.withColumn("record_key", record_key("parked_at"))


def action_for(reason: str = "quarantine_reason") -> Column:
    pairs = [F.lit(x) for item in ACTIONS.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[F.col(reason)], F.lit(PERMANENT))


def open_dlq(dlq: DataFrame) -> DataFrame:
    return dlq.filter(~F.col("reprocessed"))


def open_pending(pending: DataFrame) -> DataFrame:
    return pending.filter(~F.col("enriched"))


def with_device(dlq: DataFrame) -> DataFrame:
    return dlq.withColumn("device_id", P.json_field("raw_payload", "device_id"))


def dlq_fixable(dlq: DataFrame, inventory: DataFrame) -> DataFrame:
    """Open quarantined rows whose device is now known; no fan-out."""
    known = inventory.select("device_id").dropna().distinct()
    return attach(with_device(dlq), known, "device_id", "left_semi")


def dlq_permanent(dlq: DataFrame, inventory: DataFrame) -> DataFrame:
    known = inventory.select("device_id").dropna().distinct()
    return attach(with_device(dlq), known, "device_id", "left_anti")


@dataclass
class Replay:
    """What a replay writes: silver rows, log rows that close originals, and
    new quarantine rows."""

    silver: DataFrame
    log: DataFrame
    quarantine: DataFrame | None = None
    retry: DataFrame | None = None


def decide_dlq(dlq: DataFrame, inventory: DataFrame, by_reason: bool = True) -> DataFrame:
    """Every open row, re-parsed, re-validated, enriched and with its resolution.

    A row is promoted when its reason allows a recheck (or always, when
    `by_reason` is off), its device is known, and it now passes validation.
    One plan decides both outcomes, so no row can be both or neither.
    """
    rows = open_dlq(dlq).select(
        "raw_payload", "quarantine_reason", "source_topic", "quarantined_at")
    parsed = P.parse_stats(rows.withColumn("_ingested_at", F.col("quarantined_at")), "raw_payload")
    checked = validate_stats(enrich(parsed, inventory))
    allowed = (action_for() == "RECHECK") if by_reason else F.lit(True)
    passes = F.col("validation_reason").isNull() & F.col("site_id").isNotNull()
    return checked.withColumn(
        "resolution", F.when(allowed & passes, PROMOTED).otherwise(PERMANENT))


def resolution_log(decided: DataFrame, at: Column | None = None) -> DataFrame:
    at = F.current_timestamp() if at is None else at
    return decided.select(
        record_key("quarantined_at").alias("record_key"), "raw_payload", "source_topic",
        F.col("resolution").alias("quarantine_resolution"),
        at.alias("reprocessed_at"),
    )


def replay_dlq(
    dlq: DataFrame, inventory: DataFrame, params: DataFrame, by_reason: bool = True,
    keys: tuple[str, ...] = SEASON_KEYS, at: Column | None = None,
) -> Replay:
    decided = decide_dlq(dlq, inventory, by_reason)
    promoted = decided.filter(F.col("resolution") == PROMOTED)
    return Replay(
        silver=P.to_silver_stats(score_ingest(promoted, params, keys)),
        log=resolution_log(decided, at),
    )


def dlq_state(dlq: DataFrame, log: DataFrame) -> DataFrame:
    """Quarantine with the outcome of reprocessing, as readers see it."""
    closed = log.groupBy("record_key").agg(
        F.max(F.struct("reprocessed_at", "quarantine_resolution")).alias("_l"))
    rows = dlq.drop("reprocessed", "reprocessed_at", "quarantine_resolution").withColumn(
        "record_key", record_key("quarantined_at"))
    return attach(rows, closed, "record_key", salts=1).select(
        "raw_payload", "quarantine_reason", "source_topic", "quarantined_at",
        F.col("_l").isNotNull().alias("reprocessed"),
        F.col("_l.reprocessed_at").alias("reprocessed_at"),
        F.col("_l.quarantine_resolution").alias("quarantine_resolution"),
        "_partition_date",
    )


def for_devices(pending: DataFrame, devices: DataFrame) -> DataFrame:
    """Parked rows of the devices that just arrived, without collecting their ids."""
    wanted = devices.select("device_id").dropna().distinct()
    return attach(pending, wanted, "device_id", "left_semi")


def promote_pending(pending: DataFrame, inventory: DataFrame) -> DataFrame:
    """Parked rows whose device now has a site, re-parsed and enriched."""
    known = inventory.filter(F.col("site_id").isNotNull()).select(
        "device_id", "site_id", "vendor", "role")
    ready = attach(open_pending(pending), known, "device_id", "inner")
    return P.parse_stats(
        ready.withColumnRenamed("device_id", "_device").withColumn("_ingested_at", F.col("parked_at")),
        "raw_payload",
    ).drop("_device")


def replay_pending(
    pending: DataFrame, inventory: DataFrame, params: DataFrame,
    keys: tuple[str, ...] = SEASON_KEYS, max_retries: int = MAX_RETRIES, at: Column | None = None,
) -> Replay:
    """Promote what can be promoted; count a retry for the rest, and quarantine
    as orphaned what has been retried often enough."""
    at_col = F.current_timestamp() if at is None else at
    known = inventory.filter(F.col("site_id").isNotNull())
    promoted = promote_pending(pending, inventory)
    left = attach(open_pending(pending), known.select("device_id"), "device_id", "left_anti")
    tried = left.withColumn("retry_count", F.col("retry_count") + 1)
    given_up = orphaned(tried, max_retries)
    closed = parked(promoted).select(
        "record_key", "raw_payload", "source_topic", F.lit(PROMOTED).alias("resolution"))
    log = closed.unionByName(parked(given_up).select(
        "record_key", "raw_payload", "source_topic", F.lit("ORPHANED_DEVICE").alias("resolution")))
    return Replay(
        silver=P.to_silver_stats(score_ingest(promoted, params, keys)),
        log=log.withColumn("enriched_at", at_col),
        quarantine=P.to_silver_dlq(
            given_up.withColumn("validation_reason", F.lit("ORPHANED_DEVICE")), "raw_payload",
            at=at_col),
        retry=tried.filter(F.col("retry_count") < max_retries),
    )


def orphaned(pending: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    return pending.filter(F.col("retry_count") >= max_retries)


def still_open(pending: DataFrame, log: DataFrame) -> DataFrame:
    """Parked rows after a replay: those no log row closes."""
    return delete_matched(
        parked(open_pending(pending)), log.select("record_key").distinct(), ["record_key"]).drop("record_key")


def silver_batch(
    bronze: DataFrame, inventory: DataFrame, params: DataFrame,
    keys: tuple[str, ...] = SEASON_KEYS, extra: list[R.Rule] | None = None,
) -> DataFrame:
    """Bronze to scored silver: the same derive, route and score steps as the stream."""
    routed = route_stats(P.derive_stats(bronze), inventory, extra)
    return P.to_silver_stats(score_ingest(only(routed, ENRICHED), params, keys))


def silver_routes(
    bronze: DataFrame, inventory: DataFrame, params: DataFrame,
    keys: tuple[str, ...] = SEASON_KEYS, extra: list[R.Rule] | None = None, at: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All three routes of a bronze batch: scored silver, quarantine and parking.
    Every row goes to exactly one of them. A row is invalid by its own reading, so
    quarantine is found without the inventory."""
    derived = P.derive_stats(bronze)
    routed = route_stats(derived, inventory, extra)
    invalid = validate_stats(derived, extra).filter(F.col("validation_reason").isNotNull())
    at = F.col("_ingested_at") if at is None else at
    return (
        P.to_silver_stats(score_ingest(only(routed, ENRICHED), params, keys)),
        P.to_silver_dlq(invalid, "_raw_payload", topic="_source_topic", at=at),
        P.to_silver_pending(only(routed, PENDING), "_raw_payload", "_source_topic", at=at),
    )


def with_retries(pending: DataFrame, log: DataFrame) -> DataFrame:
    """Parked rows no log row closes, with the retries the log counts for them."""
    closing = log.filter(F.col("resolution") != RETRY)
    tries = log.filter(F.col("resolution") == RETRY).groupBy("record_key").agg(
        F.count("*").cast("int").alias("_tries"))
    left = attach(parked(still_open(pending, closing)), tries, "record_key", salts=1)
    more = F.col("retry_count") + F.coalesce("_tries", F.lit(0))
    return left.withColumn("retry_count", more).drop("_tries", "record_key")
