"""Telemetry-shaped frames derived from the driver's tables.

`events` become interface samples and syslogs, `customer` and `nation` the
device inventory. Faults follow from the `k` field each event carries, so every
row of the table takes part. Nothing is generated at random.
"""
from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark.functions import columns as C
from telemark.operators import parse as P
from telemark.operators import route as RT
from telemark.operators import score as S
from telemark.operators.versions import latest_inventory
from telemark.plans import baseline as B
from telemark.plans import gold as G
from telemark.session import scratch, tune

STATS_TOPIC = "raw.interface-stats"
SYSLOG_TOPIC = "raw.syslogs"
INVENTORY_TOPIC = "raw.inventory"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# Season slots dense enough on the test tables to have a spread.
DENSE_KEYS = ("site_id", "interface_name", "day_of_week")


def seq() -> Column:
    """The event a record came from, carried along as an unknown payload key."""
    return F.col("_extra_cols")["seq"].cast("bigint").alias("seq")


def payload_seq() -> Column:
    return P.json_field("raw_payload", "seq").cast("bigint").alias("seq")


def event_base(events: DataFrame) -> DataFrame:
    """`events` with its time as an instant and the `k` of its properties."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id", ts.alias("event_ts"), F.col("user_id").cast("string").alias("user_key"),
        "event_type", "value",
        C.once(F.get_json_object("props", "$.k").try_cast("int")).alias("k"),
    )


def stats_from_events(events: DataFrame) -> DataFrame:
    k = F.col("k")
    garbled = k == 93
    iso = F.date_format("event_ts", ISO)

    def unless_garbled(col: Column) -> Column:
        return F.when(~garbled, col)

    return event_base(events).select(
        "event_id",
        unless_garbled(F.when(k == 94, "x").otherwise(iso)).alias("ts"),
        unless_garbled(F.when(k != 97, F.col("user_key"))).alias("device_id"),
        unless_garbled(F.col("event_type")).alias("interface_name"),
        unless_garbled(
            F.when(k == 98, -1.0).when(k == 95, F.lit(float("nan"))).otherwise(F.col("value"))
        ).alias("util_in"),
        unless_garbled(k.cast("double")).alias("util_out"),
        unless_garbled(1 + k % 2).cast("int").alias("admin_status"),
        unless_garbled(
            F.when(k == 92, 9999).when(k == 99, 9).when(k < 10, 2).when(k < 20, 3).otherwise(1)
        ).cast("int").alias("oper_status"),
        F.create_map(F.lit("seq"), F.col("event_id").cast("string")).alias("_extra_cols"),
        (F.col("event_ts") + F.expr("INTERVAL 30 SECONDS")).alias("_ingested_at"),
        F.lit(STATS_TOPIC).alias("_source_topic"),
    )


def stats_payloads(events: DataFrame) -> DataFrame:
    """The same records as message text, faults included."""
    k = F.col("k")
    iso = F.when(k == 94, "x").otherwise(F.date_format("event_ts", ISO))

    def quoted(col: Column) -> Column:
        return F.concat(F.lit('"'), col, F.lit('"'))

    value = F.col("value").cast("string")
    util_in = (
        F.when(k == 98, "-1").when(k == 95, '"NaN"').when(k == 96, quoted(value)).otherwise(value)
    )
    oper = (
        F.when(k == 92, '"9999.9"').when(k == 99, "9").when(k < 10, "2").when(k < 20, "3")
        .otherwise("1")
    )
    body = F.concat(
        F.lit('{"ts":"'), iso,
        F.lit('","device_id":'), F.when(k == 97, "null").otherwise(quoted(F.col("user_key"))),
        F.lit(',"interface_name":"'), F.col("event_type"),
        F.lit('","util_in":'), util_in,
        F.lit(',"util_out":'), k.cast("string"),
        F.lit(',"admin_status":'), (1 + k % 2).cast("string"),
        F.lit(',"oper_status":'), oper,
        F.lit(',"seq":'), F.col("event_id").cast("string"),
        F.lit("}"),
    )
    garbled = F.concat(F.lit("garbled "), F.col("event_id").cast("string"))
    return event_base(events).select(
        "event_id",
        F.when(k == 93, garbled).otherwise(body).alias("payload"),
        F.lit(STATS_TOPIC).alias("source_topic"),
        (F.col("event_ts") + F.expr("INTERVAL 30 SECONDS")).alias("_ingested_at"),
    )


def syslogs_from_events(events: DataFrame) -> DataFrame:
    k = F.col("k")
    return event_base(events).filter(F.col("event_type") == "error").select(
        "event_id",
        F.when(k == 94, "x").otherwise(F.date_format("event_ts", ISO)).alias("ts"),
        F.when(k != 97, F.col("user_key")).alias("device_id"),
        (k % 9).cast("int").alias("severity"),
        F.concat(F.lit("code "), k.cast("string")).alias("message"),
        (F.col("event_ts") + F.expr("INTERVAL 30 SECONDS")).alias("_ingested_at"),
        F.lit(SYSLOG_TOPIC).alias("_source_topic"),
    )


def syslog_payloads(events: DataFrame) -> DataFrame:
    rows = syslogs_from_events(events)
    text = F.to_json(F.struct("ts", "device_id", F.col("severity").cast("string").alias("severity"), "message"))
    return rows.select(
        "event_id", text.alias("payload"), F.col("_source_topic").alias("source_topic"),
        "_ingested_at")


def all_devices(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Every customer as a device; some of them without a site."""
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    no_site = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") > 8000)
    return joined.select(
        F.col("c_custkey").cast("string").alias("device_id"),
        F.when(~no_site, F.col("n_name")).alias("site_id"),
        F.col("c_mktsegment").alias("vendor"),
        F.when(F.col("c_acctbal") > 5000, "core").otherwise("edge").alias("role"),
        F.col("c_acctbal").alias("balance"),
    )


class Tables:
    """Lazily built frames over one directory of the driver's tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = tune(spark)
        self.dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def stored(self, df: DataFrame, label: str = "stored") -> DataFrame:
        """A dimension as the table it is in operation: written once, read by all
        its users, and of a size that is known from its files."""
        path = scratch(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    @cached_property
    def latest(self) -> datetime:
        """The time of the latest event, which is "now" for all jobs and reports."""
        micros = self.events.agg(F.unix_micros(F.max(F.col("ts").cast("timestamp")))).first()[0]
        return EPOCH + timedelta(microseconds=micros or 0)

    @property
    def as_of(self) -> Column:
        return F.lit(self.latest).cast("timestamp")

    @cached_property
    def stats(self) -> DataFrame:
        """Raw interface samples, as a bronze table holds them."""
        return stats_from_events(self.events)

    @cached_property
    def syslogs(self) -> DataFrame:
        return syslogs_from_events(self.events)

    @cached_property
    def devices(self) -> DataFrame:
        return all_devices(self.read("customer"), self.read("nation"))

    @cached_property
    def inventory(self) -> DataFrame:
        """Devices known from the start: those with a balance that is not negative."""
        return self.stored(self.devices.filter("balance >= 0").drop("balance"), "inventory")

    @cached_property
    def inventory_history(self) -> DataFrame:
        """Append-only inventory: a first listing without role, then corrections."""
        at = F.lit("2024-01-01 00:00:00").cast("timestamp")
        first = self.devices.filter("balance >= 0").select(
            "device_id", "site_id", "vendor", F.lit("unset").alias("role"), at.alias("_ingested_at"))
        later = self.devices.select(
            "device_id", "site_id", "vendor", "role",
            (at + F.expr("INTERVAL 1 DAY")).alias("_ingested_at"))
        return first.unionByName(later)

    @cached_property
    def late_inventory(self) -> DataFrame:
        """Current inventory once every device is listed."""
        latest = latest_inventory(self.inventory_history).drop("_ingested_at")
        return self.stored(latest, "late-inventory")

    @cached_property
    def new_devices(self) -> DataFrame:
        return self.devices.filter("balance < 0").drop("balance")

    @cached_property
    def derived(self) -> DataFrame:
        return P.derive_stats(self.stats)

    @cached_property
    def routed(self) -> DataFrame:
        return RT.route_stats(self.derived, self.inventory)

    @cached_property
    def enriched(self) -> DataFrame:
        return RT.only(self.routed, RT.ENRICHED)

    @cached_property
    def routed_syslogs(self) -> DataFrame:
        return RT.route_syslogs(P.derive_syslogs(self.syslogs), self.inventory)

    @cached_property
    def silver_syslogs(self) -> DataFrame:
        return RT.only(self.routed_syslogs, RT.ENRICHED)

    @cached_property
    def params(self) -> DataFrame:
        """Dense-slot baselines of all enriched readings that are not saturated."""
        quiet = self.enriched.filter(~C.saturated())
        return self.stored(B.baselines(quiet, DENSE_KEYS), "params")

    @cached_property
    def scored(self) -> DataFrame:
        return S.score_ingest(self.enriched, self.params, DENSE_KEYS)

    @cached_property
    def payloads(self) -> DataFrame:
        return stats_payloads(self.events)

    @cached_property
    def routed_payloads(self) -> DataFrame:
        return RT.route_stats(P.parse_stats(self.payloads), self.inventory)

    @cached_property
    def dlq(self) -> DataFrame:
        """Quarantine: invalid samples, and parked ones given up as orphans."""
        routed = self.routed_payloads
        reason = F.when(F.col("route") == "INVALID", F.col("validation_reason")).when(
            (F.col("route") == "PENDING") & (F.col("util_out") >= 50), "ORPHANED_DEVICE")
        return P.to_silver_dlq(
            routed.withColumn("_reason", reason).filter(F.col("_reason").isNotNull()),
            reason="_reason", at=F.col("_ingested_at"))

    @cached_property
    def pending(self) -> DataFrame:
        rows = RT.only(self.routed_payloads, RT.PENDING)
        return P.to_silver_pending(
            rows, at=F.col("_ingested_at"), retries=F.col("util_out").cast("int") % 4)

    @cached_property
    def health_history(self) -> DataFrame:
        return G.site_health(self.enriched, self.silver_syslogs, self.as_of)

    @cached_property
    def health(self) -> DataFrame:
        return G.with_score(self.health_history)

    @cached_property
    def flag_windows(self) -> DataFrame:
        return G.anomaly_windows(self.scored, "1 day", 1, ("event_id",))


def present(df: DataFrame) -> DataFrame:
    """Result frame for comparison: instants without zone, doubles to 6 places
    (a hair upwards, so that exact ties do not hang on the last bit of a sum)."""
    out = []
    for f in df.schema.fields:
        col, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        if kind == "timestamp":
            col = col.cast("timestamp_ntz")
        elif kind in ("double", "float"):
            col = F.round(col.cast("double") + 1e-9, 6)
        out.append(col.alias(f.name))
    return df.select(*out)
