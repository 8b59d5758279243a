"""Micro-batches from messages to silver. Thin shells over the batch operators."""
from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemark.operators import aggregates as A
from telemark.operators import flatline as FL
from telemark.operators import parse as P
from telemark.operators import route as RT
from telemark.operators.score import merge_flatline, score_ingest
from telemark.plans import reprocess as RP
from telemark.schema import PARTITIONS, SEASON_KEYS, ddl
from telemark.sinks.tables import read_batches, write_micro_batch
from telemark.streaming.bronze import to_bronze
from telemark.streaming.inventory import CURRENT, advance
from telemark.streaming.moments import flat_from_moments

BASELINE_TTL = 1800.0


@dataclass
class Refreshing:
    """A table read again once it is older than `ttl` seconds.

    Only the plan is kept, never the rows: a new read lists the files anew.
    """

    load: Callable[[], DataFrame]
    ttl: float = BASELINE_TTL
    clock: Callable[[], float] = time.monotonic
    reads: int = 0
    _frame: DataFrame | None = field(default=None, repr=False)
    _at: float = 0.0

    def __call__(self) -> DataFrame:
        now = self.clock()
        if self._frame is None or now - self._at >= self.ttl:
            self._frame, self._at = self.load(), now
            self.reads += 1
        return self._frame


@dataclass
class SilverJob:
    """Where the micro-batches read and write, and with which parameters."""

    root: str
    inventory: Callable[[], DataFrame]
    params: Callable[[], DataFrame]
    keys: tuple[str, ...] = SEASON_KEYS
    flat_points: int = 30
    flat_eps: float = 0.01
    ingest_time: Column | None = None
    # State of `moments.moments_stream` over up readings; without it a series is flat by
    # the readings of its own micro-batch.
    moments: Callable[[], DataFrame] | None = None
    partitions: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(PARTITIONS))

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _write(self, df: DataFrame, batch_id: int, table: str) -> None:
        write_micro_batch(df, batch_id, self.path(table), self.partitions.get(table, ()), table)

    def _staged(self, routed: DataFrame, stage: str) -> DataFrame:
        """The routed rows of a micro-batch as a table. Several writes read them; a cached
        partition would be read whole by one task, files are split by their size. The next
        micro-batch (or a retry) of the stage replaces the table."""
        path = self.path(f"_staged/{stage}")
        routed.write.mode("overwrite").parquet(path)
        return routed.sparkSession.read.schema(routed.schema).parquet(path)

    def _at(self) -> Column:
        return F.current_timestamp() if self.ingest_time is None else self.ingest_time

    def _score(self, enriched: DataFrame) -> DataFrame:
        scored = score_ingest(enriched, self.params(), self.keys)
        if self.moments is None:
            flat = FL.flat_series(scored, min_points=self.flat_points, eps=self.flat_eps)
        else:
            flat = flat_from_moments(self.moments(), self.flat_points, self.flat_eps)
        return merge_flatline(scored, flat)

    def interface_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Route, score, mark flat series, write silver, quarantine, parking and counts.

        The routed rows feed all of these, so they are written once for the batch.
        """
        if batch.isEmpty():
            return
        parsed = P.parse_stats(batch.withColumn("_ingested_at", self._at()))
        routed = self._staged(RT.route_stats(parsed, self.inventory()), "interface_stats")
        scored = self._score(RT.only(routed, RT.ENRICHED))
        self._write(P.to_silver_stats(scored), batch_id, "silver_interface_stats")
        self._write(P.to_silver_dlq(RT.only(routed, RT.INVALID), at=F.col("_ingested_at")),
                    batch_id, "silver_dlq_quarantine")
        self._write(P.to_silver_pending(RT.only(routed, RT.PENDING), at=F.col("_ingested_at")),
                    batch_id, "silver_pending_enrichment")
        counts = RT.route_counts(routed, "source_topic")
        self._write(counts, batch_id, "metrics_routes")
        silver = batch.sparkSession.read.parquet(
            f"{self.path('silver_interface_stats')}/batch_id={batch_id}")
        self._write(A.flag_counts(silver), batch_id, "metrics_flags")
        self._write(A.site_now(silver), batch_id, "metrics_sites")

    def syslog_batch(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        parsed = P.parse_syslogs(batch.withColumn("_ingested_at", self._at()))
        routed = self._staged(RT.route_syslogs(parsed, self.inventory()), "syslogs")
        self._write(P.to_silver_syslogs(RT.only(routed, RT.ENRICHED)), batch_id, "silver_syslogs")
        self._write(P.to_silver_dlq(RT.only(routed, RT.INVALID), at=F.col("_ingested_at")),
                    batch_id, "syslog_dlq_quarantine")
        self._write(P.to_silver_pending(RT.only(routed, RT.PENDING), at=F.col("_ingested_at")),
                    batch_id, "syslog_pending_enrichment")

    def inventory_batch(self, batch: DataFrame, batch_id: int) -> None:
        """New inventory: keep it, then replay the parked rows of its devices.

        The devices are never collected: open parked rows are semi joined with
        them. Replayed rows and the log that closes them go to directories of
        this batch; a retry first ignores what it wrote before.
        """
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        self._write(to_bronze(batch, "bronze_inventory", self._at()), batch_id, "bronze_inventory")
        arrived = self._arrived(spark, batch_id)
        inventory = advance(
            spark, self.path(CURRENT), arrived, batch_id, lambda: self._earlier(spark, batch_id))
        pending = self._read("silver_pending_enrichment", ddl("silver_pending_enrichment"), spark)
        closed = self._read("pending_log", RP.PENDING_LOG, spark).filter(
            (F.col("resolution") != RP.RETRY) & (F.col("batch_id") < batch_id))
        waiting = RP.for_devices(RP.still_open(pending, closed), arrived)
        promoted = RP.promote_pending(waiting, inventory)
        # Into the silver table itself, under ids apart from those of the interface stream.
        self._write(P.to_silver_stats(self._score(promoted)), RP.REPLAY_BATCH + batch_id,
                    "silver_interface_stats")
        log = RP.parked(promoted).select(
            "record_key", "raw_payload", "device_id", F.lit(RP.PROMOTED).alias("resolution"))
        self._write(log.distinct(), batch_id, "pending_log")

    def _arrived(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The inventory rows of one micro-batch, from its own directory."""
        return spark.read.schema(ddl("bronze_inventory")).parquet(f"{self.path('bronze_inventory')}/batch_id={batch_id}")

    def _earlier(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The inventory rows of all micro-batches before one."""
        return self._read("bronze_inventory", ddl("bronze_inventory"), spark).filter(
            F.col("batch_id") < batch_id).drop("batch_id")

    def _timed(self, stage: str, handler: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """The handler, followed by one row about the batch in `metrics_batches`.

        A stage has a table directory of its own, as stages count their batches apart; a
        retried batch replaces its row.
        """
        def run(batch: DataFrame, batch_id: int) -> None:
            begin = time.monotonic()
            handler(batch, batch_id)
            seconds = time.monotonic() - begin
            row = batch.sparkSession.createDataFrame([(seconds,)], "seconds double")
            write_micro_batch(row, batch_id, f"{self.path('metrics_batches')}/stage={stage}")

        return run

    def batch_log(self, spark: SparkSession) -> DataFrame:
        """One row per micro-batch that ever ran: stage, batch_id, seconds."""
        return spark.read.schema("seconds double, stage string, batch_id bigint").parquet(
            self.path("metrics_batches"))

    def _read(self, table: str, schema: str, spark: SparkSession) -> DataFrame:
        return read_batches(spark, self.path(table), schema, self.partitions.get(table, ()))

    def start(self, messages: DataFrame, stage: str, once: bool = False) -> StreamingQuery:
        handler = {
            "interface_stats": self.interface_batch,
            "syslogs": self.syslog_batch,
            "inventory": self.inventory_batch,
        }[stage]
        writer = messages.writeStream.foreachBatch(self._timed(stage, handler)).option(
            "checkpointLocation", self.path(f"_checkpoints/{stage}"))
        return (writer.trigger(availableNow=True) if once else writer).start()
