"""Nightly and weekly jobs over the tables below one root.

Every job writes to the directory of its run, so that running it again for the same day
replaces its output; a backfill writes to directories of its source days. Streams use
batch ids from 0 up, jobs negative ones.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark.operators.aggregates import hourly_features
from telemark.operators.flatline import flat_windows, to_flatline_flags
from telemark.operators.parse import season_keys
from telemark.operators.versions import latest_inventory
from telemark.plans import baseline as B
from telemark.plans import forest as IF
from telemark.plans import gold as G
from telemark.plans import reprocess as RP
from telemark.plans import validation as VA
from telemark.schema import PARTITIONS, SEASON_KEYS, TABLES, ddl, struct
from telemark.sinks.compact import compact, read_compacted
from telemark.sinks.tables import align, overwrite_touched, read_batches, write_micro_batch

GATE = ("candidate_precision double, candidate_recall double, current_precision double, current_recall double, "
        "promoted boolean")


def struct_names(layout: str) -> list[str]:
    return [c.split()[0] for c in layout.split(", ")]


LOGS = {"model_gates": f"version string, {GATE}", "dlq_log": RP.DLQ_LOG, "pending_log": RP.PENDING_LOG, "replays_seen": "upto bigint"}


# A backfilled day's batch in every table: far from those of streams and of dated runs.
BACKFILL_BATCH = -(10**12)
BACKFILLED = ("silver_interface_stats", "silver_dlq_quarantine", "silver_pending_enrichment")


def backfill_batch(day: date) -> int:
    return BACKFILL_BATCH - int(day.strftime("%Y%m%d"))


@dataclass
class Jobs:
    spark: SparkSession
    root: str
    as_of: datetime
    keys: tuple[str, ...] = SEASON_KEYS
    partitions: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(PARTITIONS))
    # Tables that `compact` looks after; they are read from its runs as far as these go.
    compacted: frozenset[str] = frozenset()

    @property
    def run(self) -> int:
        return -int(self.as_of.strftime("%Y%m%d"))

    def now(self):
        return F.lit(self.as_of).cast("timestamp")

    def version(self, step: int):
        """The `valid_from` of a weekly step: later steps win over earlier ones of a run."""
        return F.lit(self.as_of + timedelta(seconds=step)).cast("timestamp")

    def batches(self, table: str) -> DataFrame:
        schema = LOGS.get(table) or ddl(table)
        read = read_compacted if table in self.compacted else read_batches
        return read(self.spark, f"{self.root}/{table}", schema, self.partitions.get(table, ()))

    def read(self, table: str) -> DataFrame:
        return self.batches(table).drop("batch_id")

    def read_before(self, table: str) -> DataFrame:
        """A table without what an earlier attempt of this very run wrote to it."""
        ours = F.col("batch_id").between(self.run * 10 - 9, self.run * 10)
        return self.batches(table).filter(~ours).drop("batch_id")

    def write(self, df: DataFrame, table: str, step: int = 0) -> None:
        """`step` keeps two jobs of one run that write the same table apart."""
        shaped = align(df, struct(table)) if table in TABLES else df
        write_micro_batch(
            shaped, self.run * 10 - step, f"{self.root}/{table}", self.partitions.get(table, ()), table)

    def inventory(self) -> DataFrame:
        return latest_inventory(self.read("bronze_inventory"))

    def params(self) -> DataFrame:
        return B.latest_params(self.read("device_baseline_params"))

    def compact(self, open_days: int = 2) -> None:
        """Days that ended before the last `open_days` are rewritten in the `compacted` tables."""
        closed_before = self.as_of.date() - timedelta(days=open_days - 1)
        for table in sorted(self.compacted):
            compact(self.spark, f"{self.root}/{table}", ddl(table), self.partitions.get(table, ()), closed_before, table)

    # -- nightly ------------------------------------------------------------------

    def replay_dlq(self) -> None:
        state = RP.dlq_state(self.read_before("silver_dlq_quarantine"), self.read_before("dlq_log"))
        replay = RP.replay_dlq(state, self.inventory(), self.params(), keys=self.keys, at=self.now())
        self.write(replay.silver, "silver_interface_stats", 1)
        self.write(replay.log.distinct(), "dlq_log")

    def replay_pending(self) -> None:
        waiting = RP.with_retries(self.read("silver_pending_enrichment"), self.read_before("pending_log"))
        replay = RP.replay_pending(
            waiting, self.inventory(), self.params(), self.keys, at=self.now())
        self.write(replay.silver, "silver_interface_stats", 2)
        self.write(replay.quarantine, "silver_dlq_quarantine", 2)
        retried = RP.parked(replay.retry).select(
            "record_key", "raw_payload", "device_id", F.lit(RP.RETRY).alias("resolution"))
        closed = replay.log.select(
            "record_key", "raw_payload", F.lit(None).cast("string").alias("device_id"), "resolution")
        self.write(closed.unionByName(retried).distinct(), "pending_log")

    def replayed_upto(self) -> int | None:
        """The latest batch that a stream's replay has written to silver by now."""
        return self.batches("silver_interface_stats").filter(
            F.col("batch_id") >= RP.REPLAY_BATCH).agg(F.max("batch_id")).first()[0]

    def promoted(self, upto: int | None = None) -> DataFrame:
        """Silver rows that replays added: those of this run, and of the streams since the
        last run, up to a batch if one is given."""
        ours = F.col("batch_id").isin(self.run * 10 - 1, self.run * 10 - 2)
        seen = self.read_before("replays_seen").agg(F.max("upto")).first()[0]
        streamed = F.col("batch_id") >= (RP.REPLAY_BATCH if seen is None else seen + 1)
        if upto is not None:
            streamed = streamed & (F.col("batch_id") <= upto)
        return self.batches("silver_interface_stats").filter(ours | streamed).drop("batch_id")

    def backfill(self, since: datetime, until: datetime, sites: list[str] | None = None) -> None:
        """Bronze readings of a span of days (and of some sites) through the stream's steps
        into silver, quarantine and parking.

        What is written is known by the day its readings came in, not by the day of the run:
        each source day has a batch of its own in every table and is replaced as a whole, so
        spans may follow, overlap and repeat each other on any days. With `sites`, the days'
        silver rows of other sites are kept; invalid and unknown devices have no site, so
        quarantine and parking of the days are replaced in full.
        """
        first, last = since.date(), until.date()
        bronze = self.read("bronze_interface_stats").filter(F.col("_partition_date").between(F.lit(first), F.lit(last)))
        keep = self.keep("backfill")
        routes = RP.silver_routes(bronze, keep(self.inventory(), "inventory"), keep(self.params(), "params"), self.keys)
        for df, table, came in zip(routes, BACKFILLED, ("_ingested_at", "quarantined_at", "parked_at")):
            parts = ["batch_id", *self.partitions.get(table, ())]
            day = F.date_format(came, "yyyyMMdd").cast("bigint")
            fresh = align(df, struct(table)).withColumn("batch_id", F.lit(BACKFILL_BATCH) - day)
            span = F.col("batch_id").between(backfill_batch(last), backfill_batch(first))
            old = self.batches(table).filter(span)
            if sites and table == BACKFILLED[0]:
                asked = F.coalesce(F.col("site_id").isin(sites), F.lit(False))
                fresh = fresh.filter(asked)
                if "site_id" in parts:      # other sites have directories of their own
                    old = old.filter(asked)
                else:                       # kept before the days are overwritten
                    others = old.filter(~asked).select(*fresh.columns)
                    fresh = fresh.unionByName(keep(others, f"{table}-others"))
            file = F.col("_metadata.file_path").alias("file")
            before = keep(old.select(file).distinct(), f"{table}-before")
            overwrite_touched(fresh, f"{self.root}/{table}", parts)
            # Directories, not rows: a file that is still there is of one that got no rows.
            left = self.batches(table).filter(span).select(file).distinct().join(before, "file", "left_semi")
            for r in left.select(F.regexp_replace("file", "/[^/]*$", "")).distinct().collect():
                fresh.drop(*parts).limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(unquote(r[0]))

    def note_replays(self, upto: int | None) -> None:
        """Remember up to which stream replay gold is refreshed."""
        if upto is not None:
            self.write(self.spark.createDataFrame([(upto,)], LOGS["replays_seen"]), "replays_seen")

    def refresh_gold(self, all_hours: bool = False) -> None:
        """Health of the last 25 whole hours and of older touched ones (or of all hours),
        and anomaly windows of the last day. Flat windows count once they are closed."""
        # Fixed once: a replay that lands during the refresh is left for the next run.
        upto = self.replayed_upto()
        stats, logs = self.read("silver_interface_stats"), self.read("silver_syslogs")
        if all_hours:
            health = G.site_health(stats, logs, self.now())
        else:
            health = G.site_health_recent(stats, logs, self.promoted(upto), self.now(), self.keep("touched"))
        self.write(health, "gold_site_health_hourly")
        recent = G.trailing(stats, self.now())
        flat = to_flatline_flags(flat_windows(G.closed_windows(stats, self.as_of)), F.col("w.end"))
        bursts = G.syslog_bursts(G.trailing(logs, self.now()))
        self.write(G.all_anomalies(G.anomaly_windows(recent), flat, bursts), "gold_anomaly_flags")
        self.note_replays(upto)

    def keep(self, label: str):
        """A store for small intermediate tables of this run."""
        def store(df: DataFrame, part: str = "all") -> DataFrame:
            path = f"{self.root}/_{label}/run={self.run}/part={part}"
            df.write.mode("overwrite").parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)
        return store

    def detect_and_validate(self, model: str) -> None:
        """Forest verdicts of the last day next to the ingest flags."""
        forest = IF.live(self.spark, model)
        if forest is None:
            raise ValueError(f"no live model in {model}")
        recent = G.trailing(self.read("silver_interface_stats"), self.now())
        hits = IF.detect(hourly_features(recent), forest)
        self.write(hits, "gold_anomaly_flags", 1)
        # Read back what was written: the forest scores each hour once.
        hits = self.batches("gold_anomaly_flags").filter(F.col("batch_id") == self.run * 10 - 1)
        flagged = hits.select(*VA.KEYS, F.lit(1).alias("batch_flagged"))
        self.write(
            VA.validate_decisions(VA.ingest_hours(recent), flagged, self.now()), "anomaly_validation")

    def nightly(self, model: str | None = None) -> None:
        self.replay_dlq()
        self.replay_pending()
        self.refresh_gold()
        if model:
            self.detect_and_validate(model)

    # -- weekly -------------------------------------------------------------------

    def normal(self) -> DataFrame:
        return B.confirmed_normal(self.read("silver_interface_stats"), self.now())

    def refresh_baselines(self) -> None:
        self.write(B.refresh_params(self.normal(), self.version(0)), "device_baseline_params", 1)

    def recent_truth(self) -> DataFrame:
        """Hourly features of the last seven days, with 1 where ingest flagged the hour."""
        recent = G.trailing(self.read("silver_interface_stats"), self.now(), 24 * 7)
        truth = recent.groupBy("device_id", "interface_name", F.date_trunc("hour", "device_ts").alias("window_start")).agg(
            F.max(F.col("ingest_anomaly").cast("int")).alias("truth"))
        return hourly_features(recent).dropna(subset=list(IF.FEATURES)).join(truth, list(IF.ROW_KEYS))

    def train_forest(self, model: str) -> bool:
        """Train a candidate into a version of its own. It goes live, and its rules to the
        parameters, only if it is at least as good as the live model on the last seven days
        (or there is none yet); either way the comparison is noted in `model_gates`."""
        path = f"{self.root}/features/run={self.run}"
        hourly_features(self.normal()).dropna(subset=list(IF.FEATURES)).write.mode("overwrite").parquet(path)
        features = self.spark.read.parquet(path)
        forest, version = IF.train(features), f"version={-self.run}"
        forest.save(self.spark, f"{model}/{version}")
        current = IF.live(self.spark, model)
        if current is None:
            noted = self.spark.createDataFrame([(None,) * 4 + (True,)], GATE)
        else:
            noted = IF.gate(self.recent_truth(), forest, current)
        self.write(noted.select(F.lit(version).alias("version"), *struct_names(GATE)), "model_gates")
        promoted = self.batches("model_gates").filter(F.col("batch_id") == self.run * 10).first()["promoted"]
        if promoted:
            rules = IF.rules_text(IF.distill(IF.label(IF.score(features, forest), forest)))
            published = IF.fan_out(features, B.baselines(self.normal()), rules, self.version(1))
            self.write(published, "device_baseline_params", 2)
            IF.publish(self.spark, model, version, self.run, self.now())
        return promoted

    def detect_drift(self) -> None:
        path = f"{self.root}/value_counts/run={self.run}"
        split = season_keys(B.split_periods(self.normal(), self.now()))
        B.value_counts(split, SEASON_KEYS).write.mode("overwrite").parquet(path)
        counts = self.spark.read.parquet(path)
        history = self.read_before("device_baseline_params")
        self.write(B.drift_params(counts, history, self.version(2)), "device_baseline_params", 3)

    def weekly(self, model: str) -> None:
        self.refresh_baselines()
        self.train_forest(model)
        self.detect_drift()
