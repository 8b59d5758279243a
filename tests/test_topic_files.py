"""Files of a topic, as the stream queries land them, grow in number and not in size."""
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from telemark.registry import streams as ST
from telemark.session import scratch

SAME = datetime(2024, 1, 30)


@pytest.mark.parametrize("batches", [1, 2])
def test_files_of_a_topic_hold_few_rows_even_of_one_time(spark, monkeypatch, batches):
    monkeypatch.setattr(ST, "FILE_ROWS", 100)
    messages = spark.range(2000).select(
        F.col("id").cast("string").alias("payload"), F.lit("t").alias("source_topic"),
        F.lit(SAME).alias("_ingested_at"))
    stream = ST.land(SimpleNamespace(spark=spark), messages, batches)
    path, batch_rows = scratch(spark, "seen"), []

    def sink(batch, batch_id):
        batch_rows.append(batch.count())
        batch.withColumn("file", F.input_file_name()).write.mode("append").parquet(path)

    stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{path}-checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    per_file = [r["count"] for r in spark.read.parquet(path).groupBy("file").count().collect()]
    assert sum(per_file) == 2000 and max(per_file) < 300
    assert len(batch_rows) == batches


def test_routed_rows_of_a_batch_are_files_and_replaced_by_the_next(spark, monkeypatch):
    from telemark.fixtures import Tables

    seen, counts = [], ST.SV.RT.route_counts

    def spy(routed, *args):
        seen.append((routed.is_cached, routed.count(), len(routed.inputFiles())))
        return counts(routed, *args)

    monkeypatch.setattr(ST.SV.RT, "route_counts", spy)
    run = ST.run_interface(Tables(spark, "/root/testdata/sf0.001"), batches=2)
    assert len(seen) == 2 and all(not cached and files for cached, _, files in seen)
    assert spark.read.parquet(run["job"].path("_staged/interface_stats")).count() == seen[-1][1]
    assert sum(n for _, n, _ in seen) == run["routes"].agg(F.sum("n")).first()[0]
