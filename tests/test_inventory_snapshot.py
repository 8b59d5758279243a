"""The inventory carried from batch to batch equals the newest rows of the whole history."""
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from telemark.operators.versions import latest_inventory
from telemark.schema import struct
from telemark.session import scratch
from telemark.sinks.tables import align
from telemark.streaming.inventory import advance, current_inventory, newest_snapshot

LAYOUT = "device_id string, site_id string, vendor string, role string, _ingested_at timestamp"
START = datetime(2024, 1, 1)


def arrival(spark, batch_id, devices=12):
    rows = [(f"d{(batch_id * 5 + i) % devices}", f"s{batch_id % 3}", None if i % 4 == 0 else f"v{batch_id}", "edge",
             START + timedelta(hours=batch_id - 2 * (i % 3))) for i in range(6)]
    rows += [(None, "lost", "v", "edge", START), rows[0], ("d0", f"tie{batch_id}", "v", "edge", START + timedelta(days=9))]
    return align(spark.createDataFrame(rows, LAYOUT), struct("bronze_inventory"))


def content(df):
    return sorted(map(str, df.select("device_id", "site_id", "vendor", "role", "_ingested_at").collect()))


def test_batches_carry_the_inventory(spark):
    path = scratch(spark, "inventory")
    assert current_inventory(spark, path).isEmpty()
    history = None
    for batch_id in (0, 1, 2, 2, 5, 6):            # one delivered twice, two batches empty
        rows = arrival(spark, batch_id)
        history = rows if history is None else history.unionByName(rows)
        got = advance(spark, path, rows, batch_id)
        assert content(got) == content(latest_inventory(history)), batch_id
        assert all("/slot=" in f for f in got.inputFiles())
    # Two snapshots at most are kept, however many batches ran.
    kept = {f.split("as_of_batch=")[1].split("/")[0] for f in spark.read.parquet(path).inputFiles()}
    assert kept == {"-1", "5", "6"}


def test_a_failed_batch_starts_from_the_same_snapshot(spark):
    path = scratch(spark, "inventory")
    first, second = arrival(spark, 0), arrival(spark, 1)
    advance(spark, path, first, 0)
    advance(spark, path, second.limit(2), 1)        # as if it had written half of its rows
    assert newest_snapshot(spark, path, 1) == (0, 0)
    got = advance(spark, path, second, 1)
    assert content(got) == content(latest_inventory(first.unionByName(second)))


def test_first_snapshot_begins_with_the_history(spark):
    path = scratch(spark, "inventory")
    old, new = arrival(spark, 3), arrival(spark, 4)
    got = advance(spark, path, new, 4, lambda: old)
    assert content(got) == content(latest_inventory(old.unionByName(new)))
    later = arrival(spark, 5)
    again = advance(spark, path, later, 5, lambda: 1 / 0)       # not asked for again
    assert content(again) == content(latest_inventory(old.unionByName(new).unionByName(later)))


def test_rows_without_a_device_leave_it_empty(spark):
    path = scratch(spark, "inventory")
    assert advance(spark, path, arrival(spark, 0).filter(F.col("device_id").isNull()), 0).isEmpty()
    assert content(advance(spark, path, arrival(spark, 1), 1)) == content(latest_inventory(arrival(spark, 1)))
