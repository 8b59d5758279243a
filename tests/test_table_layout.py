"""Columns that appear later, and compaction of closed days, on stored tables."""
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampType

from telemark.plans.jobs import Jobs
from telemark.schema import PARTITIONS, struct
from telemark.session import scratch
from telemark.sinks import compact as C
from telemark.sinks import layouts as L
from telemark.sinks import tables as SK
from telemark.streaming.bronze import promote

DECLARED = StructType().add("device_id", StringType()).add("_ingested_at", TimestampType())
ROWS = "device_id string, v int, _partition_date date"


def test_later_columns_are_read_back(spark):
    path = scratch(spark, "evolving")
    batches = [
        ("device_id string", [("a",)]),
        ("device_id string, `packet loss` double", [("b", 1.5), ("c", None)]),
        ("device_id string, `PACKET LOSS` string, ingested_ts timestamp", [("d", "2.5", None), ("e", "x", None)]),
        ("device_id string, tags array<struct<k:string,v:int>>", [("f", [("x", 1)])]),
        ("device_id string", []),
    ]
    for i, (layout, rows) in enumerate(batches):
        L.write_evolving(spark.createDataFrame(rows, layout), i, path, DECLARED)
        L.write_evolving(spark.createDataFrame(rows, layout), i, path, DECLARED)     # delivered again
    version, layout = L.newest_layout(spark, path)
    assert version == 2
    assert layout.names == ["device_id", "_ingested_at", "packet loss", "tags"]
    table = L.read_evolving(spark, path)
    got = {r["device_id"]: (r["packet loss"], r["batch_id"]) for r in table.collect()}
    assert got == {"a": (None, 0), "b": (1.5, 1), "c": (None, 1), "d": (2.5, 2), "e": (None, 2), "f": (None, 3)}
    assert table.filter("device_id = 'f'").first()["tags"][0]["v"] == 1


def test_a_table_never_written_has_no_layout(spark):
    with pytest.raises(ValueError):
        L.read_evolving(spark, scratch(spark, "evolving"))


def test_promoted_keys_leave_the_map_unless_unreadable(spark):
    rows = [({"loss": "1.5", "x": "y"},), ({"loss": "bad"},), ({},), (None,)]
    got = promote(spark.createDataFrame(rows, "_extra_cols map<string,string>"), {"loss": "double"}).collect()
    assert [(r["loss"], r["_extra_cols"]) for r in got] == [
        (1.5, {"x": "y"}), (None, {"loss": "bad"}), (None, {}), (None, None)]


def day(n):
    return date(2024, 1, n)


def put(spark, path, batch_id, rows):
    frame = spark.createDataFrame([(d, v, n and day(n)) for d, v, n in rows], ROWS)
    SK.write_micro_batch(frame, batch_id, path, ["_partition_date"])


def compact(spark, path, before):
    return C.compact(spark, path, ROWS, ["_partition_date"], before)


def values(spark, path):
    return sorted(r["v"] for r in C.read_compacted(spark, path, ROWS, ["_partition_date"]).collect())


def test_every_row_once_through_runs_late_rows_and_replacements(spark):
    path, replay = scratch(spark, "compacted"), C.RANGES[1][0]
    assert compact(spark, path, day(9)) is None and values(spark, path) == []
    put(spark, path, 0, [("a", 1, 1), ("a", 2, 2), ("b", 3, None)])
    put(spark, path, 1, [("a", 4, 1), ("b", 5, 3)])
    put(spark, path, 2, [("a", 6, 1)])
    put(spark, path, replay, [("r", 7, 1)])
    put(spark, path, replay + 1, [("r", 8, 3)])
    put(spark, path, -20240101, [("job", 9, 1)])
    first = compact(spark, path, day(3))
    assert (first.run, first.upto) == (0, (1, replay))
    assert values(spark, path) == list(range(1, 10))
    runs = spark.read.parquet(f"{path}-compacted")
    assert sorted(r["v"] for r in runs.collect()) == [1, 2, 4, 7]
    # The newest batch and those of jobs may still be replaced.
    put(spark, path, 2, [("a", 60, 1)])
    put(spark, path, -20240101, [("job", 90, 1)])
    assert values(spark, path) == [1, 2, 3, 4, 5, 7, 8, 60, 90]
    # Late rows for closed days, a day that closed since, and an earlier day asked for.
    put(spark, path, 3, [("late", 10, 1)])
    put(spark, path, 4, [("new", 11, 4)])
    assert compact(spark, path, day(4)).run == 1
    assert compact(spark, path, day(2)).run == 1        # nothing new
    assert values(spark, path) == [1, 2, 3, 4, 5, 7, 8, 10, 11, 60, 90]
    whole = C.covered_batches(spark, path, ROWS, ["_partition_date"])
    assert {r[0] for r in whole.collect()} == {1, 2, 3, replay}     # 0 has a row without a day


def test_a_run_without_mark_is_ignored_and_written_anew(spark):
    path = scratch(spark, "compacted")
    for i in range(3):
        put(spark, path, i, [("a", i, 1)])
    junk = spark.createDataFrame([("junk", 99, 0, day(1))], "device_id string, v int, batch_id bigint, _partition_date date")
    junk.write.partitionBy("_partition_date").parquet(f"{path}-compacted/run=0")
    assert values(spark, path) == [0, 1, 2]
    compact(spark, path, day(2))
    assert values(spark, path) == [0, 1, 2]
    assert "junk" not in str(spark.read.parquet(f"{path}-compacted").collect())


def test_runs_are_sorted_and_covered_directories_are_not_read(spark):
    path, table, parts = scratch(spark, "compacted"), "silver_interface_stats", ["_partition_date"]
    layout = "device_id string, device_ts timestamp, interface_name string, _partition_date date"
    for i in range(4):
        frame = spark.createDataFrame([(d, None, "e0", day(1)) for d in ("c", "a", "b")], layout)
        SK.write_micro_batch(frame, i, path, parts)
    C.compact(spark, path, layout, parts, day(2), table)
    assert SK.out_of_order(spark.read.parquet(f"{path}-compacted"), table).isEmpty()
    read = C.read_compacted(spark, path, layout, parts)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") >= 2 and plan.count("batch_id") > 2
    files = read.select(F.input_file_name().alias("f")).distinct().collect()
    assert sorted({r["f"].split(path)[1].split("/_partition")[0] for r in files}) == ["-compacted/run=0", "/batch_id=3"]


def test_jobs_read_a_compacted_table_whole(spark):
    table, root = "silver_dlq_quarantine", scratch(spark, "jobs")
    plain = Jobs(spark, root, datetime(2024, 1, 9, 12))
    jobs = Jobs(spark, root, datetime(2024, 1, 9, 12), compacted=frozenset({table}))
    for i in range(3):
        rows = spark.createDataFrame([(f"{i}-{n}", day(n)) for n in (5, 7, 8, 9)], "raw_payload string, _partition_date date")
        SK.write_micro_batch(SK.align(rows, struct(table)), i, f"{root}/{table}", PARTITIONS[table], table)
    jobs.compact()
    runs = spark.read.parquet(f"{root}/{table}-compacted")
    assert {r["_partition_date"] for r in runs.collect()} == {day(5), day(7)}
    assert runs.count() == 4

    def content(of):
        return sorted((r["raw_payload"], r["batch_id"]) for r in of.batches(table).collect())

    assert content(jobs) == content(plain) and len(content(jobs)) == 12
