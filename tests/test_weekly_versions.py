"""Weekly parameter versions follow the event times."""
from datetime import datetime
from types import SimpleNamespace

from telemark.registry.joins import weekly_versions


def test_weeks_of_any_month_get_a_version(spark):
    rows = [("s", "i", datetime(2023, 12, 27), 1.0), ("s", "i", datetime(2024, 1, 3), 2.0), ("s", "i", datetime(2025, 6, 4), 3.0)]
    frame = spark.createDataFrame(rows, "site_id string, interface_name string, device_ts timestamp, effective_util_in double")
    _, got = weekly_versions(SimpleNamespace(spark=spark, enriched=frame))
    assert sorted((str(r.valid_from), r.baseline_mean) for r in got.collect()) == [
        ("2024-01-01 00:00:00", 1.0), ("2024-01-08 00:00:00", 2.0), ("2025-06-09 00:00:00", 3.0)]
