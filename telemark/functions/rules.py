"""Validation rules: ordered (code, failing condition) pairs."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def any_null(*names: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])


def either(names: tuple[str, ...], test) -> Column:
    return reduce(lambda a, b: a | b, [test(F.col(n)) for n in names])


# Fixed rule order: the first failing code is the one reported.
def stats_rules() -> list[Rule]:
    utils = ("util_in", "util_out")
    return [
        ("NULL_FIELD", any_null("ts", "device_id", "interface_name", *utils, "oper_status")),
        ("NEGATIVE_UTIL", either(utils, lambda c: c < 0)),
        ("EXCEEDS_MAX", either(utils, lambda c: c > 100)),
        ("INVALID_STATUS", ~F.col("oper_status").isin(1, 2, 3)),
        ("INVALID_TIMESTAMP", F.col("device_ts").isNull()),
    ]


def syslog_rules() -> list[Rule]:
    return [
        ("NULL_FIELD", any_null("ts", "device_id")),
        ("INVALID_TIMESTAMP", F.col("device_ts").isNull()),
        ("INVALID_SEVERITY", F.col("severity").isNull() | ~F.col("severity").between(0, 7)),
    ]


def time_rules(ts: str = "device_ts", ingested: str = "_ingested_at", hours: int = 24) -> list[Rule]:
    """Optional: event time too far from the time of ingest."""
    span = F.expr(f"INTERVAL {hours} HOURS")
    return [
        ("STALE_TIMESTAMP", F.col(ts) < F.col(ingested) - span),
        ("FUTURE_TIMESTAMP", F.col(ts) > F.col(ingested) + span),
    ]


def admin_rules() -> list[Rule]:
    """Optional: admin status must be up or down when given."""
    return [("INVALID_ADMIN_STATUS", ~F.col("admin_status").isin(1, 2))]


def first_failure(rules: list[Rule]) -> Column:
    """Code of the first rule that fails; NULL when the row is valid."""
    (code, failing), *rest = rules
    out = F.when(failing, F.lit(code))
    for code, failing in rest:
        out = out.when(failing, F.lit(code))
    return out
