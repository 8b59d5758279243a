"""Filters, validation and routing (inventory section 2.4)."""
from pyspark.sql import functions as F

from telemark import fixtures as X
from telemark.functions import columns as C
from telemark.operators import flatline as FL
from telemark.operators import parse as P
from telemark.operators import route as RT
from telemark.plans import baseline as B
from telemark.plans import gold as G
from telemark.plans import reprocess as RP
from telemark.registry.base import query


@query("val_stats", "SELECT event_id, validation_reason FROM validated")
def _(t):
    return RT.validate_stats(t.derived).select("event_id", "validation_reason")


@query("val_syslogs", "SELECT event_id, validation_reason FROM validated_logs")
def _(t):
    return RT.validate_syslogs(P.derive_syslogs(t.syslogs)).select("event_id", "validation_reason")


@query("route_stats", """
    SELECT event_id, validation_reason, site_id, route,
           CASE WHEN route = 'PENDING' THEN CASE WHEN known THEN 'NO_SITE' ELSE 'UNKNOWN_DEVICE' END END
               AS pending_reason
    FROM routed""")
def _(t):
    return t.routed.select("event_id", "validation_reason", "site_id", "route", "pending_reason")


@query("route_syslogs", "SELECT event_id, validation_reason, site_id, route FROM routed_logs")
def _(t):
    return t.routed_syslogs.select("event_id", "validation_reason", "site_id", "route")


@query("val_contract", """
    SELECT event_id, CASE WHEN k IN (93, 97) THEN 'MISSING_KEY'
                          WHEN k = 92 THEN 'BAD_NUMBER' END AS failure FROM ev""")
def _(t):
    text = P.unpack(t.payloads, P.STATS_FIELDS, "payload")
    return text.select("event_id", RT.contract_failure("interface_stats").alias("failure"))


@query("flt_open_dlq", """
    SELECT quarantine_reason, count(*) AS n FROM dlq GROUP BY 1""")
def _(t):
    return RP.open_dlq(t.dlq).groupBy("quarantine_reason").agg(F.count("*").alias("n"))


@query("flt_open_pending", "SELECT device_id, count(*) AS n FROM pending GROUP BY 1")
def _(t):
    return RP.open_pending(t.pending).groupBy("device_id").agg(F.count("*").alias("n"))


@query("flt_new_devices", """
    SELECT event_id AS seq, device_id FROM pending
    WHERE device_id IN (SELECT device_id FROM devices WHERE balance < 0)""")
def _(t):
    return RP.for_devices(t.pending, t.new_devices).select(
        X.payload_seq(), "device_id")


@query("flt_confirmed_normal", "SELECT event_id, effective_util_in FROM normal")
def _(t):
    return B.confirmed_normal(t.scored, t.as_of).select("event_id", "effective_util_in")


@query("flt_trailing", """
    SELECT event_id, device_ts FROM enriched
    WHERE device_ts >= (SELECT now FROM latest) - INTERVAL 25 HOUR""")
def _(t):
    return G.trailing(t.enriched, t.as_of).select("event_id", "device_ts")


@query("flt_up_only", "SELECT event_id, oper_status FROM enriched WHERE oper_status = 1")
def _(t):
    return FL.up_only(t.enriched).select("event_id", "oper_status")


@query("flt_nonempty_keys", """
    SELECT event_id FROM stats
    WHERE length(coalesce(device_id, '')) > 0 AND length(coalesce(interface_name, '')) > 0""")
def _(t):
    return t.stats.filter(C.nonempty("device_id") & C.nonempty("interface_name")).select("event_id")


@query("flt_drop_null_key", "SELECT event_id, device_id FROM stats WHERE device_id IS NOT NULL")
def _(t):
    return t.stats.dropna(subset=["device_id"]).select("event_id", "device_id")
