"""Registration of queries and assembly of their oracle SQL."""
from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from telemark.fixtures import Tables, present
from telemark.registry.oracle import CTES

_BUILD: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of `Tables` under an inventory ID."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in _BUILD:
            raise ValueError(f"duplicate query {name}")
        _BUILD[name] = fn
        if sql is not None:
            _SQL[name] = settle_ties(with_ctes(sql))
        return fn

    return add


def with_ctes(sql: str) -> str:
    """Prefix the shared CTEs a statement mentions, each after those it needs."""
    words = set(re.findall(r"\b\w+\b", sql))
    needed = set()
    for name in reversed(list(CTES)):
        if name in words:
            needed.add(name)
            words |= set(re.findall(r"\b\w+\b", CTES[name]))
    parts = [f"{name} AS ({body.strip()})" for name, body in CTES.items() if name in needed]
    sql = sql.strip()
    if not parts:
        return sql
    if sql.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + sql[5:]
    return "WITH " + ",\n".join(parts) + "\n" + sql


def settle_ties(sql: str) -> str:
    """`round(x, 6)` as `round(x + 1e-9, 6)`, as `present` does: means of short
    decimals often end exactly between two roundings, where the last bit of a
    sum would decide."""
    out, rest = "", sql
    while "round(" in rest:
        head, rest = rest.split("round(", 1)
        depth, end = 1, 0
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[end], 0)
            end += 1
        inner, rest = rest[: end - 1], rest[end:]
        if inner.endswith(", 6"):
            inner = f"({settle_ties(inner[:-3])}) + 1e-9, 6"
        out += f"{head}round({inner})"
    return out + rest


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: present(fn(Tables(spark, sf_dir)))

    return {name: bind(fn) for name, fn in _BUILD.items()}


def oracles() -> dict[str, str]:
    return dict(_SQL)
