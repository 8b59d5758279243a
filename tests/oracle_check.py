"""Compare every registered query with its DuckDB twin; usable as a script."""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        v = round(v, 6)
        return 0.0 if v == 0 else v
    return v


def _key(row):
    return tuple((v is None, type(v).__name__ if not isinstance(v, (int, float)) else "n", v if v is not None else 0)
                 for v in row)


def _close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1.5e-6 * max(1.0, abs(a) * 1e-3)
    return a == b


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs. Exact after rounding to six places, and
    `~` marks differences in the last place only."""
    cols = sorted(spark_df.columns)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}"
    order = [names.index(c) for c in cols]
    want = sorted((tuple(_cell(r[i]) for i in order) for r in cur.fetchall()), key=_key)
    got = sorted((tuple(_cell(r[c]) for c in cols) for r in spark_df.collect()), key=_key)
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    if want == got:
        return None
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    soft = all(len(g) == len(w) and all(_close(a, b) for a, b in zip(g, w)) for g, w in bad)
    return f"{'~' if soft else ''}{len(bad)} rows differ, e.g. {dict(zip(cols, bad[0][0]))} != {dict(zip(cols, bad[0][1]))}"


def types(spark_df, con, sql: str) -> list[str]:
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    pairs = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
    }
    return [
        f"{f.name}: {f.dataType.simpleString()} / {kinds.get(f.name)}"
        for f in spark_df.schema.fields
        if pairs.get(f.dataType.simpleString()) != kinds.get(f.name)
    ]


def main() -> int:
    from telemark.registry import oracles, registered
    from telemark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session(
        "oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                       "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = duck(sf_dir), oracles(), 0
    for name, build in registered().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        begin = time.time()
        try:
            df = build(spark, sf_dir)
            if name in sql:
                problem = compare(df, con, sql[name])
                odd = types(df, con, sql[name])
                note = problem or "ok"
                if odd:
                    note += f"  TYPES {odd}"
            else:
                note = f"rows only: {len(df.collect())}"
                problem = None
        except Exception as exc:  # noqa: BLE001
            problem = note = f"ERROR {type(exc).__name__}: {str(exc)[:600]}"
        if problem:
            failed += 1
        print(f"{name:28s} {time.time() - begin:6.2f}s {note}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
