"""Run registered queries and their SQL twins side by side and report differences.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, build, sql, sf_dir):
    """None when both sides agree, else what differs."""
    df = build(spark, sf_dir)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    right = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = {c: t for c, t in df.dtypes}
    kinds = {d[0]: str(d[1]).upper() for d in cur.description}
    for c in columns:
        whole = types[c] in ("bigint", "int")
        if whole != (kinds[c] in ("BIGINT", "INTEGER", "NUMBER", "HUGEINT")) and kinds[c] != "NUMBER":
            return f"type of {c}: {types[c]} vs {kinds[c]}"
        if kinds[c] == "HUGEINT":
            return f"type of {c}: {types[c]} vs {kinds[c]}"
    if left != right:
        extra = [r for r in left if r not in set(right)][:3]
        missing = [r for r in right if r not in set(left)][:3]
        return f"rows {len(left)} vs {len(right)}; spark only {extra}; sql only {missing}"
    return None


def main() -> int:
    from tallyloom.catalog import ORACLES, QUERIES
    from tallyloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name, build in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, name, build, ORACLES[name], sf_dir)
                label = "ok  "
            else:
                n = build(spark, sf_dir).count()
                problem, label = None, f"rows={n}"
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        took = time.time() - start
        if problem:
            bad += 1
            print(f"BAD  {name} ({took:.1f}s): {problem}", flush=True)
        else:
            print(f"{label} {name} ({took:.1f}s)", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
