"""Run catalog queries in Spark and their SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (float, Decimal)):
        value = float(value)
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def family(kind: str) -> str:
    kind = kind.lower()
    if kind.startswith("decimal"):
        return "decimal"
    return {"bigint": "int8", "long": "int8", "int": "int4", "integer": "int4", "varchar": "string",
            "timestamp_ntz": "timestamp", "timestamp_ns": "timestamp",
            "timestamp with time zone": "timestamptz"}.get(kind, kind)


def check(spark, con, entry, folder: str) -> str | None:
    """``None`` when equal, else a short description."""
    df = entry.run(spark, folder)
    rows, columns = df.collect(), df.columns
    if entry.sql is None:
        return None if columns else "no columns"
    rel = con.sql(entry.sql)
    kinds = {c: family(str(t)) for c, t in zip(rel.columns, rel.types)}
    mine = {c: family("timestamptz" if t == "timestamp" else t) for c, t in df.dtypes}
    if sorted(columns) != sorted(rel.columns):
        return f"columns {sorted(columns)} vs {sorted(rel.columns)}"
    got, want = normal(rows, columns), normal(rel.fetchall(), rel.columns)
    if got != want:
        diff = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return f"rows {len(got)} vs {len(want)}; {diff}"
    if mine != kinds:
        return "types " + str({c: (mine[c], kinds[c]) for c in mine if mine[c] != kinds[c]})
    return None


def main() -> int:
    from shillingflow.catalog import CATALOG
    from shillingflow.session import build_session

    folder = sys.argv[1]
    keys = sys.argv[2:] or list(CATALOG)
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for key in keys:
        start = time.time()
        try:
            problem = check(spark, con, CATALOG[key], folder)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {'ok ' if problem is None else 'BAD'} {key} {problem or ''}", flush=True)
    print("bad:", bad, "of", len(keys))
    return bad


if __name__ == "__main__":
    sys.exit(main())
