"""Compare each binding with its DuckDB oracle (row count, columns, values).

    python -m chunkwise.plans.verify [--sf DIR] [key ...]

Values are compared order-insensitively with columns sorted by name;
doubles are compared exactly and, separately, to 9 significant digits so
that a summation-order difference is visible as such.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import json
import math
import sys
import time

from chunkwise.plans.tables import TABLES


def _norm(v, digits: int | None):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.{digits}g}") if digits else v
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), digits)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def _rows(cols: list[str], rows: list, digits: int | None) -> list:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda t: json.dumps(t, default=str))


_FAMILY = {"bigint": "int64", "int": "int32", "integer": "int32", "smallint": "int16",
           "tinyint": "int8", "double": "float64", "float": "float32", "real": "float32",
           "string": "str", "varchar": "str", "boolean": "bool", "timestamp_ntz": "ts",
           "timestamp": "ts", "date": "date"}


def type_family(t: str) -> str:
    """Type family with width; DECIMAL and HUGEINT stay distinct on purpose (a
    DECIMAL oracle column against a DOUBLE Spark column hashes differently)."""
    t = t.lower()
    if t.startswith("decimal"):
        return "decimal"
    if t.startswith("array") or t.endswith("[]"):
        return "list"
    return _FAMILY.get(t, t)


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    from chunkwise.plans import ORACLE, QUERIES
    con = con or duckdb_connection(sf_dir)
    t0 = time.time()
    df = QUERIES[key](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if key not in ORACLE:
        res["check"] = "rows-only"
        return res
    cur = con.execute(ORACLE[key])
    o_cols = [c[0] for c in cur.description]
    o_rows = cur.fetchall()
    res.update(oracle_rows=len(o_rows), cols_match=sorted(s_cols) == sorted(o_cols))
    o_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({ORACLE[key]})").fetchall()}
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    res["type_mismatch"] = {c: (s_types.get(c), t) for c, t in o_types.items()
                            if type_family(t) != type_family(s_types.get(c, "?"))}
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(s_cols), sorted(o_cols)
    res["exact"] = res["cols_match"] and _rows(s_cols, s_rows, None) == _rows(o_cols, o_rows, None)
    res["approx"] = res["cols_match"] and _rows(s_cols, s_rows, 9) == _rows(o_cols, o_rows, 9)
    if res["cols_match"] and not res["approx"]:
        a, b = _rows(s_cols, s_rows, 9), _rows(o_cols, o_rows, 9)
        diff = [x for x in a if x not in set(b)][:3] if len(a) < 200000 else []
        res["sample_spark_only"] = [str(x)[:300] for x in diff]
        res["sample_oracle_only"] = [str(x)[:300] for x in b if x not in set(a)][:3]
    return res


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args(argv)
    from chunkwise.plans import QUERIES
    from chunkwise.session import build_session
    spark = build_session()
    con = duckdb_connection(args.sf)
    bad = 0
    for key in args.keys or list(QUERIES):
        try:
            r = compare(spark, key, args.sf, con)
        except Exception as err:  # report and continue
            r = {"key": key, "error": f"{type(err).__name__}: {str(err)[:400]}"}
        ok = r.get("check") == "rows-only" or (r.get("exact") and not r.get("type_mismatch"))
        bad += 0 if ok else 1
        print(json.dumps(r, default=str), flush=True)
    print(json.dumps({"failed": bad}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
