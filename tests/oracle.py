"""Spark-vs-DuckDB comparison used by the tests (row count, column names, order-free values).

Run as a script to check registered queries:  python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

GENERATED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
             "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in GENERATED:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    if s_rows and any(isinstance(v, float) for v in s_rows[0]) and "round(" not in sql[:200]:
        res["warn"] = "doubles not rounded in SQL"
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = "columns"
        res["detail"] = f"spark-only {sorted(set(s_cols) - set(d_cols))} oracle-only {sorted(set(d_cols) - set(s_cols))}"
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if len(a) != len(b):
        res["status"] = "rowcount"
        return res
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        res["status"] = "values"
        res["detail"] = f"{len(bad)} rows differ; first: spark={bad[0][0]} oracle={bad[0][1]}"
        return res
    res["status"] = "ok"
    return res


def write_doubles(sf_dir: str) -> int:
    """Regenerate coursepulse/plans/output_doubles.py from the Spark output schemas."""
    from pyspark.sql import types as T

    from coursepulse.plans.registry import load_all
    from coursepulse.session import get_spark

    spark = get_spark("local[8]")
    out = {}
    for name, e in load_all().items():
        if not e.body:
            continue
        schema = e.fn(spark, sf_dir).schema
        d = [f.name for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
        if d:
            out[name] = d
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "coursepulse", "plans", "output_doubles.py")
    with open(path, "w") as fh:
        fh.write('"""Double-typed output columns of each registered query (generated by tests/oracle.py --doubles)."""\n\n')
        fh.write("OUTPUT_DOUBLES: dict[str, list[str]] = {\n")
        for k in sorted(out):
            fh.write(f"    {k!r}: {out[k]!r},\n")
        fh.write("}\n")
    print(f"wrote {len(out)} entries")
    return 0


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from coursepulse.plans.registry import load_all
    from coursepulse.session import get_spark

    sf_dir = argv[0] if argv and os.path.isdir(argv[0]) else "/root/testdata/sf0.01"
    names = [a for a in argv if not os.path.isdir(a) and not a.startswith("--")]
    if "--doubles" in argv:
        return write_doubles(sf_dir)
    if os.environ.get("COURSEPULSE_PLAIN_SESSION"):
        # a session with Spark's defaults only, as an external driver may create it
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = get_spark("local[8]")
    reg = load_all()
    con = duck(sf_dir)
    failed = 0
    for name, e in reg.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        try:
            r = compare(spark, name, e.fn, e.sql, sf_dir, con)
        except Exception as exc:  # report and go on
            r = {"name": name, "status": "error", "detail": str(exc).splitlines()[0][:300]}
        failed += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
