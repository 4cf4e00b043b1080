"""Run every registered query against its DuckDB oracle (row count, columns, value hash).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

# plan nodes that would mean rows leave the JVM
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v) if v is not None else "NULL"


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, sf_dir, names=None):
    import __spark_entry__ as entry

    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            plan = df._jdf.queryExecution().executedPlan().toString()
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as exc:  # noqa: BLE001
            report[name] = {"ok": False, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
            continue
        secs = round(time.time() - t0, 2)
        entry_ = {"rows": len(rows), "sec": secs}
        python_nodes = [tok for tok in PYTHON_NODES if tok in plan]
        if python_nodes:
            entry_["python_nodes"] = python_nodes
        if name in oracle:
            cur = con.execute(oracle[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
            entry_.update(oracle_rows=len(orows), cols_match=sorted(cols) == sorted(ocols),
                          hash_match=digest(cols, rows) == digest(ocols, orows))
            entry_["ok"] = (entry_["cols_match"] and entry_["hash_match"] and len(rows) == len(orows)
                            and not python_nodes)
            if not entry_["cols_match"]:
                entry_["cols"] = [sorted(cols), sorted(ocols)]
        else:
            entry_["ok"] = not python_nodes
            entry_["rows_only"] = True
        report[name] = entry_
    return report


if __name__ == "__main__":
    from strata.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    rep = check(spark, sf, names)
    for k, v in rep.items():
        print(k, json.dumps(v))
    bad = [k for k, v in rep.items() if not v.get("ok")]
    print("FAILED:", bad if bad else "none")
