"""Run registered queries against their DuckDB oracles and print a summary.

    python tools_check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import json
import sys
import time
import traceback


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    prefixes = argv[2:]
    from dimweave.plans.oracle_check import compare, duckdb_connection
    from dimweave.plans.registry import ORACLE, QUERIES, load_all
    from dimweave.session import build_session

    load_all()
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("OFF")
    import os
    if "SESSION_TZ" in os.environ:
        spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    for kv in filter(None, os.environ.get("SPARK_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        spark.conf.set(k, v)
    con = duckdb_connection(sf_dir)
    bad = 0
    for name in sorted(QUERIES):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            if name in ORACLE:
                res = compare(spark, con, name, QUERIES[name], ORACLE[name], sf_dir)
            else:
                n = QUERIES[name](spark, sf_dir).count()
                res = {"name": name, "spark_rows": n, "ok": True, "rows_only": True}
        except Exception as e:  # noqa: BLE001
            res = {"name": name, "ok": False, "error": f"{type(e).__name__}: {e}"[:600]}
            traceback.print_exc(limit=2)
        res["sec"] = round(time.time() - t0, 2)
        bad += not res["ok"]
        print(json.dumps(res, default=str), flush=True)
    print(f"FAILED {bad}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
