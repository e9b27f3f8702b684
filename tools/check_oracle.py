"""Compare every registered Spark query with its DuckDB oracle SQL.

    python tools/check_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowlens.plans import catalog, oracle  # noqa: E402
from flowlens.plans.check import compare, duckdb_connection  # noqa: E402
from flowlens.session import local_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    con = duckdb_connection(sf_dir)
    qs, sqls = catalog.queries(), oracle.all_sql()
    bad = 0
    for key in sys.argv[2:] or list(qs):
        t0 = time.time()
        r = compare(spark, con, sf_dir, key, qs[key], sqls.get(key))
        bad += not r.ok
        print(f"{key:28s} {'OK' if r.ok else 'MISMATCH'} spark={r.spark_rows} "
              f"oracle={r.oracle_rows} {time.time() - t0:.1f}s {r.detail}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
