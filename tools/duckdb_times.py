"""Time the oracle SQL of the headline queries in DuckDB (best of 3)."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from issuelens.plans.oracle import oracle_sql  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
names = sys.argv[2:] or ["status_timeline", "status_transitions", "status_chains", "merged_pr_issue_keys"]
con = duckdb.connect()
for t in ["customer", "orders", "lineitem", "events"]:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
sql = oracle_sql()
out = {}
for n in names:
    best = None
    for _ in range(3):
        t0 = time.time()
        con.execute(sql[n]).fetchall()
        d = time.time() - t0
        best = d if best is None else min(best, d)
    out[n] = round(best, 3)
print(json.dumps(out))
