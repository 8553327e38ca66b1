"""Run every registered query against its DuckDB SQL: python tests/run_oracle.py [sf_dir] [keys...]"""

import sys
import time

sys.path.insert(0, ".")
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from reelrank.session import local_session  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
keys = sys.argv[2:] or list(queries())
spark = local_session(8)
con = duck(sf)
sqls = oracle_sql()
bad = 0
for k in keys:
    t0 = time.time()
    df = queries()[k](spark, sf)
    if k in sqls:
        ok, msg = compare(df, sqls[k], con)
    else:
        n = df.count()
        ok, msg = True, f"rows-only: {n}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {k:32s} {time.time() - t0:6.1f}s {msg}", flush=True)
print("failures:", bad)
