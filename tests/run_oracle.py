"""Run every registered query against its DuckDB oracle: python tests/run_oracle.py [sf_dir] [name...]"""

import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

from compare import compare, duck  # noqa: E402

import __spark_entry__ as e  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = local_session(8)
con = duck(sf)
qs, sqls = e.queries(), e.oracle_sql()
bad = 0
for name, q in qs.items():
    if only and name not in only:
        continue
    t = time.time()
    try:
        ok, msg = compare(q(spark, sf), con, sqls[name]) if name in sqls else (True, "no oracle")
    except Exception as ex:  # report and continue
        ok, msg = False, f"{type(ex).__name__}: {str(ex)[:400]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t:6.1f}s {msg}", flush=True)
print("failures:", bad)
