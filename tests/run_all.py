"""Command line check: python tests/run_all.py [sf] [name-prefix ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from compare import differences, duck  # noqa: E402

from curbflow.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    path = f"/root/testdata/sf{sf}"
    spark, con, sql = local_session("8"), duck(path), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        t = time.time()
        try:
            df = query(spark, path)
            if name in sql:
                diff = differences(df, con, sql[name])
                state = "ok" if not diff else "DIFF\n    " + "\n    ".join(diff)
            else:
                state = f"rows only: {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            state = f"ERROR {type(e).__name__}: {str(e)[:900]}"
        bad += not (state == "ok" or state.startswith("rows only"))
        print(f"{name:32} {time.time() - t:6.2f}s {state}", flush=True)
    print("failed:", bad)
