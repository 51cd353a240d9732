"""Compare every registered query with its SQL check: python tests/check_queries.py [sf] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entries  # noqa: E402
from panelweave.session import local_session  # noqa: E402
from tests.oracle import connect, difference  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    spark = local_session("check", "8")
    sf_dir = f"/root/testdata/{sf}"
    db = connect(sf_dir)
    checks = entries.oracle_sql()
    bad = 0
    for name, run in entries.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            result = difference(df, db, checks[name]) if name in checks else f"{len(df.collect())} rows, no check"
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:600]}"
        ok = result is None or result.endswith("no check")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:28s} {time.time() - start:6.2f}s {result or ''}", flush=True)
    print(f"{bad} bad")
