"""Run every registered query against its DuckDB oracle.

    python tests/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from rollcall.session import build_session  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    names = args or sorted(qs)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = qs[n](spark, sf_dir)
            if n not in sqls:
                cnt = df.count()
                print(f"[rows-only] {n}: {cnt} rows ({time.time() - t0:.1f}s)")
                continue
            ok, msg = compare(df, con, sqls[n])
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
            traceback.print_exc(limit=2)
        bad += 0 if ok else 1
        print(f"[{'ok' if ok else 'FAIL'}] {n}: {msg} ({time.time() - t0:.1f}s)", flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
