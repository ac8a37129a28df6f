"""Run registered queries against their check SQL: python tests/check.py [sf folder] [name prefix ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

import oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from vitrine.session import local_session  # noqa: E402


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = local_session()
    con = oracle.connect(folder)
    checks, bad = entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            problem = oracle.compare(df, con, checks[name]) if name in checks else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        status = "ok" if problem is None else problem
        if problem and not problem.startswith("rows only"):
            bad.append(name)
        print(f"{name:28} {time.time() - start:6.2f}s  {status}", flush=True)
    print("BAD:", bad)


if __name__ == "__main__":
    main()
