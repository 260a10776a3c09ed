"""Compare queries with their SQL: ``python tests/compare.py SF_DIR [name ...]``."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]

import __spark_entry__ as contract  # noqa: E402
from harness import connect, difference  # noqa: E402

from stratawork.session import build_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in names or queries:
        begin = time.perf_counter()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
            else:
                problem = None if df.count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        seconds = time.perf_counter() - begin
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {seconds:6.2f}s {'' if name in oracles else '(rows only) '}{problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
