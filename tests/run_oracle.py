"""Run named queries against their DuckDB text: python tests/run_oracle.py <sf dir> [name ...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from gridspark.session import get_spark  # noqa: E402


def main(sf: str, names: list[str]) -> int:
    spark = get_spark("oracle", "local[8]", 8, **{"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        t0 = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracles:
                problems = compare(df, oracles[name], con)
                status = "ok" if not problems else "FAIL " + " | ".join(problems)[:700]
            else:
                rows = df.collect()
                status = f"rows-only {len(rows)}" if rows else "FAIL no rows"
                status += f"  {rows[0]}"[:160] if rows else ""
        except Exception as e:  # report and go on with the next query
            status = "FAIL " + (str(e).split("JVM stacktrace")[0][:600] if "-v" not in sys.argv else traceback.format_exc())
        failed += status.startswith("FAIL")
        print(f"{name:28s} {time.time() - t0:6.1f}s {status}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], [a for a in sys.argv[2:] if a != "-v"])))
