"""Run registered queries against their SQL: ``python tests/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from riskmart.session import build_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main() -> None:
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                diff = differences(df, con, oracles[name])
                state = "ok" if not diff else "DIFF " + "\n  ".join(diff)
            else:
                state = f"rows {len(df.collect())}"
        except Exception as e:  # noqa: BLE001 - the report goes on
            state = "ERROR " + (str(e)[:1500] if "-v" not in sys.argv else traceback.format_exc())
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{name:28s} {time.time() - t:6.2f}s {state}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
