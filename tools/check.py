"""Compare named queries with their SQL: python tools/check.py SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from compare import connect, difference  # noqa: E402

from tallyfold.plans.catalogue import REGISTRY  # noqa: E402
from tallyfold.session import local_session  # noqa: E402


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    names = [n for want in names for n in REGISTRY if n == want or (want.endswith("*") and n.startswith(want[:-1]))]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        q, started = REGISTRY[name], time.time()
        try:
            df = q.run(spark, sf_dir)
            if q.sql is None:
                rows = df.collect()
                verdict = f"rows-only {len(rows)} {str(rows[:2])[:300]}"
            else:
                said = difference(df, con, q.sql)
                verdict = "ok" if said is None else f"DIFF {said[:700]}"
                bad += said is not None
        except Exception as e:  # report and go on with the next query
            bad += 1
            verdict = f"ERROR {type(e).__name__}: {str(e)[:700]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        print(f"{time.time() - started:6.2f}s {name}: {verdict}", flush=True)
    print(f"{len(names)} checked, {bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(min(main(), 1))
