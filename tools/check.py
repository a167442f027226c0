"""Run registered queries against their DuckDB oracle and print one line each.

    python tools/check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans import ORACLE, QUERIES  # noqa: E402
from quarry.plans.registry import widen_integers  # noqa: E402
from quarry.plans.verify import compare, duck  # noqa: E402
from quarry.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")] or list(QUERIES)
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            if name in ORACLE:
                res = compare(spark, name, lambda s, d, f=QUERIES[name]: widen_integers(f(s, d)), ORACLE[name], sf_dir, con)
            else:
                n = QUERIES[name](spark, sf_dir).count()
                res = {"name": name, "rows_spark": n, "match": None}
        except Exception as e:  # report and continue
            res = {"name": name, "error": f"{type(e).__name__}: {str(e)[:600]}", "match": False}
        res["sec"] = round(time.time() - t0, 2)
        bad += res.get("match") is False
        print(json.dumps(res, default=str), flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
