"""Write the formatted physical plan of queries to docs/plans/<name>.txt.

    python tools/plans.py [sf_dir] [name ...]     (default: headline queries)
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from quarry.plans import HEADLINE, QUERIES  # noqa: E402
from quarry.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in argv[1:] if not a.startswith("/")] or list(HEADLINE)
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    spark = build_session()
    for name in names:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(buf.getvalue().replace("\x00", ""))
        print(name)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
