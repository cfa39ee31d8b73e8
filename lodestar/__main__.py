"""Command line: list the registered queries or run one and show its rows.

    python -m lodestar list
    python -m lodestar show <query> [sf_dir] [rows]

``show`` prints the first rows the way the studied programs' ``show()``
calls did; the query itself runs in full on Spark.
"""

from __future__ import annotations

import re
import sys
import tempfile

from lodestar.plans import NOTES, ORACLES, QUERIES

USAGE = "usage: python -m lodestar list | show <query> [sf_dir] [rows]"


def main(argv: list[str]) -> int:
    if len(argv) < 2 or argv[1] not in ("list", "show"):
        print(USAGE)
        return 2
    if argv[1] == "list":
        for name in sorted(QUERIES):
            kind = "oracle" if name in ORACLES else "rows-only"
            print(f"{name:30s} {kind:9s} {NOTES.get(name, '')}")
        return 0
    if len(argv) < 3 or argv[2] not in QUERIES:
        print(USAGE)
        return 2
    sf_dir = argv[3] if len(argv) > 3 else "/root/testdata/sf0.01"
    rows = int(argv[4]) if len(argv) > 4 else 20
    from lodestar.session import build_session, use_checkpoint_dir

    spark = build_session()
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # on a cluster the session names shared storage
        use_checkpoint_dir(spark, lambda: tempfile.mkdtemp(prefix="lodestar-"))
    df = QUERIES[argv[2]](spark, sf_dir)
    df.printSchema()
    df.show(rows, truncate=80)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
