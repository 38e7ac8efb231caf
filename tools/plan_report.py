"""Final (post-AQE) physical plan shape of every registered query of the range library.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

Per query: shuffles of data (Exchange hashpartitioning / rangepartitioning /
SinglePartition that are not reused), exchanges reused by AQE, broadcasts,
window operators and parquet scans.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from solospan.queries import QUERIES  # noqa: E402
from solospan.session import local_session  # noqa: E402


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    return text.split("== Initial Plan ==")[0]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16)
    print(f"# Final physical plans ({os.path.basename(sf)}, local[8], AQE on)\n")
    print("| query | shuffles | reused exchanges | broadcasts | windows | parquet scans |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, q in QUERIES.items():
        plan = final_plan(q(spark, sf))
        lines = plan.splitlines()
        shuffles = sum(bool(re.search(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", l)) and "ReusedExchange" not in l for l in lines)
        reused = sum("ReusedExchange" in l and "BroadcastExchange" not in l for l in lines)
        broadcasts = sum("BroadcastExchange" in l and "ReusedExchange" not in l for l in lines)
        windows = sum(bool(re.search(r"\bWindow \[", l)) for l in lines)
        scans = sum("FileScan parquet" in l for l in lines)
        print(f"| `{name}` | {shuffles} | {reused} | {broadcasts} | {windows} | {scans} |")


if __name__ == "__main__":
    main()
