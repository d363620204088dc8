"""Summarize the physical plan of every registered query (sf0.01 by default):
shuffles, join strategies, map-side group limits, Python stages and pushed
filters.  Writes a Markdown table to stdout.

usage: python scripts/plan_notes.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomis.plans.registry import load_all  # noqa: E402
from loomis.session import build_session  # noqa: E402

PATTERNS = {
    "shuffles": r"^\(\d+\) Exchange$",
    "broadcasts": r"^\(\d+\) BroadcastExchange$",
    "smj": r"^\(\d+\) SortMergeJoin",
    "bhj": r"^\(\d+\) BroadcastHashJoin",
    "bnlj": r"^\(\d+\) BroadcastNestedLoopJoin",
    "group_limit": r"^\(\d+\) WindowGroupLimit",
    "windows": r"^\(\d+\) Window$",
    "python": r"^\(\d+\) (MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython)",
}


def summarize(df) -> dict:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    lines = [ln.strip() for ln in buf.getvalue().splitlines()]
    out = {k: sum(1 for ln in lines if re.match(p, ln)) for k, p in PATTERNS.items()}
    out["pushed"] = sum(1 for ln in lines if ln.startswith("PushedFilters: [") and ln != "PushedFilters: []")
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session(shuffle_partitions=8)
    queries, _ = load_all()
    cols = list(PATTERNS) + ["pushed"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name in args.names or sorted(queries):
        if name.startswith("stream_") or name in ("read_sectioned_tasks", "write_training_set", "store_generations"):
            continue  # these run a job while building their result; their plans are file scans
        s = summarize(queries[name](spark, args.sf))
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
