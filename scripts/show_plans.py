"""Write the physical plans of some queries to PLANS.md, as adaptive execution left them.

usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402
from tidemark.suite import QUERIES  # noqa: E402

NOTES = {
    "cdc_merge": "Watermark pushed into the history scan (`PushedFilters: GreaterThan(o_orderkey, ...)`); "
                 "keep-last as a Partial `WindowGroupLimit` below the exchange; the snapshot side is a "
                 "plain scan into a `BroadcastHashJoin LeftAnti` whose build side is the partially "
                 "aggregated set of changed keys.",
    "keep_latest": "Partial `WindowGroupLimit` before `Exchange hashpartitioning(user_id)`: map tasks "
                   "forward at most one row per key, so a hot key does not move its rows.",
    "max_over_keep_ties": "Partial `max` per key before the shuffle, then a semi join on (key, max).",
    "federated_join": "Plain Spark SQL over the registered datasets: column pruning to the scans, "
                      "broadcast of the small dimensions, partial aggregation.",
    "range_read_once": "One scan of orders; the range id is a binary search in one array of tile begins: "
                       "no shuffle, each row once.",
    "merge_three_clause": "The target is scanned once; the changes, one row per key, are the small side of "
                          "the anti join.",
    "source_slice": "Offset and limit as filters on exact order statistics: ranges that reach the scan and, "
                    "for the dates at the two ends, a cut by the next column. No sort of all rows into one task.",
    "version_upsert": "Reading the result: one scan over the live part directories of any version.",
    "reconcile_buckets": "Reading the result; the comparison before it is one partial aggregate per side and "
                         "part, and a join of the parts that differ, which the scan gets as key ranges.",
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[4]", shuffle_partitions=8)
    out = ["# Physical plans of headline queries", "",
           f"Generated by `scripts/show_plans.py` at `{sf}`, after each query ran.", ""]
    for name, note in NOTES.items():
        df = QUERIES[name](spark, sf)
        df.collect()        # runs the frame's own plan, which is final afterwards
        plan = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", note, "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
