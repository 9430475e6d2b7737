"""Summarise the executed (post-AQE) physical plan of every registered query.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

NODES = {
    "shuffles": r"Exchange (?:hashpartitioning|rangepartitioning|RoundRobinPartitioning)",
    "reused": r"ReusedExchange",
    "single-partition": r"Exchange SinglePartition",
    "broadcast joins": r"BroadcastHashJoin",
    "sort-merge joins": r"SortMergeJoin",
    "nested-loop / cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "python": r"EvalPython|InPandas",
    "window group limit": r"WindowGroupLimit",
}


NOTES = """
## Reading the table

* **Where the shuffles come from.** Silver flights take one shuffle (dedup by `flight_id`, with a partial
  `WindowGroupLimit` in each task before it, hence the group-limit counts in pairs). Each rollup adds one shuffle on
  its keys with map-side partial aggregation. The supplied files hold one row group each, so one task reads a file;
  nothing is added for that.
* **Broadcast joins** are dimensions that Spark's own size statistics or AQE found small; none is forced. Beyond the
  threshold they are sort-merge joins whose skewed partitions AQE splits.
* **Sort-merge joins** are passenger events against flights (both sides grow with the data; events are pre-aggregated
  per flight, type and channel first) and the anti joins of the orphan checks (pre-aggregated per key).
* **Single-partition exchanges** are the final stage of global aggregates after partial aggregation, and the positions
  and rank of reports, whose input is one row per route, airport or segment.
* **No** Python evaluation, nested-loop or Cartesian join, and no Spark job while a query is built (both asserted by
  `tests/test_plans.py`).

Regenerate with `python tests/plan_report.py /root/testdata/sf0.01 > PLANS.md`.
"""


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from aerolith.plans.registry import QUERIES
    from aerolith.session import build_session

    spark = build_session(
        "plan-report", master="local[8]", shuffle_partitions=16, extra_conf={"spark.driver.memory": "12g"}
    )
    print(f"# Executed plans of the registered queries\n\nInput `{sf_dir}`, `local[8]`, AQE on. Counts of plan nodes")
    print("in the final adaptive plan (a shuffle that AQE reused is counted once under *reused*).\n")
    print("| query | " + " | ".join(NODES) + " |")
    print("|---|" + "---|" * len(NODES))
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # run this QueryExecution so the adaptive plan is final
        plan = qe.executedPlan().toString()
        final = plan.split("+- == Initial Plan ==")[0]
        counts = [len(re.findall(p, final)) for p in NODES.values()]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")
    print(NOTES)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
