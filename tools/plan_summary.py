"""Print the physical plan of catalog queries as an indented operator list.

    python tools/plan_summary.py [--run] [--sf DIR] query ...

Cached relations are shown as one line (their plan ran once, when cached).
With ``--run`` the query executes first and the final adaptive plan is shown.
"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from strata.plans.catalog import QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402

KEEP = (
    "Exchange", "BroadcastExchange", "Join", "Aggregate", "Window", "WindowGroupLimit",
    "Sort", "TakeOrdered", "Scan", "InMemoryTableScan", "Subquery", "Generate", "Union",
    "Expand", "AQEShuffleRead", "ShuffleQueryStage", "BroadcastQueryStage", "Reused",
)


def walk(node, depth=0, out=None):
    out = [] if out is None else out
    name = node.nodeName()
    text = node.simpleString(200)
    if any(k in name for k in KEEP):
        out.append("  " * depth + text[:220])
        depth += 1
    if name == "InMemoryTableScan":
        return out
    children = node.children()
    for i in range(children.size()):
        walk(children.apply(i), depth, out)
    # adaptive plans keep their tree in executedPlan / inputPlan
    if name == "AdaptiveSparkPlan":
        walk(node.executedPlan(), depth, out)
    if name in ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage"):
        walk(node.plan(), depth, out)
    return out


def main() -> None:
    args = sys.argv[1:]
    run = "--run" in args
    sf = "/root/testdata/sf0.01"
    if "--sf" in args:
        sf = args[args.index("--sf") + 1]
    names = [a for a in args if not a.startswith("--") and not a.startswith("/")]
    spark = build_session("local[8]", 8)
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf)
        built = time.time() - t0
        if run:
            t0 = time.time()
            df.write.format("noop").mode("overwrite").save()
            print(f"== {name}: build {built:.1f}s, run {time.time() - t0:.1f}s")
        else:
            print(f"== {name}: build {built:.1f}s")
        plan = df._jdf.queryExecution().executedPlan()
        print("\n".join(walk(plan)))


if __name__ == "__main__":
    main()
