"""Write PLANS.md: the physical operator tree of every registered query.

    python scripts/plan_digest.py [--sf /root/testdata/sf0.001]

Expressions are left out (they are long); the tree shows scans with their read
schema, exchanges (shuffles), aggregates, joins and generators, which is what
decides how a query scales.  Plans are the initial adaptive plans (AQE may
coalesce partitions or switch join strategies at run time).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def digest(plan, depth=0, out=None):
    out = [] if out is None else out
    name = plan.nodeName()
    extra = ""
    if name.startswith("Scan"):
        try:
            meta = plan.metadata()
            schema = meta.get("ReadSchema").get() if meta.contains("ReadSchema") else ""
            pushed = meta.get("PushedFilters").get() if meta.contains("PushedFilters") else ""
            extra = f" ReadSchema={schema}" + (f" PushedFilters={pushed}" if pushed and pushed != "[]" else "")
        except Exception:  # noqa: BLE001 - scans without file metadata
            extra = ""
    elif "Exchange" in name:
        extra = " " + plan.simpleString(200).split("[plan_id")[0].replace(name, "").strip()[:120]
    elif "Join" in name:
        extra = " " + plan.simpleString(400).split(",")[0].replace(name, "").strip()[:80]
    out.append("  " * depth + name + extra)
    children = plan.children()
    for i in range(children.size()):
        digest(children.apply(i), depth + 1, out)
    return out


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"))
    args = ap.parse_args()

    from quire.queries import QUERIES
    from quire.session import local_session

    spark = local_session(8)
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `scripts/plan_digest.py` on `{os.path.basename(args.sf)}` (local[8]); operator trees",
        "only. `Exchange RoundRobinPartitioning` is `spread` (only when the input has fewer splits than",
        "cores); every other exchange is listed on purpose in README §Design for scale.",
        "",
    ]
    for name, fn in QUERIES.items():
        df = fn(spark, args.sf)
        plan = df._jdf.queryExecution().executedPlan()
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.executedPlan()
        tree = digest(plan)
        n_ex = sum("Exchange" in t and "RoundRobin" not in t for t in tree)
        lines += [f"## {name}", "", f"shuffles (besides spread): {n_ex}", "", "```", *tree, "```", ""]
    with open(args.out, "w") as f:
        f.write("\n".join(lines))
    print("wrote", args.out)


if __name__ == "__main__":
    main()
