"""Summarise the physical plan of every registered query.

    python -m tools.plan_report [sf_dir] > PLANS.md

Per query: shuffles by kind, file scans and the columns they read,
aggregate operators, joins, top-k, sliding-window expansion, and whether any
Python evaluation node appears.  The final adaptive plan is walked node by
node (into query stages, reused exchanges and scalar subqueries; a reused
stage or subquery is counted once), after running the query to the noop
sink.
"""

from __future__ import annotations

import sys
from collections import Counter

PYTHON_NODES = {"BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"}


def _seq(s):
    return [s.apply(i) for i in range(s.size())]


def walk(plan):
    """Yield every physical node once, following stages and subqueries."""
    seen: set[int] = set()
    stack = [plan]
    while stack:
        node = stack.pop()
        ident = node.id() if hasattr(node, "id") else None
        key = ident if isinstance(ident, int) else id(node)
        name = node.nodeName()
        if name.startswith("Reused") or name.endswith("QueryStage"):
            # reused stage/subquery: follow the original once
            target = node.plan() if name.endswith("QueryStage") else node.child()
            tid = target.id()
            if tid in seen:
                continue
            seen.add(tid)
            stack.append(target)
            continue
        if key in seen:
            continue
        seen.add(key)
        yield node
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        stack.extend(_seq(node.children()))
        stack.extend(_seq(node.subqueries()))


def summarize(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan()
    names = Counter()
    cols: set[str] = set()
    shuffles = Counter()
    for node in walk(plan):
        name = node.nodeName()
        names[name] += 1
        if name == "Exchange":
            text = node.simpleString(1000)
            kind = ("hash" if "hashpartitioning" in text else "range" if "rangepartitioning" in text
                    else "single" if "SinglePartition" in text else "other")
            shuffles[kind] += 1
        if name.startswith("Scan ") or name.startswith("FileScan"):
            names["_scan"] += 1
            try:
                cols.update(node.requiredSchema().fieldNames())
            except Exception:  # not a file-source scan
                pass
    return {"names": names, "shuffles": shuffles, "cols": sorted(cols)}


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from logsentinel.plans.catalog import REGISTRY
    from logsentinel.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    print("# Physical plan summary\n")
    print(f"Generated by `python -m tools.plan_report {sf_dir}` from the final adaptive plans;")
    print("reused stages and subqueries are counted once.\n")
    print("| query | shuffles (hash / range / single) | file scans | columns read | aggregates | joins | top-k | expand | python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in REGISTRY.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarize(df)
        n = s["names"]
        aggs = ", ".join(f"{k}×{v}" for k, v in sorted(n.items()) if k.endswith("Aggregate")) or "—"
        joins = ", ".join(f"{k}×{v}" for k, v in sorted(n.items()) if k.endswith("Join")) or "—"
        sh = s["shuffles"]
        print(
            f"| {name} | {sh['hash']} / {sh['range']} / {sh['single']} | {n['_scan']} | "
            f"{', '.join(s['cols']) or '—'} | {aggs} | {joins} | "
            f"{'yes' if n['TakeOrderedAndProject'] else ''} | {'yes' if n['Expand'] else ''} | "
            f"{'YES' if any(n[p] for p in PYTHON_NODES) else 'no'} |"
        )
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
