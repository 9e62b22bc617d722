"""Summarise the physical plan of every binding (plan review tool).

    python -m chunkwise.plans.explain [--sf DIR] > PLANS.md

For each key: exchanges (hash / range / single-partition), broadcasts,
join and aggregate operators, and whether the Parquet scans prune columns
and push filters.  Bindings that checkpoint (global positions) show the
plan *after* the checkpoint; streaming and model bindings are skipped.
"""

from __future__ import annotations

import argparse
import re
import sys

SKIP = {"train_forest", "score_batch", "score_single", "model_roundtrip", "stream_score",
        "stream_ledger", "stream_quarantine", "dedupe_redelivery", "dedupe_late", "stream_decode",
        "predict_run", "stream_progress", "stream_combine"}
OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
       "BroadcastExchange", "BroadcastHashJoin", "BroadcastNestedLoopJoin", "SortMergeJoin",
       "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window",
       "TakeOrderedAndProject", "Generate", "CartesianProduct", "BatchEvalPython"]


def summarise(plan: str) -> dict:
    out = {op: plan.count(op) for op in OPS if plan.count(op)}
    out["scans"] = len(re.findall(r"FileScan parquet", plan))
    out["pushed"] = len([p for p in re.findall(r"PushedFilters: \[([^\]]*)", plan) if p])
    out["checkpointed"] = "ExistingRDD" in plan or "LogicalRDD" in plan or "Scan ExistingRDD" in plan
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args(argv)
    from chunkwise.plans import QUERIES
    from chunkwise.session import build_session
    spark = build_session()
    print("| key | exchanges / joins / aggregates | scans (pushed) | checkpointed input |")
    print("|---|---|---|---|")
    for key, fn in QUERIES.items():
        if key in SKIP:
            continue
        df = fn(spark, args.sf)
        df.write.format("noop").mode("overwrite").save()      # final adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        ops = ", ".join(f"{k}×{v}" for k, v in s.items() if k in OPS) or "none (narrow)"
        print(f"| {key} | {ops} | {s['scans']} ({s['pushed']}) | "
              f"{'yes' if s['checkpointed'] else ''} |", flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
